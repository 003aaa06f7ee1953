"""Structured Streaming operators (rows 66-70)."""
