"""Composed plans over the driver's tables: series sets, metadata tables, requests."""
