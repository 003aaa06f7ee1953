"""Calendar arithmetic on TIMESTAMP_NTZ columns, daily ('D') and month-end ('M').

Month-end stepping follows the reference's offset semantics (quirk Q9): one
step from a mid-month timestamp lands on the end of the *same* month, one step
from a month end lands on the end of the *next* month; the time of day is kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FREQS = ("D", "M")


def check_freq(freq: str) -> str:
    """Only daily and month-end are supported; the reference silently treated
    any other code as daily (quirk Q8), we reject it."""
    if freq not in FREQS:
        raise ValueError(f"freq must be one of {FREQS}, got {freq!r}")
    return freq


def day_floor(c: Column) -> Column:
    """Midnight of the timestamp's day (TIMESTAMP_NTZ)."""
    return F.to_date(c).cast("timestamp_ntz")


def month_end(c: Column) -> Column:
    """Midnight of the last day of the timestamp's month."""
    return F.last_day(F.to_date(c)).cast("timestamp_ntz")


def floor_to(c: Column, grain: str) -> Column:
    """Truncate a timestamp to its day ('D') or its month-end ('M') label."""
    return day_floor(c) if check_freq(grain) == "D" else month_end(c)


def time_of_day(c: Column) -> Column:
    """Time since midnight, as a day-time interval."""
    return c - day_floor(c)


def is_month_end(c: Column) -> Column:
    """True when the timestamp falls on the last day of its month."""
    return F.to_date(c) == F.last_day(F.to_date(c))


def add_steps(c: Column, i: Column, freq: str) -> Column:
    """``c`` advanced by ``i`` (>= 1) steps of ``freq``."""
    if check_freq(freq) == "D":
        return F.timestamp_add("DAY", i, c)
    shift = i - F.when(is_month_end(c), F.lit(0)).otherwise(F.lit(1))
    return F.last_day(F.add_months(F.to_date(c), shift)).cast("timestamp_ntz") + time_of_day(c)


def sql_add_steps(ts: str, i: str, freq: str) -> str:
    """DuckDB twin of ``add_steps``."""
    if check_freq(freq) == "D":
        return f"({ts} + to_days(CAST({i} AS INTEGER)))"
    d = f"CAST({ts} AS DATE)"
    shift = f"(CAST({i} AS INTEGER) - CASE WHEN {d} = last_day({d}) THEN 0 ELSE 1 END)"
    return (f"(CAST(last_day({d} + to_months({shift})) AS TIMESTAMP)"
            f" + ({ts} - CAST({d} AS TIMESTAMP)))")
