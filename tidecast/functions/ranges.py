"""Safe integer/date ranges.

``sequence(a, b)`` counts *down* when ``a > b``; every range in this package
that may be empty goes through ``upto``, which is NULL (no rows after
``explode``) instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upto(start, stop) -> Column:
    """``sequence(start, stop)`` when ``stop >= start``, else NULL (no rows once exploded)."""
    a = start if isinstance(start, Column) else F.lit(start)
    b = stop if isinstance(stop, Column) else F.lit(stop)
    return F.when(b >= a, F.sequence(a, b))


def positive(name: str, value) -> int:
    """Validate a count or horizon: an int >= 1."""
    v = int(value)
    if v < 1:
        raise ValueError(f"{name} must be >= 1, got {value!r}")
    return v
