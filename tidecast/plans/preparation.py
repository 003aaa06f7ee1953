"""The data-preparation flow as one plan: sample ids, cut, re-date.

Daily: ids ``prefix1 .. prefix(n-1)`` (n-1 series), last ``keep`` points,
re-dated daily from ``start``.  Monthly: ids ``prefix1 .. prefixn`` (n series),
first ``keep`` points, re-dated to month ends from ``start``'s month
(quirk Q1 keeps the two id ranges as they are).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidecast.operators.select import id_range, sample_series_ids
from tidecast.operators.timeindex import rebase_daily, rebase_monthly


def prepare_daily(df: DataFrame, n: int, keep: int = 1020, start: str = "2020-01-01",
                  prefix: str = "") -> DataFrame:
    """Ids 1..n-1, last ``keep`` points, re-dated daily from ``start``."""
    return rebase_daily(sample_series_ids(df, id_range(prefix, 1, int(n))), keep=keep, start=start)


def prepare_monthly(df: DataFrame, n: int, keep: int = 60, start: str = "2018-01-01",
                    prefix: str = "") -> DataFrame:
    """Ids 1..n, first ``keep`` points, re-dated to month ends from ``start``."""
    return rebase_monthly(sample_series_ids(df, id_range(prefix, 1, int(n) + 1)), keep=keep, start=start)
