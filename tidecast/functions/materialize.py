"""Reliable materialisation of intermediate results.

``materialize`` writes a DataFrame to the shared folder the cluster names in
``spark.checkpoint.dir`` (a reliable checkpoint, never a local one) and
returns a DataFrame reading it back: later branches reuse it instead of
recomputing, and lost executors do not replay the lineage before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidecast.session import ensure_checkpoint_dir


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint of ``df`` into the shared checkpoint folder (eager by default)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
