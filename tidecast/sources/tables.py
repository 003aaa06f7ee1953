"""Table scans and sinks (rows 1, 4, 5, 6)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidecast.schema import DS, ID, Y, canonical

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def _check_name(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"bad table name {name!r}")
    return name


def scan_series(spark: SparkSession, table_or_path: str, id_col: str = ID,
                ds_col: str = DS, y_col: str = Y) -> DataFrame:
    """Read a long table (catalog name or Parquet path) onto the canonical schema.

    Only the three columns are projected, so the Parquet scan reads only them.
    """
    if "/" in table_or_path or table_or_path.endswith(".parquet"):
        df = spark.read.parquet(table_or_path)
    else:
        df = spark.table(table_or_path)
    return canonical(df, id_col, ds_col, y_col)


def ensure_namespace(spark: SparkSession, db: str, volume: str | None = None) -> str | None:
    """``CREATE DATABASE IF NOT EXISTS``; a *volume* is a folder under the db location.

    Returns the volume path (or None).
    """
    _check_name(db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if volume is None:
        return None
    _check_name(volume)
    loc = spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").first()[1]
    path = f"{loc.rstrip('/')}/{volume}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def default_location(spark: SparkSession, name: str) -> str:
    """The folder that the catalog gives a new managed table of this name."""
    db, _, table = _check_name(name).rpartition(".")
    db = db or spark.catalog.currentDatabase()
    loc = spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").first()[1]
    return f"{loc.rstrip('/')}/{table.lower()}"


def check_free(spark: SparkSession, name: str) -> None:
    """Raise if files that the catalog knows nothing of lie where the new table ``name`` would go.

    They may be another job's, so they are neither read nor removed.
    """
    if spark.catalog.tableExists(_check_name(name)):
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(default_location(spark, name))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and len(fs.listStatus(p)):
        raise ValueError(f"{p.toString()} holds files of no table that the catalog knows; "
                         f"remove them or choose another name than {name}")


def drop_if_exists(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS``: a managed table's files go with it.

    A table that the catalog doesn't know, and any folder of its name, stay as they are.
    """
    spark.sql(f"DROP TABLE IF EXISTS {_check_name(name)}")


def write_series_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                       fmt: str = "parquet") -> DataFrame:
    """Overwrite-save a managed table and read it back.

    Where files of no known table lie in the new table's place it raises and
    leaves them alone.  ``partition_by`` (e.g. a month column) lets later
    scans prune partitions.
    """
    spark = df.sparkSession
    check_free(spark, name)
    if partition_by:
        # Range-partition on (partition columns, series id) before writing:
        # each task then covers a contiguous slice of one or two partition
        # values, so the file count follows the task count (not tasks x
        # values) and a hot partition value is split over several tasks.
        order = list(partition_by) + ([ID] if ID in df.columns else [])
        df = df.repartitionByRange(*order)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return spark.table(name)


def write_bucketed_table(df: DataFrame, name: str, buckets: int, fmt: str = "parquet") -> DataFrame:
    """Overwrite-save a managed series table in ``buckets`` by series, sorted by (series, time), and read it back.

    The rows are exchanged once, here.  Whatever groups, windows or joins the
    table by ``unique_id`` later reads its buckets as they are, without an
    exchange: ``pack_series``, ``forecast_points``, and joins of tables with
    as many buckets.  A bucket is one file, so ``buckets`` should leave files
    of some hundred megabytes; a series is in one bucket, so very long ones
    belong to ``longscan``.
    """
    spark = df.sparkSession
    k = int(buckets)
    if k < 1:
        raise ValueError("buckets must be at least 1")
    check_free(spark, name)
    order = [ID] + ([DS] if DS in df.columns else [])
    (df.repartition(k, ID).sortWithinPartitions(*order).write.mode("overwrite").format(fmt)
       .bucketBy(k, ID).sortBy(*order).saveAsTable(name))
    return spark.table(name)
