"""The five series sets derived from the fact tables, with DuckDB twins.

Each is ``series_from_facts`` over one fact table: one partial+final
aggregate with a single exchange on (unique_id, ds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.select import fact_ids
from tidecast.operators.timeindex import densify
from tidecast.schema import ID
from tidecast.sources.facts import series_from_facts

# set name -> (table, id column, time column, value column, grain)
SERIES_SETS = {
    "ship_daily": ("lineitem", "l_returnflag", "l_shipdate", "l_quantity", "D"),
    "supplier_daily": ("lineitem", "l_suppkey", "l_shipdate", "l_quantity", "D"),
    "order_monthly": ("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "M"),
    "supplier_monthly": ("lineitem", "l_suppkey", "l_shipdate", "l_quantity", "M"),
    "events_user_daily": ("events", "user_id", "ts", "value", "D"),
    "events_type_daily": ("events", "event_type", "ts", "value", "D"),
}


# the facts' values have two decimals; four are kept
DECIMALS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def series_set(spark: SparkSession, sf_dir: str, name: str, ids=None) -> DataFrame:
    """A named series set (see ``SERIES_SETS``) as a canonical long table; of the series in the list ``ids``, if given."""
    tbl, id_col, ts_col, val, grain = SERIES_SETS[name]
    facts = table(spark, sf_dir, tbl)
    if ids is not None:
        facts = fact_ids(facts, id_col, ids)
    return series_from_facts(facts, id_col, ts_col, val, "sum", grain, decimals=DECIMALS)


#: Facts whose series one task of a dense set holds, at most, on average.
TASK_FACTS = 250_000


def dense_set(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named series set on a gap-free grid, in as many partitions by series as its facts ask for.

    Windows and arrays of the dense series keep this partitioning, so what a
    task sorts or holds doesn't grow with the table.  The facts are counted
    from the files' footers.
    """
    s, facts = series_set(spark, sf_dir, name), table(spark, sf_dir, SERIES_SETS[name][0])
    n = -(-facts.count() // TASK_FACTS)
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        s = s.repartition(n, ID)
    return densify(s, freq_of(name))


def freq_of(name: str) -> str:
    """The grain ('D' or 'M') of a named series set."""
    return SERIES_SETS[name][4]


def series_set_sql(name: str) -> str:
    """DuckDB SELECT producing the same (unique_id, ds, y) rows."""
    tbl, id_col, ts_col, val, grain = SERIES_SETS[name]
    if grain == "D":
        ds = f"CAST(CAST({ts_col} AS DATE) AS TIMESTAMP)"
    else:
        ds = f"CAST(last_day(CAST({ts_col} AS DATE)) AS TIMESTAMP)"
    return (f"SELECT CAST({id_col} AS VARCHAR) AS unique_id, {ds} AS ds, "
            f"CAST(SUM(CAST({val} AS DECIMAL(18, {DECIMALS}))) AS DOUBLE) AS y FROM {tbl} GROUP BY 1, 2")


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a point of its own; nine suppliers in ten share the series 'main', first lines have no value."""
    x = table(spark, sf_dir, "lineitem")
    # the quantity is part of the time: points of one time are then equal, and their order is none
    place = (F.col("l_orderkey").cast("bigint") * 8 + F.col("l_linenumber")) * 64 + F.col("l_quantity").cast("bigint")
    tick = (place / F.lit(1000000)).cast("decimal(18,6)")
    at = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), tick)
    return x.select(F.when(F.col("l_suppkey") % 10 == 0, F.concat(F.lit("s"), F.col("l_suppkey").cast("string")))
                    .otherwise(F.lit("main")).alias("unique_id"), at.alias("ds"),
                    F.when(F.col("l_linenumber") != 1, F.col("l_quantity").cast("double")).alias("y"))


LONG_SQL = """SELECT CASE WHEN l_suppkey % 10 = 0 THEN 's' || CAST(l_suppkey AS VARCHAR) ELSE 'main' END AS unique_id,
  CAST(l_shipdate AS TIMESTAMP) + to_microseconds(CAST((CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * 64 + CAST(l_quantity AS BIGINT) AS BIGINT)) AS ds,
  CASE WHEN l_linenumber <> 1 THEN CAST(l_quantity AS DOUBLE) END AS y FROM lineitem"""
