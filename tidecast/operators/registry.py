"""Pooled model fits kept as registry rows, and scoring from the registry
(rows 63, 64; the registry query itself is row 28 in ``aggregate``).

The pooled model is an AR(1) on mean-abs-scaled series,
``y_t/s = a + b * y_{t-1}/s``, shared by all series.  A fit is a global
aggregate (partial sums per task, one final row), so it scales with the data
without moving it.  A registry row is ``(name, version STRING, params JSON)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C
from tidecast.functions.calendar import add_steps, month_end
from tidecast.functions.ranges import positive
from tidecast.operators.forecast import last_points
from tidecast.schema import DS, ID, Y
from tidecast.sources.tables import check_free

PARAMS = T.StructType([T.StructField("slope", T.DoubleType()), T.StructField("intercept", T.DoubleType()),
                       T.StructField("n", T.LongType()), T.StructField("context", T.IntegerType())])


def _scaled_pairs(df: DataFrame, context: int | None) -> DataFrame:
    src = last_points(df, context) if context else df
    scale = F.avg(F.abs(F.col(Y))).over(Window.partitionBy(ID))
    s = F.when(scale > 0, scale).otherwise(F.lit(1.0))
    w = Window.partitionBy(ID).orderBy(DS)
    return src.select(ID, DS, (F.col(Y) / s).alias("_y"), (F.lag(Y).over(w) / s).alias("_x"))


def pooled_fit(df: DataFrame, context: int = C.CONTEXT_LENGTH, name: str = "pooled_ar1",
               registry: DataFrame | None = None) -> DataFrame:
    """Fit the shared model on the last ``context`` points of every series.
    Version = latest existing version of ``name`` + 1 (1 for a new name)."""
    p = _scaled_pairs(df, context)
    fit = p.agg(F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"),
                F.regr_count("_y", "_x").alias("n"))
    if registry is None:
        version = F.lit(1)
    else:
        prev = registry.where(F.col("name") == name).select(F.max(F.col("version").try_cast("int")))
        version = F.coalesce(prev.scalar(), F.lit(0)) + 1
    return fit.select(F.lit(name).alias("name"), version.cast("string").alias("version"),
                      F.to_json(F.struct("slope", "intercept", "n", F.lit(int(context)).alias("context"))).alias("params"),
                      "slope", "intercept", "n")


def registry_history(df: DataFrame, name: str = "pooled_ar1") -> DataFrame:
    """One registry version per calendar month: version k is the pooled fit
    on all pairs up to the end of the k-th month of data.

    Per-month sufficient statistics (n, Sx, Sy, Sxx, Sxy) are aggregated once
    and accumulated over months (a table with one row per month), instead of
    refitting on a growing prefix of the data.  Scales use whole series.
    """
    p = _scaled_pairs(df, None).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    m = p.groupBy(month_end(F.col(DS)).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_x").alias("sx"), F.sum("_y").alias("sy"),
        F.sum(F.col("_x") * F.col("_x")).alias("sxx"), F.sum(F.col("_x") * F.col("_y")).alias("sxy"))
    cum = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    c = m.select("month", *[F.sum(k).over(cum).alias(k) for k in ("n", "sx", "sy", "sxx", "sxy")],
                 F.row_number().over(Window.orderBy("month")).alias("_v"))
    den = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when(den != 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / den)
    c = c.withColumn("slope", slope).withColumn(
        "intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n"))
    return c.select(F.lit(name).alias("name"), F.col("_v").cast("string").alias("version"),
                    F.to_json(F.struct("slope", "intercept", F.col("n").cast("long").alias("n"),
                                       F.lit(None).cast("int").alias("context"))).alias("params"),
                    "slope", "intercept", F.col("n").cast("long").alias("n"),
                    F.col("month").alias("trained_through"))


def registry_append(fit: DataFrame, table: str) -> DataFrame:
    """Append fitted versions to the registry table ``table``, which is made where the catalog lacks it.

    Returns the whole registry, read back: name, version, params and the
    parameters as columns.
    """
    spark = fit.sparkSession
    check_free(spark, table)
    fit.select("name", "version", "params").write.mode("append").format("parquet").saveAsTable(table)
    rows = spark.table(table).select("name", "version", "params", F.from_json("params", PARAMS).alias("_p"))
    return rows.select("name", "version", "params", "_p.slope", "_p.intercept", "_p.n")


def registry_score(df: DataFrame, registry: DataFrame, name: str, h: int, freq: str = "D",
                   context: int = C.CONTEXT_LENGTH) -> DataFrame:
    """Score every series with the newest version of ``name``.

    The chosen registry row (one per name) enters as scalar subqueries for
    its version and parameters, so scoring needs no join with the series.
    Output: unique_id, step, ds, yhat, version.
    """
    h = positive("h", h)
    mine = registry.where(F.col("name") == name)
    newest = mine.select(F.max(F.col("version").try_cast("int"))).scalar()
    chosen = mine.where(F.col("version").try_cast("int") == newest).select(F.from_json("params", PARAMS).alias("p"))
    b_val = chosen.select(F.max("p.slope")).scalar()
    a_val = chosen.select(F.max("p.intercept")).scalar()
    cut = last_points(df, context).where(F.col(Y).isNotNull())
    st = cut.groupBy(ID).agg(F.avg(F.abs(F.col(Y))).alias("_s"), F.max(DS).alias("last_ds"),
                             F.max_by(Y, DS).alias("last_y"))
    st = st.withColumn("_s", F.when(F.col("_s") > 0, F.col("_s")).otherwise(F.lit(1.0)))
    st = st.withColumn("a", a_val).withColumn("b", b_val).withColumn("version", newest.cast("string"))
    steps = st.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(h)))).alias("step"))
    a, b, k = F.col("a"), F.col("b"), F.col("step")
    bk = F.pow(b, k)
    z = F.when(b == 1.0, a * k).otherwise(a * (1 - bk) / (1 - b)) + bk * (F.col("last_y") / F.col("_s"))
    return steps.select(ID, k.cast("int").alias("step"), add_steps(F.col("last_ds"), k, freq).alias(DS),
                        (z * F.col("_s")).alias("yhat"), "version")
