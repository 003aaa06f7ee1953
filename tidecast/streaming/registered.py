"""Streamed requests scored by the newest registered model (rows 64, 66, 68).

The registry is a table of versions (``operators.registry``).  Each micro-batch
reads it anew, so a version that is registered while the stream runs scores
the batches after it, and every reply keeps the version that made it.

A batch is written to a folder of its own.  One that was written whole is left
as it is when the stream repeats it after a failure, so a reply never changes
its version; one that was cut short is written anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.ranges import upto
from tidecast.operators.registry import PARAMS
from tidecast.streaming.scoring import REQUEST_FILE_SCHEMA, score_requests

#: Columns of a written reply, beside the folder's ``batch_id``.
REPLY = ("request_id", "request", "kind", "reply", "error", "version")


def pooled_array_forecast(ctx: Column, h: Column, slope: Column, intercept: Column) -> Column:
    """``h`` steps of the pooled model after an array context, scaled by its mean absolute value.

    Null and NaN values take no part; null for a context without a value or a model without coefficients.
    """
    # an array of one element binds a name, so that what it holds is computed once a context, not once a step
    def of(v: Column) -> Column:
        n = F.size(v)
        mean = F.when(n > 0, F.aggregate(v, F.lit(0.0), lambda a, x: a + F.abs(x)) / n)
        told = F.struct(F.when(mean > 0, mean).otherwise(F.lit(1.0)).alias("s"), F.get(v, n - 1).alias("last"), n.alias("n"))
        return F.get(F.transform(F.array(told), steps), F.lit(0))

    def steps(z: Column) -> Column:
        s = z["s"]
        last = z["last"] / s

        def step(k: Column) -> Column:
            power = F.pow(slope, k)
            drift = F.when(slope == 1.0, intercept * k).otherwise(intercept * (1 - power) / (1 - slope))
            return (drift + power * last) * s

        return F.when((z["n"] > 0) & slope.isNotNull() & intercept.isNotNull(), F.transform(upto(F.lit(1), h), step))

    return F.get(F.transform(F.array(F.filter(ctx, lambda x: x.isNotNull() & ~F.isnan(x))), of), F.lit(0))


def score_registered(requests: DataFrame, registry: DataFrame, name: str, request_col: str = "request") -> DataFrame:
    """``score_requests`` by the newest version of ``name``, with that ``version`` beside each reply.

    Versions are compared as numbers; one that is no number takes no part.
    Without a version every reply is null, with an error that says so.  The
    newest row enters as scalar subqueries: requests meet no join.
    """
    mine = registry.where(F.col("name") == name).select(F.col("version").try_cast("int").alias("v"), "params")
    newest = mine.select(F.max(F.struct("v", "params"))["v"]).scalar()
    params = mine.where("v IS NOT NULL").select(F.max(F.struct("v", "params"))["params"]).scalar()
    df = requests.withColumn("version", newest.cast("string")).withColumn("_model", F.from_json(params, PARAMS))
    out = score_requests(df, lambda c, h: pooled_array_forecast(c, h, F.col("_model.slope"), F.col("_model.intercept")),
                         request_col=request_col)
    missing = F.col("version").isNull() & (F.col("error").isNull() | (F.col("error") == "empty context"))
    return out.withColumn("error", F.when(missing, F.lit(f"no registered version of {name}")).otherwise(F.col("error"))) \
        .drop("_model")


def _whole(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_batch(batch: DataFrame, batch_id: int, registry_table: str, name: str, out: str) -> None:
    """Score one micro-batch by the registry as it is now and write it to ``<out>/batch_id=<id>``, once."""
    spark, path = batch.sparkSession, f"{out.rstrip('/')}/batch_id={int(batch_id)}"
    if _whole(spark, path):
        return
    spark.catalog.refreshTable(registry_table)                # another job may have added a version
    score_registered(batch, spark.table(registry_table), name).select(*REPLY).write.mode("overwrite").parquet(path)


def registered_stream(spark: SparkSession, in_dir: str, registry_table: str, name: str, out: str, checkpoint: str,
                      files_per_batch: int | None = None, once: bool = True):
    """Request files (JSON lines: request_id, request) -> replies below ``out``; returns the started StreamingQuery.

    ``files_per_batch`` bounds a micro-batch; ``once`` ends when all files are read.
    """
    src = spark.readStream.schema(REQUEST_FILE_SCHEMA)
    if files_per_batch:
        src = src.option("maxFilesPerTrigger", int(files_per_batch))
    w = (src.json(in_dir).writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda b, i: write_batch(b, i, registry_table, name, out)))
    return (w.trigger(availableNow=True) if once else w).start()


def registered_replies(spark: SparkSession, out: str) -> DataFrame:
    """All replies written below ``out``: the columns of ``REPLY`` and batch_id."""
    return spark.read.option("basePath", out).parquet(out)
