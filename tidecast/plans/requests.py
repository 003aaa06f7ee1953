"""Scoring requests built from series tables (feeds rows 66-68).

Each series yields one request of each shape from all its points, so the
request stream grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.aggregate import pack_series
from tidecast.schema import ID

#: Contexts of a batch request.
BATCH = 5


def requests_from_series(df: DataFrame, split_h: int = 20) -> DataFrame:
    """(request_id, request) rows, three for each series, all of its whole length:
    'single:<id>' (its values), 'batch:<id>' (the values cut into 5 consecutive
    contexts of about equal length, one value each where there are fewer) and
    'split:<id>' (dataframe_split with params.h = ``split_h``)."""
    p = pack_series(df).withColumn("_n", F.size("y")).where("_n > 0")
    k = F.least(F.col("_n"), F.lit(BATCH))
    border = lambda r: F.floor(r * F.col("_n") / k).cast("int")
    wins = F.transform(F.sequence(F.lit(0), k - 1), lambda r: F.slice("y", border(r) + 1, border(r + 1) - border(r)))
    rows = F.transform(F.arrays_zip(F.col("ds").alias("t"), F.col("y").alias("v")), lambda e: F.concat(
        F.lit('["'), F.date_format(e["t"], "yyyy-MM-dd HH:mm:ss"), F.lit('",'),
        F.coalesce(e["v"].cast("string"), F.lit("null")), F.lit("]")))
    body = F.concat(
        F.lit('{"dataframe_split": {"columns": ["timestamp", "value"], "index": '),
        F.to_json(F.sequence(F.lit(0), F.col("_n") - 1)), F.lit(', "data": ['),
        F.array_join(rows, ","), F.lit(f']}}, "params": {{"h": {int(split_h)}}}}}'))

    def req(kind, text):
        return F.struct(F.concat(F.lit(kind + ":"), ID).alias("request_id"), text.alias("request"))

    # all three shapes from one pass over the packed series (no re-computation per shape)
    shapes = F.array(req("single", F.to_json(F.struct(F.col("y").alias("inputs")))),
                     req("batch", F.to_json(F.struct(wins.alias("inputs")))), req("split", body))
    return p.select(F.explode(shapes).alias("_r")).select("_r.request_id", "_r.request")
