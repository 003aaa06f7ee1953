"""Long forecasts as a table function callable from SQL (row 61).

``register_forecast_table`` registers a plug-in as

    SELECT * FROM forecast_table(TABLE(series) PARTITION BY unique_id ORDER BY (ds), 10, 'D')

Rows of a series stream through Arrow in the order of time; only its last
``context`` values are held.  Every row costs a call in Python, so a row may
bring many points: an array ``y`` holds the values up to its row's ``ds``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C
from tidecast.functions.calendar import check_freq
from tidecast.functions.ranges import positive
from tidecast.schema import DS, ID, Y
from tidecast.session import ship_package


def register_forecast_table(spark: SparkSession, model, name: str = "forecast_table", context: int = C.CONTEXT_LENGTH,
                            num_samples: int = 1) -> str:
    """Register ``model`` (a plug-in ``Forecaster``) as the table function ``name``(table, h, freq); returns the name.

    Output: unique_id (of the table's own type), step, last_ds, yhat, for each
    of ``h`` steps.  The schema comes from the arguments: a table without
    unique_id, ds or y, a horizon below 1 or an unknown grain fails when the
    query is analysed.  Null values are missing input; a series without an
    observed value gets null forecasts; an empty table gives no rows; other
    columns are not read.  The model is set up once a worker.
    """
    ship_package(spark)
    n, samples = positive("context", context), positive("num_samples", num_samples)

    class ForecastTable:
        ready = False

        @staticmethod
        def analyze(table, h, freq):
            from pyspark.sql.udtf import AnalyzeResult
            lacks = [c for c in (ID, DS, Y) if not table.isTable or c not in table.dataType.names]
            if lacks:
                raise ValueError(f"the table argument lacks {lacks}")
            positive("h", h.value)
            check_freq(freq.value)
            return AnalyzeResult(T.StructType([
                T.StructField(ID, table.dataType[ID].dataType), T.StructField("step", T.IntegerType()),
                T.StructField("last_ds", T.TimestampNTZType()), T.StructField("yhat", T.DoubleType())]))

        def __init__(self):
            from collections import deque
            if not type(self).ready:
                model.setup()
                type(self).ready = True
            self.key, self.h, self.last, self.values = None, 0, None, deque(maxlen=n)

        def eval(self, row, h, freq):
            self.key, self.h, self.last = row[ID], h, row[DS]
            for y in row[Y] if hasattr(row[Y], "__len__") else (row[Y],):
                self.values.append(float("nan") if y is None else float(y))

        def terminate(self):
            if not self.values:
                return
            import numpy as np
            paths = model.predict([np.array(self.values)], self.h, samples)[0]
            for k, v in enumerate(np.median(paths, axis=0).tolist(), 1):
                yield self.key, k, self.last, None if v != v else v

    spark.udtf.register(name, F.udtf(ForecastTable, useArrow=True))
    return name
