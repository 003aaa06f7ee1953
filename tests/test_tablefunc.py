"""A plug-in as a table function equals forecast_long."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidecast.operators import plugins as pl
from tidecast.operators import tablefunc as tf

CALL = "SELECT * FROM ft(TABLE({t}) PARTITION BY unique_id ORDER BY (ds), %s, '%s')"


def test_equals_forecast_long_on_odd_series(spark, series):
    rows = [("a", f"2024-01-{d:02d}", float(d * d % 11)) for d in range(1, 29)]
    rows += [("b", "2024-01-01", None), ("c", "2024-01-02", 5.0), ("c", "2024-01-03", None), (None, "2024-01-04", 2.0)]
    t = series(rows).withColumn("step", F.lit("clash")).repartition(7)
    tf.register_forecast_table(spark, pl.SeasonalNaive(3), "ft", 5)
    got = {(r.unique_id, r.step): r.yhat for r in spark.sql(CALL % (4, "D"), t=t).collect()}
    want = {(r.unique_id, r.step): r.yhat for r in pl.forecast_long(t, pl.SeasonalNaive(3), "D", 4, context=5).collect()}
    none = lambda d: {k: None if v is None or v != v else v for k, v in d.items()}
    assert none(got) == none(want) and len(got) == 16 and got["b", 1] is None and got["c", 4] == 5.0
    assert spark.sql(CALL % (4, "D"), t=t.where("false")).count() == 0


@pytest.mark.parametrize("h, freq, drop, why", [(0, "D", "step", "h must|positive|>= 1"), (3, "X", "step", "freq|grain|'X'"), (3, "D", "y", "lacks")])
def test_bad_arguments_fail_in_analysis(spark, series, h, freq, drop, why):
    tf.register_forecast_table(spark, pl.Drift(), "ft")
    with pytest.raises(AnalysisException, match=why):
        spark.sql(CALL % (h, freq), t=series([("a", "2024-01-01", 1.0)]).drop(drop)).schema
