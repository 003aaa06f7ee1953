"""tidecast: time-series preparation, forecasting and evaluation as Spark jobs.

Every operator is a function from DataFrames to a DataFrame.  The canonical
*long series table* has the columns ``unique_id STRING, ds TIMESTAMP_NTZ,
y DOUBLE``; missing values are SQL NULL inside the engine.
"""

from tidecast.schema import SERIES_SCHEMA, canonical, conform_schema  # noqa: F401

__version__ = "0.1.0"
