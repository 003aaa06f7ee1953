import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidecast.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tidecast-tests")
    yield s


@pytest.fixture
def series(spark):
    """Build a long series table from (id, 'YYYY-mm-dd[ HH:MM:SS]', y) tuples."""
    import datetime as dt

    def make(rows):
        out = []
        for i, d, y in rows:
            fmt = "%Y-%m-%d %H:%M:%S" if " " in d else "%Y-%m-%d"
            out.append((i, dt.datetime.strptime(d, fmt), y))
        return spark.createDataFrame(out, "unique_id string, ds timestamp_ntz, y double")
    return make
