"""Session helpers: a local session for tests/bench, and shared scratch paths."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours relies on.  UTC keeps date arithmetic
# independent of executor locale; AQE re-plans joins and coalesces partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # "last n points" cuts (1020 for daily preparation) get a partial top-n
    # before the exchange only when n is within this threshold (default 1000)
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidecast") -> SparkSession:
    """A ``local[cores]`` session for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("TIDECAST_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Where it is unset a
    ``local[...]`` session gets one of its own under /tmp; on a cluster that
    folder would not be shared, so there it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = f"/tmp/tidecast-checkpoints-{uuid.uuid4().hex[:8]}"
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidecast/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``tidecast`` importable on executors' Python workers.

    Plug-in forecasters and grouped-pandas functions are pickled by
    reference, so workers must import this package.  When it is not installed
    on the cluster, a zip of it is written once per application into the
    shared scratch folder (through the Hadoop FileSystem API, so no
    machine-local folder is involved) and added with ``addPyFile``.
    """
    import io
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = scratch_path(spark, "pyfiles") + "/tidecast.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    _SHIPPED.add(app)
