"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes.  AQE re-plans joins and coalesces small shuffle
# partitions at runtime; skew-join splits a hot key's partition.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


#: Rows and bytes of one Arrow batch: a batch of very long texts is cut earlier.
ARROW_ROWS = 1000
ARROW_BYTES = 16 << 20


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session (possibly created by someone else) ready for tessera jobs.

    * Python functions of this package are shipped by value, so executors do
      not need the package installed.
    * Arrow batches are bounded in rows and bytes, so what a Python worker holds
      does not follow the size of a task's input.
    * A reliable checkpoint directory exists.  On a cluster it is the shared
      folder named by ``spark.checkpoint.dir``; only when that is unset (tests,
      a laptop) do we create a scratch one.
    """
    import tessera
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(tessera)
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(key, "true")
        except Exception:  # static in some deployments
            pass
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    checkpoint_dir(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings that hold inside the block only."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster; "
                               "tessera cuts lineage and stages files there")
        # single machine (tests, a laptop): a scratch folder is shared by definition
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (never machine-local
    on a cluster) for tables a job writes to cut lineage or to stage files."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
