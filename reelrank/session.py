"""Session helpers: local sessions for tests and bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "reelrank") -> SparkSession:
    """Session for tests and the local bench. A cluster passes its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.driver.memory", os.environ.get("REELRANK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables, stream checkpoints and lineage cuts.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. A local session
    (one machine) without one gets a folder of its own; a cluster session without
    one is an error, since executors don't share a folder of the driver's.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        base = conf_dir
    else:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            base = current
        elif not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        else:
            base = tempfile.mkdtemp(prefix="reelrank-")
            spark.sparkContext.setCheckpointDir(base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/") + "/reelrank"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the work folder."""
    return f"{work_dir(spark)}/{name}/{uuid.uuid4().hex}"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams that are started inside keep their state in RocksDB, off the JVM heap. The
    session's own setting is back afterwards; a query keeps what it was started with."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reelrank`` importable on every executor's Python workers.

    The blocked kernels and stream-state functions are pickled by reference,
    so the workers import this package. It is zipped once per application and
    handed to ``SparkContext.addPyFile``, Spark's own way to ship Python code
    to executors (the same as ``--py-files``). The zip is a driver-side file
    that Spark serves to the executors; no executor reads a local folder.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="reelrank-pyfiles-"), "reelrank.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
