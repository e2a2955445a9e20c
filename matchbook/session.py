"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "matchbook") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the cluster's builder."""
    builder = SparkSession.builder.master(master).appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder is made here only for a local master that has none (tests); on a cluster the
    cluster's setting is used as is, and a missing one is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="matchbook-ckpt-", dir=os.environ.get("MATCHBOOK_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, known to ``release``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    sc = spark.sparkContext
    if not hasattr(sc, "_matchbook_folders"):
        sc._matchbook_folders = []
    sc._matchbook_folders.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the intermediate folders of this session, once the results read from them are written; returns how many."""
    sc = spark.sparkContext
    paths, sc._matchbook_folders = getattr(sc, "_matchbook_folders", []), []
    for path in paths:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def ship_package(spark: SparkSession) -> None:
    """Make this package's code available to Python workers, once per context.

    The package is registered with cloudpickle for by-value pickling: every
    Python function Spark sends to a worker (``mapInArrow`` bodies, the
    stateful processor) carries the package code it uses, so executors and the
    streaming state driver runner need no installed copy and no files are
    staged on any machine-local disk.
    """
    sc = spark.sparkContext
    if getattr(sc, "_matchbook_shipped", False):
        return
    from pyspark import cloudpickle

    import matchbook

    cloudpickle.register_pickle_by_value(matchbook)
    sc._matchbook_shipped = True
