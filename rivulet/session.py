"""Session settings the transforms rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; zone-less columns must be read as UTC too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Map states need a state store with column families, which Spark's default has not; any other one stays."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(provider, ROCKSDB)
    return spark


def build_session(master: str | None = None, app: str = "rivulet", **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` unset; ``spark-submit`` provides it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the session names; a job that restarts must find it again."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The folder of :func:`checkpoint_root`; where none is set, as in tests on one machine, one of our own."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rivulet-"))
    return checkpoint_root(spark)
