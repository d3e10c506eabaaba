"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tickloom", **conf: str) -> SparkSession:
    """A session with the settings the pipelines expect; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All calendar work is UTC; set it where the caller's session differs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder named by ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful queries, so the caller's settings stay as they are.

    The number of state partitions is fixed for the life of a checkpoint, from the first start on.
    It is ``state_partitions``, or the caller's shuffle setting. State changes are checkpointed as
    changelogs, so a small batch does not upload whole snapshots.
    """
    child = spark.newSession()
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    child.conf.set("spark.sql.shuffle.partitions", str(partitions))
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    child.conf.set("spark.sql.session.timeZone", "UTC")
    child.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return child
