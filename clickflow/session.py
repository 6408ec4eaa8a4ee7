"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str = "clickflow", master: str | None = None,
                  time_zone: str = "UTC", **settings) -> SparkSession:
    """A session with adaptive execution on; cluster size settings are left to the cluster.

    ``time_zone`` decides the calendar hour, day and month of every click. Extra settings
    are given with ``__`` for ``.``, e.g. ``spark__sql__shuffle__partitions=8``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run, below the shared folder the cluster names.

    Only a local session may fall back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="clickflow-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def keep_table(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table into the shared folder and reads it from there, once for all its uses."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, **values):
    """Give session settings for the length of a block, then put the old ones back."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
