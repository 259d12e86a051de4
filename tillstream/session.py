"""Session settings the transformations rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Zone-less Parquet timestamps are read as UTC; AQE splits hot join partitions and
# merges small ones, so no query needs a hand-set partition count.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def configure_streaming(spark: SparkSession) -> SparkSession:
    """Settings of ``configure`` plus the state store custom stateful operators need."""
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which driver and executors share.

    Only a session on one machine may leave it unset; it then gets a temporary folder, once. A cluster without the
    setting is an error, as executors would write where nobody else can read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _own_folder
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="tillstream-")
    return _own_folder


_own_folder = ""


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the session's file system closes."""
    path = f"{checkpoint_dir(spark)}/tillstream-{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
