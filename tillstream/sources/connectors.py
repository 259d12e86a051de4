"""Kafka and JDBC sources. Addresses and credentials are always given by the caller.

The Kafka connector and JDBC drivers are no part of PySpark; the cluster supplies them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.text import rename_camel


def kafka_options(servers: str, topic: str, start: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a Kafka source. Progress lives in the checkpoint, so there is no group to set."""
    if start not in ("latest", "earliest") and not start.startswith("{"):
        raise ValueError("start is latest, earliest or a JSON map of offsets")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, **extra}


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The string payloads of a topic, with the topic name."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select("topic", F.col("value").cast("string").alias("value"))


def json_table(lines: DataFrame, schema: T.StructType, time_col: str, delay: str,
               view: str | None = None, value: str = "value", zone_format: str | None = None) -> DataFrame:
    """A declared table over JSON payloads: typed columns, a ``rowtime`` and its watermark.

    ``time_col`` holds epoch milliseconds, or a text in ``zone_format``.
    """
    typed = lines.select(F.from_json(value, schema).alias("_r")).select("_r.*")
    if zone_format:
        rowtime = F.try_to_timestamp(time_col, F.lit(zone_format))
    else:
        rowtime = F.timestamp_millis(time_col)
    table = typed.withColumn("rowtime", rowtime).withWatermark("rowtime", delay)
    if view:
        table.createOrReplaceTempView(view)
    return table


def jdbc_options(url: str, table: str, split_by: str | None = None, bounds: tuple[int, int] | None = None,
                 parts: int | None = None, **extra: str) -> dict[str, str]:
    """Options of a JDBC scan; a large table needs a numeric split column to be read in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **extra}
    if split_by:
        if bounds is None or parts is None:
            raise ValueError("a split column needs bounds and a number of parts")
        options |= {"partitionColumn": split_by, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(parts)}
    return options


def jdbc_table(spark: SparkSession, options: dict[str, str], camel: bool = False) -> DataFrame:
    df = spark.read.format("jdbc").options(**options).load()
    return rename_camel(df) if camel else df
