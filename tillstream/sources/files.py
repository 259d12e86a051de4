"""File scans, in batch or as streams over growing folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One string row ``value`` per line of a file or folder."""
    return (spark.readStream if stream else spark.read).text(path)


def delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
              stream: bool = False) -> DataFrame:
    """Header-less delimited records, columns by position with the types of ``schema``."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("sep", sep).csv(path)


def rows(spark: SparkSession, data: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """In-memory rows."""
    return spark.createDataFrame(list(data), schema)


def access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Web-access-log lines as id, ts, method and url (space-separated fields 0, 3, 5, 6).

    Fields that a short line lacks are null; ``broken_lines`` gives such lines.
    """
    part = F.split(col, " ")
    # Fixed value: the time format of the log.
    at = F.try_to_timestamp(F.get(part, 3), F.lit("dd/MM/yyyy:HH:mm:ss"))
    return lines.select(F.get(part, 0).alias("id"), at.alias("ts"), F.get(part, 5).alias("method"), F.get(part, 6).alias("url"))


def broken_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Web-access-log lines with fewer than seven fields."""
    return lines.where(F.coalesce(F.size(F.split(col, " ")) < 7, F.lit(True)))


def seconds_to_ts(df: DataFrame, col: str = "ts") -> DataFrame:
    """Epoch seconds as an instant."""
    return df.withColumn(col, F.timestamp_seconds(col))


def millis_to_ts(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn(col, F.timestamp_millis(col))
