"""Rows for Kafka topics and JDBC tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_messages(df: DataFrame, key: str | None = None, topic: str | Column | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as Kafka messages: JSON ``value``, optional ``key``, and a ``topic`` per row.

    ``topic`` is a fixed name or a column, which sends each row to its own topic.
    """
    out = [F.to_json(F.struct(*(columns or df.columns))).alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    if topic is not None:
        out.append((F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    return df.select(*out)


def kafka_sink_options(servers: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **extra}


def without_transient(df: DataFrame, transient: Sequence[str], target: Sequence[str]) -> DataFrame:
    """The columns a positional insert writes, in the order of the target table."""
    return df.drop(*transient).select(*target)


def jdbc_append(df: DataFrame, options: dict[str, str], batch_rows: int = 10_000) -> None:
    df.write.format("jdbc").options(**options).option("batchsize", str(batch_rows)).mode("append").save()


def write_by_table(df: DataFrame, path: str, batch: int | str = 0, column: str = "sink_table") -> None:
    """Routed rows as one folder per sink table within the batch's folder; a batch written again replaces itself."""
    df.write.mode("overwrite").partitionBy(column).parquet(f"{path}/batch={batch}")
