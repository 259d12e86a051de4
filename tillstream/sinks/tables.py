"""Dimension tables kept as upsert logs, and tables made on demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.aggregates import newest


def dim_schema(columns: str) -> T.StructType:
    """All-text schema of a routed dimension table from its comma-separated column list."""
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in columns.split(",")])


def create_table(spark: SparkSession, name: str, columns: str, pk: str | None = None,
                 extend: str | None = None) -> None:
    """Create a routed table if it is missing: text columns, key ``id`` unless one is named."""
    key = pk or "id"
    listed = [c.strip() for c in columns.split(",")]
    names = listed if key in listed else [key, *listed]
    cols = ", ".join(f"`{c}` STRING" for c in names)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet {extend or ''} "
              f"TBLPROPERTIES ('primary_key' = '{key}')")


class DimTable:
    """A dimension as a log of changes in Parquet; reading merges it, newest row per key.

    Each micro-batch writes its own folder and replaces it when it runs again, so a retried
    batch changes nothing. ``compact`` folds the log up to a batch into one base.
    """

    def __init__(self, spark: SparkSession, path: str, pk: Sequence[str], schema: T.StructType):
        self.spark, self.path, self.pk = spark, path.rstrip("/"), list(pk)
        self.schema = T.StructType([*schema.fields, T.StructField("_seq", T.LongType()),
                                    T.StructField("batch", T.LongType())])
        self.columns = schema.names

    def upsert(self, rows: DataFrame, batch_id: int, seq: str) -> None:
        """Write the changes of one batch; within it the highest ``seq`` of a key wins."""
        last = newest(rows.select(*self.columns, F.col(seq).cast("long").alias("_seq")), self.pk, ["_seq"])
        last.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        log = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)
        return newest(log, self.pk, ["batch", "_seq"]).select(*self.columns)

    def compact(self, upto: int, target: "DimTable") -> None:
        """Write the merged state up to a batch as the first batch of ``target``."""
        log = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)
        merged = newest(log.where(F.col("batch") <= upto), self.pk, ["batch", "_seq"])
        merged.drop("batch").write.mode("overwrite").parquet(f"{target.path}/batch={upto}")
