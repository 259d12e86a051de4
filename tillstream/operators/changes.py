"""Change records: one envelope shape, table routing and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.aggregates import newest
from tillstream.schemas import CHANGE, CHANGE_RECORD


def normalize_changes(df: DataFrame, topic: str, value: str) -> DataFrame:
    """Database log records (topic ``server.database.table``, JSON before/after/op) as envelopes.

    Columns: database, table, data, before-data, type; operation ``create`` becomes ``insert``.
    Parts that a topic lacks are null. Every record is parsed once (out of a generator).
    """
    rest = [c for c in df.columns if c not in (topic, value)]
    record = F.coalesce(F.from_json(value, CHANGE_RECORD), F.from_json(F.lit("{}"), CHANGE_RECORD))
    parsed = df.select("*", F.explode(F.array(record)).alias("_r")).withColumn("_t", F.split(topic, r"\."))
    op = F.lower("_r.op")
    empty = F.create_map().cast("map<string,string>")
    return parsed.select(
        *rest,
        F.get("_t", 1).alias("database"),
        F.get("_t", 2).alias("table"),
        F.coalesce("_r.after", empty).alias("data"),
        F.coalesce("_r.before", empty).alias("before-data"),
        F.when(op == "create", "insert").otherwise(op).alias("type"),
    )


def parse_envelopes(df: DataFrame, value: str) -> DataFrame:
    rest = [c for c in df.columns if c != value]
    return df.select(*rest, F.from_json(value, CHANGE).alias("_e")).select(*rest, "_e.*")


def with_data(changes: DataFrame) -> DataFrame:
    """Drop envelopes whose data object is absent or empty (deletes)."""
    return changes.where(F.col("data").isNotNull() & (F.size("data") > 0))


def active_routes(config: DataFrame, version: str | None = None, deleted: Column | None = None) -> DataFrame:
    """The newest route per source table and operation; a deleted route is gone."""
    if version is None:
        return config
    marked = config.withColumn("_gone", deleted if deleted is not None else F.lit(False))
    return newest(marked, ["source_table", "operate_type"], [version]).where(~F.col("_gone")).drop("_gone")


def keep_columns(data: Column, columns: Column) -> Column:
    """The map entries whose key is in a comma-separated list."""
    names = F.split(columns, ",")
    return F.map_filter(data, lambda k, _: F.array_contains(names, k))


def route(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach sink type and table to each change and prune its columns; unknown ones drop out.

    There is one route per source table and operation of a database; Spark broadcasts them while
    they are below its threshold, and joins by shuffle beyond it.
    """
    r = routes.select(F.col("source_table").alias("_table"), F.col("operate_type").alias("_op"),
                      "sink_type", "sink_table", "sink_columns", "sink_pk")
    hit = (changes["table"] == r["_table"]) & (changes["type"] == r["_op"])
    out = changes.join(r, hit).withColumn("data", keep_columns(F.col("data"), F.col("sink_columns")))
    return out.drop("_table", "_op", "sink_columns")


def upserted(current: DataFrame, changes: DataFrame, pk: Sequence[str], seq: str) -> DataFrame:
    """A table after its changes: the row with the highest ``seq`` per primary key.

    Rows of ``current`` count as older than any change. Combined before the shuffle.
    """
    old = current.withColumn(seq, F.lit(None).cast(changes.schema[seq].dataType))
    both = old.unionByName(changes.select(*old.columns))
    return newest(both, pk, [seq]).drop(seq)


def latest_documents(df: DataFrame, key: str, seq: Sequence[str]) -> DataFrame:
    """Last row per key as document id and JSON text."""
    last = newest(df, [key], seq)
    return last.select(F.col(key).cast("string").alias("id"), F.to_json(F.struct(*df.columns)).alias("doc"))
