"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then SHA-256 of the whole text.

A row leaves the search as soon as its length, or its length and prefix hash, is its own; only rows that share both
are grouped by digest. All keys are narrow columns of one scan, so texts are never shuffled to find the groups. Only
DataFrame functions are used.

Cases: a null text equals an empty one; texts are compared after lower-casing A-Z; of equal texts the largest id
stays; rows that repeat an id are all reported, and `without_copies` keeps one of them; a null id is smaller than any
other; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.names import unused
from tillstream.session import stored

KEYS = ["_length", "_head"]


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case, all else as it is; null becomes empty."""
    full = F.coalesce(text, F.lit(""))
    plain = F.octet_length(full) == F.char_length(full)  # lower() touches other letters too, where there are any
    return F.when(plain, F.lower(full)).otherwise(F.translate(full, string.ascii_uppercase, string.ascii_lowercase))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", head: int = 256) -> DataFrame:
    """One row per document: `doc_id`, `keep_id`, `group_size`, `kept` and `text_sha256`.

    head: characters whose hash refines the length groups.
    """
    body = F.col(text)
    keys = stored(docs.select(
        F.col(doc_id).alias("doc_id"), F.octet_length(F.coalesce(body, F.lit(""))).alias("_length"),
        F.xxhash64(normalised(F.substring(body, 1, head))).alias("_head"), F.sha2(normalised(body), 256).alias("text_sha256"),
    ), "exact")
    shared = F.col("_n") > 1
    lengths = keys.groupBy("_length").agg(F.count(F.lit(1)).alias("_n")).where(shared)
    heads = keys.join(lengths, "_length", "left_semi").groupBy(KEYS).agg(F.count(F.lit(1)).alias("_n")).where(shared)
    equal = keys.join(heads, KEYS, "left_semi").groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("_n")).where(shared)
    alone = F.col("_n").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return keys.join(equal, "text_sha256", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, all columns as they were; of rows with the same id and text one stays.

    Texts move at most once, and not at all where the ids to drop are few enough for Spark to broadcast them. Only rows
    whose id repeats are looked at by id and digest.
    """
    found = stored(exact_groups(docs, doc_id, text).select("doc_id", "kept", "text_sha256"), "kept")
    gone, digest, own = (unused(docs, name) for name in ("_gone", "_digest", "_digest_own"))
    repeated = stored(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias(gone)), "repeated")
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias(gone)).union(repeated).distinct()
    alone = docs.join(dropped, F.col(doc_id).eqNullSafe(F.col(gone)), "left_anti")
    again = docs.join(repeated, F.col(doc_id).eqNullSafe(F.col(gone)), "left_semi").withColumn(own, F.sha2(normalised(F.col(text)), 256))
    stay = found.where("kept").select(F.col("doc_id").alias(gone), F.col("text_sha256").alias(digest)).distinct()
    kept = again.join(stay, F.col(doc_id).eqNullSafe(F.col(gone)) & (F.col(own) == F.col(digest)), "left_semi")
    return alone.unionByName(kept.dropDuplicates([doc_id, own]).drop(own))
