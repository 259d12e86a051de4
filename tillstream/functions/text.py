"""Names, tokens and JSON text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of letters or a run of digits, in any language.
WORD_PATTERN = r"\p{L}+|\p{N}+"


def camel_case(name: str) -> str:
    """``snake_case`` name as ``camelCase``."""
    head, *rest = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def rename_camel(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_case(c) for c in df.columns])


def words(col: Column) -> Column:
    """The lower-case words of a text, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(col), F.lit(WORD_PATTERN), F.lit(0))


def explode_words(df: DataFrame, col: str, out: str = "word") -> DataFrame:
    """One row per word of ``col``; rows without words vanish."""
    return df.withColumn(out, F.explode(words(F.col(col))))


def explode_with(df: DataFrame, col: str, splitter: Callable[[str], list[str]],
                 out: str = "word") -> DataFrame:
    """One row per word as cut by a custom ``splitter`` (runs on Arrow batches)."""

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: [] if t is None else splitter(t))

    return df.withColumn(out, F.explode(cut(F.col(col))))


class SplitWords:
    """Table function ``split_words(text) -> (word)`` for SQL lateral joins."""

    def eval(self, text: str):
        for word in regex.findall(WORD_PATTERN, (text or "").lower()):
            yield (word,)


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    spark.udtf.register(name, F.udtf(SplitWords, returnType="word: string"))


def is_empty(col: Column) -> Column:
    return col.isNull() | (F.length(col) == 0)


def code_flag(col: Column, code: str) -> Column:
    """1 where the column holds the code, else 0."""
    return F.when(col == code, 1).otherwise(0).cast("long")


def as_json(*cols: str | Column) -> Column:
    """The columns as JSON text with a fixed field order."""
    return F.to_json(F.struct(*cols))
