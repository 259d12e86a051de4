"""Tumbling and sliding event-time windows and rankings inside windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.times import epoch_micros, from_micros, interval_text, micros, text


def tumbling(df: DataFrame, ts: str, size: timedelta, keys: Sequence[str | Column],
             *aggs: Column) -> DataFrame:
    """Aggregates per tumbling window and key, with ``window_start`` and ``window_end``.

    Valid on streams too; the caller sets the watermark.
    """
    grouped = df.groupBy(F.window(ts, interval_text(size)).alias("_w"), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c != "_w"]
    return grouped.select(F.col("_w.start").alias("window_start"),
                          F.col("_w.end").alias("window_end"), *rest)


def stamp(df: DataFrame) -> DataFrame:
    """Window borders as texts ``stt`` and ``edt``."""
    rest = [c for c in df.columns if c not in ("window_start", "window_end")]
    return df.select(text(F.col("window_start")).alias("stt"),
                     text(F.col("window_end")).alias("edt"), *rest)


def distinct_in_windows(df: DataFrame, ts: str, size: timedelta, values: Sequence[str], out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Different values per tumbling window and key, counted exactly; a null is no value.

    One row per window, key and value is left before the count, so a window with many rows is never one group of
    them all. On a watermarked stream both steps drop their state once their window is closed.
    """
    first = df.withColumn("_w", F.window(ts, interval_text(size))).select("_w", *keys, *values).dropDuplicates()
    known = F.lit(True)
    for value in values:
        known = known & F.col(value).isNotNull()
    grouped = first.groupBy("_w", *keys).agg(F.count(F.when(known, 1)).alias(out))
    return grouped.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, out)


def sliding_direct(df: DataFrame, ts: str, size: timedelta, slide: timedelta,
                   keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Sliding windows by Spark's own window expression: every row is copied ``size/slide``
    times. The form for streams and for aggregates that cannot be subtracted."""
    window = F.window(ts, interval_text(size), interval_text(slide)).alias("_w")
    grouped = df.groupBy(window, *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c != "_w"]
    return grouped.select(F.col("_w.start").alias("window_start"),
                          F.col("_w.end").alias("window_end"), *rest)


def sliding_sums(df: DataFrame, ts: str, size: timedelta, slide: timedelta,
                 keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Sliding-window sums of row values from changes at window borders.

    A row enters the windows at one start and leaves them at a later one, so two signed
    changes describe it completely. Changes are summed per key and slide-wide step before their
    shuffle; the running sum of the changes is the window value from one change to the next.
    Cost follows ``2 * rows`` and results, not ``rows * size / slide``. Sums must be integers
    or decimals, for which adding and subtracting is exact.

    The ordered step works on steps of time, whose number per key is bounded by the time span
    and not by the rows of the key.
    """
    s, d = micros(slide), micros(size)
    if d % s:
        raise ValueError("window size must be a multiple of the slide")
    names = ["_rows", *sums]
    us = epoch_micros(F.col(ts))
    values = {"_rows": F.lit(1).cast("long")} | {n: F.coalesce(c, F.lit(0)) for n, c in sums.items()}
    panes = df.where(F.col(ts).isNotNull()).select(
        *keys, (us - F.pmod(us, F.lit(s))).alias("_p"), *[c.alias(n) for n, c in values.items()])

    def change(at: Column, sign: int) -> Column:
        return F.struct(at.alias("_at"), *[(F.col(n) * sign).alias(n) for n in names])

    changes = (
        panes.select(*keys, F.explode(F.array(change(F.col("_p") - (d - s), 1),
                                              change(F.col("_p") + s, -1))).alias("_c"))
        .select(*keys, "_c.*")
        .groupBy(*keys, "_at").agg(*[F.sum(n).alias(n) for n in names])
    )
    by_key = Window.partitionBy(*keys).orderBy("_at") if keys else Window.orderBy("_at")
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = changes.select(
        *keys, "_at", F.lead("_at").over(by_key).alias("_until"),
        *[F.sum(n).over(upto).alias(n) for n in names],
    ).where(F.col("_rows") > 0)
    starts = F.sequence(F.col("_at"), F.col("_until") - s, F.lit(s))
    return levels.select(*keys, *sums, F.explode(starts).alias("_s")).select(
        from_micros(F.col("_s")).alias("window_start"),
        from_micros(F.col("_s") + d).alias("window_end"), *keys, *sums)


def top_n(df: DataFrame, by: Sequence[str], score: str, ties: Sequence[str], n: int,
          rank: str = "rk") -> DataFrame:
    """The ``n`` rows with the highest score per group, ties broken by ``ties`` ascending.

    Spark limits each task to ``n`` rows per group before the shuffle (window group limit),
    so a large group is never gathered whole.
    """
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), *ties)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).withColumn(
        rank, F.col(rank).cast("long"))
