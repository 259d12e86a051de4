"""Rows that come in after their window has been closed."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.times import epoch_micros, micros


def window_end(ts: Column, size: timedelta) -> Column:
    """End of the tumbling window of a time, in epoch microseconds."""
    us = epoch_micros(ts)
    return us - F.pmod(us, F.lit(micros(size))) + micros(size)


def mark_late(df: DataFrame, ts: str, batch: str, size: timedelta, delay: timedelta,
              lateness: timedelta = timedelta(0)) -> DataFrame:
    """Flag ``late``: the row's window plus lateness had ended at the watermark of the batches before.

    The watermark is the largest event time of all earlier batches minus the delay. Only one
    maximum per batch enters the ordered step; batches are triggers, so their number follows
    the run time of the stream. They join back by batch, with Spark choosing the join. A row
    without a time or a batch has no mark before it and is not late.
    """
    tops = df.groupBy(batch).agg(F.max(epoch_micros(F.col(ts))).alias("_top"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    marks = tops.select(F.col(batch).alias("_batch"), (F.max("_top").over(before) - micros(delay)).alias("_mark"))
    closed = window_end(F.col(ts), size) + micros(lateness)
    out = df.join(marks, df[batch].eqNullSafe(marks["_batch"]), "left")
    known = F.col(batch).isNotNull()
    return out.withColumn("late", F.coalesce(known & (closed <= F.col("_mark")), F.lit(False))).drop("_batch", "_mark")


def closed_before(ts: Column, mark_us: int, size: timedelta, lateness: timedelta = timedelta(0)) -> Column:
    """Whether a row's window plus lateness had ended at a watermark (epoch microseconds)."""
    return window_end(ts, size) + micros(lateness) <= mark_us
