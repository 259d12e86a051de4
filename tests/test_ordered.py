"""Ordered values are the same with and without split keys."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstream.operators.aggregates import running_distinct
from tillstream.operators.ordered import SplitPolicy, _tag, following, hot_keys, position, previous, running, with_ordered
from tillstream.plans import bindings as b

SMALL = SplitPolicy(share=1000)


@pytest.fixture
def events(spark, sf):
    """Events with rows and keys that have no value, and one user with a third of the rows."""
    e = b.events(spark, sf)
    user = F.when(F.col("event_id") % 3 == 0, 1).when(F.col("user_id") > 4, F.col("user_id"))
    ts = F.when(F.col("event_id") % 40 != 0, F.col("ts"))
    return e.select("event_id", user.alias("user_id"), ts.alias("ts"), "event_type", "value").cache()


def values():
    view = F.col("event_type") == "view"
    return {
        "n": position(), "total": running("sum", F.col("event_id")), "top": running("max", F.col("value")),
        "low": running("min", F.struct("ts", "event_id")), "before": previous(F.col("event_type")),
        "after": following(F.col("ts")), "view_before": previous(F.col("event_id"), view),
        "view_after": following(F.col("event_id"), view),
    }


def direct(df, keys):
    up = Window.partitionBy(*keys).orderBy("ts", "event_id")
    down = Window.partitionBy(*keys).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    view = F.when(F.col("event_type") == "view", F.col("event_id"))
    rows = (Window.unboundedPreceding, -1)
    return df.select(
        "*", F.row_number().over(up).cast("long").alias("n"), F.sum("event_id").over(up).alias("total"),
        F.max("value").over(up).alias("top"), F.min(F.struct("ts", "event_id")).over(up).alias("low"),
        F.lag("event_type").over(up).alias("before"), F.lead("ts").over(up).alias("after"),
        F.last(view, True).over(up.rowsBetween(*rows)).alias("view_before"),
        F.last(view, True).over(down.rowsBetween(*rows)).alias("view_after"))


@pytest.mark.parametrize("keys", [["user_id"], ["user_id", "event_type"], []])
@pytest.mark.parametrize("policy", [SMALL, None])
def test_equals_plain_window(events, keys, policy):
    got = with_ordered(events, keys, "ts", ["event_id"], policy, **values())
    want = direct(events, keys)
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_chunks_from_another_table(events):
    """Any chunk table gives the same values, also one that knows only some keys and times."""
    part = events.where((F.col("event_id") > 300) & (F.col("user_id") < 9))
    got = with_ordered(events, ["user_id"], "ts", ["event_id"], hot=hot_keys(part, ["user_id"], "ts", SMALL), **values())
    assert got.exceptAll(direct(events, ["user_id"])).count() == 0


def test_hot_keys_are_few_and_chunks_are_even(events):
    """Never more hot keys than ``share``; a burst is cut as finely as its rows ask for."""
    hot = hot_keys(events, ["user_id"], "ts", SplitPolicy(share=5))
    assert 1 <= hot.spans.count() <= 5
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert 1 <= hot_keys(events, ["user_id"], "ts").spans.count() <= parts  # the hot user, also on a small table
    burst = events.where(F.col("ts").isNotNull()).withColumn(
        "ts", F.when(F.col("event_id") % 50 != 0, F.lit("2024-01-03").cast("timestamp") + F.make_dt_interval(secs=F.col("event_id") % 3000))
        .otherwise(F.col("ts").cast("timestamp")))
    policy = SplitPolicy(share=10, cells=5000)
    got = with_ordered(burst, [], "ts", ["event_id"], policy, n=position())
    assert got.agg(F.max("n")).first()[0] == burst.count() == got.select("n").distinct().count()
    sizes = _tag(burst, hot_keys(burst, [], "ts", policy), [], "ts", False).groupBy("_chunk").count()
    assert sizes.count() >= 8
    assert sizes.agg(F.max("count")).first()[0] <= 2 * burst.count() / 10


def test_running_distinct(events):
    rows = events.where(F.col("ts").isNotNull())
    first = Window.partitionBy("user_id").orderBy("ts", "event_id")
    new = F.when(F.col("user_id").isNotNull() & (F.row_number().over(first) == 1), 1).otherwise(0)
    want = rows.withColumn("new", new).select("event_id", F.sum("new").over(Window.orderBy("ts", "event_id")).alias("uv"))
    for policy in (SMALL, None):
        got = running_distinct(rows, "user_id", "ts", "event_id", "uv", policy).select("event_id", "uv")
        assert got.exceptAll(want).count() == 0
        assert got.count() == want.count()
