"""Streams give the results of the batch forms (file streams in small batches)."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import patterns
from tillstream.plans import bindings as b
from tillstream.streaming import flows
from tillstream.streaming import processors as p

HOURS = timedelta(hours=1)
FAR = datetime(2031, 1, 1)


@pytest.fixture(scope="module")
def event_folder(spark, tmp_path_factory):
    """Events in three files by time, each shuffled, then a far-future row that closes everything."""
    folder = str(tmp_path_factory.mktemp("events"))
    e = b.events(spark, "/root/testdata/sf0.001")
    for i, (lo, hi) in enumerate(((1, 11), (11, 21), (21, 32))):
        day = F.dayofmonth("ts")
        part = e.where((day >= lo) & (day < hi)).orderBy(F.rand(i))
        part.coalesce(1).write.mode("append").parquet(folder)
    far = spark.createDataFrame([(10**9, FAR, -4, "end", 0.0, "{}")],
                                "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    far.coalesce(1).write.mode("append").parquet(folder)
    return folder, e


def collect_stream(df, tmp_path, mode="append", sink=None):
    out = str(tmp_path / "out")
    flows.run(df, sink or flows.to_folder(out), str(tmp_path / "cp"), mode, once=True).awaitTermination(300)
    return df.sparkSession.read.parquet(out)


def stream(spark, folder, e):
    return flows.parquet_stream(spark, folder, e.schema, files_per_batch=1)


def pairs(df, *cols):
    return sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect())


DELAY = timedelta(days=11)


def followed(spark, event_folder, tmp_path, kind, processor, key="user_id", where=None):
    folder, e = event_folder
    s = stream(spark, folder, e)
    s = s.where(where | (F.col("user_id") < 0)) if where is not None else s
    out = collect_stream(p.follow(s, key, "ts", "event_id", kind, DELAY, processor), tmp_path)
    return out.where(~F.col("key").startswith("-"))


def test_new_visitor(spark, event_folder, tmp_path):
    flag = F.when(F.coalesce(b.k(), F.lit(0)) % 2 == 0, "1").otherwise("0")
    got = followed(spark, event_folder, tmp_path, flag, p.NewVisitor())
    want = patterns.correct_new_flag(event_folder[1].withColumn("flag", flag), "user_id", "flag", "ts", ["event_id"])
    assert pairs(got, "seq", "outcome") == pairs(want, "event_id", "flag")


def test_daily_visit(spark, event_folder, tmp_path):
    got = followed(spark, event_folder, tmp_path, "event_type", p.DailyVisit())
    want = patterns.first_of_day(event_folder[1], "user_id", "ts", ["event_id"])
    assert pairs(got, "seq") == pairs(want, "event_id")


def test_bounce(spark, event_folder, tmp_path):
    kind = F.when(F.col("event_type") == "signup", "entry").otherwise("page")
    got = followed(spark, event_folder, tmp_path, kind, p.Bounce(12 * HOURS))
    want = patterns.bounces(event_folder[1], "user_id", F.col("event_type") == "signup", "ts", ["event_id"], 12 * HOURS)
    assert pairs(got, "seq") == pairs(want, "event_id")


def test_login_guard(spark, event_folder, tmp_path):
    kind = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    got = followed(spark, event_folder, tmp_path, kind, p.LoginGuard(24 * HOURS),
                   where=F.col("event_type").isin("error", "signup"))
    logins = event_folder[1].withColumn("kind", kind).where(F.col("event_type").isin("error", "signup"))
    want = patterns.login_alerts(logins, "user_id", "kind", "ts", ["event_id"], 24 * HOURS)
    ids = logins.join(want, (logins["user_id"] == want["user_id"]) & (logins["ts"] == want["second_ts"]))
    assert pairs(got, "seq") == pairs(ids, "event_id")
    assert want.count() > 0


def test_pay_next(spark, event_folder, tmp_path):
    kind = F.when(F.col("event_type") == "view", "create").otherwise("pay")
    used = F.col("event_type").isin("view", "purchase")
    got = followed(spark, event_folder, tmp_path, kind, p.PayNext(12 * HOURS), where=used)
    orders = event_folder[1].withColumn("kind", kind).where(used)
    matched, timeout = patterns.next_is(orders, "user_id", "kind", "create", "pay", "ts", ["event_id"], 12 * HOURS)
    assert pairs(got.where("outcome = 'matched'"), "seq") == pairs(matched, "event_id")
    assert pairs(got.where("outcome = 'timeout'"), "seq") == pairs(timeout, "event_id")


def test_click_limit(spark, event_folder, tmp_path):
    key = F.concat_ws("/", "user_id", "event_type")
    got = followed(spark, event_folder, tmp_path, "event_type", p.ClickLimit(2), key=key)
    normal, alert, _ = patterns.blacklist(event_folder[1], "user_id", "event_type", "ts", ["event_id"], 2)
    assert pairs(got.where("outcome = 'normal'"), "seq") == pairs(normal, "event_id")
    assert pairs(got.where("outcome = 'alert'"), "seq") == pairs(alert, "event_id")


def test_order_watch(spark, tmp_path):
    at = datetime(2024, 1, 1)
    rows = [(1, "create", 0), (1, "pay", 15), (2, "pay", 16), (2, "create", 0), (3, "create", 0), (4, "pay", 3),
            (5, "create", 0), (5, "pay", 21), (6, "create", 0), (6, "pay", 20)]
    events = spark.createDataFrame([(o, k, at + timedelta(minutes=m)) for o, k, m in rows],
                                   "order_id long, kind string, ts timestamp")
    end = spark.createDataFrame([(-1, "create", FAR)], events.schema)
    folder = str(tmp_path / "in")
    for part in (events, end):
        part.coalesce(1).write.mode("append").parquet(folder)
    s = flows.parquet_stream(spark, folder, events.schema, files_per_batch=1)
    minutes = timedelta(minutes=1)
    got = collect_stream(p.follow(s, "order_id", "ts", "order_id", "kind", timedelta(hours=1),
                                  p.OrderWatch(15 * minutes, 20 * minutes)), tmp_path)
    want = patterns.watch_payments(events, "order_id", "kind", "ts", 15 * minutes, 20 * minutes)
    assert pairs(got.where("key <> '-1'"), "key", "outcome") == pairs(want, "order_id", "outcome")
