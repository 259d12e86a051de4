"""Patterns on sample rows with known results, split and unsplit."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import patterns as p
from tillstream.operators.ordered import SplitPolicy
from tillstream.plans import bindings as b

S, M = timedelta(seconds=1), timedelta(minutes=1)
POLICIES = [None, SplitPolicy(share=1000)]


def events(spark, rows, columns="key long, kind string, sec long"):
    return spark.createDataFrame(rows, columns).withColumn("ts", F.timestamp_seconds("sec")).withColumn(
        "id", F.monotonically_increasing_id())


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


LOGINS = [(5402, "success", 1558430815), (23064, "fail", 1558430826), (5692, "fail", 1558430833),
          (1035, "fail", 1558430842), (1035, "success", 1558430844), (1035, "fail", 1558430843)]


@pytest.mark.parametrize("policy", POLICIES)
def test_login_sample(spark, policy):
    """Event-time order puts the success after both failures."""
    logins = events(spark, LOGINS)
    alert = p.login_alerts(logins, "key", "kind", "ts", ["id"], 3 * S, policy=policy)
    assert values(alert, "key", F.unix_seconds("first_ts"), F.unix_seconds("second_ts")) == [(1035, 1558430842, 1558430843)]
    seq = p.failure_sequences(logins, "key", "kind", "ts", "id", 2 * S, policy)
    assert values(seq, "key", "fails") == [(1035, 2)]


@pytest.mark.parametrize("policy", POLICIES)
def test_failures(spark, policy):
    rows = [(1, "fail", 0), (1, "fail", 1), (1, "fail", 1), (1, "fail", 5), (1, "success", 6), (1, "fail", 7),
            (1, "fail", 9), (2, "fail", 0), (2, "success", 1), (2, "fail", 1)]
    logins = events(spark, rows).withColumn("id", F.col("id") * 0 + F.col("sec"))
    once = p.login_alerts(logins, "key", "kind", "ts", ["id"], 3 * S, policy=policy)
    assert values(once, "run", F.unix_seconds("second_ts")) == [(0, 1), (1, 9)]
    every = p.login_alerts(logins, "key", "kind", "ts", ["id"], 3 * S, once_per_run=False, policy=policy)
    assert values(every, F.unix_seconds("second_ts")) == [(1,), (1,), (9,)]
    seqs = p.failure_sequences(logins, "key", "kind", "ts", "id", 2 * S, policy)
    got = values(seqs, F.unix_seconds("start_ts"), F.unix_seconds("end_ts"), "fails", "first_pos", "last_pos")
    assert got == [(0, 1, 2, 1, 2), (0, 1, 3, 1, 3), (1, 1, 2, 2, 3)]
    members = p.sequence_members(seqs, logins, "key", "kind", "ts", "id", policy)
    assert values(members, "first_pos", "last_pos", "id") == [(1, 2, 0), (1, 2, 1), (1, 3, 0), (1, 3, 1), (1, 3, 1), (2, 3, 1), (2, 3, 1)]


def test_long_run_of_failures(spark):
    """Two thousand failures of one attacker: all sequences within ten seconds, none of them with a list."""
    logins = events(spark, [(1, "fail", k) for k in range(2000)])
    seqs = p.failure_sequences(logins, "key", "kind", "ts", "id", 10 * S)
    assert seqs.count() == sum(min(9, 1999 - k) for k in range(2000))
    assert not any(t.startswith("array") for _, t in seqs.dtypes)


ORDERS = [(34756, "create", 1558430913), (34767, "create", 1558430949), (34768, "pay", 1558430950),
          (34756, "pay", 1558431951), (34767, "pay", 1558432021), (34729, "create", 1558430842), (34729, "pay", 1558430844)]


def test_order_watch_sample(spark):
    got = p.watch_payments(events(spark, ORDERS), "key", "kind", "ts", 15 * M, 20 * M)
    assert values(got, "key", "outcome") == [(34729, "normal"), (34756, "late"), (34767, "late"), (34768, "pay_only")]


@pytest.mark.parametrize("policy", POLICIES)
def test_order_next_sample(spark, policy):
    matched, timeout = p.next_is(events(spark, ORDERS), "key", "kind", "create", "pay", "ts", ["id"], 15 * M, policy)
    assert values(matched, "key") == [(34729,)]
    assert values(timeout, "key") == [(34756,), (34767,)]


def test_order_next_other(spark):
    """Another creation in between ends the first match without a timeout; the limit itself is a timeout."""
    rows = [(1, "create", 0), (1, "create", 10), (1, "pay", 20), (2, "create", 0), (2, "pay", 900)]
    matched, timeout = p.next_is(events(spark, rows), "key", "kind", "create", "pay", "ts", ["id"], 15 * M)
    assert values(matched, "key", "sec") == [(1, 10)]
    assert values(timeout, "key", "sec") == [(2, 0)]


def test_order_watch_edges(spark):
    rows = [(1, "create", 0), (1, "pay", 900), (2, "create", 0), (2, "pay", 901), (3, "create", 0), (3, "pay", 1200),
            (4, "create", 0), (4, "pay", 1201), (5, "pay", 0), (5, "create", 60), (6, "create", 0)]
    got = p.watch_payments(events(spark, rows), "key", "kind", "ts", 15 * M, 20 * M)
    assert values(got, "key", "outcome") == [(1, "normal"), (2, "late"), (3, "late"), (4, "cancelled"), (4, "pay_only"),
                                             (5, "normal"), (6, "cancelled")]


@pytest.mark.parametrize("policy", POLICIES)
def test_bounce(spark, policy):
    rows = [(1, "entry", 0), (1, "entry", 10), (1, "page", 20), (1, "entry", 100), (1, "page", 130), (2, "page", 0),
            (2, "entry", 5), (3, "entry", 0), (3, "page", 29)]
    got = p.bounces(events(spark, rows), "key", F.col("kind") == "entry", "ts", ["id"], 30 * S, policy)
    assert values(got, "key", "sec") == [(1, 0), (1, 100), (2, 5)]


@pytest.mark.parametrize("policy", POLICIES)
def test_blacklist(spark, policy):
    """Counts start again at local midnight, and every click is in exactly one output."""
    evening = 1511711999 - 4  # 23:59:55 in UTC+8
    clicks = events(spark, [(1, "ad", evening + i) for i in range(10)])
    normal, alert, dropped = p.blacklist(clicks, "key", "kind", "ts", ["id"], 4, "+08:00", policy)
    assert values(normal, "sec") == [(evening + i,) for i in (0, 1, 2, 5, 6, 7)]
    assert values(alert, "sec") == [(evening + 3,), (evening + 8,)]
    assert values(dropped, "sec") == [(evening + 4,), (evening + 9,)]


@pytest.mark.parametrize("policy", POLICIES)
def test_new_flag(spark, policy):
    rows = [(1, "0", 0), (1, "1", 1), (1, "1", 2), (1, "0", 3), (1, "1", 4), (2, "1", 9)]
    got = p.correct_new_flag(events(spark, rows), "key", "kind", "ts", ["id"], policy)
    assert values(got, "key", "sec", "kind") == [(1, 0, "0"), (1, 1, "1"), (1, 2, "0"), (1, 3, "0"), (1, 4, "0"), (2, 9, "1")]


def test_first_of_day(spark):
    rows = [(1, "a", 57600), (1, "b", 57599), (1, "c", 10), (2, "d", 0)]  # local midnight at 57600
    got = p.first_of_day(events(spark, rows), "key", "ts", ["id"], "+08:00")
    assert values(got, "key", "kind") == [(1, "a"), (1, "c"), (2, "d")]


def test_split_keys_on_tables(spark, sf):
    """Whole tables give the same with hot keys split."""
    e, small = b.events(spark, sf), SplitPolicy(share=1000)
    for run in (lambda s: p.bounces(e, "user_id", F.col("event_type") == "signup", "ts", ["event_id"], 720 * M, s),
                lambda s: p.failure_sequences(b.logins(spark, sf), "user_id", "kind", "ts", "event_id", 720 * M, s),
                lambda s: p.blacklist(e, "user_id", "event_type", "ts", ["event_id"], 2, policy=s)[0]):
        assert run(None).exceptAll(run(small)).count() == 0
        assert run(None).count() == run(small).count() > 0
