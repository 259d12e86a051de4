"""Windows, aggregates, joins, logs, changes and late rows on small inputs."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions import text, times
from tillstream.operators import aggregates as a
from tillstream.operators import changes, joins, late, logs, windows
from tillstream.plans import bindings as b
from tillstream.plans import stats
from tillstream.plans.stats_queries import product_inputs

M, H = timedelta(minutes=1), timedelta(hours=1)


def values(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def same(x, y):
    return x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


@pytest.mark.parametrize("size, slide", [(H, 5 * M), (H, H), (12 * H, 3 * H)])
@pytest.mark.parametrize("keys", [["event_type"], ["user_id", "event_type"]])
def test_sliding_sums_equal_direct_windows(spark, sf, size, slide, keys):
    e = b.events(spark, sf).withColumn("cents", F.round(F.col("value") * 100).cast("long")).withColumn("ts", F.col("ts").cast("timestamp"))
    got = windows.sliding_sums(e, "ts", size, slide, keys, {"n": F.lit(1), "cents": F.col("cents")})
    want = windows.sliding_direct(e, "ts", size, slide, keys, F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    assert same(got, want.select(got.columns))


def test_sliding_needs_whole_panes(spark, sf):
    with pytest.raises(ValueError):
        windows.sliding_sums(b.events(spark, sf), "ts", H, 7 * M, [], {})


def test_top_n_limits_before_the_shuffle(spark, sf):
    counts = b.events(spark, sf).groupBy("event_type", "user_id").count()
    top = windows.top_n(counts, ["event_type"], "count", ["user_id"], 2)
    assert values(top.groupBy("event_type").count(), "count") == [(2,)] * 5
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


SENSORS = [("ws_001", 1577844001, 45), ("ws_002", 1577844015, 43), ("ws_003", 1577844020, 42), ("ws_001", 1577844001, 25),
           ("ws_006", 1577844015, 18), ("ws_007", 1577844020, 42), ("ws_008", 1577844010, 48), ("ws_006", 1577844001, 1),
           ("ws_001", 1577844001, 5), ("ws_001", 1577844001, 3), ("ws_002", 1577844001, 1), ("ws_001", 1577844001, 5),
           ("ws_001", 1577844001, 32), ("ws_001", 1577844001, 51), ("ws_001", 1577844001, 35)]


def test_sensor_sample(spark):
    s = spark.createDataFrame(SENSORS, "id string, ts long, vc long")
    got = s.groupBy("id").agg(F.sum("vc"), F.max("vc"), F.min("vc"))
    assert values(got) == [("ws_001", 201, 51, 3), ("ws_002", 44, 43, 1), ("ws_003", 42, 42, 42), ("ws_006", 19, 18, 1),
                           ("ws_007", 42, 42, 42), ("ws_008", 48, 48, 48)]


def test_arg_max_ties(spark):
    rows = [("s1", 1, 20), ("s1", 2, 50), ("s1", 3, 50), ("s2", 4, 10), ("s2", 5, 10), ("s2", 6, 30)]
    s = spark.createDataFrame(rows, "id string, seq long, vc long")
    assert values(a.arg_max(s, ["id"], "vc", ["seq"])) == [("s1", 3, 50), ("s2", 6, 30)]
    assert values(a.arg_max(s, ["id"], "vc", ["seq"], last_tie=False)) == [("s1", 2, 50), ("s2", 6, 30)]
    assert values(a.arg_min(s, ["id"], "vc", ["seq"])) == [("s1", 1, 20), ("s2", 4, 10)]
    assert values(a.arg_min(s, ["id"], "vc", ["seq"], last_tie=True)) == [("s1", 1, 20), ("s2", 5, 10)]


def test_rolled_keeps_first_fields(spark):
    s = spark.createDataFrame([("s1", 2, 5), ("s1", 1, 7)], "id string, ts long, vc long")
    assert values(a.rolled(s, ["id"], ["ts"], ["ts"], vc=F.sum("vc"))) == [("s1", 1, 12)]


def test_user_aggregate_equals_built_in(spark, sf):
    """A mean as (sum, count), with a hot key, null keys and tasks that hand on early."""
    mean = a.Aggregator(create=lambda: (0, 0), add=lambda acc, r: (acc[0] + int(r["k"].sum()), acc[1] + len(r)),
                        merge=lambda x, y: (x[0] + y[0], x[1] + y[1]), result=lambda acc: acc[0] / acc[1],
                        result_type=T.DoubleType())
    e = b.events(spark, sf).select(F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("t"), b.k().alias("k"))
    got = a.aggregate(e.repartition(6), ["t"], mean, "m", fan_in=2, max_held_keys=2)
    assert same(got.select("t", F.round("m", 9)), e.groupBy("t").agg(F.avg("k").alias("m")).select("t", F.round("m", 9)))


def test_word_sample(spark):
    lines = ["hello spark", "hello flow", "hello scala", "hive hive", "hello flow", "hello scala"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = text.explode_words(df, "line").groupBy("word").count()
    assert values(got) == [("flow", 2), ("hello", 5), ("hive", 2), ("scala", 2), ("spark", 1)]


def test_custom_and_sql_splitters(spark):
    df = spark.createDataFrame([(1, "Ab-c 12"), (2, None)], "id long, t string")
    assert values(text.explode_with(df, "t", lambda t: t.split("-")), "word") == [("Ab",), ("c 12",)]
    text.register_split_words(spark)
    df.createOrReplaceTempView("texts")
    assert values(spark.sql("SELECT word FROM texts, LATERAL split_words(t)")) == [("12",), ("ab",), ("c",)]


def test_interval_join_bounds_and_slots(spark):
    """Both forms: bounds are inclusive, hot keys give the same pairs."""
    left = spark.createDataFrame([(1, i * 7) for i in range(40)] + [(2, 0)], "k long, ls long").withColumn("lt", F.timestamp_seconds("ls"))
    right = spark.createDataFrame([(1, i * 5) for i in range(60)] + [(2, 5), (2, 6), (2, -5)], "rk long, rs long").withColumn(
        "rt", F.timestamp_seconds("rs"))
    for lo, hi in ((-5, 5), (-15, 0), (0, 30)):
        args = (left, right, {"k": "rk"}, "lt", "rt", timedelta(seconds=lo), timedelta(seconds=hi))
        plain, slots = joins.interval_join(*args), joins.interval_join(*args, hot=True)
        want = left.join(right, (F.col("k") == F.col("rk")) & F.expr(f"rs - ls between {lo} and {hi}"))
        assert same(plain, want) and same(slots, want)


def test_lookup_keeps_or_drops(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "f long")
    dim = spark.createDataFrame([(1, "one")], "id long, name string")
    assert joins.lookup(facts, dim, "f", "id", {"n": "name"}).where("n is null").count() == 2
    assert values(joins.lookup(facts, dim, "f", "id", {"n": "name"}, "inner", fixed_size=True)) == [(1, "one")]


def test_growing_dimensions_are_not_broadcast_by_hint(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from tillstream.plans.registry import QUERIES
        plan = QUERIES["dim_user"](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairing_is_one_to_one(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, t long").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([("a", 5), ("b", 3), ("b", 4), ("c", 1)], "k string, u long").withColumn("u", F.timestamp_seconds("u"))
    out = joins.pair_by_occurrence(left, right, "k", ["t"], ["u"])
    assert values(out, "k", "nth", F.unix_seconds("t"), F.unix_seconds("u")) == [("a", 1, 1, 5), ("b", 1, 1, 3)]


def test_grouping_sets(spark):
    df = spark.createDataFrame([("c1", "x"), ("c2", "x"), ("c2", "y")], "c string, b string")
    got = a.grouping_sets(df, [["c", "b"], ["b"]], F.count(F.lit(1)).alias("n"))
    assert values(got, F.coalesce("c", F.lit("all")), "b", "n") == [
        ("all", "x", 2), ("all", "y", 1), ("c1", "x", 1), ("c2", "x", 1), ("c2", "y", 1)]


LINES = ['{"common":{"mid":"m1","is_new":"1"},"start":{"entry":"icon"},"ts":1}',
         '{"common":{"mid":"m1","is_new":"1"},"page":{"page_id":"home"},"displays":[{"item":"1","item_type":"sku_id"},{"item":"2","item_type":"x"}],"ts":2}',
         '{"common":{"mid":"m1"', "", "no json", '{"common":{"mid":"m2","is_new":"1"},"page":{"page_id":"good_detail","item":"7","item_type":"sku_id"},"start":{},"ts":3}']


def test_log_split(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)] + [(9, None)], "n long, line string")
    parsed = logs.parse_log(df, "line")
    assert values(logs.dirty(parsed, "line").where("line is not null")) == [("",), ("no json",), ('{"common":{"mid":"m1"',)]
    log = logs.valid(parsed)
    assert logs.dirty(parsed, "line").count() + logs.starts(log).count() + logs.pages(log).count() == 7
    assert values(logs.pages(log), "n") == [(1,), (5,)]
    assert values(logs.displays(log), "display.item", "ts") == [("1", 2), ("2", 2)]
    assert values(logs.product_actions(logs.pages(log))) == [(1, 0, 1, 2), (7, 1, 0, 3)]
    fixed = logs.fix_new_visitors(log, ["n"])
    assert values(fixed, "n", "common.is_new") == [(0, "1"), (1, "0"), (5, "1")]


def test_visitor_forms_agree(spark, sf):
    """Three inputs united, or one ordered pass over the log."""
    from tillstream.operators import patterns
    log = b.log_rows(spark, sf)
    pages = logs.pages(logs.fix_new_visitors(log, ["event_id"])).withColumn("mid", F.col("common.mid"))
    uniques = patterns.first_of_day(pages, "mid", "at", ["event_id"])
    jumps = patterns.bounces(pages, "mid", logs.is_entry(), "at", ["event_id"], 12 * H)
    united = stats.visitor_stats(stats.visitor_rows(pages, uniques, jumps), H)
    passed = stats.visitor_stats(stats.visitor_rows_one_pass(log, ["event_id"], 12 * H), H)
    assert same(united, passed)


def test_product_amount_of_the_share(spark, sf):
    """Order rows can add their own share instead of the whole order's total."""
    inputs = product_inputs(spark, sf)
    total = stats.product_sums(stats.product_rows(**inputs)).agg(F.sum("order_amount")).first()[0]
    share = stats.product_sums(stats.product_rows(**inputs, order_amount="split_total_amount")).agg(F.sum("order_amount")).first()[0]
    assert share == inputs["orders"].agg(F.sum("split_total_amount")).first()[0] != total


def test_changes_and_routes(spark):
    rows = [("s.db.t", '{"after":{"id":"1","a":"x","b":"y"},"op":"create"}'),
            ("s.db.t", '{"before":{"id":"1"},"after":{"id":"1","a":"z"},"op":"UPDATE"}'),
            ("s.db.t", '{"before":{"id":"1"},"op":"delete"}'), ("s.db.u", '{"after":{"id":"2"},"op":"create"}')]
    norm = changes.normalize_changes(spark.createDataFrame(rows, "topic string, value string"), "topic", "value")
    assert values(norm, "database", "table", "type", F.size("data")) == [
        ("db", "t", "delete", 0), ("db", "t", "insert", 3), ("db", "t", "update", 2), ("db", "u", "insert", 1)]
    assert norm.where("type = 'update'").select("`before-data`").first()[0] == {"id": "1"}
    config = spark.createDataFrame(
        [("t", "insert", "kafka", "old", "id", "id", None, 1), ("t", "insert", "hbase", "dim_t", "id,b", "id", None, 2),
         ("t", "update", "kafka", "dwd_t", "id,a", None, None, 1), ("t", "update", "kafka", "dwd_t", "id,a", None, "gone", 2)],
        "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, sink_pk string, sink_extend string, v long")
    routes = changes.active_routes(config, "v", F.coalesce(F.col("sink_extend") == "gone", F.lit(False)))
    out = changes.route(changes.with_data(norm), routes)
    assert values(out, "sink_type", "sink_table", F.to_json("data")) == [("hbase", "dim_t", '{"id":"1","b":"y"}')]


def test_parse_envelopes(spark):
    df = spark.createDataFrame([('{"database":"d","table":"t","data":{"id":1},"before-data":{},"type":"insert"}',)], "v string")
    got = changes.parse_envelopes(df, "v")
    assert got.columns == ["database", "table", "data", "before-data", "type"]
    assert got.first()["data"] == {"id": "1"}


def test_upserts(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, n string")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id long, n string, seq long")
    assert values(changes.upserted(base, new, ["id"], "seq")) == [(1, "a"), (2, "y"), (3, "z")]
    assert values(changes.latest_documents(new, "id", ["seq"])) == [("2", '{"id":2,"n":"y","seq":2}'), ("3", '{"id":3,"n":"z","seq":1}')]


def test_late_marks(spark):
    rows = [(1, 0, 5), (2, 1, 130), (3, 2, 10), (4, 2, 65), (5, 2, 70)]
    df = spark.createDataFrame(rows, "id long, batch long, s long").withColumn("ts", F.timestamp_seconds("s"))
    args = ("ts", "batch", M, timedelta(seconds=10))
    assert values(late.mark_late(df, *args).where("late"), "id") == [(3,), (4,), (5,)]
    assert values(late.mark_late(df, *args, lateness=timedelta(seconds=30)).where("late"), "id") == [(3,)]


def test_times(spark):
    row = spark.sql("SELECT timestamp'2021-03-04 20:30:00' AS ts").select(
        times.text_to_epoch_ms(F.lit("2021-03-04 20:30:00"), "+08:00"), times.text_to_epoch_ms(F.lit("never"), "+08:00"),
        times.epoch_ms_to_text(F.lit(0), "+08:00"), times.text(times.next_midnight(F.col("ts"), "+08:00")),
        times.age_in_years(F.lit("2000-01-01").cast("date"), F.lit("2001-01-01").cast("date")),
        times.text(times.event_time(F.lit("2021-01-01 00:00:00"), F.col("ts"))), times.text(times.event_time(F.lit("?"), F.col("ts"))))
    assert list(row.first()) == [1614861000000, None, "1970-01-01 08:00:00", "2021-03-05 16:00:00", 1, "2021-01-01 00:00:00",
                                 "2021-03-04 20:30:00"]


def test_names():
    assert text.camel_case("order_detail_id") == "orderDetailId"


def test_aggregate_keys_beyond_doubles(spark):
    """Nullable long keys stay apart above 2^53; arrays and times may be keys."""
    from datetime import datetime

    from tillstream.operators.aggregates import aggregate
    from tillstream.plans.aggregate_queries import COUNTER

    rows = [(2**53, "a"), (2**53 + 1, "a"), (None, "a"), (None, "b"), (2**53 + 1, "a")]
    found = aggregate(spark.createDataFrame(rows, "k long, s string"), ["k", "s"], COUNTER, "n")
    assert {(r.k, r.s): r.n for r in found.collect()} == {(2**53, "a"): 1, (2**53 + 1, "a"): 2, (None, "a"): 1, (None, "b"): 1}
    at = datetime(2024, 1, 1, 0, 0, 0, 123456)
    other = spark.createDataFrame([([1, 2], at), ([1, 2], at), ([1], None)], "k array<int>, t timestamp")
    assert sorted((r.k, r.t, r.n) for r in aggregate(other, ["k", "t"], COUNTER, "n").collect()) == [([1], None, 1), ([1, 2], at, 2)]


def test_late_keeps_rows_without_batch(spark):
    from datetime import datetime, timedelta

    from tillstream.operators.late import mark_late

    rows = [(1, 0, datetime(2024, 1, 1)), (2, None, datetime(2024, 1, 1)), (3, 1, None), (4, 1, datetime(2023, 1, 1))]
    df = spark.createDataFrame(rows, "id int, batch int, ts timestamp")
    found = mark_late(df, "ts", "batch", timedelta(hours=1), timedelta(0))
    assert sorted((r.id, r.late) for r in found.collect()) == [(1, False), (2, False), (3, False), (4, True)]


def test_short_records_are_kept(spark):
    from tillstream.operators.changes import normalize_changes
    from tillstream.operators.logs import product_actions
    from tillstream.sources.files import access_log, broken_lines

    lines = spark.createDataFrame([("1 - - 17/05/2015:10:05:03 +0000 GET /a",), ("2 - -",), ("",), (None,)], "value string")
    assert [(r.id, r.url) for r in access_log(lines).collect()] == [("1", "/a"), ("2", None), ("", None), (None, None)]
    assert broken_lines(lines).count() == 3
    topics = spark.createDataFrame([("s.db.t", '{"op":"create","after":{"a":"1"}}'), ("short", "{}"), ("s.db", "broken"), (None, None)], "topic string, value string")
    found = normalize_changes(topics, "topic", "value").collect()
    assert [(r.database, r.table, r.type) for r in found] == [("db", "t", "insert"), (None, None, None), ("db", None, None), (None, None, None)]
    page = "named_struct('page_id', 'good_detail', 'item', 'x1', 'item_type', 'sku_id')"
    log = spark.range(1).selectExpr(f"{page} AS page", "array(named_struct('item', '7', 'item_type', 'sku_id')) AS displays", "1L AS ts")
    assert [(r.sku_id, r.click_ct) for r in product_actions(log).collect()] == [(None, 1), (7, 0)]


def test_integer_quotient(spark):
    rows = spark.createDataFrame([(-8,), (2**53 + 1,), (13,)], "k long").selectExpr("k DIV 7 AS q")
    assert [r.q for r in rows.collect()] == [-1, (2**53 + 1) // 7, 1]
