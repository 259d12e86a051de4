"""State of the stream processors: keys like the closing row's, open partial matches, queues, timers."""

from __future__ import annotations

import glob
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators.joins import chunked_pairs, interval_join
from tillstream.operators.windows import distinct_in_windows, tumbling
from tillstream.plans import stream_queries
from tillstream.session import checkpoint_dir, configure_streaming
from tillstream.streaming import flows
from tillstream.streaming import processors as p

T0 = datetime(2024, 1, 1)
MINUTE = timedelta(minutes=1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def worked_off(spark, rows, schema, processor, slot=MINUTE):
    """Results of (key, time, seq, kind) rows, given in three slices and a closing row."""
    table = spark.createDataFrame(rows, schema)

    def build(df):
        return p.follow(df, "key", "ts", "seq", "kind", MINUTE, processor, slot, stream_queries.CLOSING)

    return stream_queries._worked_off(spark, {"rows": (table, "ts", {"key": "-1", "kind": "x"})}, build, parts=2).collect()


SCHEMA = "key string, ts timestamp, seq long, kind string"


def test_keys_like_the_closing_one_and_no_key(spark):
    """Keys -1, -12, -1/view and null keep their rows; a row without a time or kind does no harm."""
    keys = ["-1", "-12", "-1/view", None, "3", ""]
    rows = [(k, at(10 * n), n, "1") for k in keys for n in range(4)]
    found = worked_off(spark, rows, SCHEMA, p.NewVisitor())
    assert sorted(((r.key or "none", r.seq, r.outcome)) for r in found) == sorted((k or "none", n, "1" if n == 0 else "0") for k in keys for n in range(4))


def test_click_limit_gives_three_outcomes(spark):
    rows = [("a", at(n), n, "c") for n in range(6)]
    found = worked_off(spark, rows, SCHEMA, p.ClickLimit(3, rest=True))
    assert [r.outcome for r in sorted(found, key=lambda r: r.seq)] == ["normal", "normal", "alert", "dropped", "dropped", "dropped"]


def test_open_failures_against_all_pairs(spark):
    """A run of 2,000 failures, of which few are open at a time, and random short ones."""
    rng = random.Random(1)
    rows = [("long", at(3 * n), n, "fail") for n in range(2000)]
    rows += [(f"k{k}", at(rng.randint(0, 300)), n, rng.choice(["fail", "fail", "success"])) for k in range(10) for n in range(40)]
    found = worked_off(spark, rows, SCHEMA, p.FailureRuns(10 * MINUTE), slot=timedelta(hours=1))
    by_key, want = defaultdict(list), set()
    for key, ts, seq, kind in rows:
        by_key[key].append((ts, seq, kind))
    for key, own in by_key.items():
        own.sort()
        for i, (first, _, kind) in enumerate(own):
            for j in range(i + 1, len(own)):
                if kind != "fail" or own[j][2] != "fail" or own[j][0] - first >= 10 * MINUTE:
                    break
                want.add((key, i + 1, j + 1))
    assert {(r.key, r.first_pos, r.last_pos) for r in found} == want and len(found) == len(want)


def test_pairs_in_either_order_and_leftovers(spark):
    rng = random.Random(2)
    rows = [(f"k{k}", at(rng.randint(0, 500)), n, rng.choice(["left", "right"])) for k in range(8) for n in range(30)]
    rows += [("only", at(5), 1, "left"), ("only", at(6), 2, "left"), (None, at(7), 3, "right"), (None, at(9), 4, "left")]
    found = worked_off(spark, rows, SCHEMA, p.Pairing(timedelta(days=20)), slot=timedelta(hours=1))
    want = set()
    for key in {r[0] for r in rows}:
        sides = [[seq for _, seq in sorted((ts, seq) for k, ts, seq, kind in rows if k == key and kind == side)] for side in ("left", "right")]
        for n in range(max(map(len, sides))):
            a, b = (s[n] if n < len(s) else None for s in sides)
            want.add((key, n + 1 if a is not None and b is not None else None, a, b))
    assert {(r.key, r.nth, r.left_seq, r.right_seq) for r in found} == want and len(found) == len(want)


def test_pairing_forgets_what_waits_too_long(spark):
    rows = [("a", at(0), 1, "left"), ("a", at(100), 2, "right"), ("a", at(101), 3, "left")]
    found = worked_off(spark, rows, SCHEMA, p.Pairing(30 * MINUTE))
    assert {(r.nth, r.left_seq, r.right_seq) for r in found} == {(None, 1, None), (1, 3, 2)}


class Fake:
    """A state handle in memory that counts timers and writes."""

    class Value:
        def __init__(self):
            self.value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    class Map:
        def __init__(self):
            self.items, self.written = {}, 0

        def containsKey(self, key):
            return key in self.items

        def getValue(self, key):
            return self.items.get(key)

        def updateValue(self, key, value):
            self.items[key] = value
            self.written += len(value[0]) if isinstance(value[0], list) else 0

        def removeKey(self, key):
            del self.items[key]

        def keys(self):
            return list(self.items)

    def __init__(self):
        self.timers, self.most, self.states = set(), 0, {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, self.Value())

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, self.Map())

    def registerTimer(self, ms):
        self.timers.add(ms)
        self.most = max(self.most, len(self.timers))

    def deleteTimer(self, ms):
        self.timers.remove(ms)


class Mark:
    def __init__(self, us):
        self.us = us

    def getCurrentWatermarkInMs(self):
        return self.us // 1000


def test_one_timer_a_key_and_rows_written_once(spark):
    """A slot handed over in many parts: nothing is written twice, and one timer at most is alive."""
    handle, processor = Fake(), p.NewVisitor()
    processor.hold = 7
    processor.slot = 10**9
    processor.init(handle)
    rng, key = random.Random(3), ("a", False)
    times = [rng.randrange(50 * 10**9) for _ in range(1000)]
    given = []
    for n in range(0, 1000, 100):
        rows = [{"us": t, "seq": n + k, "kind": "1"} for k, t in enumerate(times[n : n + 100])]
        assert not list(processor.handleInputRows(key, iter(rows), None))
    assert handle.states["waiting"].written == 1000
    for mark in (10**9, 25 * 10**9 + 1, 60 * 10**9):
        while handle.timers and min(handle.timers) * 1000 <= mark:
            handle.timers.remove(min(handle.timers))
            given += [r.seq for r in processor.handleExpiredTimer(key, Mark(mark), None)]
        assert len(handle.timers) <= 1
    assert given == [seq for _, seq in sorted(zip(times, range(1000)))]
    assert handle.most == 1 and not handle.states["waiting"].items and not handle.states["chunks"].items
    assert handle.states["waiting"].written < 1200


def test_distinct_users_leave_the_state(spark, tmp_path):
    own = configure_streaming(spark.newSession())
    schema = "user long, ts timestamp"
    folder = str(tmp_path / "in")
    for part in ([(1, at(1)), (1, at(2)), (2, at(3)), (None, at(4)), (None, at(5))], [(1, at(50)), (3, at(61)), (1, at(62))], [(9, at(600))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = flows.watermarked(flows.parquet_stream(own, folder, spark.createDataFrame([], schema).schema, files_per_batch=1), "ts", MINUTE)
    query = flows.run(distinct_in_windows(stream, "ts", timedelta(hours=1), ["user"], "uv"), flows.to_folder(str(tmp_path / "out")), str(tmp_path / "cp"), once=True)
    query.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.window_start, r.uv) for r in found.collect()) == [(T0, 2), (at(60), 2)]
    # of the first two windows nothing is left, only the closing row's user and window
    assert [s.numRowsTotal for s in query.lastProgress.stateOperators] == [1, 1] if query.lastProgress else True


def test_cogrouped_chunks(spark):
    left = spark.createDataFrame([("hot", n) for n in range(500)] + [("x", 1), (None, 5)], "k string, a long")
    right = spark.createDataFrame([("hot", n) for n in range(450)] + [("y", 1)], "k string, b long")
    sizes = []

    def each(x, y):
        import pyarrow as pa

        key = (x if x.num_rows else y).column("k")[:1].to_pylist() * 1
        return pa.table({"k": pa.array(key, pa.string()), "n": pa.array([x.num_rows], pa.int64()), "m": pa.array([y.num_rows], pa.int64())})

    found = chunked_pairs(left, right, "k", ["a"], ["b"], each, "k string, n long, m long", chunk=100).collect()
    sizes = sorted((r.k or "", r.n, r.m) for r in found)
    assert sizes == sorted([("hot", 100, 100)] * 4 + [("hot", 100, 50), ("x", 1, 0), ("y", 0, 1), ("", 1, 0)])


@pytest.mark.parametrize("name", ["stream_login_cep", "stream_hourly_uv", "stream_tx_reconcile"])
def test_registered(name):
    assert name in stream_queries.QUERIES and name in stream_queries.ORACLE


def test_open_windows_are_ranked_again_and_closed_ones_leave(spark, tmp_path):
    """Three batches with late rows: rankings as over all rows, and the table holds open windows only."""
    own = configure_streaming(spark.newSession())
    schema, folder = "item string, ts timestamp", str(tmp_path / "in")
    parts = [[("a", at(1)), ("a", at(2)), ("b", at(3)), ("c", at(55))], [("b", at(4)), ("b", at(6)), ("c", at(300))], [("d", at(290)), ("a", at(301))]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = flows.parquet_stream(own, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    counts = tumbling(flows.watermarked(stream, "ts", MINUTE, 60 * MINUTE), "ts", 10 * MINUTE, ["item"], F.count(F.lit(1)).alias("n"))
    sink = flows.reranked_to_folder(str(tmp_path / "out"), ["item"], ["window_end"], "n", ["item"], 2, str(tmp_path / "open"), 10 * MINUTE, 61 * MINUTE)
    flows.run(counts, sink, str(tmp_path / "cp"), "update", once=True).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    last = out.join(out.groupBy("window_end").agg(F.max("batch").alias("batch")), ["window_end", "batch"]).collect()
    assert {(r.window_end, r.item, r.n, r.rk) for r in last} == {
        (at(10), "b", 3, 1), (at(10), "a", 2, 2), (at(60), "c", 1, 1), (at(300), "d", 1, 1), (at(310), "a", 1, 1), (at(310), "c", 1, 2)}
    newest = max((tmp_path / "open").iterdir(), key=lambda p: p.stat().st_mtime)
    assert {r.window_end for r in spark.read.parquet(str(newest)).collect()} == {at(300), at(310)}


def test_changing_dimension(spark, tmp_path):
    """An update, a newer update and an older one that comes late; the first batch runs twice."""
    schema = "kind string, id long, name string, version int"
    sink = flows.upserted_lookup(str(tmp_path / "out"), str(tmp_path / "dim"), lambda df: df.where("kind = 'dim'").select("id", "name", "version"),
                                 lambda df: df.where("kind = 'fact'").select(F.col("id").alias("key")), "id", "version", "key", {"name": "name"})
    batches = [[("dim", 1, "one", 1), ("dim", 2, "two", 1), ("fact", 1, None, None), ("fact", 3, None, None), ("fact", None, None, None)],
               [("dim", 1, "uno", 2), ("fact", 1, None, None), ("fact", 2, None, None)], [("dim", 1, "old", 1), ("dim", 2, None, 5), ("fact", 1, None, None), ("fact", 2, None, None)]]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        for _ in range(2):
            sink(df, n)
    found = {(r.batch, r.key, r["name"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {(0, 1, "one"), (0, 3, None), (0, None, None), (1, 1, "uno"), (1, 2, "two"), (2, 1, "uno"), (2, 2, None)}


def test_pane_state_is_bounded_and_right(spark):
    """Sums carried from window to window against plain ones; a key holds the panes of one window at most, and then nothing."""
    rng = random.Random(5)
    size, slide = 6, 1
    counts = {n: rng.randint(1, 5) for n in rng.sample(range(0, 300), 60)}
    processor = p.PaneSums(size * MINUTE, slide * MINUTE)
    handle, minute, given = Fake(), 60_000_000, {}
    processor.init(handle)
    for now in range(0, 320, 3):
        rows = [{"us": n * minute, "n": c} for n, c in counts.items() if now - 3 <= n < now]
        if rows:
            list(processor.handleInputRows(("k",), iter(rows), None))
        while handle.timers and min(handle.timers) * 1000 <= now * minute:
            handle.timers.remove(min(handle.timers))
            given |= {r.window_end // minute: r.total for r in processor.handleExpiredTimer(("k",), Mark(now * minute), None)}
        assert len(handle.states["panes"].items) <= size // slide + 3 and len(handle.timers) <= 1
    want = {e: sum(counts.get(n, 0) for n in range(e - size, e)) for e in range(0, 320)}
    assert given == {e: n for e, n in want.items() if n}
    assert not handle.states["panes"].items and handle.states["kept"].value is None and not handle.timers


def test_changes_on_top_of_a_snapshot(spark, tmp_path):
    """New keys, updates, deletions, changes the snapshot holds already, and versions out of order."""
    own = configure_streaming(spark.newSession())
    schema, folder = "key string, version long, value string", str(tmp_path / "in")
    snapshot = own.createDataFrame([("a", 5, "a5"), ("b", 1, "b1")], schema)
    parts = [[("a", 4, "a4"), ("a", 5, "a5"), ("a", 7, "a7"), ("a", 6, "a6"), ("c", 1, "c1")], [("b", 2, None), ("a", 6, "late"), ("c", 2, None), ("d", 1, None)], [("b", 3, "b3"), (None, 1, "none")]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = flows.parquet_stream(own, folder, snapshot.schema, files_per_batch=1)
    flows.run(p.changes_on_snapshot(stream, snapshot), flows.to_folder(str(tmp_path / "out")), str(tmp_path / "cp"), "update", once=True).awaitTermination(120)
    found = {(r.key, r.version, r.op, r.before, r.after) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {("a", 6, "update", "a5", "a6"), ("a", 7, "update", "a6", "a7"), ("c", 1, "insert", None, "c1"), ("b", 2, "delete", "b1", None),
                     ("c", 2, "delete", "c1", None), ("b", 3, "insert", None, "b3"), (None, 1, "insert", None, "none")}


def test_cogrouped_chunks_share_calls(spark):
    """A function that tells keys apart is called for some thousand rows and not for each chunk; keys without a value meet too."""
    import pyarrow as pa

    from tillstream.plans.join_queries import _receipts

    rng = random.Random(4)
    orders = [(k, at(rng.randint(0, 9)), n) for n, k in enumerate(rng.choices([*range(900), None], k=2000))] + [(7, at(n), n) for n in range(50)]
    receipts = [(k, at(rng.randint(0, 9)), n, n, n) for n, k in enumerate(rng.choices([*range(900), None], k=3000))]
    left = spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, total long").withColumn("total", F.col("total").cast("decimal(18,2)"))
    right = spark.createDataFrame(receipts, "o_orderkey long, l_shipdate timestamp, l_linenumber int, l_partkey long, l_suppkey long")
    schema = "o_orderkey long, nth long, total decimal(18,2), l_linenumber int, l_partkey long, l_suppkey long, rows long"

    def each(x, y):
        found = _receipts(x, y)
        return found.append_column("rows", pa.array([x.num_rows + y.num_rows] * found.num_rows, pa.int64()))

    found = chunked_pairs(left, right, "o_orderkey", ["o_orderdate", "total"], ["l_shipdate", "l_linenumber"], each, schema, chunk=3, call_rows=1000).collect()
    of = lambda rows, k, tie: [tie(r) for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3])]
    want = [(k, n + 1, a, b) for k in {r[0] for r in orders} for n, (a, b) in enumerate(zip(of(orders, k, lambda r: r[2]), of(receipts, k, lambda r: r[2])))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.o_orderkey, r.nth, int(r.total), r.l_linenumber) for r in found), key=order) == sorted(want, key=order)
    assert min(r.rows for r in found) > 500


def test_keys_of_a_group_share_slots_timer_and_memories(spark):
    """A thousand keys in one group cost one entry a slot, one timer and one entry of memories; results are those of each key alone."""
    import pandas as pd

    handle, processor, group = Fake(), p.Grouped(p.ClickLimit(2, rest=True)), (5, False)
    processor.slot = 3_600_000_000
    processor.init(handle)
    rng = random.Random(6)
    rows = [(rng.randrange(5 * processor.slot), n, f"k{n % 999}" if n % 1000 else None) for n in range(5000)]
    for low in range(0, 5000, 1000):
        part = rows[low : low + 1000]
        frame = pd.DataFrame({"us": [r[0] for r in part], "seq": [r[1] for r in part], "numbered": True, "kind": "c", "known": True,
                              "key": [r[2] for r in part], "named": [r[2] is not None for r in part]})
        assert not list(processor.handleInputRows(group, iter([frame]), None))
    assert len(handle.states["waiting"].items) == 25 and len(handle.timers) == 1 and handle.most == 1
    given = []
    for mark in (2 * processor.slot + 1, 6 * processor.slot):
        while handle.timers and min(handle.timers) * 1000 <= mark:
            handle.timers.remove(min(handle.timers))
            given += [tuple(r) for frame in processor.handleExpiredTimer(group, Mark(mark), None) for r in frame.itertuples(index=False)]
    want = []
    for key in {r[2] for r in rows}:
        own = [seq for _, seq in sorted((us, seq) for us, seq, k in rows if k == key)]
        want += [(key, seq, "normal" if n == 0 else "alert" if n == 1 else "dropped") for n, seq in enumerate(own)]
    order = lambda r: r[1]
    assert sorted(given, key=order) == sorted(want, key=order)
    assert not handle.states["waiting"].items and not handle.states["chunks"].items and len(handle.timers) == 1


def test_pairs_years_apart_with_long_queues(spark):
    """Without a time limit every row meets its partner, however long it waits; the middle of a long queue is kept in parts."""
    handle, pattern = Fake(), p.Pairing(None)
    pattern.part = 10
    pattern.attach(handle)
    mem, day = dict.fromkeys(f.split()[0] for f in "side nth last low high front back".split()), 86_400_000_000
    for n in range(500):
        assert not list(pattern.step(("a",), mem, n * day, n, "left"))
        assert len(mem["front"]) + len(mem["back"]) <= 20 and pattern.deadline(mem) is None
    assert handle.states["queue"].written <= 500
    found = [r for n in range(500) for r in pattern.step(("a",), mem, (2000 + n) * day, 1000 + n, "right")]
    assert found == [("a", n + 1, n, 1000 + n) for n in range(500)]
    assert not handle.states["queue"].items and not mem["front"] and not mem["back"]


def test_joined_as_tables_against_all_pairs(spark):
    """Keys that repeat or are null, rows without a time, an input that lies behind the other, intervals at their ends."""
    rng = random.Random(3)
    keys = [None, -1, -2, *range(20)]
    left = [(n, rng.choice(keys), at(rng.randint(0, 400))) for n in range(300)] + [(300, 1, None)]
    right = [(n, rng.choice(keys), at(rng.randint(90, 700))) for n in range(300)] + [(300, 1, None)]
    join = lambda l, r: interval_join(l, r.toDF("rn", "rk", "rts"), {"k": "rk"}, "ts", "rts", -5 * MINUTE, 90 * MINUTE).select("n", "rn")
    tables = [spark.createDataFrame(rows, "n long, k long, ts timestamp_ntz") for rows in (left, right)]
    found = stream_queries._joined(spark, *tables, join, -5 * MINUTE, 90 * MINUTE).collect()
    want = [(n, m) for n, k, t in left for m, j, u in right if k is not None and k == j and t and u and -5 * MINUTE <= u - t <= 90 * MINUTE]
    assert sorted(map(tuple, found)) == sorted(want) and len(want) > 100


@pytest.mark.parametrize("name, most", [("stream_order_details", 0), ("stream_payment_wide", 0), ("stream_product_stats", 2)])
def test_joins_of_streams_keep_no_state_store(spark, sf, name, most):
    """A row of a join costs no entries of a state store; the two sums of product statistics are what has state."""
    before = set(glob.glob(f"{checkpoint_dir(spark)}/tillstream-stream-*"))
    stream_queries.QUERIES[name](spark, sf).count()
    own = set(glob.glob(f"{checkpoint_dir(spark)}/tillstream-stream-*")) - before
    assert own and sum(len(glob.glob(f"{path}/progress/state/*")) for path in own) <= most


def test_rows_of_a_group_come_in_one_pack(spark):
    """A stretch of rows gives one row per group, whatever their number and order; nulls are kept, the closing row is not."""
    import pyarrow as pa

    rng = random.Random(7)
    rows = [(rng.randrange(9), rng.random() < 0.01, rng.randrange(10**6), rng.choice([n, None]), rng.choice(["é", None]), rng.choice(["a", "", None])) for n in range(30_000)]
    names = ["part", "closing", "us", "seq", "kind", "key"]
    types = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    batches = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[low : low + 7000]), types)], names) for low in range(0, 30_000, 7000)]
    packs = [r for batch in p._packs(iter(batches)) for r in batch.to_pylist()]
    assert sorted(r["part"] for r in packs) == list(range(9)) and not list(p._packs(iter([])))
    found = [(r["part"], *row.values()) for r in packs for row in p._from_bytes(r["pack"]).to_pylist()]
    assert sorted(map(str, found)) == sorted(str((r[0], *r[2:])) for r in rows if not r[1])


def test_packs_in_order_and_what_is_too_late(spark):
    """Null numbers and kinds come first at one time; of rows behind the watermark, those a group has been worked off past are left out."""
    import pandas as pd
    import pyarrow as pa

    class Given(p.InOrder):
        def step(self, key, mem, us, seq, kind):
            yield key[0], seq, f"{us} {kind}"

    pack = lambda rows: pd.DataFrame({"pack": [p._to_bytes(pa.table([list(c) for c in zip(*rows)], schema=p.ROW))]})
    handle, processor = Fake(), p.Grouped(Given())
    processor.slot = 10_000
    processor.init(handle)

    def worked(rows, mark):
        assert not list(processor.handleInputRows((1,), iter([pack(rows)]), None))
        handle.timers.clear()
        return [tuple(r) for frame in processor.handleExpiredTimer((1,), Mark(mark), None) for r in frame.itertuples(index=False)]

    first = [(25_000, 3, "a", "k"), (5_000, 2, "b", "k"), (5_000, 2, None, "k"), (5_000, None, "z", None), (41_000, 2**62 + 1, "a", "k")]
    assert worked(first, 30_000) == [(None, None, "5000 z"), ("k", 2, "5000 None"), ("k", 2, "5000 b"), ("k", 3, "25000 a")]
    assert worked([(30_000, 7, "late", "k"), (30_001, 8, "c", "k")], 50_000) == [("k", 8, "30001 c"), ("k", 2**62 + 1, "41000 a")]


def test_events_wait_in_few_entries(spark, monkeypatch):
    """A month of a user's events costs a few entries of the state store a slice, not two a day."""
    queries, run = [], flows.run
    monkeypatch.setattr(flows, "run", lambda *args, **named: queries.append(run(*args, **named)) or queries[-1])
    events = spark.createDataFrame([(n, 1, at(30 * n)) for n in range(1440)], "event_id long, user_id long, ts timestamp")
    found = stream_queries._followed(spark, {"events": (events, "ts", {"event_id": -1})}, p.DailyVisit(), F.lit("x")).collect()
    assert sorted(r.seq for r in found) == [48 * day for day in range(30)]
    assert 0 < max(s.numRowsTotal for q in queries for progress in q.recentProgress for s in progress.stateOperators) <= 12


@pytest.mark.parametrize("name, rows", [("stream_user_jump", "true"), ("stream_login_alert", "event_type IN ('error', 'signup')"), ("stream_new_user_fix", "true")])
def test_patterns_are_fed_what_they_use(spark, sf, name, rows):
    """Four columns of the rows that a pattern looks at, and the closing row."""
    before = set(glob.glob(f"{checkpoint_dir(spark)}/tillstream-stream-*"))
    stream_queries.QUERIES[name](spark, sf).count()
    (own,) = set(glob.glob(f"{checkpoint_dir(spark)}/tillstream-stream-*")) - before
    fed = spark.read.parquet(f"{own}/in/events")
    assert fed.columns == ["key", "ts", "seq", "kind", stream_queries.CLOSING]
    assert fed.count() == spark.read.parquet(f"{sf}/events.parquet").where(rows).count() + 1


def test_events_of_years_wait_in_few_entries(spark, monkeypatch):
    """The entries go with the rows and not with the time they are spread over; so do those of a row far from all others."""
    queries, run = [], flows.run
    monkeypatch.setattr(flows, "run", lambda *args, **named: queries.append(run(*args, **named)) or queries[-1])
    for times in ([at(1500 * n) for n in range(1440)], [datetime(1970, 1, 2), *[at(1500 * n) for n in range(1439)]]):
        events = spark.createDataFrame([(n, n % 2, ts) for n, ts in enumerate(times)], "event_id long, user_id long, ts timestamp")
        found = stream_queries._followed(spark, {"events": (events, "ts", {"event_id": -1})}, p.NewVisitor(), F.lit("1")).collect()
        assert sorted((r.seq, r.outcome) for r in found) == [(n, "1" if n < 2 else "0") for n in range(1440)]
    assert 0 < max(s.numRowsTotal for q in queries for progress in q.recentProgress for s in progress.stateOperators) <= 16


def test_shared_slots_give_rows_in_order(spark):
    """Chunks of many slots that overlap, of one row to all rows, with marks at, between and far behind them: every row once, in order."""
    import pandas as pd
    import pyarrow as pa

    class Given(p.InOrder):
        def step(self, key, mem, us, seq, kind):
            yield key[0], seq, f"{us}"

    rng = random.Random(9)
    for share, hold in ((0, 100), (7, 100), (40, 30), (1000, 50), (10**6, 10**6)):
        handle, processor = Fake(), p.Grouped(Given(), share)
        processor.slot, processor.hold, processor.batch = 10_000, hold, 13
        processor.init(handle)
        given, want, mark = [], [], -1_000_000
        for low in (-500_000, 0, 20_000, 3_000_000):
            rows = [(rng.randrange(max(low, mark + 1), 4_000_000) if n % 3 else max(low, mark + 1) + n * 100, 1000 * n + len(want), "x", f"k{n % 5}") for n in range(200)]
            want += rows
            packs = [p._to_bytes(pa.table([list(c) for c in zip(*rows[at : at + 10])], schema=p.ROW)) for at in range(0, 200, 10)]
            assert not list(processor.handleInputRows((1,), iter([pd.DataFrame({"pack": packs})]), None))
            assert len(handle.timers) == 1 and min(handle.timers) * 1000 <= min(us for us, *_ in rows) + 1000
            mark = low + 30_000
            while handle.timers and min(handle.timers) * 1000 <= mark:
                handle.timers.remove(min(handle.timers))
                given += [r for frame in processor.handleExpiredTimer((1,), Mark(mark), None) for r in frame.itertuples(index=False)]
            assert [int(r.outcome) for r in given] == sorted(us for us, *_ in want if us <= mark)
        handle.timers.clear()
        given += [r for frame in processor.handleExpiredTimer((1,), Mark(5_000_000), None) for r in frame.itertuples(index=False)]
        assert [(int(r.outcome), r.seq, r.key) for r in given] == sorted((us, seq, key) for us, seq, _, key in want)
        assert not handle.states["waiting"].items and not handle.states["chunks"].items and not handle.timers
