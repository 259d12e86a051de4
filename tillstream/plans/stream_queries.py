"""Stream forms as queries: a test table is fed as a stream, worked off, and the result table read.

A table arrives in slices of its time span. Each is written to the shared folder and worked off by a run that goes
on from the checkpoint of the one before. The end of the input is a closing row far ahead of all others, so that
every window and every wait is closed; it is no part of any result. The runs have a session of their own, so no
setting of the caller's session changes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.text import register_split_words
from tillstream.functions.times import interval_text, text
from tillstream.operators import logs
from tillstream.operators.windows import distinct_in_windows, sliding_direct, stamp, tumbling
from tillstream.plans import bindings as b
from tillstream.plans import aggregate_queries, join_queries, pattern_queries, stats, stats_queries, wide
from tillstream.session import configure_streaming, scratch
from tillstream.sources.connectors import json_table
from tillstream.streaming import flows
from tillstream.streaming.processors import Bounce, ClickLimit, DailyVisit, FailureRuns, InOrder, LoginGuard, NewVisitor, OrderWatch, Pairing, PayNext, VisitorMeasures, changes_on_snapshot, follow, pane_sums

HOUR, HALF_DAY = timedelta(hours=1), timedelta(hours=12)
DELAY = timedelta(seconds=5)


AHEAD = timedelta(days=60)
SLICES = 3
CLOSING = "_closing"
STATE_PARTS = 8
#: Rows that a part of the state stands for at most, all slices together; groups of keys in a part.
PART_ROWS, PART_GROUPS = 400_000, 16
#: The same for a pattern over events, whose rows wait as compact tables: a part costs a second or so in every batch.
PATTERN_ROWS = 1_000_000
#: Time slot by which events wait: a few for a slice of their month, as the state store is asked per group and slot.
SLOT = timedelta(days=5)
#: Rows of neighbouring slots that wait together: about what a group has of a slice, so that entries go with rows and not with time.
SHARE = 20_000


def _feed(table: DataFrame, ts: str, folder: str, low: int, high: int, n: int, closing: dict[str, object], last: int) -> None:
    """Write one slice of a table's time span, the last one with the closing row, which only it marks as such."""
    table = table.withColumn(CLOSING, F.lit(False))
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    cut = F.least(F.lit(SLICES - 1), F.floor((at - low) * SLICES / F.lit(max(1, high - low))))
    table.where(F.coalesce(cut, F.lit(0)) == n).write.mode("append").parquet(folder)
    if n == SLICES - 1:
        end = F.timestamp_micros(F.lit(last) + int(AHEAD.total_seconds() * 1_000_000))
        values = {ts: end, CLOSING: F.lit(True)} | {name: value(end) if callable(value) else F.lit(value) for name, value in closing.items()}
        row = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
        table.sparkSession.range(1).select(*row).write.mode("append").parquet(folder)


def _worked_off(spark: SparkSession, tables: dict[str, tuple[DataFrame, str, dict[str, object]]], build: Callable[..., DataFrame],
                sink=flows.to_folder, parts: int = STATE_PARTS, mode: str = "append", keep_batch: bool = False, part_rows: int = PART_ROWS) -> DataFrame:
    """Feed tables (each with its time column and the values of its closing row) to `build` and give the result table.

    State is kept in `parts` parts, or more for large tables (one for `part_rows` rows); a running query keeps that number.
    """
    own = configure_streaming(spark.newSession())
    folder = scratch(spark, "stream")
    spans, rows = {}, 0
    for name, (table, ts, _) in tables.items():
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        low, high, n = table.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
        spans[name], rows = [low or 0, high or 0], rows + n
    own.conf.set("spark.sql.shuffle.partitions", max(parts, -(-rows // part_rows)))
    for n in range(SLICES):
        for name, (table, ts, closing) in tables.items():
            _feed(table, ts, f"{folder}/in/{name}", *spans[name], n, closing, max(high for _, high in spans.values()))
        streams = [flows.parquet_stream(own, f"{folder}/in/{name}", T.StructType([*table.schema, T.StructField(CLOSING, T.BooleanType())]))
                   for name, (table, _, _) in tables.items()]
        flows.run(build(*streams), sink(f"{folder}/out"), f"{folder}/progress", mode, once=True).awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out if keep_batch else out.drop("batch")


def _joined(spark: SparkSession, left: DataFrame, right: DataFrame, join: Callable[[DataFrame, DataFrame], DataFrame],
            lower: timedelta, upper: timedelta) -> DataFrame:
    """Two tables with times ``ts`` as streams, joined where the right time is that of the left and from `lower` to `upper` more.

    All joins are made when the input ends, with no need of the closing row.
    """
    def build(*inputs: DataFrame) -> DataFrame:
        return flows.two_inputs(*[df.where(f"NOT {CLOSING}").drop(CLOSING) for df in inputs], "ts", "ts")

    return _worked_off(spark, {"left": (left, "ts", {}), "right": (right, "ts", {})}, build,
                       lambda path: flows.joined_to_folder(path, f"{path}-open", join, "ts", "ts", lower, upper, DELAY))


def _groups(rows: DataFrame) -> int:
    """Groups for the keys of a stream: their number goes with the parts of the state, and so with the table."""
    return PART_GROUPS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _events(spark: SparkSession, sf: str, event_type: str = "view") -> dict[str, tuple[DataFrame, str, dict[str, object]]]:
    return {"events": (b.events(spark, sf), "ts", {"event_id": -1, "user_id": -1, "event_type": event_type})}


def stream_hourly_pv(spark: SparkSession, sf: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        pv = flows.watermarked(events.where("event_type = 'view'"), "ts", DELAY)
        return stamp(tumbling(pv, "ts", HOUR, [], F.count(F.lit(1)).alias("pv")))

    return _worked_off(spark, _events(spark, sf), build)


def stream_hot_types(spark: SparkSession, sf: str) -> DataFrame:
    """The two most frequent event types per sliding window."""
    def build(events: DataFrame) -> DataFrame:
        return sliding_direct(flows.watermarked(events, "ts", DELAY), "ts", 6 * HOUR, HOUR, ["event_type"], F.count(F.lit(1)).alias("cnt"))

    out = _worked_off(spark, _events(spark, sf), build, lambda path: flows.ranked_to_folder(path, ["window_end"], "cnt", ["event_type"], 2))
    return out.select(text(F.col("window_end")).alias("edt"), "event_type", "cnt", "rk")


def stream_order_details(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and details as two streams, joined when at most five days apart."""
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderdate").alias("ts"))
    d = b.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("long").alias("sku_num"), F.col("l_shipdate").alias("ts"))
    unused = ("order_price", "sku_name", "split_activity_amount", "split_coupon_amount", "split_total_amount")

    def join(orders: DataFrame, details: DataFrame) -> DataFrame:
        joined = wide.join_details(orders, details.withColumns({c: F.lit(None) for c in unused}), b.ORDER_WITHIN)
        return joined.select("order_id", "detail_id", "sku_id", "sku_num", "create_date")

    return _joined(spark, o, d, join, -b.ORDER_WITHIN, b.ORDER_WITHIN)


def stream_user_jump(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "entry").otherwise("page")
    out = _followed(spark, _events(spark, sf), Bounce(HALF_DAY), kind)
    return out.select(F.col("seq").alias("event_id"), F.col("key").alias("user_id"))


def _followed(spark: SparkSession, tables: dict, processor: InOrder, kind: str | Column, key: str | Column = "user_id",
              where: str = "true", seq: str = "event_id", slot: timedelta = SLOT) -> DataFrame:
    """What a pattern gives for a table's rows; only the rows and columns it uses are fed."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    used = {name: (table.where(where).select(as_column(key).alias("key"), F.col(ts).alias("ts"), as_column(seq).alias("seq"), as_column(kind).alias("kind")), "ts", {})
            for name, (table, ts, _) in tables.items()}

    def build(rows: DataFrame) -> DataFrame:
        return follow(rows, "key", "ts", "seq", "kind", DELAY, processor, slot, CLOSING, _groups(rows), SHARE)

    return _worked_off(spark, used, build, part_rows=PATTERN_ROWS)


def _lines(df: DataFrame, ts: str, **closing: object) -> dict[str, tuple[DataFrame, str, dict[str, object]]]:
    """Rows as JSON lines with their time in milliseconds, `ms`."""
    fields = [F.col(c) for c in df.columns if c != ts]
    lines = df.select(F.col(ts).alias("at"), F.to_json(F.struct(*fields, F.unix_millis(F.col(ts).cast("timestamp")).alias("ms"))).alias("value"))
    last = lambda end: F.to_json(F.struct(*[F.lit(v).alias(n) for n, v in closing.items()], F.unix_millis(end).alias("ms")))
    return {"lines": (lines, "at", {"value": last})}


def stream_province_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Order amounts per province and day, from JSON lines by way of a declared table."""
    orders = stats_queries.province_orders(spark, sf)
    kept = orders.select("order_id", "total_amount", "rowtime", "province_id", "province_name", "province_area_code",
                         "province_iso_code", "province_3166_2_code")
    schema = T.StructType([f for f in kept.schema if f.name != "rowtime"]).add("ms", T.LongType())

    def build(lines: DataFrame) -> DataFrame:
        return stats.province_sums(json_table(lines.select("value"), schema, "ms", interval_text(DELAY)), timedelta(days=1))

    return _worked_off(spark, _lines(kept, "rowtime", order_id=-1), build)


def stream_keyword_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Words searched for per hour; the words come out of the table function in SQL."""
    texts = stats.search_texts(logs.pages(b.log_rows(spark, sf))).select("full_word", "at")

    def build(rows: DataFrame) -> DataFrame:
        own = rows.sparkSession
        register_split_words(own)
        words = own.sql("SELECT at, w.word AS keyword FROM {texts}, LATERAL split_words(full_word) AS w",
                        texts=flows.watermarked(rows, "at", DELAY))
        counted = stamp(tumbling(words, "at", HOUR, ["keyword"], F.count(F.lit(1)).alias("ct")))
        return counted.select("keyword", "ct", F.lit("search").alias("source"), "stt", "edt")

    return _worked_off(spark, {"texts": (texts, "at", {"full_word": "end"})}, build)


def stream_new_user_fix(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(b.k() % 2 == 0, "1").otherwise("0")
    out = _followed(spark, _events(spark, sf), NewVisitor(), flag)
    return out.select(F.col("seq").alias("event_id"), F.col("outcome").alias("is_new"))


def stream_daily_visit(spark: SparkSession, sf: str) -> DataFrame:
    return _followed(spark, _events(spark, sf), DailyVisit(), "event_type").select(F.col("seq").alias("event_id"))


def stream_login_alert(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    out = _followed(spark, _events(spark, sf, "signup"), LoginGuard(6 * HOUR), kind, where="event_type IN ('error', 'signup')")
    return out.select(F.col("seq").alias("event_id"), F.col("key").alias("user_id"))


def stream_order_next(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "create").otherwise("pay")
    out = _followed(spark, _events(spark, sf), PayNext(HALF_DAY), kind, where="event_type IN ('view', 'purchase')")
    return out.select(F.col("seq").alias("event_id"), "outcome")


def stream_click_limit(spark: SparkSession, sf: str) -> DataFrame:
    """All clicks with what becomes of them, those beyond the limit too."""
    out = _followed(spark, _events(spark, sf), ClickLimit(3, rest=True), "event_type", F.concat_ws("/", "user_id", "event_type"))
    return out.select(F.col("seq").alias("event_id"), "outcome")


def stream_login_cep(spark: SparkSession, sf: str) -> DataFrame:
    """Every sequence of failures in a row within six hours, as its last failure comes in."""
    kind = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    out = _followed(spark, _events(spark, sf), FailureRuns(6 * HOUR), kind, where="event_type IN ('error', 'signup')")
    return out.select(F.col("key").cast("long").alias("user_id"), "first_pos", text(F.timestamp_micros("start_us")).alias("started"),
                      text(F.timestamp_micros("end_us")).alias("ended"), (F.col("last_pos") - F.col("first_pos") + 1).alias("fails"))


def stream_hourly_uv(spark: SparkSession, sf: str) -> DataFrame:
    """Different users per hour, counted exactly: a user's first view of a window passes on, later ones do not.

    Both the users seen and the counts leave the state when the watermark passes their window.
    """
    def build(events: DataFrame) -> DataFrame:
        return stamp(distinct_in_windows(flows.watermarked(events.where("event_type = 'view'"), "ts", DELAY), "ts", HOUR, ["user_id"], "uv"))

    return _worked_off(spark, _events(spark, sf), build)


def stream_tx_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and receipts as one stream of two kinds of rows, paired by number and occurrence, either arriving first.

    Years may lie between the two, so a row waits for its partner without a limit.
    """
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), F.lit("left").alias("kind"),
                                            (b.money("o_totalprice") * 100).cast("long").alias("seq"))
    r = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("ts"), F.lit("right").alias("kind"),
                                              F.col("l_linenumber").cast("long").alias("seq"))

    def build(rows: DataFrame) -> DataFrame:
        return follow(rows, "id", "ts", "seq", "kind", DELAY, Pairing(None), timedelta(days=400), CLOSING, _groups(rows), SHARE)

    out = _worked_off(spark, {"rows": (o.union(r), "ts", {"kind": "left"})}, build).where("nth IS NOT NULL")
    return out.select(F.col("key").cast("long").alias("o_orderkey"), "nth", (F.col("left_seq") / 100).cast("decimal(18,2)").alias("total"),
                      F.col("right_seq").alias("l_linenumber"))


def _ads(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame, str, dict[str, object]]]:
    clicks = b.ad_clicks(spark, sf).select("province", "ad_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return {"clicks": (clicks, "ts", {"province": "end"})}


def stream_ads_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks per province and advert in six hours, every hour: counted per hour first, then carried from hour to hour in state."""
    def build(clicks: DataFrame) -> DataFrame:
        own = flows.watermarked(clicks, "ts", DELAY)
        key = F.to_json(F.struct("province", "ad_id"))
        counted = own.groupBy(F.window("ts", interval_text(HOUR)).alias("_w"), key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        panes = counted.select("key", F.window_time("_w").alias("at"), F.unix_micros("_w.start").alias("start"), "n")
        return pane_sums(panes, "key", "at", "start", "n", 6 * HOUR, HOUR)

    out = _worked_off(spark, _ads(spark, sf), build)
    names = F.from_json("key", "province string, ad_id long").alias("k")
    end = F.col("window_end")
    return out.select(names, end, "total").where("k.province <> 'end'").select(
        text(F.timestamp_micros(end)).alias("edt"), "k.province", "k.ad_id", F.col("total").alias("cnt"))


def stream_ads_topn_late(spark: SparkSession, sf: str) -> DataFrame:
    """The top three adverts per window, ranked again as rows come up to two days late; the last ranking of each window."""
    late = timedelta(days=2)
    clicks = _ads(spark, sf)["clicks"][0]
    behind = F.make_dt_interval(secs=F.pmod(F.xxhash64("event_id"), F.lit(late // timedelta(seconds=1))))
    arriving = clicks.withColumn("arrival", F.col("ts") + behind)

    def build(rows: DataFrame) -> DataFrame:
        own = flows.watermarked(rows.where(f"NOT {CLOSING}"), "ts", DELAY, late)
        return sliding_direct(own, "ts", 6 * HOUR, HOUR, ["province", "ad_id"], F.count(F.lit(1)).alias("cnt")).drop("window_start")

    sink = lambda path: flows.reranked_to_folder(path, ["province", "ad_id"], ["window_end"], "cnt", ["province", "ad_id"], 3, f"{path}-open", 6 * HOUR, DELAY + late)
    out = _worked_off(spark, {"clicks": (arriving, "arrival", {})}, build, sink, mode="update", keep_batch=True)
    last = out.groupBy("window_end").agg(F.max("batch").alias("batch"))
    return out.join(last, ["window_end", "batch"]).select(text(F.col("window_end")).alias("edt"), "province", "ad_id", "cnt", "rk")


def _supplier_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Shipped details, and three versions of suppliers in front of the first, second and third part of the time span.

    All suppliers have the first version, those with money the second, those of even nations the third.
    """
    line = b.table(spark, sf, "lineitem")
    low, high = line.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    supplier = b.table(spark, sf, "supplier")
    facts = line.select(F.lit("fact").alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("supplier"),
                        F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("version"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    for n, who in enumerate(("true", "s_acctbal > 0", "s_nationkey % 2 = 0")):
        at = F.lit(low).cast("timestamp") + F.make_dt_interval(secs=F.lit((high - low).total_seconds() * n / SLICES))
        facts = facts.unionByName(supplier.where(who).select(
            F.lit("dim").alias("kind"), F.lit(None).cast("long").alias("id"), F.col("s_suppkey").alias("supplier"),
            F.concat("s_name", F.lit(f" v{n + 1}")).alias("name"), F.lit(n + 1).alias("version"), at.alias("ts")))
    return facts


def stream_dim_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Shipped details with their supplier's name as it was at their time: the dimension changes under the stream."""
    sink = lambda path: flows.upserted_lookup(
        path, f"{path}-dim", lambda df: df.where("kind = 'dim'").select("supplier", "name", "version"),
        lambda df: df.where("kind = 'fact'").select("id", F.col("supplier").alias("supp")), "supplier", "version", "supp", {"name": "name"})
    rows = _supplier_changes(spark, sf)
    return _worked_off(spark, {"rows": (rows, "ts", {"kind": "end"})}, lambda df: df.drop(CLOSING), sink).select("id", "supp", "name")


def stream_cdc_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of suppliers with the row before and after, started from a snapshot; the log begins with what the snapshot holds."""
    changes = _supplier_changes(spark, sf).where("kind = 'dim'").select(
        F.col("supplier").cast("string").alias("key"), F.col("version").cast("long").alias("version"), F.col("name").alias("value"), "ts")
    path = scratch(spark, "snapshot")
    changes.where("version = 1").drop("ts").write.parquet(path)

    def build(rows: DataFrame) -> DataFrame:
        return changes_on_snapshot(rows.where(f"NOT {CLOSING}"), rows.sparkSession.read.parquet(path))

    out = _worked_off(spark, {"changes": (changes, "ts", {})}, build, mode="update")
    return out.select(F.col("key").cast("long").alias("supplier"), "version", "op", "before", "after")


def stream_payment_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Payments joined with wide orders, which a stream before makes of orders and details."""
    paths = {}
    for name, dim in vars(b.dims(spark, sf)).items():
        paths[name] = scratch(spark, f"dim-{name}")
        dim.write.parquet(paths[name])

    def order_wide(orders: DataFrame, details: DataFrame) -> DataFrame:
        own = wide.Dims(**{name: orders.sparkSession.read.parquet(path) for name, path in paths.items()})
        return wide.order_wide(orders, details, own, F.lit(b.AS_OF), b.ORDER_WITHIN)

    orders = _joined(spark, b.order_info(spark, sf), b.order_detail(spark, sf), order_wide, -b.ORDER_WITHIN, b.ORDER_WITHIN)
    paid = _joined(spark, b.payment_info(spark, sf), orders, lambda p, w: wide.payment_wide(p, w, b.PAY_AFTER), -b.PAY_AFTER, timedelta(0))
    return paid.drop("ts", "payment_ts")


def stream_visitor_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Visitor statistics per hour: a device's rows in order give measures, and windows sum them, in one stream."""
    log = b.log_rows(spark, sf)
    kind = F.to_json(F.struct((~logs.is_start()).alias("page"), F.coalesce(logs.is_entry(), F.lit(False)).alias("entry"), *[F.col(f"common.{d}").alias(d) for d in stats.VISITOR_DIMS],
                              F.col("page.during_time").alias("dur")))
    rows = log.select("event_id", F.col("common.mid").alias("mid"), "at", kind.alias("kind"))

    def build(own: DataFrame) -> DataFrame:
        return stats.visitor_stats(follow(own, "mid", "at", "event_id", "kind", DELAY, VisitorMeasures(HALF_DAY), SLOT, CLOSING, _groups(own), SHARE), HOUR)

    return _worked_off(spark, {"rows": (rows, "at", {"mid": "-1"})}, build)


def stream_product_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Product statistics per day from seven inputs, two of them joined by a stream before, then sums per order and sums per window."""
    inputs = stats_queries.product_inputs(spark, sf)
    e = b.events(spark, sf).select("event_type", b.k().alias("sku_id"), F.col("ts").cast("timestamp").alias("at"))
    payments = inputs["payments"].select("sku_id", "ts", "total_amount", "order_id")
    narrow = lambda o, d: wide.join_details(o, d, b.ORDER_WITHIN).select("sku_id", F.col("order_ts").alias("ts"), "sku_num", "total_amount", "order_id")
    details = _joined(spark, b.order_info(spark, sf), b.order_detail(spark, sf), narrow, -b.ORDER_WITHIN, b.ORDER_WITHIN)
    tables = {"pages": (inputs["pages"].select("page", "displays", "at"), "at", {}), "acts": (e, "at", {"event_type": "end"}),
              "details": (details, "ts", {"order_id": -1}), "payments": (payments, "ts", {"order_id": -1}), "refunds": (inputs["refunds"], "at", {"order_id": -1})}

    def build(pages: DataFrame, acts: DataFrame, details: DataFrame, paid: DataFrame, refunds: DataFrame) -> DataFrame:
        pages, acts, refunds = (flows.watermarked(df, "at", DELAY) for df in (pages, acts, refunds))
        details, paid = (flows.watermarked(df.drop(CLOSING), "ts", DELAY) for df in (details, paid))
        # Filters move below watermarks, so they let the closing row pass; its window stays open for good.
        of = lambda kind: acts.where((F.col("event_type") == kind) | F.col(CLOSING))
        rows = stats.product_rows(
            None, of("click"), of("purchase").withColumn("sku_num", F.col("sku_id") % 3 + 1),
            details, paid, refunds,
            of("error").withColumn("appraise", F.concat(F.lit("120"), (F.col("sku_id") % 4 + 1).cast("string"))),
            mixed=logs.product_actions(pages.withColumnRenamed("at", "ts")).withColumnRenamed("ts", "at"))
        return stats.product_sums(rows, timedelta(days=1))

    return stats.product_enriched(_worked_off(spark, tables, build), b.dims(spark, sf))


def stream_order_watch(spark: SparkSession, sf: str) -> DataFrame:
    states = {"states": (b.order_states(spark, sf, "true"), "ts", {"order_id": -1, "kind": "create"})}
    out = _followed(spark, states, OrderWatch(timedelta(days=15), timedelta(days=20)), "kind", "order_id", seq="order_id", slot=timedelta(days=100))
    return out.select(F.col("key").cast("long").alias("order_id"), "outcome")


QUERIES: dict[str, b.Query] = {f.__name__: f for f in (
    stream_hourly_pv, stream_hot_types, stream_order_details, stream_user_jump, stream_new_user_fix, stream_daily_visit,
    stream_login_alert, stream_order_next, stream_click_limit, stream_order_watch, stream_province_stats,
    stream_keyword_stats, stream_login_cep, stream_hourly_uv, stream_tx_reconcile, stream_ads_sliding, stream_ads_topn_late, stream_dim_lookup, stream_payment_wide, stream_cdc_snapshot, stream_visitor_stats, stream_product_stats)}

_TEXT = "'%Y-%m-%d %H:%M:%S'"

ORACLE: dict[str, str] = {
    "stream_hourly_pv": f"""
        SELECT strftime(w, {_TEXT}) AS stt, strftime(w + INTERVAL 1 HOUR, {_TEXT}) AS edt, count(*) AS pv
        FROM (SELECT date_trunc('hour', ts) AS w FROM events WHERE event_type = 'view') GROUP BY w""",
    "stream_hot_types": f"""
        WITH c AS (SELECT ws + INTERVAL 6 HOUR AS we, event_type, count(*) AS cnt
                   FROM (SELECT event_type, date_trunc('hour', ts) - o * INTERVAL 1 HOUR AS ws FROM events, range(6) r(o)) GROUP BY ALL)
        SELECT strftime(we, {_TEXT}) AS edt, event_type, cnt, rk
        FROM (SELECT *, row_number() OVER (PARTITION BY we ORDER BY cnt DESC, event_type) AS rk FROM c)
        WHERE rk <= 2""",
    "stream_order_details": """
        SELECT o_orderkey AS order_id, l_orderkey * 10 + l_linenumber AS detail_id, l_partkey AS sku_id,
               CAST(l_quantity AS BIGINT) AS sku_num, strftime(o_orderdate, '%Y-%m-%d') AS create_date
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY""",
    "stream_user_jump": """
        WITH n AS (SELECT *, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type FROM events
                   WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM n WHERE event_type = 'signup'
        AND (next_type = 'signup' OR next_ts - ts >= INTERVAL 12 HOUR OR next_ts IS NULL)""",
}
_PATTERNS = pattern_queries.ORACLE
ORACLE |= {
    "stream_new_user_fix": f"SELECT event_id, is_new FROM ({_PATTERNS['new_user_fix']})",
    "stream_daily_visit": f"SELECT event_id FROM ({_PATTERNS['daily_unique_visit']})",
    "stream_login_alert": f"""
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM (
            WITH {pattern_queries.LOGINS} SELECT event_id, user_id FROM f
            WHERE event_type = 'error' AND prev_type = 'error' AND ts - prev_ts < INTERVAL 6 HOUR
            QUALIFY row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) = 1)""",
    "stream_order_next": f"""
        SELECT event_id, 'matched' AS outcome FROM ({_PATTERNS['order_cep_matched']})
        UNION ALL SELECT event_id, 'timeout' FROM ({_PATTERNS['order_cep_timeout']})""",
    "stream_click_limit": f"""
        SELECT event_id, 'normal' AS outcome FROM ({_PATTERNS['blacklist_normal']})
        UNION ALL SELECT event_id, 'alert' FROM ({_PATTERNS['blacklist_alert']})
        UNION ALL SELECT event_id, 'dropped' FROM ({_PATTERNS['blacklist_dropped']})""",
    "stream_province_stats": stats_queries.ORACLE["province_stats"],
    "stream_keyword_stats": stats_queries.ORACLE["keyword_stats"],
    "stream_login_cep": _PATTERNS["login_cep"],
    "stream_ads_sliding": f"""
        WITH {aggregate_queries._slides(aggregate_queries._ADS, 'province, ad_id', 6, 1, 'HOUR')}
        SELECT strftime(we, {_TEXT}) AS edt, province, ad_id, cnt FROM counted""",
    "stream_ads_topn_late": aggregate_queries.ORACLE["ads_sliding_topn"],
    "stream_dim_lookup": """
        WITH b AS (SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem),
             f AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS supp,
                          least(2, (epoch_us(l_shipdate) - epoch_us(low)) * 3 // (epoch_us(high) - epoch_us(low))) AS slice FROM lineitem, b)
        SELECT id, supp, CASE WHEN s_suppkey IS NULL THEN NULL WHEN slice >= 2 AND s_nationkey % 2 = 0 THEN s_name || ' v3'
                              WHEN slice >= 1 AND s_acctbal > 0 THEN s_name || ' v2' ELSE s_name || ' v1' END AS name
        FROM f LEFT JOIN supplier ON s_suppkey = supp""",
    "stream_product_stats": stats_queries.ORACLE["product_stats"],
    "stream_visitor_stats": stats_queries.ORACLE["visitor_stats"],
    "stream_cdc_snapshot": """
        SELECT s_suppkey AS supplier, CAST(2 AS BIGINT) AS version, 'update' AS op, s_name || ' v1' AS before, s_name || ' v2' AS after FROM supplier WHERE s_acctbal > 0
        UNION ALL SELECT s_suppkey, 3, 'update', s_name || CASE WHEN s_acctbal > 0 THEN ' v2' ELSE ' v1' END, s_name || ' v3' FROM supplier WHERE s_nationkey % 2 = 0""",
    "stream_payment_wide": join_queries.ORACLE["payment_wide"],
    "stream_tx_reconcile": f"SELECT o_orderkey, nth, total, l_linenumber FROM ({join_queries.ORACLE['tx_reconcile']})",
    "stream_hourly_uv": aggregate_queries.ORACLE["hourly_uv"],
    "stream_order_watch": _PATTERNS["order_pay_watch_all"],
}
