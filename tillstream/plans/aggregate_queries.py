"""Queries on keyed aggregates, running values, windows and rankings."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.times import epoch_micros, text
from tillstream.operators.aggregates import (
    Aggregator,
    aggregate,
    arg_max,
    arg_min,
    grouping_sets,
    rolled,
    running_distinct,
)
from tillstream.operators.late import mark_late
from tillstream.operators.ordered import SplitPolicy, position, running, with_ordered
from tillstream.operators.windows import sliding_sums, stamp, top_n, tumbling
from tillstream.plans import bindings as b
from tillstream.sources.files import access_log

HOUR = timedelta(hours=1)


def _count() -> Column:
    return F.count(F.lit(1))


def _one() -> Column:
    return F.lit(1).cast("long")


def sensor_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Sum per sensor next to the time of its first reading."""
    return rolled(b.sensors(spark, sf), ["id"], ["ts"], ["seq"], vc=F.sum("vc"))


def sensor_max_by(spark: SparkSession, sf: str) -> DataFrame:
    return arg_max(b.sensors(spark, sf).select("id", "ts", "vc", "seq"), ["id"], "vc", ["seq"])


def sensor_min_by(spark: SparkSession, sf: str) -> DataFrame:
    return arg_min(b.sensors(spark, sf).select("id", "ts", "vc", "seq"), ["id"], "vc", ["seq"])


def parity_min_max(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    numbers = b.events(spark, sf).select(b.k().alias("k"))
    return numbers.groupBy(F.when(k % 2 == 0, "even").otherwise("odd").alias("parity")).agg(
        F.max(k).alias("highest"), F.min(k).alias("lowest"), F.sum(k).alias("total"))


#: Cuts almost every key, so that the borders of chunks are part of the result.
FINE = SplitPolicy(share=200)


def _running_sum(spark: SparkSession, sf: str, policy: SplitPolicy | None) -> DataFrame:
    s = b.sensors(spark, sf)
    return with_ordered(s, ["id"], "at", ["seq"], policy, total=running("sum", F.col("vc"))).select("seq", "id", "total")


def running_sum(spark: SparkSession, sf: str) -> DataFrame:
    return _running_sum(spark, sf, None)


def running_sum_cut(spark: SparkSession, sf: str) -> DataFrame:
    return _running_sum(spark, sf, FINE)


def running_min_max(spark: SparkSession, sf: str) -> DataFrame:
    """Lowest and highest value of each sensor so far, after every reading."""
    v = F.col("vc")
    out = with_ordered(b.sensors(spark, sf), ["id"], "at", ["seq"], low=running("min", v), high=running("max", v))
    return out.select("seq", "id", "low", "high")


def running_pv(spark: SparkSession, sf: str) -> DataFrame:
    """Number of page views so far, after every page view."""
    pv = b.behaviors(spark, sf).where(F.col("behavior") == "pv").select("event_id", "ts")
    return with_ordered(pv, [], "ts", ["event_id"], pv=position()).select("event_id", "pv")


def running_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """The combined row after every reading: first time, sum so far."""
    s = b.sensors(spark, sf)
    first = running("min", F.struct("at", "seq", "ts"))
    out = with_ordered(s, ["id"], "at", ["seq"], first=first, total=running("sum", F.col("vc")))
    return out.select("seq", "id", F.col("first.ts").alias("ts"), F.col("total").alias("vc"))


def running_uv(spark: SparkSession, sf: str) -> DataFrame:
    """Number of different users so far, after every page view."""
    pv = b.behaviors(spark, sf).where(F.col("behavior") == "pv").select("user_id", "ts", "event_id")
    return running_distinct(pv, "user_id", "ts", "event_id", "uv").select("event_id", "uv")


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    d = b.documents(spark, sf).select(F.explode(F.split("text", " ")).alias("word"))
    return d.where(F.col("word") != "").groupBy("word").agg(_count().alias("n"))


def pv_total(spark: SparkSession, sf: str) -> DataFrame:
    return b.behaviors(spark, sf).where(F.col("behavior") == "pv").groupBy("behavior").agg(_count().alias("pv"))


def uv_total(spark: SparkSession, sf: str) -> DataFrame:
    return b.behaviors(spark, sf).where(F.col("behavior") == "pv").agg(F.count_distinct("user_id").alias("uv"))


def ads_by_province(spark: SparkSession, sf: str) -> DataFrame:
    return b.ad_clicks(spark, sf).groupBy("province", "ad_id").agg(_count().alias("clicks"))


def channel_behavior_sets(spark: SparkSession, sf: str) -> DataFrame:
    m = b.events(spark, sf).select(F.concat(F.lit("ch"), (F.col("user_id") % 5).cast("string")).alias("channel"),
                                   F.col("event_type").alias("behavior"))
    return grouping_sets(m, [["channel", "behavior"], ["behavior"]], _count().alias("n"))


COUNTER = Aggregator(create=lambda: 0, add=lambda acc, rows: acc + len(rows), merge=lambda a, c: a + c,
                     result=lambda acc: acc, result_type=T.LongType())


def udaf_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate(b.events(spark, sf).select("event_type"), ["event_type"], COUNTER, "n")


def udaf_by_user(spark: SparkSession, sf: str) -> DataFrame:
    """A user-defined count by a number that doubles cannot hold, null for every tenth user."""
    number = F.when(F.col("user_id") % 10 != 0, F.col("user_id") + 2**53)
    return aggregate(b.events(spark, sf).select(number.alias("number"), "event_type"), ["number", "event_type"], COUNTER, "n")


def hourly_pv(spark: SparkSession, sf: str) -> DataFrame:
    pv = b.behaviors(spark, sf).where(F.col("behavior") == "pv")
    return stamp(tumbling(pv, "ts", HOUR, ["behavior"], _count().alias("pv")))


def hourly_uv(spark: SparkSession, sf: str) -> DataFrame:
    pv = b.behaviors(spark, sf).where(F.col("behavior") == "pv")
    return stamp(tumbling(pv, "ts", HOUR, [], F.count_distinct("user_id").alias("uv")))


def _item_counts(spark: SparkSession, sf: str) -> DataFrame:
    pv = b.behaviors(spark, sf).where(F.col("behavior") == "pv")
    return sliding_sums(pv, "ts", HOUR, timedelta(minutes=5), ["item_id"], {"cnt": _one()})


def sliding_item_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stamp(_item_counts(spark, sf))


def hot_items_topn(spark: SparkSession, sf: str) -> DataFrame:
    top = top_n(_item_counts(spark, sf), ["window_end"], "cnt", ["item_id"], 3)
    return stamp(top).select("edt", "item_id", "cnt", "rk")


def hot_pages_topn(spark: SparkSession, sf: str) -> DataFrame:
    log = access_log(b.access_lines(spark, sf))
    counts = sliding_sums(log, "ts", HOUR, timedelta(minutes=10), ["url"], {"cnt": _one()})
    return stamp(top_n(counts, ["window_end"], "cnt", ["url"], 3)).select("edt", "url", "cnt", "rk")


def ads_sliding_topn(spark: SparkSession, sf: str) -> DataFrame:
    counts = sliding_sums(b.ad_clicks(spark, sf), "ts", timedelta(hours=6), HOUR, ["province", "ad_id"],
                          {"cnt": _one()})
    return stamp(top_n(counts, ["window_end"], "cnt", ["province", "ad_id"], 3)).select(
        "edt", "province", "ad_id", "cnt", "rk")


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows up to four hours behind their arrival, hourly triggers, one-hour windows, 2 h delay."""
    lag = F.make_dt_interval(hours=(F.col("event_id") % 5).cast("int"))
    trigger = F.floor(epoch_micros(F.col("ts")) / 3_600_000_000)
    rows = b.events(spark, sf).select("event_id", trigger.alias("batch"), (F.col("ts") - lag).alias("event_time"))
    marked = mark_late(rows, "event_time", "batch", HOUR, timedelta(hours=2))
    return marked.where("late").select("event_id", text(F.col("event_time")).alias("event_time"))


QUERIES: dict[str, b.Query] = {f.__name__: f for f in (
    sensor_sum, sensor_max_by, sensor_min_by, parity_min_max, running_sum, running_sum_cut, running_min_max, running_pv, running_reduce, running_uv, word_count,
    pv_total, uv_total, ads_by_province, channel_behavior_sets, udaf_count, udaf_by_user, hourly_pv, hourly_uv,
    sliding_item_counts, hot_items_topn, hot_pages_topn, ads_sliding_topn, late_rows)}

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TEXT = "'%Y-%m-%d %H:%M:%S'"
_SENSOR = """s AS (SELECT user_id AS id, epoch_us(ts) // 1000 AS ts, CAST(round(value * 100) AS BIGINT) AS vc,
                          event_id AS seq FROM events)"""


def _slides(source: str, keys: str, size: int, slide: int, unit: str) -> str:
    """Counts per sliding window: every row copied to its windows."""
    return f"""src AS ({source}),
        counted AS (SELECT ws + INTERVAL {size} {unit} AS we, ws, {keys}, count(*) AS cnt
                    FROM (SELECT *, time_bucket(INTERVAL {slide} {unit}, ts) - o * INTERVAL {slide} {unit} AS ws
                          FROM src, range({size // slide}) r(o)) GROUP BY ALL)"""


def _top(keys: str) -> str:
    return f"""SELECT strftime(we, {_TEXT}) AS edt, {keys}, cnt, rk FROM (
            SELECT *, row_number() OVER (PARTITION BY we ORDER BY cnt DESC, {keys}) AS rk FROM counted) WHERE rk <= 3"""


_ADS = f"""SELECT n_name AS province, {_K} % 10 AS ad_id, ts FROM events
           JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey"""
_ITEMS = _slides(f"SELECT {_K} AS item_id, ts FROM events WHERE event_type = 'view'", "item_id", 60, 5, "MINUTE")

ORACLE: dict[str, str] = {
    "sensor_sum": f"WITH {_SENSOR} SELECT id, arg_min(ts, seq) AS ts, CAST(sum(vc) AS BIGINT) AS vc FROM s GROUP BY id",
    "sensor_max_by": f"""
        WITH {_SENSOR} SELECT id, ts, vc, seq FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY vc DESC, seq DESC) = 1""",
    "sensor_min_by": f"""
        WITH {_SENSOR} SELECT id, ts, vc, seq FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY vc, seq) = 1""",
    "parity_min_max": f"""
        SELECT CASE WHEN {_K} % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, max({_K}) AS highest, min({_K}) AS lowest,
               CAST(sum({_K}) AS BIGINT) AS total FROM events GROUP BY 1""",
    "running_sum": f"""
        WITH {_SENSOR} SELECT seq, id, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq) AS BIGINT) AS total FROM s""",
    "running_sum_cut": f"""
        WITH {_SENSOR} SELECT seq, id, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq) AS BIGINT) AS total FROM s""",
    "running_min_max": f"""
        WITH {_SENSOR} SELECT seq, id, min(vc) OVER w AS low, max(vc) OVER w AS high FROM s WINDOW w AS (PARTITION BY id ORDER BY seq)""",
    "running_pv": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pv FROM events WHERE event_type = 'view'",
    "udaf_by_user": """
        SELECT CASE WHEN user_id % 10 <> 0 THEN user_id + 9007199254740992 END AS number, event_type, count(*) AS n
        FROM events GROUP BY ALL""",
    "running_reduce": f"""
        WITH {_SENSOR} SELECT seq, id, first_value(ts) OVER w AS ts, CAST(sum(vc) OVER w AS BIGINT) AS vc FROM s
        WINDOW w AS (PARTITION BY id ORDER BY seq)""",
    "running_uv": """
        WITH pv AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
                    FROM events WHERE event_type = 'view')
        SELECT event_id, count(*) FILTER (WHERE n = 1) OVER (ORDER BY event_id) AS uv FROM pv""",
    "word_count": """
        SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "pv_total": "SELECT 'pv' AS behavior, count(*) AS pv FROM events WHERE event_type = 'view'",
    "uv_total": "SELECT count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view'",
    "ads_by_province": f"SELECT province, ad_id, count(*) AS clicks FROM ({_ADS}) GROUP BY ALL",
    "channel_behavior_sets": """
        SELECT channel, behavior, count(*) AS n
        FROM (SELECT 'ch' || user_id % 5 AS channel, event_type AS behavior FROM events)
        GROUP BY GROUPING SETS ((channel, behavior), (behavior))""",
    "udaf_count": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "hourly_pv": f"""
        SELECT strftime(w, {_TEXT}) AS stt, strftime(w + INTERVAL 1 HOUR, {_TEXT}) AS edt, 'pv' AS behavior, count(*) AS pv
        FROM (SELECT date_trunc('hour', ts) AS w FROM events WHERE event_type = 'view') GROUP BY w""",
    "hourly_uv": f"""
        SELECT strftime(w, {_TEXT}) AS stt, strftime(w + INTERVAL 1 HOUR, {_TEXT}) AS edt, count(DISTINCT user_id) AS uv
        FROM (SELECT date_trunc('hour', ts) AS w, user_id FROM events WHERE event_type = 'view') GROUP BY w""",
    "sliding_item_counts": f"""
        WITH {_ITEMS} SELECT strftime(ws, {_TEXT}) AS stt, strftime(we, {_TEXT}) AS edt, item_id, cnt FROM counted""",
    "hot_items_topn": f"WITH {_ITEMS} {_top('item_id')}",
    "hot_pages_topn": "WITH " + _slides(f"SELECT '/' || event_type || '/' || {_K} AS url, ts FROM events",
                                        "url", 60, 10, "MINUTE") + _top("url"),
    "ads_sliding_topn": "WITH " + _slides(_ADS, "province, ad_id", 6, 1, "HOUR") + _top("province, ad_id"),
    "late_rows": f"""
        WITH r AS (SELECT event_id, date_trunc('hour', ts) AS batch, ts - (event_id % 5) * INTERVAL 1 HOUR AS et FROM events),
             m AS (SELECT batch, max(max(et)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
                   FROM r GROUP BY batch)
        SELECT event_id, strftime(et, {_TEXT}) AS event_time FROM r JOIN m USING (batch)
        WHERE date_trunc('hour', et) + INTERVAL 1 HOUR <= top - INTERVAL 2 HOUR""",
}
