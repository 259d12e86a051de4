"""Queries on per-key event patterns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.times import text
from tillstream.operators import patterns as p
from tillstream.operators.ordered import SplitPolicy
from tillstream.plans import bindings as b

HALF_DAY, SIX_HOURS = timedelta(hours=12), timedelta(hours=6)
CLICK_LIMIT = 3


def new_user_fix(spark: SparkSession, sf: str) -> DataFrame:
    e = b.events(spark, sf).select("event_id", "user_id", "ts", F.when(b.k() % 2 == 0, "1").otherwise("0").alias("is_new"))
    return p.correct_new_flag(e, "user_id", "is_new", "ts", ["event_id"]).select("event_id", "user_id", "is_new")


def daily_unique_visit(spark: SparkSession, sf: str) -> DataFrame:
    first = p.first_of_day(b.events(spark, sf).select("user_id", "ts", "event_id"), "user_id", "ts", ["event_id"])
    return first.select("user_id", F.col("visit_date").cast("string").alias("visit_date"), "event_id")


def _user_jump(spark: SparkSession, sf: str, policy: SplitPolicy | None) -> DataFrame:
    e = b.events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    found = p.bounces(e, "user_id", F.col("event_type") == "signup", "ts", ["event_id"], HALF_DAY, policy)
    return found.select("event_id", "user_id")


def user_jump(spark: SparkSession, sf: str) -> DataFrame:
    return _user_jump(spark, sf, None)


def user_jump_cut(spark: SparkSession, sf: str) -> DataFrame:
    """With almost every key cut into chunks."""
    return _user_jump(spark, sf, SplitPolicy(share=200))


def login_alert(spark: SparkSession, sf: str) -> DataFrame:
    hits = p.login_alerts(b.logins(spark, sf), "user_id", "kind", "ts", ["event_id"], SIX_HOURS)
    return hits.select("user_id", "run", text(F.col("first_ts")).alias("first_fail"), text(F.col("second_ts")).alias("second_fail"))


def login_cep(spark: SparkSession, sf: str) -> DataFrame:
    seqs = p.failure_sequences(b.logins(spark, sf), "user_id", "kind", "ts", "event_id", SIX_HOURS)
    return seqs.select("user_id", "first_pos", text(F.col("start_ts")).alias("started"), text(F.col("end_ts")).alias("ended"), "fails")


def login_cep_members(spark: SparkSession, sf: str) -> DataFrame:
    """The failures of each sequence."""
    logins = b.logins(spark, sf)
    seqs = p.failure_sequences(logins, "user_id", "kind", "ts", "event_id", SIX_HOURS)
    return p.sequence_members(seqs, logins, "user_id", "kind", "ts", "event_id")


def _cep(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return p.next_is(b.create_pay_events(spark, sf), "user_id", "kind", "create", "pay", "ts", ["event_id"], HALF_DAY)


def order_cep_matched(spark: SparkSession, sf: str) -> DataFrame:
    return _cep(spark, sf)[0].select("event_id", "user_id", text(F.col("ts")).alias("created"), text(F.col("next_ts")).alias("paid"))


def order_cep_timeout(spark: SparkSession, sf: str) -> DataFrame:
    return _cep(spark, sf)[1].select("event_id", "user_id", text(F.col("ts")).alias("created"))


def order_pay_watch(spark: SparkSession, sf: str) -> DataFrame:
    return p.watch_payments(b.order_states(spark, sf), "order_id", "kind", "ts", timedelta(days=15), timedelta(days=20))


def order_pay_watch_all(spark: SparkSession, sf: str) -> DataFrame:
    """Over all orders."""
    return p.watch_payments(b.order_states(spark, sf, "true"), "order_id", "kind", "ts", timedelta(days=15), timedelta(days=20))


def _clicks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = b.events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    return p.blacklist(e, "user_id", "event_type", "ts", ["event_id"], CLICK_LIMIT)


def blacklist_normal(spark: SparkSession, sf: str) -> DataFrame:
    return _clicks(spark, sf)[0].select("event_id", "user_id", "event_type", "nth")


def blacklist_alert(spark: SparkSession, sf: str) -> DataFrame:
    return _clicks(spark, sf)[1].select("event_id", "user_id", "event_type", F.col("click_date").cast("string").alias("click_date"))


def blacklist_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """The clicks beyond the limit."""
    return _clicks(spark, sf)[2].select("event_id", "user_id", "event_type", "nth")


QUERIES: dict[str, b.Query] = {f.__name__: f for f in (
    new_user_fix, daily_unique_visit, user_jump, user_jump_cut, login_alert, login_cep, login_cep_members, order_cep_matched, order_cep_timeout,
    order_pay_watch, order_pay_watch_all, blacklist_normal, blacklist_alert, blacklist_dropped)}

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TEXT = "'%Y-%m-%d %H:%M:%S'"
LOGINS = """f AS (SELECT *, row_number() OVER w AS pos, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type,
                   count(*) FILTER (WHERE event_type = 'signup') OVER w AS run
            FROM events WHERE event_type IN ('error', 'signup') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
_CEP = """n AS (SELECT *, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type
                FROM events WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
_CLICKS = """c AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS nth
                   FROM events)"""

ORACLE: dict[str, str] = {
    "new_user_fix": f"""
        SELECT event_id, user_id, CASE WHEN flag = '1' AND row_number() OVER (PARTITION BY user_id, flag ORDER BY ts, event_id) = 1
               THEN '1' ELSE '0' END AS is_new
        FROM (SELECT *, CASE WHEN {_K} % 2 = 0 THEN '1' ELSE '0' END AS flag FROM events)""",
    "daily_unique_visit": """
        SELECT user_id, strftime(ts, '%Y-%m-%d') AS visit_date, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) = 1""",
    "user_jump": """
        SELECT event_id, user_id FROM (
            SELECT *, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type FROM events
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE event_type = 'signup' AND (next_ts IS NULL OR next_ts - ts >= INTERVAL 12 HOUR OR next_type = 'signup')""",
    "login_alert": f"""
        WITH {LOGINS} SELECT user_id, run, strftime(prev_ts, {_TEXT}) AS first_fail, strftime(ts, {_TEXT}) AS second_fail FROM f
        WHERE event_type = 'error' AND prev_type = 'error' AND ts - prev_ts < INTERVAL 6 HOUR
        QUALIFY row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) = 1""",
    "login_cep": f"""
        WITH {LOGINS}, e AS (SELECT * FROM f WHERE event_type = 'error')
        SELECT h.user_id, h.pos AS first_pos, strftime(h.ts, {_TEXT}) AS started, strftime(t.ts, {_TEXT}) AS ended, count(*) AS fails
        FROM e h JOIN e t ON t.user_id = h.user_id AND t.run = h.run AND t.pos > h.pos AND t.ts - h.ts < INTERVAL 6 HOUR
        JOIN e m ON m.user_id = h.user_id AND m.pos BETWEEN h.pos AND t.pos
        GROUP BY h.user_id, h.pos, t.pos, h.ts, t.ts""",
    "login_cep_members": f"""
        WITH {LOGINS}, e AS (SELECT * FROM f WHERE event_type = 'error')
        SELECT h.user_id, h.pos AS first_pos, t.pos AS last_pos, m.event_id
        FROM e h JOIN e t ON t.user_id = h.user_id AND t.run = h.run AND t.pos > h.pos AND t.ts - h.ts < INTERVAL 6 HOUR
        JOIN e m ON m.user_id = h.user_id AND m.pos BETWEEN h.pos AND t.pos""",
    "order_cep_matched": f"""
        WITH {_CEP} SELECT event_id, user_id, strftime(ts, {_TEXT}) AS created, strftime(next_ts, {_TEXT}) AS paid FROM n
        WHERE event_type = 'view' AND next_type = 'purchase' AND next_ts - ts < INTERVAL 12 HOUR""",
    "order_cep_timeout": f"""
        WITH {_CEP} SELECT event_id, user_id, strftime(ts, {_TEXT}) AS created FROM n
        WHERE event_type = 'view' AND (next_ts IS NULL OR next_ts - ts >= INTERVAL 12 HOUR)""",
    "order_pay_watch": """
        WITH c AS (SELECT o_orderkey AS order_id, o_orderdate AS ct FROM orders WHERE o_orderstatus <> 'P'),
             p AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS pt FROM lineitem GROUP BY 1),
             j AS (SELECT coalesce(c.order_id, p.order_id) AS order_id, ct, pt, date_diff('day', ct, pt) AS gap
                   FROM c FULL JOIN p ON c.order_id = p.order_id)
        SELECT order_id, CASE WHEN gap <= 15 THEN 'normal' ELSE 'late' END AS outcome FROM j WHERE abs(gap) <= 20
        UNION ALL SELECT order_id, 'cancelled' FROM j WHERE ct IS NOT NULL AND (pt IS NULL OR abs(gap) > 20)
        UNION ALL SELECT order_id, 'pay_only' FROM j WHERE pt IS NOT NULL AND (ct IS NULL OR abs(gap) > 20)""",
    "blacklist_normal": f"WITH {_CLICKS} SELECT event_id, user_id, event_type, nth FROM c WHERE nth < 3",
    "blacklist_alert": f"""
        WITH {_CLICKS} SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS click_date FROM c WHERE nth = 3""",
}
ORACLE["user_jump_cut"] = ORACLE["user_jump"]
ORACLE["blacklist_dropped"] = f"WITH {_CLICKS} SELECT event_id, user_id, event_type, nth FROM c WHERE nth > 3"
ORACLE["order_pay_watch_all"] = ORACLE["order_pay_watch"].replace(" WHERE o_orderstatus <> 'P'", "")
