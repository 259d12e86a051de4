"""Queries on the statistics tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators import logs
from tillstream.operators.joins import lookup
from tillstream.operators.ordered import hot_keys
from tillstream.plans import bindings as b
from tillstream.plans import join_queries as j
from tillstream.plans import stats
from tillstream.plans.wide import add_province, join_details, join_payments
from tillstream.session import stored

HOUR, DAY, HALF_DAY = timedelta(hours=1), timedelta(days=1), timedelta(hours=12)


def province_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the province of their customer."""
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey",
                                            b.money("o_totalprice").alias("total_amount"), F.col("o_orderdate").alias("rowtime"))
    o = lookup(o, b.table(spark, sf, "customer"), "o_custkey", "c_custkey", {"province_id": F.col("c_nationkey").cast("long")}, "inner")
    return add_province(o, b.dims(spark, sf).province, "inner")


def province_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by the province of their customer, per day."""
    return stats.province_stats(spark, province_orders(spark, sf), DAY)


def visitor_stats(spark: SparkSession, sf: str) -> DataFrame:
    users = b.events(spark, sf).select(F.col("user_id").cast("string").alias("_mid"), "ts")
    rows = stats.visitor_rows_one_pass(b.log_rows(spark, sf), ["event_id"], HALF_DAY, hot=hot_keys(users, ["_mid"], "ts"))
    return stats.visitor_stats(rows, HOUR)


def product_page_actions(spark: SparkSession, sf: str) -> DataFrame:
    return logs.product_actions(logs.pages(b.log_rows(spark, sf)))


def product_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame | None]:
    """Favours are clicks, carts are purchases, comments are errors, refunds are returned details.

    Orders meet their details once; what comes out is a table that orders and payments both read.
    """
    e = b.events(spark, sf).select("event_type", b.k().alias("sku_id"), F.col("ts").cast("timestamp").alias("at"))
    kind = F.col("event_type")
    joined = join_details(b.order_info(spark, sf), b.order_detail(spark, sf), b.ORDER_WITHIN)
    details = stored(joined.select("sku_id", "sku_num", "order_id", "user_id", "total_amount", "split_total_amount", "create_time", "order_ts"), "details").withColumnRenamed("order_ts", "ts")
    returned = b.table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return {
        "pages": logs.pages(b.log_rows(spark, sf)),
        "favors": None, "carts": None, "comments": None,
        "mixed": stats.acts(e, kind == "click", kind == "purchase", kind == "error", F.col("sku_id") % 3 + 1,
                            F.concat(F.lit("120"), (F.col("sku_id") % 4 + 1).cast("string"))),
        "orders": details,
        "payments": join_payments(b.payment_info(spark, sf), details).withColumnRenamed("payment_ts", "ts"),
        "refunds": returned.select(F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
                                   b.money("l_extendedprice").alias("refund_amount"), F.col("l_shipdate").alias("at")),
    }


def product_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.product_stats(stats.product_rows(**product_inputs(spark, sf)), b.dims(spark, sf), DAY)


def keyword_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.keyword_stats(stats.search_texts(logs.pages(b.log_rows(spark, sf))), HOUR)


QUERIES: dict[str, b.Query] = {f.__name__: f for f in (
    province_stats, visitor_stats, product_page_actions, product_stats, keyword_stats)}

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TEXT = "'%Y-%m-%d %H:%M:%S'"
_LOG = f"log AS (SELECT *, {_K} AS k FROM events WHERE event_id % 97 <> 0)"
_ACTIONS = f"""
    SELECT k AS sku_id, 1 AS click_ct, 0 AS display_ct, ts FROM log WHERE event_type = 'view'
    UNION ALL SELECT k, 0, 1, ts FROM log WHERE event_type = 'view'
    UNION ALL SELECT (k + 1) % 100, 0, 1, ts FROM log WHERE event_type = 'view'"""

ORACLE: dict[str, str] = {
    "province_stats": f"""
        SELECT strftime(d, {_TEXT}) AS stt, strftime(d + INTERVAL 1 DAY, {_TEXT}) AS edt, CAST(n_nationkey AS BIGINT) AS province_id,
               n_name AS province_name, 'A' || n_nationkey AS province_area_code, 'ISO-' || n_nationkey AS province_iso_code,
               'CN-' || n_nationkey AS province_3166_2_code,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS order_amount,
               count(DISTINCT o_orderkey) AS order_count
        FROM (SELECT *, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS d FROM orders)
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY d, n_nationkey, n_name""",
    "visitor_stats": f"""
        WITH {_LOG},
        fixed AS (SELECT *, CASE WHEN k % 2 = 0 AND row_number() OVER (PARTITION BY user_id, k % 2 ORDER BY ts, event_id) = 1
                         THEN '1' ELSE '0' END AS is_new FROM log),
        pages AS (SELECT *, event_type = 'signup' AS entry,
                         row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS nth,
                         lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type
                  FROM fixed WHERE event_type <> 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT strftime(date_trunc('hour', ts), {_TEXT}) AS stt, strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {_TEXT}) AS edt,
               'v' || k % 3 AS vc, 'ch' || k % 4 AS ch, 'ar' || user_id % 7 AS ar, is_new,
               count(*) FILTER (WHERE nth = 1) AS uv_ct, count(*) AS pv_ct, count(*) FILTER (WHERE entry) AS sv_ct,
               count(*) FILTER (WHERE entry AND (next_ts IS NULL OR next_type = 'signup'
                                OR epoch_ms(next_ts) - epoch_ms(ts) >= 43200000)) AS uj_ct,
               CAST(sum(k * 100) AS BIGINT) AS dur_sum
        FROM pages GROUP BY ALL""",
    "product_page_actions": f"""
        WITH {_LOG} SELECT sku_id, CAST(click_ct AS BIGINT) AS click_ct, CAST(display_ct AS BIGINT) AS display_ct,
                           epoch_us(ts) // 1000 AS ts FROM ({_ACTIONS})""",
    "product_stats": f"""
        WITH {_LOG}, ow AS ({j.ORDER_WIDE_SQL}), pw AS ({j.PAYMENT_WIDE_SQL}),
        u AS (SELECT sku_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d, click_ct, display_ct, 0 AS favor_ct, 0 AS cart_ct, 0 AS order_sku_num,
                     0 AS order_amount, NULL AS o, 0 AS payment_amount, NULL AS p, NULL AS r, 0 AS refund_amount,
                     0 AS comment_ct, 0 AS good_comment_ct FROM ({_ACTIONS})
              UNION ALL BY NAME SELECT {_K} AS sku_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d, 1 AS favor_ct FROM events WHERE event_type = 'click'
              UNION ALL BY NAME SELECT {_K} AS sku_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d, {_K} % 3 + 1 AS cart_ct FROM events WHERE event_type = 'purchase'
              UNION ALL BY NAME SELECT sku_id, CAST(create_time[:10] AS TIMESTAMP) AS d, sku_num AS order_sku_num,
                                       total_amount AS order_amount, order_id AS o FROM ow
              UNION ALL BY NAME SELECT sku_id, CAST(payment_create_time[:10] AS TIMESTAMP) AS d, total_amount AS payment_amount, order_id AS p FROM pw
              UNION ALL BY NAME SELECT l_partkey AS sku_id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS d,
                                       CAST(l_extendedprice AS DECIMAL(18,2)) AS refund_amount, l_orderkey AS r FROM lineitem WHERE l_returnflag = 'R'
              UNION ALL BY NAME SELECT {_K} AS sku_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d, 1 AS comment_ct,
                                       CAST({_K} % 4 = 0 AS INTEGER) AS good_comment_ct FROM events WHERE event_type = 'error'),
        s AS (SELECT sku_id, d, CAST(coalesce(sum(click_ct), 0) AS BIGINT) AS click_ct, CAST(coalesce(sum(display_ct), 0) AS BIGINT) AS display_ct,
                     CAST(coalesce(sum(favor_ct), 0) AS BIGINT) AS favor_ct, CAST(coalesce(sum(cart_ct), 0) AS BIGINT) AS cart_ct,
                     CAST(coalesce(sum(order_sku_num), 0) AS BIGINT) AS order_sku_num,
                     CAST(coalesce(sum(order_amount), 0) AS DECIMAL(28,2)) AS order_amount, count(DISTINCT o) AS order_ct,
                     CAST(coalesce(sum(payment_amount), 0) AS DECIMAL(28,2)) AS payment_amount, count(DISTINCT p) AS paid_order_ct,
                     count(DISTINCT r) AS refund_order_ct, CAST(coalesce(sum(refund_amount), 0) AS DECIMAL(28,2)) AS refund_amount,
                     CAST(coalesce(sum(comment_ct), 0) AS BIGINT) AS comment_ct,
                     CAST(coalesce(sum(good_comment_ct), 0) AS BIGINT) AS good_comment_ct
              FROM u GROUP BY sku_id, d)
        SELECT strftime(d, {_TEXT}) AS stt, strftime(d + INTERVAL 1 DAY, {_TEXT}) AS edt, s.* EXCLUDE (d), p_name AS sku_name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS sku_price, {j.SPU_ID} AS spu_id, p_type AS spu_name, {j.TM_ID} AS tm_id,
               p_brand AS tm_name, p_partkey % 5 AS category3_id, r_name AS category3_name
        FROM s LEFT JOIN part ON p_partkey = sku_id LEFT JOIN region ON r_regionkey = p_partkey % 5""",
    "keyword_stats": rf"""
        WITH {_LOG}, t AS (SELECT date_trunc('hour', ts) AS w, unnest(['red', 'shoe', CAST(k AS VARCHAR), 'shop', CAST(k % 10 AS VARCHAR)]) AS keyword
                           FROM log WHERE event_type = 'click')
        SELECT keyword, count(*) AS ct, 'search' AS source, strftime(w, {_TEXT}) AS stt, strftime(w + INTERVAL 1 HOUR, {_TEXT}) AS edt
        FROM t GROUP BY keyword, w""",
}
