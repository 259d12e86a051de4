"""Queries on dimension lookups, wide rows and pairing."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.joins import chunked_pairs, pair_by_occurrence
from tillstream.operators.ordered import SplitPolicy
from tillstream.plans import bindings as b
from tillstream.plans import wide


def order_wide_rows(spark: SparkSession, sf: str) -> DataFrame:
    return wide.order_wide(b.order_info(spark, sf), b.order_detail(spark, sf), b.dims(spark, sf), F.lit(b.AS_OF),
                           b.ORDER_WITHIN)


def payment_wide_rows(spark: SparkSession, sf: str) -> DataFrame:
    return wide.payment_wide(b.payment_info(spark, sf), order_wide_rows(spark, sf), b.PAY_AFTER)


def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    return order_wide_rows(spark, sf).drop("ts")


def payment_wide(spark: SparkSession, sf: str) -> DataFrame:
    return payment_wide_rows(spark, sf).drop("ts")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return b.order_info(spark, sf).select(F.col("id").alias("order_id"), "user_id", "province_id")


def dim_user(spark: SparkSession, sf: str) -> DataFrame:
    return wide.add_user(_orders(spark, sf), b.dims(spark, sf).user, F.lit(b.AS_OF)).drop("province_id")


def dim_province(spark: SparkSession, sf: str) -> DataFrame:
    return wide.add_province(_orders(spark, sf), b.dims(spark, sf).province).drop("user_id")


def dim_sku_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Products, their line, brand and category for every order detail."""
    d = b.order_detail(spark, sf).select(F.col("id").alias("detail_id"), "sku_id", "sku_num")
    return wide.add_sku_chain(d, b.dims(spark, sf), price=True, name=True)


def _orders_and_receipts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", b.money("o_totalprice").alias("total"))
    r = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_partkey",
                                              "l_suppkey", "l_linenumber")
    return o, r


def _tx_reconcile(spark: SparkSession, sf: str, policy: SplitPolicy | None) -> DataFrame:
    o, r = _orders_and_receipts(spark, sf)
    out = pair_by_occurrence(o, r, "o_orderkey", ["o_orderdate", "total"],
                             ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], policy)
    return out.select("o_orderkey", "nth", "total", "l_linenumber", "l_partkey", "l_suppkey")


def tx_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and receipts, paired by number and occurrence."""
    return _tx_reconcile(spark, sf, None)


def tx_reconcile_cut(spark: SparkSession, sf: str) -> DataFrame:
    """With keys of a few rows cut into chunks already."""
    return _tx_reconcile(spark, sf, SplitPolicy(share=20_000))


def _receipts(orders: pa.Table, receipts: pa.Table) -> pa.Table:
    """The n-th order of a key next to the key's n-th receipt; rows without a key have one in common."""
    def keyed(rows: pa.Table) -> pa.Table:
        key = rows.column("o_orderkey")
        return rows.append_column("_none", pc.is_null(key)).append_column("_key", pc.fill_null(key, 0))

    both = keyed(orders).join(keyed(receipts).drop_columns(["o_orderkey", "l_shipdate", "_chunk"]), ["_none", "_key", "nth"], join_type="inner", use_threads=False)
    return both.select(["o_orderkey", "nth", "total", "l_linenumber", "l_partkey", "l_suppkey"])


def cogroup_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a function of both inputs, in chunks of a few rows, many of them a call."""
    o, r = _orders_and_receipts(spark, sf)
    schema = "o_orderkey long, nth long, total decimal(18,2), l_linenumber int, l_partkey long, l_suppkey long"
    return chunked_pairs(o, r, "o_orderkey", ["o_orderdate", "total"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], _receipts, schema, chunk=3, call_rows=100_000)


QUERIES: dict[str, b.Query] = {f.__name__: f for f in (
    cogroup_reconcile, order_wide, payment_wide, dim_user, dim_province, dim_sku_chain, tx_reconcile, tx_reconcile_cut)}

_TEXT = "'%Y-%m-%d %H:%M:%S'"
_AGE = "CAST(date_diff('day', DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), DATE '2024-01-01') // 365 AS INTEGER)"
_GENDER = "CASE WHEN c_custkey % 2 = 0 THEN 'F' WHEN c_custkey IS NOT NULL THEN 'M' END"
SPU_ID = "CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT)"
TM_ID = "CAST(substring(p_brand, 7) AS BIGINT)"

ORDER_WIDE_SQL = f"""
    SELECT l_orderkey * 10 + l_linenumber AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
           'sku-' || l_partkey AS sku_name, o_custkey % 25 AS province_id,
           CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'O' THEN '1002' ELSE '1001' END AS order_status,
           o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
           CAST(o_orderkey % 10 AS DECIMAL(18,2)) AS activity_reduce_amount,
           CAST(o_orderkey % 5 AS DECIMAL(18,2)) AS coupon_reduce_amount,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) + o_orderkey % 10 + o_orderkey % 5 AS DECIMAL(18,2)) AS original_total_amount,
           CAST(5 AS DECIMAL(18,2)) AS feight_fee, CAST(NULL AS DECIMAL(18,2)) AS split_feight_fee,
           CAST(l_tax AS DECIMAL(18,2)) AS split_activity_amount, CAST(l_discount AS DECIMAL(18,2)) AS split_coupon_amount,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS split_total_amount,
           strftime(o_orderdate + INTERVAL 15 MINUTE, {_TEXT}) AS expire_time, strftime(o_orderdate, {_TEXT}) AS create_time,
           strftime(o_orderdate + INTERVAL 1 HOUR, {_TEXT}) AS operate_time, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
           strftime(o_orderdate, '%H') AS create_hour, n_name AS province_name, 'A' || n_nationkey AS province_area_code,
           'ISO-' || n_nationkey AS province_iso_code, 'CN-' || n_nationkey AS province_3166_2_code,
           {_AGE} AS user_age, {_GENDER} AS user_gender, {SPU_ID} AS spu_id, {TM_ID} AS tm_id, p_partkey % 5 AS category3_id,
           p_type AS spu_name, p_brand AS tm_name, r_name AS category3_name
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = o_custkey % 25
    LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN region ON r_regionkey = p_partkey % 5"""

PAYMENT_WIDE_SQL = f"""
    SELECT o_orderkey + 1000000 AS payment_id, 'order ' || o_orderkey AS subject,
           CASE WHEN o_orderkey % 2 = 0 THEN '1101' ELSE '1102' END AS payment_type,
           strftime(o_orderdate + (o_orderkey % 30) * INTERVAL 1 MINUTE, {_TEXT}) AS payment_create_time,
           strftime(o_orderdate + (o_orderkey % 30) * INTERVAL 1 MINUTE + INTERVAL 10 SECOND, {_TEXT}) AS callback_time,
           w.* EXCLUDE (create_time, expire_time, operate_time, create_date, create_hour), w.create_time AS order_create_time
    FROM orders JOIN ({ORDER_WIDE_SQL}) w ON w.order_id = o_orderkey
    WHERE o_orderstatus <> 'P' AND o_orderkey % 30 <= 15"""

ORACLE: dict[str, str] = {
    "order_wide": ORDER_WIDE_SQL,
    "payment_wide": PAYMENT_WIDE_SQL,
    "dim_user": f"""
        SELECT o_orderkey AS order_id, o_custkey AS user_id, {_AGE} AS user_age, {_GENDER} AS user_gender
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "dim_province": """
        SELECT o_orderkey AS order_id, o_custkey % 25 AS province_id, n_name AS province_name,
               'A' || n_nationkey AS province_area_code, 'ISO-' || n_nationkey AS province_iso_code,
               'CN-' || n_nationkey AS province_3166_2_code
        FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 25""",
    "dim_sku_chain": f"""
        SELECT l_orderkey * 10 + l_linenumber AS detail_id, l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num,
               p_name AS sku_name, CAST(p_retailprice AS DECIMAL(18,2)) AS sku_price, {SPU_ID} AS spu_id, {TM_ID} AS tm_id,
               p_partkey % 5 AS category3_id, p_type AS spu_name, p_brand AS tm_name, r_name AS category3_name
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN region ON r_regionkey = p_partkey % 5""",
    "tx_reconcile": """
        WITH o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
                          row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate, o_totalprice) AS nth FROM orders),
             r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                          ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem)
        SELECT o_orderkey, nth, total, l_linenumber, l_partkey, l_suppkey FROM o JOIN r ON l_orderkey = o_orderkey AND n = nth""",
}
ORACLE["cogroup_reconcile"] = ORACLE["tx_reconcile_cut"] = ORACLE["tx_reconcile"]
