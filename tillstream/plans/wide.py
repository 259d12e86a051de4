"""Wide order and payment rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.times import age_in_years, create_parts
from tillstream.operators.joins import interval_join, lookup
from tillstream.schemas import MONEY, ORDER_WIDE_COLUMNS, PAYMENT_WIDE_COLUMNS


@dataclass(frozen=True)
class Dims:
    """Dimension tables: user(id, birthday, gender), province(id, name, area_code, iso_code,
    iso_3166_2), sku(id, sku_name, price, spu_id, tm_id, category3_id), spu(id, spu_name),
    trademark(id, tm_name), category3(id, name). Provinces and categories are of fixed size."""

    user: DataFrame
    province: DataFrame
    sku: DataFrame
    spu: DataFrame
    trademark: DataFrame
    category3: DataFrame


def derive_order(orders: DataFrame, ts: str = "ts") -> DataFrame:
    return orders.withColumns(create_parts(F.col(ts)))


def add_user(df: DataFrame, user: DataFrame, as_of: Column, how: str = "left") -> DataFrame:
    return lookup(df, user, "user_id", "id",
                  {"user_age": age_in_years(F.col("birthday"), as_of), "user_gender": "gender"}, how)


def add_province(df: DataFrame, province: DataFrame, how: str = "left") -> DataFrame:
    return lookup(df, province, "province_id", "id",
                  {"province_name": "name", "province_area_code": "area_code",
                   "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"},
                  how, fixed_size=True)


def flat_sku(dims: Dims, how: str = "left") -> DataFrame:
    """The SKU dimension with the names of its SPU, trademark and category."""
    out = lookup(dims.sku, dims.spu, "spu_id", "id", {"spu_name": "spu_name"}, how)
    out = lookup(out, dims.trademark, "tm_id", "id", {"tm_name": "tm_name"}, how)
    return lookup(out, dims.category3, "category3_id", "id", {"category3_name": "name"}, how)


def add_sku_chain(df: DataFrame, dims: Dims, how: str = "left", price: bool = False,
                  name: bool = False) -> DataFrame:
    """SKU columns and the names behind the ids a SKU brings.

    The chain of lookups runs once over the dimension, so the facts meet one join, not four.
    """
    names = ["spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
    take = {n: n for n in names}
    if name:
        take["sku_name"] = "sku_name"
    if price:
        take["sku_price"] = "price"
    return lookup(df, flat_sku(dims, how), "sku_id", "id", take, how)


def join_details(orders: DataFrame, details: DataFrame, within: timedelta = timedelta(seconds=5)) -> DataFrame:
    """Orders with their details created at most ``within`` apart (both sides carry ``ts``)."""
    o = orders.withColumnsRenamed({"ts": "order_ts", "id": "order_id"})
    d = details.select(F.col("id").alias("detail_id"), F.col("order_id").alias("_order_id"), "sku_id",
                       "order_price", "sku_num", "sku_name", "split_activity_amount", "split_coupon_amount",
                       "split_total_amount", F.col("ts").alias("detail_ts"))
    out = interval_join(o, d, {"order_id": "_order_id"}, "order_ts", "detail_ts", -within, within)
    # Derived columns come after the join, so they are neither shuffled nor made for unmatched orders.
    return derive_order(out.drop("_order_id"), "order_ts")


def order_wide(orders: DataFrame, details: DataFrame, dims: Dims, as_of: Column,
               within: timedelta = timedelta(seconds=5), how: str = "left") -> DataFrame:
    """Order details with their order and all dimension columns; keeps the order time as ``ts``.

    The freight share of a detail is never known and stays null.
    """
    wide = join_details(orders, details, within)
    wide = add_sku_chain(add_province(add_user(wide, dims.user, as_of, how), dims.province, how), dims, how)
    wide = wide.withColumn("split_feight_fee", F.lit(None).cast(MONEY))
    return wide.select(*ORDER_WIDE_COLUMNS, F.col("order_ts").alias("ts"))


def join_payments(payments: DataFrame, wide: DataFrame, after: timedelta = timedelta(minutes=15)) -> DataFrame:
    """Payments with the order rows created up to ``after`` before (both sides carry ``ts``).

    Where both have a column (order, user, total amount) the payment's value stands.
    """
    p = payments.select(F.col("id").alias("payment_id"), "order_id", "user_id", "total_amount", "subject",
                        "payment_type", F.col("create_time").alias("payment_create_time"), "callback_time",
                        F.col("ts").alias("payment_ts"))
    w = wide.drop("user_id", "total_amount").withColumnsRenamed(
        {"order_id": "_order_id", "create_time": "order_create_time", "ts": "order_ts"})
    return interval_join(p, w, {"order_id": "_order_id"}, "payment_ts", "order_ts", -after, timedelta(0)).drop("_order_id")


def payment_wide(payments: DataFrame, wide: DataFrame, after: timedelta = timedelta(minutes=15)) -> DataFrame:
    """Wide payment rows; keeps the payment ``ts``."""
    return join_payments(payments, wide, after).select(*PAYMENT_WIDE_COLUMNS, F.col("payment_ts").alias("ts"))
