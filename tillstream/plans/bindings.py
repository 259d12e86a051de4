"""The shop's inputs derived from the test tables.

The tables carry no application log, change log or payments, so these are derived from
``events``, ``orders`` and ``lineitem`` by plain expressions and grow with them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.times import text
from tillstream.operators import logs
from tillstream.operators.joins import lookup
from tillstream.plans.wide import Dims
from tillstream.schemas import MONEY

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 1)
ORDER_WITHIN = timedelta(days=5)
PAY_AFTER = timedelta(minutes=15)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def k() -> Column:
    """The number in an event's properties."""
    return F.get_json_object("props", "$.k").try_cast("long")


def money(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def sensors(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor readings: id, ts (epoch ms), vc, and the event number as sequence."""
    return events(spark, sf).select(F.col("user_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
                                    F.round(F.col("value") * 100).cast("long").alias("vc"),
                                    F.col("event_id").alias("seq"), F.col("ts").alias("at"))


def behaviors(spark: SparkSession, sf: str) -> DataFrame:
    """User behaviour: views are page views of item k in category k mod 10."""
    kind = F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type"))
    return events(spark, sf).select("user_id", k().alias("item_id"), (k() % 10).cast("int").alias("category_id"),
                                    kind.alias("behavior"), "ts", "event_id")


def ad_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Advert clicks with the province of the user."""
    clicks = events(spark, sf).select("user_id", (k() % 10).alias("ad_id"), "ts", "event_id")
    users = table(spark, sf, "customer")
    out = lookup(clicks, users, "user_id", "c_custkey", {"_nation": "c_nationkey"}, "inner")
    return lookup(out, table(spark, sf, "nation"), "_nation", "n_nationkey", {"province": "n_name"}, "inner",
                  fixed_size=True).drop("_nation")


def logins(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "signup", "success")
    return events(spark, sf).select("user_id", kind.alias("kind"), "ts", "event_id").where(F.col("kind").isNotNull())


def create_pay_events(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "create").when(F.col("event_type") == "purchase", "pay")
    return events(spark, sf).select("user_id", kind.alias("kind"), "ts", "event_id").where(F.col("kind").isNotNull())


def order_states(spark: SparkSession, sf: str, created_if: str = "o_orderstatus <> 'P'") -> DataFrame:
    """Creations of orders that are not pending, or as told, and one payment per ordered number: its first shipping."""
    created = table(spark, sf, "orders").where(created_if).select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("kind"), F.col("o_orderdate").alias("ts"))
    paid = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("ts")).select("order_id", F.lit("pay").alias("kind"), "ts")
    return created.unionByName(paid)


def access_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Web server lines; the type of event and k make the address."""
    at = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    url = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), k().cast("string"))
    return events(spark, sf).select(F.concat_ws(" ", F.col("event_id").cast("string"), F.lit("-"), F.lit("-"), at,
                                                F.lit("+0000"), F.lit("GET"), url).alias("value"))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Application log lines; every 97th is cut off and cannot be parsed."""
    e = events(spark, sf).withColumn("k", k())
    kind = F.col("event_type")

    def by_type(**texts: Column) -> Column:
        out = None
        for t, c in texts.items():
            out = F.when(kind == t, c) if out is None else out.when(kind == t, c)
        return out

    ks = F.col("k").cast("string")
    common = F.struct(F.col("user_id").cast("string").alias("mid"), F.concat(F.lit("v"), (F.col("k") % 3).cast("string")).alias("vc"),
                      F.concat(F.lit("ch"), (F.col("k") % 4).cast("string")).alias("ch"),
                      F.concat(F.lit("ar"), (F.col("user_id") % 7).cast("string")).alias("ar"),
                      F.when(F.col("k") % 2 == 0, "1").otherwise("0").alias("is_new"))
    word = F.concat(F.lit("Red shoe "), ks, F.lit(" shop"), (F.col("k") % 10).cast("string"))
    page = F.when(kind != "error", F.struct(
        by_type(view=F.lit("good_detail"), click=F.lit("good_list"), purchase=F.lit("trade"), signup=F.lit("home")).alias("page_id"),
        by_type(view=F.lit("home"), click=F.lit("search"), purchase=F.lit("good_detail"), signup=F.lit("")).alias("last_page_id"),
        by_type(view=ks, click=word, purchase=ks).alias("item"),
        by_type(view=F.lit("sku_id"), click=F.lit("keyword"), purchase=F.lit("sku_id")).alias("item_type"),
        (F.col("k") * 100).alias("during_time")))

    def shown(item: Column) -> Column:
        return F.struct(item.cast("string").alias("item"), F.lit("sku_id").alias("item_type"))

    displays = F.when(kind == "view", F.array(shown(F.col("k")), shown((F.col("k") + 1) % 100)))
    start = F.when(kind == "error", F.struct(F.lit("icon").alias("entry")))
    line = F.to_json(F.struct(common.alias("common"), start.alias("start"), page.alias("page"), displays.alias("displays"),
                              F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")))
    text_line = F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 40)).otherwise(line)
    return e.select("event_id", F.explode(F.array(text_line)).alias("line"))


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The valid log rows with their event number and time ``at``."""
    good = logs.valid(logs.parse_log(log_lines(spark, sf), "line")).drop("line")
    return good.withColumn("at", F.timestamp_millis("ts"))


def fixed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page rows after the new-visitor correction."""
    return logs.pages(logs.fix_new_visitors(log_rows(spark, sf), ["event_id"]))


def order_info(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    number = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "1004").when(F.col("o_orderstatus") == "O", "1002").otherwise("1001")
    total, activity, coupon = money("o_totalprice"), money(number % 10), money(number % 5)
    return o.select(
        number.alias("id"), (F.col("o_custkey") % 25).alias("province_id"), status.alias("order_status"),
        F.col("o_custkey").alias("user_id"), total.alias("total_amount"), activity.alias("activity_reduce_amount"),
        coupon.alias("coupon_reduce_amount"), money(total + activity + coupon).alias("original_total_amount"),
        money(F.lit(5)).alias("feight_fee"),
        text(F.col("o_orderdate") + F.expr("INTERVAL 15 MINUTES")).alias("expire_time"),
        text(F.col("o_orderdate")).alias("create_time"),
        text(F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("operate_time"),
        F.col("o_orderdate").alias("ts"))


def order_detail(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "lineitem")
    return d.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        text(F.col("l_shipdate")).alias("create_time"), money("l_extendedprice").alias("split_total_amount"),
        money("l_tax").alias("split_activity_amount"), money("l_discount").alias("split_coupon_amount"),
        F.col("l_shipdate").alias("ts"))


def payment_info(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that are not pending are paid up to half an hour after their creation."""
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    number = F.col("o_orderkey")
    at = F.col("o_orderdate") + F.make_dt_interval(mins=(number % 30).cast("int"))
    return o.select(
        (number + 1_000_000).alias("id"), number.alias("order_id"), F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"), F.concat(F.lit("order "), number.cast("string")).alias("subject"),
        F.when(number % 2 == 0, "1101").otherwise("1102").alias("payment_type"), text(at).alias("create_time"),
        text(at + F.expr("INTERVAL 10 SECONDS")).alias("callback_time"), at.alias("ts"))


def _spu_id() -> Column:
    return F.conv(F.substring(F.md5("p_type"), 1, 15), 16, 10).cast("long")


def dims(spark: SparkSession, sf: str) -> Dims:
    c, n, p, r = (table(spark, sf, t) for t in ("customer", "nation", "part", "region"))
    code = F.col("n_nationkey").cast("string")
    return Dims(
        user=c.select(F.col("c_custkey").alias("id"),
                      F.date_add(F.lit(date(1950, 1, 1)), (F.col("c_custkey") % 15000).cast("int")).alias("birthday"),
                      F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender")),
        province=n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
                          F.concat(F.lit("A"), code).alias("area_code"), F.concat(F.lit("ISO-"), code).alias("iso_code"),
                          F.concat(F.lit("CN-"), code).alias("iso_3166_2")),
        sku=p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"), money("p_retailprice").alias("price"),
                     _spu_id().alias("spu_id"), F.substring("p_brand", 7, 9).cast("long").alias("tm_id"),
                     (F.col("p_partkey") % 5).alias("category3_id")),
        spu=p.select("p_type").distinct().select(_spu_id().alias("id"), F.col("p_type").alias("spu_name")),
        trademark=p.select("p_brand").distinct().select(F.substring("p_brand", 7, 9).cast("long").alias("id"),
                                                        F.col("p_brand").alias("tm_name")),
        category3=r.select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")),
    )
