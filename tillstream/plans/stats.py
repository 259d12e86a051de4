"""Statistics over event-time windows: visitors, products, provinces, keywords."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.text import code_flag, explode_words
from tillstream.functions.times import epoch_micros, interval_text, local_day, micros
from tillstream.operators.logs import is_entry, is_start, product_actions
from tillstream.operators.ordered import HotKeys, SplitPolicy, following, previous, running, with_ordered
from tillstream.operators.windows import stamp, tumbling
from tillstream.plans.wide import Dims, add_sku_chain
from tillstream.schemas import APPRAISE, MONEY, PRODUCT_STATS_COLUMNS, VISITOR_STATS_COLUMNS

TEN_SECONDS = timedelta(seconds=10)
VISITOR_DIMS = ["vc", "ch", "ar", "is_new"]
VISITOR_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _long(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")


def visitor_rows(pages: DataFrame, uniques: DataFrame, jumps: DataFrame) -> DataFrame:
    """Page, unique-visit and bounce rows as one stream of measures (for streams or separate inputs)."""
    dims = [F.col(f"common.{d}").alias(d) for d in VISITOR_DIMS]

    def part(df: DataFrame, **set_to) -> DataFrame:
        return df.select(*dims, "at", *[_long(set_to.get(m, 0)).alias(m) for m in VISITOR_SUMS])

    entry = F.when(is_entry(), 1).otherwise(0)
    pv = part(pages, pv_ct=1, sv_ct=entry, dur_sum=F.coalesce("page.during_time", F.lit(0)))
    return pv.unionByName(part(uniques, uv_ct=1)).unionByName(part(jumps, uj_ct=1))


def visitor_rows_one_pass(log: DataFrame, ties: Sequence[str], within: timedelta, zone: str = "UTC",
                          policy: SplitPolicy | None = None, hot: HotKeys | None = None) -> DataFrame:
    """The same measures straight from valid log rows, start rows included, in one ordered pass.

    The corrected new-visitor flag is a running count over all rows of a device; unique visits
    and bounces are read off the page rows next to each page. The log is parsed and shuffled
    once, instead of once for the correction and once for each of the three inputs.
    """
    page = ~is_start()
    flat = log.withColumns({"_mid": F.col("common.mid"), "_entry": is_entry(), "_page": page,
                            "_new": F.when(F.col("common.is_new") == "1", 1).otherwise(0).cast("long")})
    seen = with_ordered(flat, ["_mid"], "at", ties, policy, hot,
                        _flagged=running("sum", F.col("_new")),
                        _before=previous(F.col("at"), F.col("_page")),
                        _after=following(F.struct("at", "_entry"), F.col("_page"))).where("_page")
    new_day = F.col("_before").isNull() | (local_day(F.col("_before"), zone) < local_day(F.col("at"), zone))
    gap = epoch_micros(F.col("_after.at")) - epoch_micros(F.col("at"))
    alone = F.col("_after").isNull() | (gap >= micros(within)) | F.col("_after._entry")
    is_new = F.when((F.col("_new") == 1) & (F.col("_flagged") > 1), "0").otherwise(F.col("common.is_new"))
    return seen.select(
        *[F.col(f"common.{d}").alias(d) for d in VISITOR_DIMS if d != "is_new"], is_new.alias("is_new"), "at",
        _long(F.when(new_day, 1).otherwise(0)).alias("uv_ct"),
        _long(1).alias("pv_ct"),
        _long(F.when(F.col("_entry"), 1).otherwise(0)).alias("sv_ct"),
        _long(F.when(F.col("_entry") & alone, 1).otherwise(0)).alias("uj_ct"),
        F.coalesce("page.during_time", F.lit(0)).alias("dur_sum"),
    )


def visitor_stats(rows: DataFrame, size: timedelta = TEN_SECONDS) -> DataFrame:
    """Five sums per version, channel, area, new-visitor flag and window."""
    sums = [F.sum(m).alias(m) for m in VISITOR_SUMS]
    return stamp(tumbling(rows, "at", size, VISITOR_DIMS, *sums)).select(*VISITOR_STATS_COLUMNS)


# Measures a source row can carry; absent ones count as nothing.
_COUNTS = ["click_ct", "display_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"]
_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
_ORDER_IDS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id", "refund_order_ct": "refund_order_id"}


def acts(rows: DataFrame, favor: Column, cart: Column, comment: Column, sku_num: Column, appraise: Column) -> DataFrame:
    """Favours, carts and comments that are rows of one table, in one pass: measures with sku_id and time ``at``."""
    one = _long(1)
    return rows.where(favor | cart | comment).select(
        "sku_id", "at", F.when(favor, one).alias("favor_ct"), F.when(cart, sku_num).alias("cart_ct"), F.when(comment, one).alias("comment_ct"),
        F.when(comment, code_flag(appraise, APPRAISE["good"])).alias("good_comment_ct"))


def product_rows(pages: DataFrame | None, favors: DataFrame | None, carts: DataFrame | None, orders: DataFrame, payments: DataFrame,
                 refunds: DataFrame, comments: DataFrame | None, order_amount: str = "total_amount", mixed: DataFrame | None = None) -> DataFrame:
    """Seven sources as one stream of product measures with sku_id and time ``at``.

    ``mixed`` may hold measures in place of tables of their own, such as those of ``acts``.

    Inputs: pages (log rows), favors (sku_id, at), carts (sku_id, sku_num, at), orders and
    payments (rows per order detail with order_id, amount and ts; wide rows will do, but the
    dimension columns are not needed), refunds (sku_id, order_id, refund_amount, at), comments
    (sku_id, appraise, at). ``order_amount`` names the amount an order row adds: the whole
    order's total, or its own share ``split_total_amount``.
    """
    one = _long(1)
    parts = [
        *([] if pages is None else [product_actions(pages).withColumn("at", F.timestamp_millis("ts")).drop("ts")]),
        *([] if favors is None else [favors.select("sku_id", "at", one.alias("favor_ct"))]),
        *([] if carts is None else [carts.select("sku_id", "at", F.col("sku_num").alias("cart_ct"))]),
        *([] if mixed is None else [mixed]),
        orders.select("sku_id", F.col("ts").alias("at"), F.col("sku_num").alias("order_sku_num"),
                      F.col(order_amount).alias("order_amount"), "order_id"),
        payments.select("sku_id", F.col("ts").alias("at"), F.col("total_amount").alias("payment_amount"),
                        F.col("order_id").alias("paid_order_id")),
        refunds.select("sku_id", "at", "refund_amount", F.col("order_id").alias("refund_order_id")),
        *([] if comments is None else [comments.select("sku_id", "at", one.alias("comment_ct"),
                                                       code_flag(F.col("appraise"), APPRAISE["good"]).alias("good_comment_ct"))]),
    ]
    # A time that needs no cast is left as it is, and so keeps its watermark on a stream.
    parts = [p if p.schema["at"].dataType == T.TimestampType() else p.withColumn("at", F.col("at").cast("timestamp")) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def product_sums(rows: DataFrame, size: timedelta = TEN_SECONDS) -> DataFrame:
    """Thirteen measures per product and window.

    Sums are taken per product, window and order first; an order id then counts once per
    kind. This keeps the distinct counts on plain partial aggregation: one shuffle by the
    finer key, in which a hot product is spread over its orders.
    """
    ids = list(_ORDER_IDS.values())
    id_key = F.coalesce(*ids).alias("_id")
    kinds = [F.max(F.when(F.col(i).isNotNull(), 1).otherwise(0)).alias(f"_has_{i}") for i in ids]
    sums = [F.sum(F.coalesce(c, _long(0))).alias(c) for c in _COUNTS]
    sums += [F.sum(F.coalesce(c, F.lit(0).cast(MONEY))).alias(c) for c in _AMOUNTS]
    fine = rows.groupBy(F.window("at", interval_text(size)).alias("_w"), "sku_id", id_key).agg(*sums, *kinds)
    total = [F.sum(c).alias(c) for c in [*_COUNTS, *_AMOUNTS]]
    total += [F.sum(f"_has_{i}").alias(n) for n, i in _ORDER_IDS.items()]
    out = fine.groupBy("_w", "sku_id").agg(*total)
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *[c for c in out.columns if c != "_w"])


def product_stats(rows: DataFrame, dims: Dims, size: timedelta = TEN_SECONDS) -> DataFrame:
    """Product measures per window, enriched after the aggregation, when few rows are left."""
    return product_enriched(product_sums(rows, size), dims)


def product_enriched(sums: DataFrame, dims: Dims) -> DataFrame:
    """Product sums with window texts and what the dimensions say of the product."""
    out = add_sku_chain(stamp(sums), dims, price=True, name=True)
    amounts = {a: F.col(a).cast("decimal(28,2)") for a in _AMOUNTS}
    return out.withColumns(amounts).select(*PRODUCT_STATS_COLUMNS)


# The view holds one row per order detail: order_id, province columns, total_amount, rowtime.
PROVINCE_SQL = """
    SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
           date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
           province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
           CAST(sum(total_amount) AS DECIMAL(28,2)) AS order_amount,
           count(DISTINCT order_id) AS order_count
    FROM {orders}
    GROUP BY window(rowtime, '{size}'), province_id, province_name, province_area_code,
             province_iso_code, province_3166_2_code
"""


def province_stats(spark: SparkSession, orders: DataFrame, size: timedelta = TEN_SECONDS) -> DataFrame:
    """Order amount and number of orders per province and window, in SQL."""
    sql = PROVINCE_SQL.replace("{size}", interval_text(size))
    return spark.sql(sql, orders=orders)


def province_sums(orders: DataFrame, size: timedelta = TEN_SECONDS) -> DataFrame:
    """``province_stats`` for streams, which allow no exact distinct count: rows are summed per
    order first, and an order then counts once."""
    dims = ["province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code"]
    fine = orders.groupBy(F.window("rowtime", interval_text(size)).alias("_w"), *dims, "order_id").agg(
        F.sum("total_amount").alias("order_amount"))
    out = fine.groupBy("_w", *dims).agg(F.sum("order_amount").cast("decimal(28,2)").alias("order_amount"),
                                        F.count("order_id").alias("order_count"))
    return stamp(out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *dims,
                            "order_amount", "order_count"))


def search_texts(pages: DataFrame) -> DataFrame:
    """Texts searched for: keyword items of pages reached from the search page."""
    hit = (F.col("page.item_type") == "keyword") & (F.col("page.last_page_id") == "search")
    return pages.where(hit & F.col("page.item").isNotNull()).select(F.col("page.item").alias("full_word"), "at")


def keyword_stats(texts: DataFrame, size: timedelta = TEN_SECONDS, source: str = "search") -> DataFrame:
    """How often each word is searched for per window."""
    counted = tumbling(explode_words(texts, "full_word", "keyword"), "at", size, ["keyword"],
                       F.count(F.lit(1)).alias("ct"))
    return stamp(counted).select("keyword", "ct", F.lit(source).alias("source"), "stt", "edt")
