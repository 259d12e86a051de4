"""Cleaning and splitting of the raw application log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.text import is_empty
from tillstream.operators.ordered import HotKeys, SplitPolicy
from tillstream.operators.patterns import correct_new_flag
from tillstream.schemas import APP_LOG

BROKEN = "_broken"


def parse_log(df: DataFrame, line: str, schema: T.StructType = APP_LOG) -> DataFrame:
    """Parse a JSON line into the columns of ``schema``; ``dirty`` tells lines that are no JSON object.

    The record comes out of a generator (``inline``): Spark neither repeats the parse for each
    column used nor pushes a copy of it into filters, so every line is parsed exactly once.
    """
    full = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    parsed = F.from_json(line, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    out = df.select("*", F.inline(F.array(parsed)))
    blank = F.coalesce(F.length(F.trim(line)) == 0, F.lit(True))
    return out.withColumn("dirty", blank | F.col(BROKEN).isNotNull()).drop(BROKEN)


def valid(parsed: DataFrame) -> DataFrame:
    """The lines that parsed."""
    return parsed.where(~F.col("dirty")).drop("dirty")


def dirty(parsed: DataFrame, line: str) -> DataFrame:
    """The text of the lines that did not parse."""
    return parsed.where("dirty").select(line)


def is_start() -> Column:
    """A log row with a non-empty start object is a start row; any other row is a page row."""
    return F.col("start").isNotNull() & (F.size("start") > 0)


def starts(log: DataFrame) -> DataFrame:
    return log.where(is_start())


def pages(log: DataFrame) -> DataFrame:
    return log.where(~is_start())


def displays(log: DataFrame) -> DataFrame:
    """One row per displayed item of a page, with the page's common fields and time."""
    rest = [c for c in log.columns if c not in ("displays", "start")]
    return pages(log).select(*rest, F.explode("displays").alias("display"))


def fix_new_visitors(log: DataFrame, ties: Sequence[str], policy: SplitPolicy | None = None,
                     hot: HotKeys | None = None) -> DataFrame:
    """Correct ``common.is_new``: only a device's first row marked new keeps the mark."""
    flat = log.withColumns({"_mid": F.col("common.mid"), "_new": F.col("common.is_new"),
                            "_at": F.timestamp_millis("ts")})
    fixed = correct_new_flag(flat, "_mid", "_new", "_at", ties, policy, hot)
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("_new"))).drop("_mid", "_new", "_at")


def is_entry() -> Column:
    """A page nobody navigated to from another page."""
    return is_empty(F.col("page.last_page_id"))


def product_actions(log: DataFrame) -> DataFrame:
    """Clicks on product pages and displays of products, one row per action (over page rows).

    A page's actions come out of one list, so the log is read once for both kinds. An item that
    is no number gives an action without a product.
    """
    def action(item: Column, click: int) -> Column:
        return F.struct(item.try_cast("long").alias("sku_id"), F.lit(click).cast("long").alias("click_ct"),
                        F.lit(1 - click).cast("long").alias("display_ct"))

    opened = (F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")
    clicks = F.when(opened, F.array(action(F.col("page.item"), 1)))
    shown = F.transform(F.filter("displays", lambda d: d["item_type"] == "sku_id"), lambda d: action(d["item"], 0))
    none = F.array().cast("array<struct<sku_id:bigint,click_ct:bigint,display_ct:bigint>>")
    actions = F.concat(F.coalesce(clicks, none), F.coalesce(shown, none))
    return log.select("ts", F.explode(actions).alias("a")).select("a.*", "ts")
