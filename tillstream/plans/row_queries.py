"""Queries on rows: projections, scalars, JSON, change records, logs, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillstream.functions import text as t
from tillstream.functions import times
from tillstream.operators import changes, logs
from tillstream.operators.joins import coalesce_merge as merge_rows
from tillstream.operators.joins import tag_union
from tillstream.plans import bindings as b
from tillstream.schemas import ADS_CLICK, APPRAISE, ROUTE
from tillstream.session import scratch
from tillstream.sinks.connectors import as_messages
from tillstream.sources.files import access_log, broken_lines, delimited, rows, text_lines


def access_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    log = access_log(b.access_lines(spark, sf))
    return log.withColumn("ts", times.text(F.col("ts")))


def supplier_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change records of suppliers: a third creations, a third updates, a third deletes."""
    s = b.table(spark, sf, "supplier")
    row = F.struct(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name",
                   b.money("s_acctbal").cast("string").alias("s_acctbal"))
    n = F.col("s_suppkey") % 3
    op = F.when(n == 0, "create").when(n == 1, "update").otherwise("delete")
    record = F.to_json(F.struct(F.when(n != 0, row).alias("before"), F.when(n != 2, row).alias("after"), op.alias("op")))
    return s.select(F.col("s_suppkey").alias("id"), F.lit("binlog.shop.supplier").alias("topic"), record.alias("value"))


def part_changes(spark: SparkSession, sf: str) -> DataFrame:
    p = b.table(spark, sf, "part")
    row = F.struct(F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", "p_brand", "p_type")
    record = F.to_json(F.struct(row.alias("after"), F.lit("create").alias("op")))
    return p.select(F.col("p_partkey").alias("id"), F.lit("binlog.shop.part").alias("topic"), record.alias("value"))


def customer_changes(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer")
    record = F.to_json(F.struct(F.struct("c_name").alias("after"), F.lit("create").alias("op")))
    return c.select(F.col("c_custkey").alias("id"), F.lit("binlog.shop.customer").alias("topic"), record.alias("value"))


def cdc_normalize(spark: SparkSession, sf: str) -> DataFrame:
    out = changes.with_data(changes.normalize_changes(supplier_changes(spark, sf), "topic", "value"))
    return out.select("id", "database", "table", F.to_json("data").alias("data"),
                      F.to_json("before-data").alias("before_data"), "type")


# Version, and the route itself; customers have none, so their changes drop out.
ROUTES = [
    ("supplier", "insert", "kafka", "dwd_supplier_old", "s_suppkey", None, None, 1),
    ("supplier", "insert", "hbase", "dim_supplier", "s_suppkey,s_name", "s_suppkey", None, 2),
    ("supplier", "update", "hbase", "dim_supplier", "s_suppkey,s_name", "s_suppkey", None, 1),
    ("part", "insert", "kafka", "dwd_part", "p_partkey,p_brand", None, None, 1),
]


def dynamic_route(spark: SparkSession, sf: str) -> DataFrame:
    every = supplier_changes(spark, sf).unionByName(part_changes(spark, sf)).unionByName(customer_changes(spark, sf))
    config = rows(spark, ROUTES, StructType([*ROUTE.fields, StructField("version", IntegerType())]))
    routes = changes.active_routes(config, "version")
    out = changes.route(changes.with_data(changes.normalize_changes(every, "topic", "value")), routes)
    return out.select("id", "table", "type", "sink_type", "sink_table", F.to_json("data").alias("data"))


def snake_to_camel(spark: SparkSession, sf: str) -> DataFrame:
    return t.rename_camel(b.table(spark, sf, "supplier"))


def rows_to_json(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return as_messages(c, key="c_custkey")


def keyed_doc_upsert(spark: SparkSession, sf: str) -> DataFrame:
    e = b.events(spark, sf).select("user_id", "event_id", "event_type", b.k().alias("k"))
    return changes.latest_documents(e, "user_id", ["event_id"])


def dim_upsert(spark: SparkSession, sf: str) -> DataFrame:
    base = b.table(spark, sf, "supplier").select("s_suppkey", "s_name")

    def renamed(every: int, suffix: str, seq: int) -> DataFrame:
        return base.where(F.col("s_suppkey") % every == 0).select(
            "s_suppkey", F.concat("s_name", F.lit(suffix)).alias("s_name"), F.lit(seq).cast("long").alias("seq"))

    changed = renamed(7, " (new)", 1).unionByName(renamed(14, " (newer)", 2))
    return changes.upserted(base, changed, ["s_suppkey"], "seq")


def _numbers(spark: SparkSession, sf: str) -> DataFrame:
    return b.events(spark, sf).select("event_id", b.k().alias("k"))


def map_square(spark: SparkSession, sf: str) -> DataFrame:
    return _numbers(spark, sf).withColumn("sq", F.col("k") * F.col("k"))


def partition_map(spark: SparkSession, sf: str) -> DataFrame:
    """Set up once per task, then work on Arrow batches."""

    def square(batches):
        power = 2
        for pdf in batches:
            yield pdf.assign(sq=pdf["k"] ** power)

    return _numbers(spark, sf).mapInPandas(square, "event_id long, k long, sq long")


def flatmap_powers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    return _numbers(spark, sf).select("event_id", F.explode(F.array(k * k, k * k * k)).alias("power"))


def filter_even(spark: SparkSession, sf: str) -> DataFrame:
    return _numbers(spark, sf).where(F.col("k") % 2 == 0)


def key_by_parity(spark: SparkSession, sf: str) -> DataFrame:
    parity = F.when(F.col("k") % 2 == 0, "even").otherwise("odd").alias("parity")
    return _numbers(spark, sf).groupBy(parity).agg(F.count(F.lit(1)).alias("n"))


def keyed_project(spark: SparkSession, sf: str) -> DataFrame:
    return b.sensors(spark, sf).select("seq", F.concat(F.lit("key="), F.col("id").cast("string")).alias("key"), "vc")


def shuffle_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Rows spread evenly and anew; the row set stays the same."""
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return o.repartition(F.col("o_orderkey"))


def log_dirty_split(spark: SparkSession, sf: str) -> DataFrame:
    parsed = logs.parse_log(b.log_lines(spark, sf), "line")
    return parsed.groupBy(F.col("dirty").cast("long").alias("dirty")).agg(F.count(F.lit(1)).alias("n"))


def log_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per class from one parse; displays are counted off their pages."""
    parsed = logs.parse_log(b.log_lines(spark, sf), "line")
    kind = F.when(F.col("dirty"), "dirty").when(logs.is_start(), "start").otherwise("page")
    shown = F.when(kind == "page", F.greatest(F.coalesce(F.size("displays"), F.lit(0)), F.lit(0))).otherwise(0)
    counted = parsed.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(shown).alias("_d"))
    each = F.when(F.col("kind") == "page", F.array(F.struct(F.lit("page").alias("kind"), F.col("n")),
                                                  F.struct(F.lit("display").alias("kind"), F.col("_d").alias("n"))))
    return counted.select(F.explode(each.otherwise(F.array(F.struct("kind", "n")))).alias("c")).select("c.*")


def log_display_explode(spark: SparkSession, sf: str) -> DataFrame:
    shown = logs.displays(b.log_rows(spark, sf))
    return shown.select("event_id", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                        F.col("display.item").alias("item"), "ts")


def order_derive(spark: SparkSession, sf: str) -> DataFrame:
    o = b.table(spark, sf, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in times.create_parts(F.col("o_orderdate")).items()])


def coalesce_merge(spark: SparkSession, sf: str) -> DataFrame:
    """All orders, those that are pending without a status, and all numbers that were shipped."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    holes = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", status.alias("o_orderstatus"))
    other = b.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("o_custkey")).withColumn("o_orderstatus", F.lit("X"))
    return merge_rows(holes, other, "o_orderkey", ["o_custkey", "o_orderstatus"])


def coalesce_merge_all(spark: SparkSession, sf: str) -> DataFrame:
    """Whole tables: customers' balances where they are positive, else zero; all users of events besides."""
    left = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, b.money("c_acctbal")).alias("balance"), F.col("c_mktsegment").alias("segment"))
    right = b.events(spark, sf).select(F.col("user_id").alias("id")).distinct().select(
        "id", F.lit(0).cast("decimal(18,2)").alias("balance"), F.lit("none").alias("segment"))
    return merge_rows(left, right, "id", ["balance", "segment"])


def union_all(spark: SparkSession, sf: str) -> DataFrame:
    ids = [b.table(spark, sf, n).select(F.col(c).alias("id"))
           for n, c in (("supplier", "s_suppkey"), ("part", "p_partkey"), ("customer", "c_custkey"))]
    return ids[0].union(ids[1]).union(ids[2])


def connect_tagged(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    p = b.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand"))
    return tag_union(customer=c, part=p).select("source", "id", "name", "c_mktsegment", "p_brand")


def event_time_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh record has a time text nobody can read."""
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("not a time")).otherwise(times.text(F.col("ts") + F.expr("INTERVAL 1 DAY")))
    at = times.event_time(F.col("raw"), F.col("ts"))
    return b.events(spark, sf).withColumn("raw", raw).select("event_id", times.text(at).alias("event_time"))


def scalar_string(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer")
    parts = F.split("c_name", "#")
    return c.select("c_custkey", parts[0].alias("head"), parts[1].alias("tail"),
                    F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("joined"),
                    F.array_join(F.array(F.lit("a"), "c_mktsegment"), ",").alias("listed"),
                    F.lower("c_mktsegment").alias("lowered"),
                    (F.col("c_mktsegment") == "BUILDING").cast("long").alias("building"),
                    t.is_empty(F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name"))).cast("long").alias("empty"))


def scalar_date(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    ms = F.unix_millis(ts.cast("timestamp"))
    return b.events(spark, sf).select(
        "event_id", times.text_to_epoch_ms(times.text(ts), "+08:00").alias("parsed_ms"),
        times.epoch_ms_to_text(ms, "+08:00").alias("local_text"),
        times.text(times.epoch_ms_to_ts(ms), "yyyy-MM-dd").alias("utc_day"),
        times.text(times.next_midnight(ts, "+08:00")).alias("next_midnight"),
        F.from_unixtime(F.floor(ms / 1000)).alias("unix_text"))


def scalar_math(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    return _numbers(spark, sf).select("event_id", (k * k).alias("product"), (k % 7).alias("modulo"),
                                      F.expr("k DIV 7").alias("quotient"))


def age_365(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit(b.AS_OF)
    user = b.dims(spark, sf).user
    return user.select("id", times.age_in_years(F.col("birthday"), as_of).alias("age"))


def json_access(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.from_json("props", "k long")
    return b.events(spark, sf).select("event_id", doc["k"].alias("k_long"),
                                      F.get_json_object("props", "$.k").alias("k_text"),
                                      doc["k"].cast("decimal(18,2)").alias("k_decimal"))


def json_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.from_json("props", "k long").withField("k", F.lit(0).cast("long")).withField("user", F.col("user_id"))
    return b.events(spark, sf).select("event_id", F.to_json(doc).alias("props"))


def good_comment_flag(spark: SparkSession, sf: str) -> DataFrame:
    appraise = F.concat(F.lit("120"), (F.col("k") % 4 + 1).cast("string"))
    return _numbers(spark, sf).select("event_id", appraise.alias("appraise"),
                                      t.code_flag(appraise, APPRAISE["good"]).alias("good"))


def _written(df: DataFrame, kind: str, **options: str) -> str:
    """Rows written as files to the shared folder."""
    path = scratch(df.sparkSession, kind)
    df.write.format(kind).options(**options).save(path)
    return path


def file_text_words(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts over text files of the part names, one line each."""
    path = _written(b.table(spark, sf, "part").select(F.col("p_name").alias("value")), "text")
    words = text_lines(spark, path).select(F.explode(F.split("value", " ")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def file_csv_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Advert clicks read from delimited files."""
    clicks = b.events(spark, sf).select("user_id", (b.k() % 10).alias("ad_id"), F.lit("p").alias("province"), F.lit("c").alias("city"),
                                        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"))
    path = _written(clicks, "csv")
    return delimited(spark, path, ADS_CLICK).groupBy("ad_id").agg(F.count(F.lit(1)).alias("clicks"), F.max("ts").alias("latest"))


def access_log_broken(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the access log that lack fields, among whole ones: every eleventh is cut off."""
    cut = F.when(F.col("event_id") % 11 == 0, F.substring_index("value", " ", 4)).otherwise(F.col("value"))
    lines = b.access_lines(spark, sf).withColumn("event_id", F.split("value", " ")[0].cast("long"))
    return broken_lines(lines.select("event_id", cut.alias("value"))).select("event_id", F.size(F.split("value", " ")).alias("fields"))


def keyword_explode_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the users' turns of conversations with their counts."""
    turns = b.table(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    return t.explode_words(turns, "text").groupBy("conv_id", "turn", "word").agg(F.count(F.lit(1)).alias("n"))


def keyword_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document with their counts."""
    return t.explode_words(b.documents(spark, sf), "text").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, b.Query] = {f.__name__: f for f in (
    access_log_parse, cdc_normalize, dynamic_route, snake_to_camel, rows_to_json, keyed_doc_upsert, dim_upsert,
    map_square, partition_map, flatmap_powers, filter_even, key_by_parity, keyed_project, shuffle_identity,
    log_dirty_split, log_split_counts, log_display_explode, order_derive, coalesce_merge, coalesce_merge_all, union_all, connect_tagged,
    event_time_fallback, scalar_string, scalar_date, scalar_math, age_365, json_access, json_rebuild,
    good_comment_flag, keyword_explode, keyword_explode_turns, file_text_words, file_csv_clicks, access_log_broken)}

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TEXT = "'%Y-%m-%d %H:%M:%S'"
_SUPPLIER = """'{"s_suppkey":"' || s_suppkey || '","s_name":"' || s_name || '","s_acctbal":"' || CAST(s_acctbal AS DECIMAL(18,2)) || '"}'"""

ORACLE: dict[str, str] = {
    "access_log_parse": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, {_TEXT}) AS ts, 'GET' AS method,
               '/' || event_type || '/' || {_K} AS url FROM events""",
    "cdc_normalize": f"""
        SELECT s_suppkey AS id, 'shop' AS "database", 'supplier' AS "table", {_SUPPLIER} AS data,
               CASE WHEN s_suppkey % 3 = 0 THEN '{{}}' ELSE {_SUPPLIER} END AS before_data,
               CASE WHEN s_suppkey % 3 = 0 THEN 'insert' ELSE 'update' END AS type
        FROM supplier WHERE s_suppkey % 3 <> 2""",
    "dynamic_route": """
        SELECT s_suppkey AS id, 'supplier' AS "table", CASE WHEN s_suppkey % 3 = 0 THEN 'insert' ELSE 'update' END AS type,
               'hbase' AS sink_type, 'dim_supplier' AS sink_table,
               '{"s_suppkey":"' || s_suppkey || '","s_name":"' || s_name || '"}' AS data
        FROM supplier WHERE s_suppkey % 3 <> 2
        UNION ALL
        SELECT p_partkey, 'part', 'insert', 'kafka', 'dwd_part',
               '{"p_partkey":"' || p_partkey || '","p_brand":"' || p_brand || '"}' FROM part""",
    "snake_to_camel": """
        SELECT s_suppkey AS "sSuppkey", s_name AS "sName", s_nationkey AS "sNationkey", s_acctbal AS "sAcctbal" FROM supplier""",
    "rows_to_json": """
        SELECT CAST(c_custkey AS VARCHAR) AS key,
               '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
               || ',"c_mktsegment":"' || c_mktsegment || '"}' AS value FROM customer""",
    "keyed_doc_upsert": f"""
        SELECT CAST(user_id AS VARCHAR) AS id,
               '{{"user_id":' || user_id || ',"event_id":' || event_id || ',"event_type":"' || event_type
               || '","k":' || {_K} || '}}' AS doc
        FROM events WHERE event_id IN (SELECT max(event_id) FROM events GROUP BY user_id)""",
    "dim_upsert": """
        SELECT s_suppkey, s_name || CASE WHEN s_suppkey % 14 = 0 THEN ' (newer)' WHEN s_suppkey % 7 = 0 THEN ' (new)'
               ELSE '' END AS s_name FROM supplier""",
    "map_square": f"SELECT event_id, {_K} AS k, {_K} * {_K} AS sq FROM events",
    "partition_map": f"SELECT event_id, {_K} AS k, {_K} * {_K} AS sq FROM events",
    "flatmap_powers": f"""
        SELECT event_id, {_K} * {_K} AS power FROM events
        UNION ALL SELECT event_id, {_K} * {_K} * {_K} FROM events""",
    "filter_even": f"SELECT event_id, {_K} AS k FROM events WHERE {_K} % 2 = 0",
    "key_by_parity": f"""
        SELECT CASE WHEN {_K} % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, count(*) AS n FROM events GROUP BY 1""",
    "keyed_project": """
        SELECT event_id AS seq, 'key=' || user_id AS key, CAST(round(value * 100) AS BIGINT) AS vc FROM events""",
    "shuffle_identity": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "log_dirty_split": """
        SELECT CAST(event_id % 97 = 0 AS BIGINT) AS dirty, count(*) AS n FROM events GROUP BY 1""",
    "log_split_counts": """
        WITH c AS (SELECT CASE WHEN event_id % 97 = 0 THEN 'dirty' WHEN event_type = 'error' THEN 'start' ELSE 'page' END AS kind,
                          event_type FROM events)
        SELECT kind, count(*) AS n FROM c GROUP BY kind
        UNION ALL SELECT 'display', 2 * count(*) FROM c WHERE kind = 'page' AND event_type = 'view'""",
    "log_display_explode": f"""
        WITH v AS (SELECT *, {_K} AS k FROM events WHERE event_type = 'view' AND event_id % 97 <> 0)
        SELECT event_id, CAST(user_id AS VARCHAR) AS mid, 'good_detail' AS page_id, CAST(k AS VARCHAR) AS item,
               epoch_us(ts) // 1000 AS ts FROM v
        UNION ALL SELECT event_id, CAST(user_id AS VARCHAR), 'good_detail', CAST((k + 1) % 100 AS VARCHAR), epoch_us(ts) // 1000 FROM v""",
    "order_derive": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
               epoch_ms(o_orderdate) AS create_ts FROM orders""",
    "coalesce_merge": """
        WITH l AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus FROM orders),
             r AS (SELECT l_orderkey AS o_orderkey, min(l_suppkey) AS o_custkey, 'X' AS o_orderstatus FROM lineitem GROUP BY 1)
        SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey, coalesce(l.o_custkey, r.o_custkey) AS o_custkey,
               coalesce(l.o_orderstatus, r.o_orderstatus) AS o_orderstatus
        FROM l FULL JOIN r ON l.o_orderkey = r.o_orderkey""",
    "coalesce_merge_all": """
        WITH l AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS balance, c_mktsegment AS segment FROM customer),
             r AS (SELECT DISTINCT user_id AS id, CAST(0 AS DECIMAL(18,2)) AS balance, 'none' AS segment FROM events)
        SELECT coalesce(l.id, r.id) AS id, coalesce(l.balance, r.balance) AS balance, coalesce(l.segment, r.segment) AS segment
        FROM l FULL JOIN r ON l.id = r.id""",
    "union_all": """
        SELECT s_suppkey AS id FROM supplier UNION ALL SELECT p_partkey FROM part UNION ALL SELECT c_custkey FROM customer""",
    "connect_tagged": """
        SELECT 'customer' AS source, c_custkey AS id, c_name AS name, c_mktsegment, CAST(NULL AS VARCHAR) AS p_brand FROM customer
        UNION ALL SELECT 'part', p_partkey, NULL, NULL, p_brand FROM part""",
    "event_time_fallback": f"""
        SELECT event_id, strftime(CASE WHEN event_id % 7 = 0 THEN ts ELSE ts + INTERVAL 1 DAY END, {_TEXT}) AS event_time
        FROM events""",
    "scalar_string": """
        SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 2) AS tail,
               c_mktsegment || '_' || c_nationkey AS joined, 'a,' || c_mktsegment AS listed, lower(c_mktsegment) AS lowered,
               CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS building, CAST(c_custkey % 3 = 0 AS BIGINT) AS empty
        FROM customer""",
    "scalar_date": f"""
        SELECT event_id, epoch_ms(date_trunc('second', ts) - INTERVAL 8 HOUR) AS parsed_ms,
               strftime(ts + INTERVAL 8 HOUR, {_TEXT}) AS local_text, strftime(ts, '%Y-%m-%d') AS utc_day,
               strftime(CAST(date_trunc('day', ts + INTERVAL 8 HOUR) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 8 HOUR, {_TEXT}) AS next_midnight,
               strftime(ts, {_TEXT}) AS unix_text
        FROM events""",
    "scalar_math": f"""
        SELECT event_id, {_K} * {_K} AS product, {_K} % 7 AS modulo, {_K} // 7 AS quotient FROM events""",
    "age_365": """
        SELECT c_custkey AS id,
               CAST(date_diff('day', DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), DATE '2024-01-01') // 365 AS INTEGER) AS age
        FROM customer""",
    "json_access": f"""
        SELECT event_id, {_K} AS k_long, json_extract_string(props, '$.k') AS k_text, CAST({_K} AS DECIMAL(18,2)) AS k_decimal
        FROM events""",
    "json_rebuild": """
        SELECT event_id, '{"k":0,"user":' || user_id || '}' AS props FROM events""",
    "good_comment_flag": f"""
        SELECT event_id, '120' || ({_K} % 4 + 1) AS appraise, CAST({_K} % 4 = 0 AS BIGINT) AS good FROM events""",
    "keyword_explode_turns": r"""
        SELECT conv_id, turn, word, count(*) AS n
        FROM (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '\p{L}+|\p{N}+')) AS word FROM conversations WHERE role = 'user')
        GROUP BY ALL""",
    "file_text_words": """
        SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> '' GROUP BY word""",
    "file_csv_clicks": f"""
        SELECT {_K} % 10 AS ad_id, count(*) AS clicks, max(CAST(floor(epoch(ts)) AS BIGINT)) AS latest FROM events GROUP BY ALL""",
    "access_log_broken": "SELECT event_id, 4 AS fields FROM events WHERE event_id % 11 = 0",
    "keyword_explode": r"""
        SELECT doc_id, word, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+|\p{N}+')) AS word FROM documents)
        GROUP BY doc_id, word""",
}
