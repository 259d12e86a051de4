"""Stream flows and sinks."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from tillstream import schemas
from tillstream.operators.joins import interval_join
from tillstream.operators.windows import sliding_direct, stamp, tumbling
from tillstream.plans import stats, wide
from tillstream.sinks import connectors as out
from tillstream.sinks.tables import DimTable, create_table, dim_schema
from tillstream.sources import connectors as src
from tillstream.sources import files
from tillstream.streaming import flows

S, M = timedelta(seconds=1), timedelta(minutes=1)
T0 = datetime(2024, 1, 1)
CLICKS = "user long, item string, ts timestamp"


def write_parts(spark, folder, schema, *parts):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return flows.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)


def at(s):
    return T0 + timedelta(seconds=s)


def finish(df, sink, tmp_path, mode="append", name="cp"):
    flows.run(df, sink, str(tmp_path / name), mode, once=True).awaitTermination(300)


def read(spark, path, *cols):
    df = spark.read.option("basePath", str(path)).parquet(str(path))
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_tumbling_stream_closes_on_watermark(spark, tmp_path):
    s = write_parts(spark, str(tmp_path / "in"), CLICKS, [(1, "a", at(1)), (2, "a", at(9)), (1, "b", at(12))],
                    [(3, "a", at(3))], [(4, "z", at(1000))])
    counted = stamp(tumbling(flows.watermarked(s, "ts", 5 * S), "ts", 10 * S, ["item"], F.count(F.lit(1)).alias("n")))
    finish(counted, flows.to_folder(str(tmp_path / "out")), tmp_path)
    # The row of second 3 is still in time: the watermark stands at second 7.
    assert read(spark, tmp_path / "out", "stt", "item", "n") == [("2024-01-01 00:00:00", "a", 3), ("2024-01-01 00:00:10", "b", 1)]


def test_ranked_windows(spark, tmp_path):
    rows = [(u, item, at(i)) for i, (u, item) in enumerate([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "c"), (6, "c"), (7, "d")])]
    s = write_parts(spark, str(tmp_path / "in"), CLICKS, rows, [(9, "z", at(1000))])
    counts = sliding_direct(flows.watermarked(s, "ts", 5 * S), "ts", 20 * S, 10 * S, ["item"], F.count(F.lit(1)).alias("n"))
    sink = flows.ranked_to_folder(str(tmp_path / "out"), ["window_end"], "n", ["item"], 2)
    finish(counts, sink, tmp_path)
    got = read(spark, tmp_path / "out", F.unix_seconds("window_end") - int((T0 - datetime(1970, 1, 1)).total_seconds()), "item", "n", "rk")
    assert got == [(10, "a", 2, 2), (10, "c", 3, 1), (20, "a", 2, 2), (20, "c", 3, 1)]


def test_late_updates_rank_the_whole_window(spark, tmp_path):
    first = [(1, "a", at(1)), (2, "a", at(2)), (3, "b", at(3))]
    late = [(4, "b", at(4)), (5, "b", at(5))]
    s = write_parts(spark, str(tmp_path / "in"), CLICKS, first, late)
    counts = tumbling(flows.watermarked(s, "ts", 5 * S, lateness=10 * S), "ts", 10 * S, ["item"], F.count(F.lit(1)).alias("n"))
    sink = flows.reranked_to_folder(str(tmp_path / "out"), ["item"], ["window_end"], "n", ["item"], 2, str(tmp_path / "open"), M, 30 * S)
    finish(counts, sink, tmp_path, "update")
    got = read(spark, tmp_path / "out", "batch", "item", "n", "rk")
    assert [r for r in got if r[0] == got[-1][0]] == [(got[-1][0], "a", 2, 2), (got[-1][0], "b", 3, 1)]


def test_interval_join_stream(spark, tmp_path):
    orders = write_parts(spark, str(tmp_path / "o"), "id long, ots timestamp", [(1, at(0)), (2, at(0))], [(3, at(1000))])
    details = write_parts(spark, str(tmp_path / "d"), "oid long, dts timestamp", [(1, at(5)), (2, at(6))], [(1, at(-5)), (3, at(999))])
    joined = interval_join(flows.watermarked(orders, "ots", 10 * S), flows.watermarked(details, "dts", 10 * S),
                           {"id": "oid"}, "ots", "dts", -5 * S, 5 * S)
    finish(joined, flows.to_folder(str(tmp_path / "out")), tmp_path)
    assert read(spark, tmp_path / "out", "id", "dts") == [(1, at(-5)), (1, at(5)), (3, at(999))]


def test_wide_rows_on_streams(spark, tmp_path):
    """Two order streams joined, then dimension lookups and a payment stream; printed as well."""
    make = {"o": (schemas.ORDER_INFO, {"id": 1, "user_id": 5, "province_id": 2, "create_time": "2024-01-01 00:00:00"}),
            "d": (schemas.ORDER_DETAIL, {"id": 10, "order_id": 1, "sku_id": 7, "sku_num": 3}),
            "p": (schemas.PAYMENT_INFO, {"id": 100, "order_id": 1, "user_id": 6})}
    seconds = {"o": 0, "d": 4, "p": 60}
    streams = {}
    for name, (schema, row) in make.items():
        full = StructType([*schema.fields, StructField("ts", TimestampType())])
        df = spark.createDataFrame([{**row, "ts": at(seconds[name])}], full)
        df.write.parquet(str(tmp_path / name))
        streams[name] = flows.watermarked(flows.parquet_stream(spark, str(tmp_path / name), full), "ts", timedelta(hours=1))
    one = spark.createDataFrame
    dims = wide.Dims(
        user=one([(5, date(2000, 1, 1), "F")], "id long, birthday date, gender string"),
        province=one([(2, "n", "a", "i", "c")], "id long, name string, area_code string, iso_code string, iso_3166_2 string"),
        sku=one([(7, "s", 1, 11, 12, 13)], "id long, sku_name string, price long, spu_id long, tm_id long, category3_id long"),
        spu=one([(11, "spu")], "id long, spu_name string"), trademark=one([(12, "tm")], "id long, tm_name string"),
        category3=one([(13, "cat")], "id long, name string"))
    orders = wide.order_wide(streams["o"], streams["d"], dims, F.lit(date(2024, 1, 1)))
    paid = wide.payment_wide(streams["p"], orders)

    def sink(df, batch_id):
        flows.to_folder(str(tmp_path / "out"))(df, batch_id)
        flows.to_console()(df.select("payment_id", "spu_name"), batch_id)

    finish(paid, sink, tmp_path)
    got = read(spark, tmp_path / "out", "payment_id", "order_id", "user_id", "user_age", "province_name", "spu_name",
               "tm_name", "category3_name", "order_create_time")
    assert got == [(100, 1, 6, 24, "n", "spu", "tm", "cat", "2024-01-01 00:00:00")]


MONEY = "decimal(18,2)"


def test_statistics_on_streams(spark, tmp_path):
    """Province and product statistics of streams equal the batch forms for closed windows."""
    dims = "province_id long, province_name string, province_area_code string, province_iso_code string, province_3166_2_code string"
    schema = f"order_id long, {dims}, total_amount double, rowtime timestamp"
    p1, p2 = (1, "p", "a", "i", "c"), (2, "q", "a", "i", "c")
    rows = [(7, *p1, 1.5, at(1)), (7, *p1, 1.5, at(2)), (8, *p1, 2.0, at(3)), (7, *p2, 9.0, at(4)), (9, *p2, 1.0, at(15))]
    s = write_parts(spark, str(tmp_path / "o"), schema, rows[:3], rows[3:], [(0, *p1, 0.0, at(1000))])
    typed = flows.watermarked(s.withColumn("total_amount", F.col("total_amount").cast(MONEY)), "rowtime", 30 * S)
    finish(stats.province_sums(typed, 10 * S), flows.to_folder(str(tmp_path / "p")), tmp_path, name="cp1")
    batch = spark.createDataFrame(rows, schema).withColumn("total_amount", F.col("total_amount").cast(MONEY))
    want = stats.province_stats(spark, batch, 10 * S)
    assert read(spark, tmp_path / "p", *want.columns) == sorted(map(tuple, want.collect()))

    schema = ("sku_id long, at timestamp, click_ct long, display_ct long, favor_ct long, cart_ct long, order_sku_num long, "
              "comment_ct long, good_comment_ct long, order_amount double, payment_amount double, refund_amount double, "
              "order_id long, paid_order_id long, refund_order_id long")
    none = (None,) * 7
    rows = [(1, at(1), 1, *none[1:], None, None, None, None, None, None), (1, at(2), *none, 5.0, None, None, 7, None, None),
            (1, at(3), *none, 6.0, None, None, 7, None, None), (2, at(3), *none, None, 8.0, None, None, 7, None)]
    s = write_parts(spark, str(tmp_path / "r"), schema, rows[:2], rows[2:], [(3, at(1000), *none, None, None, None, None, None, None)])
    finish(stats.product_sums(flows.watermarked(s, "at", 30 * S), 10 * S), flows.to_folder(str(tmp_path / "s")), tmp_path, name="cp2")
    want = stats.product_sums(spark.createDataFrame(rows, schema), 10 * S)
    assert read(spark, tmp_path / "s", *want.columns) == sorted(map(tuple, want.collect()))
    assert [r["order_ct"] for r in want.orderBy("sku_id").collect()] == [1, 0]


def test_late_split(spark, tmp_path):
    s = write_parts(spark, str(tmp_path / "in"), CLICKS, [(1, "a", at(0)), (2, "a", at(100))], [(3, "a", at(30)), (4, "a", at(95))],
                    [(5, "a", at(61))])
    finish(s, flows.late_to_folder(str(tmp_path / "out"), "ts", M, 10 * S), tmp_path)
    assert read(spark, tmp_path / "out/rows", "user", F.col("late").cast("boolean")) == [(1, False), (2, False), (3, True), (4, False), (5, False)]


def test_upserted_dimension(spark, tmp_path):
    schema = "id long, name string, v long"
    s = write_parts(spark, str(tmp_path / "in"), schema, [(1, "a", 1), (2, "b", 2), (1, "c", 3)], [(2, "d", 1), (3, "e", 1)])
    table = DimTable(spark, str(tmp_path / "dim"), ["id"], spark.createDataFrame([], "id long, name string").schema)
    finish(s, flows.upsert_to(table, "v"), tmp_path)
    want = [(1, "c"), (2, "d"), (3, "e")]
    assert sorted(map(tuple, table.read().collect())) == want
    # A batch that runs again changes nothing, and a compacted table reads the same.
    table.upsert(spark.createDataFrame([(2, "d", 1), (3, "e", 1)], schema), 1, "v")
    assert sorted(map(tuple, table.read().collect())) == want
    small = DimTable(spark, str(tmp_path / "dim2"), ["id"], spark.createDataFrame([], "id long, name string").schema)
    table.compact(1, small)
    assert sorted(map(tuple, small.read().collect())) == want


def test_routes_are_read_anew_in_each_batch(spark, tmp_path):
    schema = "`table` string, `type` string, data map<string,string>"
    s = write_parts(spark, str(tmp_path / "in"), schema, [("t", "insert", {"id": "1", "x": "y"})], [("t", "insert", {"id": "2", "x": "z"})])
    read_count = []

    def routes():
        read_count.append(1)
        table = "first" if len(read_count) == 1 else "second"
        return spark.createDataFrame([("t", "insert", "kafka", table, "id", None, None)], schemas.ROUTE)

    finish(s, flows.routed_to_folder(routes, str(tmp_path / "out")), tmp_path)
    assert read(spark, tmp_path / "out", "sink_table", F.to_json("data")) == [("first", '{"id":"1"}'), ("second", '{"id":"2"}')]


def test_file_sources(spark, tmp_path):
    (tmp_path / "c.csv").write_text("937166,1715,beijing,beijing,1511661602\n5,36156,jiangsu,nanjing,x\n")
    clicks = files.seconds_to_ts(files.delimited(spark, str(tmp_path / "c.csv"), schemas.ADS_CLICK))
    assert [tuple(r) for r in clicks.select("user_id", "ad_id", "province", F.unix_seconds("ts")).collect()] == [
        (937166, 1715, "beijing", 1511661602), (5, 36156, "jiangsu", None)]
    (tmp_path / "a.log").write_text("83.1.9.2 - - 17/05/2015:10:05:03 +0000 GET /a/b.png\n")
    log = files.access_log(files.text_lines(spark, str(tmp_path / "a.log"))).first()
    assert (log["id"], log["ts"], log["method"], log["url"]) == ("83.1.9.2", datetime(2015, 5, 17, 10, 5, 3), "GET", "/a/b.png")
    assert files.text_lines(spark, str(tmp_path), stream=True).isStreaming
    ms = files.millis_to_ts(files.rows(spark, [(1, "1.1.1.1", "fail", 1000)], schemas.LOGIN))
    assert ms.first()["ts"] == datetime(1970, 1, 1, 0, 0, 1)


def test_json_table(spark):
    lines = spark.createDataFrame([('{"order_id":1,"create_time":"2021-01-01 00:00:01"}',)], "value string")
    schema = spark.createDataFrame([], "order_id long, create_time string").schema
    src.json_table(lines, schema, "create_time", "1 second", view="orders_v", zone_format="yyyy-MM-dd HH:mm:ss")
    assert spark.sql("SELECT rowtime FROM orders_v WHERE order_id = 1").first()[0] == datetime(2021, 1, 1, 0, 0, 1)


def test_options():
    assert src.kafka_options("h:1", "t", "earliest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"}
    with pytest.raises(ValueError):
        src.kafka_options("h:1", "t", "newest")
    assert src.jdbc_options("jdbc:x", "t", "id", (0, 9), 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        src.jdbc_options("jdbc:x", "t", "id")
    assert out.kafka_sink_options("h:1", acks="all") == {"kafka.bootstrap.servers": "h:1", "acks": "all"}


def test_messages_and_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2")], "id long, n string, sink_table string")
    msgs = out.as_messages(df, key="id", topic=F.col("sink_table"), columns=["id", "n"])
    assert sorted(map(tuple, msgs.collect())) == [("1", '{"id":1,"n":"a"}', "t1"), ("2", '{"id":2,"n":"b"}', "t2")]
    assert out.as_messages(df, topic="one").select("topic").distinct().count() == 1
    assert out.without_transient(df, ["sink_table"], ["n", "id"]).columns == ["n", "id"]
    out.write_by_table(df, str(tmp_path / "by"))
    assert read(spark, tmp_path / "by", "sink_table", "n") == [("t1", "a"), ("t2", "b")]


def test_create_table(spark):
    create_table(spark, "dim_made", "name,logo")
    create_table(spark, "dim_made", "name,logo")
    assert spark.table("dim_made").dtypes == [("id", "string"), ("name", "string"), ("logo", "string")]
    assert dim_schema("a, b").names == ["a", "b"]
