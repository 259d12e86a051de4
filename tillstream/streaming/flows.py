"""Streaming sources, sinks and runs.

Windows, interval joins, lookups and routing are the batch transformations on a watermarked
stream; what Structured Streaming does not allow there (ranking, upserts, late rows) runs in
``foreachBatch``. Every sink writes one folder per micro-batch and replaces it when the batch
is run again, so a retry after a lost executor changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.times import epoch_micros, interval_text, micros
from tillstream.operators.changes import route, with_data
from tillstream.operators.joins import lookup
from tillstream.operators.late import closed_before
from tillstream.operators.windows import top_n
from tillstream.sinks.connectors import as_messages, jdbc_append, without_transient
from tillstream.sinks.tables import DimTable

BatchSink = Callable[[DataFrame, int], None]


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
                   files_per_batch: int | None = None) -> DataFrame:
    """A growing folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def watermarked(df: DataFrame, ts: str, delay: timedelta, lateness: timedelta = timedelta(0)) -> DataFrame:
    """Event time with bounded disorder; extra lateness keeps windows open for late rows."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, interval_text(delay + lateness))


def run(df: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "append", once: bool = False,
        every: str | None = None) -> StreamingQuery:
    """Start a stream into a batch sink; ``once`` works off what is there and stops."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def to_folder(path: str, partition_by: Sequence[str] = ()) -> BatchSink:
    """One folder per micro-batch."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch={batch_id}")

    return write


def to_console(rows: int | None = None) -> BatchSink:
    """The rows of each micro-batch on the console, or so many of them."""
    def write(df: DataFrame, batch_id: int) -> None:
        count = df.count()
        df.show(count if rows is None else rows, truncate=False)
        print(f"batch {batch_id}: {count} rows")

    return write


def to_jdbc(options: dict[str, str], target: Sequence[str], transient: Sequence[str] = ()) -> BatchSink:
    """Append each micro-batch to a table by position, helper columns left out.

    A batch that runs again appends again; a table that must not see a row twice needs a key.
    """
    return lambda df, batch_id: jdbc_append(without_transient(df, transient, target), options)


def to_kafka(df: DataFrame, options: dict[str, str], checkpoint: str, key: str | None = None,
             topic: str | Column | None = None, columns: Sequence[str] | None = None) -> StreamingQuery:
    """Start a stream of JSON messages, each row to its own topic if ``topic`` is a column.

    Kafka gets each row at least once.
    """
    messages = as_messages(df, key, topic, columns)
    return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()


def ranked_to_folder(path: str, by: Sequence[str], score: str, ties: Sequence[str], n: int) -> BatchSink:
    """The top rows of each group of a micro-batch, for windows that come whole (append mode)."""
    inner = to_folder(path)
    return lambda df, batch_id: inner(top_n(df, by, score, ties, n), batch_id)


def _snapshot(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the batch before left in one of a state folder's two slots; nothing before the first batch.

    A batch reads the one slot and writes the other, so one that runs again finds what it found before.
    """
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/slot={(batch_id - 1) % 2}")


def _keep(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write the state that the next batch starts from, and read it back."""
    df.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/slot={batch_id % 2}")


def reranked_to_folder(path: str, keys: Sequence[str], by: Sequence[str], score: str, ties: Sequence[str],
                       n: int, open_path: str, size: timedelta, delay: timedelta) -> BatchSink:
    """Rankings under late updates (update mode): every window a batch touches is ranked anew.

    ``by`` starts with the window's end. The counts of all open windows are a table that each batch brings up to date;
    a window leaves it once no row can come any more: ``delay`` (with the lateness allowed) behind the latest row, which is
    at least ``size`` before the latest window's end. A batch reads open windows only.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark, names = df.sparkSession, [*by, *keys]
        # The stream is read once: what it gives is a table before anything is worked out from it.
        marked = _keep(df.select(*names, score).withColumn("_new", F.lit(1)), f"{open_path}-changes", batch_id)
        before = _snapshot(spark, open_path, batch_id, marked.schema)
        rows = before.withColumn("_new", F.lit(0)).unionByName(marked)
        every = rows.groupBy(*names).agg(F.max_by(score, "_new").alias(score), F.max("_new").alias("_new"))
        touched = marked.select(*by).distinct()
        ranked = top_n(every.join(touched, list(by), "left_semi").drop("_new"), by, score, ties, n)
        # What this batch closes was still open for it.
        mark = every.select(F.max(by[0]) - F.make_dt_interval(secs=F.lit((size + delay).total_seconds()))).scalar()
        _keep(every.where(F.col(by[0]) > mark), open_path, batch_id)
        ranked.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def two_inputs(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str) -> DataFrame:
    """Two streams as one whose rows hold a row of either, ``left`` or ``right``, with its time as a timestamp."""
    def one(df: DataFrame, ts: str, name: str) -> DataFrame:
        return df.withColumn(ts, F.col(ts).cast("timestamp")).select(F.struct("*").alias(name))

    return one(left, left_ts, "left").unionByName(one(right, right_ts, "right"), allowMissingColumns=True)


def joined_to_folder(path: str, open_path: str, join: Callable[[DataFrame, DataFrame], DataFrame], left_ts: str, right_ts: str,
                     lower: timedelta, upper: timedelta, delay: timedelta) -> BatchSink:
    """An interval join of `two_inputs`, by the batch join: each pair comes with the batch of its later row.

    ``join`` takes left and right rows and pairs those with ``right_ts`` in ``left_ts + [lower, upper]``. Rows that a row
    to come may still meet, as either input is out of order by ``delay`` at most, are a table that each batch brings up to
    date; so a row costs no entry of a state store, and what a batch adds to its own rows is what is open.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        # The streams are read once: what they give is a table before anything is worked out from it.
        new = _keep(df, f"{open_path}-new", batch_id)
        before = _snapshot(df.sparkSession, open_path, batch_id, new.schema)
        rows = before.unionByName(new)
        side = lambda of, name: of.where(F.col(name).isNotNull()).select(f"{name}.*")
        out = join(side(new, "left"), side(rows, "right")).unionByName(join(side(before, "left"), side(new, "right")))
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        l, r = epoch_micros(F.col(f"left.{left_ts}")), epoch_micros(F.col(f"right.{right_ts}"))
        tops = rows.agg(F.max(l).alias("l"), F.max(r).alias("r")).first()
        # An input without a row may still give any.
        still = lambda at, top: at.isNotNull() if top is None else at >= top - micros(delay)
        _keep(rows.where(still(l + micros(upper), tops["r"]) | still(r - micros(lower), tops["l"])), open_path, batch_id)

    return write


def upserted_lookup(path: str, state: str, dim: Callable[[DataFrame], DataFrame], fact: Callable[[DataFrame], DataFrame], key: str, seq: str,
                    fact_key: str, take: dict[str, str]) -> BatchSink:
    """Facts looked up in a dimension that changes under the stream.

    Each batch brings the dimension's snapshot up to date first, the newest row per ``key`` by ``seq`` (the table is made
    with the first batch), and then looks its facts up in it; a later change does not touch facts that are written.
    Both tables are plain Parquet; the snapshot is as large as the dimension and read once per batch.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark, changes = df.sparkSession, dim(df)
        rows = _snapshot(spark, state, batch_id, changes.schema).unionByName(changes)
        now = _keep(rows.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*changes.columns), F.struct(seq, *[c for c in changes.columns if c != seq])).alias("_r")).select("_r.*"), state, batch_id)
        lookup(fact(df), now, fact_key, key, take).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def late_to_folder(path: str, ts: str, size: timedelta, delay: timedelta,
                   lateness: timedelta = timedelta(0)) -> BatchSink:
    """Tell rows whose window was closed before their micro-batch from those in time.

    Writes ``rows`` in one pass, split into folders by ``late``, and ``marks``: one row per batch
    with its largest event time, from which the next batches take their watermark, also after
    a restart.
    """
    marks_schema = T.StructType([T.StructField("top", T.LongType()), T.StructField("batch", T.LongType())])

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        # Batch 0 creates the folder; before that there is no mark and nothing can be late.
        mark = None
        if batch_id > 0:
            marks = spark.read.schema(marks_schema).option("basePath", f"{path}/marks").parquet(f"{path}/marks")
            top = marks.where(F.col("batch") < batch_id).agg(F.max("top").alias("top")).first()["top"]
            mark = None if top is None else top - micros(delay)
        here = f"{path}/rows/batch={batch_id}"
        late = F.lit(False) if mark is None else closed_before(F.col(ts), mark, size, lateness)
        df.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(here)
        top = spark.read.schema(df.schema).parquet(here).agg(F.max(epoch_micros(F.col(ts))).alias("top"))
        top.write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")

    return write


def upsert_to(table: DimTable, seq: str) -> BatchSink:
    """Upserts of each micro-batch into a dimension table."""
    return lambda df, batch_id: table.upsert(df, batch_id, seq)


def routed_to_folder(read_routes: Callable[[], DataFrame], path: str) -> BatchSink:
    """Route changes with the configuration as it is at each micro-batch, one folder per table."""
    def write(df: DataFrame, batch_id: int) -> None:
        out = route(with_data(df), read_routes())
        out.write.mode("overwrite").partitionBy("sink_type", "sink_table").parquet(f"{path}/batch={batch_id}")

    return write
