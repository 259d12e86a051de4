"""Keyed aggregates: row picks, grouping sets, running forms and user-defined aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillstream.operators.ordered import DEFAULT_POLICY, SplitPolicy, hot_keys, running, with_ordered


def rolled(df: DataFrame, keys: Sequence[str | Column], first: Sequence[str], order: Sequence[str],
           **aggs: Column) -> DataFrame:
    """Aggregates per key next to the fields of the key's first row (by ``order``)."""
    firsts = F.min_by(F.struct(*first), F.struct(*order)).alias("_f")
    out = df.groupBy(*keys).agg(firsts, *[c.alias(n) for n, c in aggs.items()])
    names = [c for c in out.columns if c not in ("_f", *aggs)]
    return out.select(*names, *[F.col(f"_f.{c}").alias(c) for c in first], *aggs)


def arg_max(df: DataFrame, keys: Sequence[str], value: str, seq: Sequence[str],
            last_tie: bool = True) -> DataFrame:
    """The whole row with the largest ``value`` per key.

    On ties the row that is last in ``seq`` order wins, or the first if ``last_tie`` is false.
    """
    return _pick(df, keys, value, seq, highest=True, last_tie=last_tie)


def arg_min(df: DataFrame, keys: Sequence[str], value: str, seq: Sequence[str],
            last_tie: bool = False) -> DataFrame:
    """The whole row with the smallest ``value`` per key; ties as in ``arg_max``."""
    return _pick(df, keys, value, seq, highest=False, last_tie=last_tie)


def _pick(df, keys, value, seq, highest, last_tie):
    # Numeric order columns are negated where the tie rule runs against the aggregate.
    sign = 1 if highest == last_tie else -1
    order = F.struct(value, *[(F.col(c) * sign).alias(f"_o{i}") for i, c in enumerate(seq)])
    pick = F.max_by if highest else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*df.columns), order).alias("_r")).select("_r.*")


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``: combined before the shuffle, so a hot key is cheap."""
    row = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(row).select("_r.*")


def oldest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``."""
    row = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(row).select("_r.*")


def running_distinct(df: DataFrame, value: str, ts: str, tie: str, out: str,
                     policy: SplitPolicy | None = None) -> DataFrame:
    """Number of different values seen up to and including each row, over the whole input.

    The first row of each value (an aggregate, combined before its shuffle) adds a marker row;
    the count is a running sum over rows and markers, cut into time chunks when large.
    """
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(F.struct(ts, tie)).alias("_f"))
    marks = first.select(F.col(f"_f.{ts}").alias(ts), F.col(f"_f.{tie}").alias(tie), F.lit(0).alias("_row"))
    rows = df.withColumn("_row", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    hot = hot_keys(df, [], ts, policy or DEFAULT_POLICY)
    new = (1 - F.col("_row")).cast("long")
    counted = with_ordered(rows, [], ts, [tie, "_row"], hot=hot, **{out: running("sum", new)})
    return counted.where(F.col("_row") == 1).drop("_row")


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], *aggs: Column) -> DataFrame:
    """Aggregates for several key sets in one pass; absent keys are null."""
    every = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in every]).agg(*aggs)


@dataclass(frozen=True)
class Aggregator:
    """A user-defined aggregate: make an accumulator, fold a batch in, merge two, finish.

    Accumulators must pickle; they travel as binary between the two stages.
    """

    create: Callable[[], Any]
    add: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    result: Callable[[Any], Any]
    result_type: T.DataType


def aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregator, out: str,
              fan_in: int = 64, max_held_keys: int = 50_000, piece: int = 1 << 16) -> DataFrame:
    """Run an ``Aggregator`` per key without gathering a key's rows.

    In Python the key is a JSON text, from which the columns come back at the end: nullable longs stay exact, and
    arrays and structs may be keys.

    Each task sorts its rows by key in pieces of ``piece`` rows, calls ``add`` once for each key of a piece, and hands on
    one accumulator per key; only these are shuffled. They are merged in two steps, first in ``fan_in`` parts per key,
    so the last step sees at most ``fan_in`` accumulators of a key. Both steps go through sorted parts and hold one
    key at a time. A task that holds ``max_held_keys`` keys hands them on and starts again; the merge makes up for it.
    """
    import pickle

    keys = list(keys)
    kept = T.StructType([df.schema[k] for k in keys])
    partial = "_key string, _acc binary, _part int"
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

    def add(held: dict[str, Any], batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches)
        coded = table.column("_key").combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        rows = table.drop_columns(["_key"]).take(pa.array(order)).to_pandas()
        for name in rows.columns[[isinstance(t, pd.DatetimeTZDtype) for t in rows.dtypes]]:
            rows[name] = rows[name].dt.tz_convert(zone).dt.tz_localize(None)
        own, first = np.unique(codes[order], return_index=True)
        for key, a, b in zip(coded.dictionary.take(pa.array(own)).to_pylist(), first, [*first[1:], len(order)], strict=True):
            held[key] = agg.add(held[key] if key in held else agg.create(), rows.iloc[a:b])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Any] = {}
        waiting: list[pa.RecordBatch] = []
        # The part follows the task, so a task that runs again sends its rows to the same place.
        part = TaskContext.get().partitionId() % fan_in
        for batch in batches:
            waiting.append(batch)
            if sum(w.num_rows for w in waiting) >= piece:
                add(held, waiting)
                waiting = []
            if len(held) >= max_held_keys:
                yield packed(held, part)
                held = {}
        if waiting:
            add(held, waiting)
        yield packed(held, part)

    def packed(held: dict[str, Any], part: int) -> pa.RecordBatch:
        return pa.record_batch({"_key": pa.array(held, pa.string()), "_acc": pa.array([pickle.dumps(acc) for acc in held.values()], pa.binary()),
                                "_part": pa.array([part] * len(held), pa.int32())})

    def neighbours(batches: Iterator[pa.RecordBatch], size: int = 1000) -> Iterator[list[tuple[tuple, Any]]]:
        """Merged accumulators of rows that follow each other with one key and part, some at a time."""
        done, now, total = [], None, None
        for batch in batches:
            for key, part, acc in zip(*(batch.column(c).to_pylist() for c in ("_key", "_part", "_acc")), strict=True):
                if (key, part) != now:
                    if now is not None:
                        done.append((now, total))
                    now, total = (key, part), agg.create()
                    if len(done) >= size:
                        yield done
                        done = []
                total = agg.merge(total, pickle.loads(acc))
        yield done + ([(now, total)] if now is not None else [])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in neighbours(batches):
            yield pa.record_batch({"_key": pa.array([k for (k, _), _ in done], pa.string()), "_acc": pa.array([pickle.dumps(acc) for _, acc in done], pa.binary()),
                                   "_part": pa.array([0] * len(done), pa.int32())})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in neighbours(batches):
            yield pa.record_batch({"_key": pa.array([k for (k, _), _ in done], pa.string()), out: pa.array([agg.result(acc) for _, acc in done], to_arrow_type(agg.result_type))})

    final = T.StructType([T.StructField("_key", T.StringType()), T.StructField(out, agg.result_type)])
    keyed = df.withColumn("_key", F.to_json(F.struct(*keys), exact))
    folded = keyed.mapInArrow(fold, partial)
    once = folded.repartition("_key", "_part").sortWithinPartitions("_key", "_part").mapInArrow(merge, partial)
    done = once.repartition("_key").sortWithinPartitions("_key").mapInArrow(finish, final)
    return done.select(F.from_json("_key", kept, exact).alias("_k"), out).select("_k.*", out)
