"""Interval joins, dimension lookups, pairing and merging joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.times import epoch_micros, micros
from tillstream.operators.ordered import SplitPolicy, position, with_ordered


def _all_equal(left: DataFrame, right: DataFrame, on: dict[str, str]) -> Column:
    cond = F.lit(True)
    for l, r in on.items():
        cond = cond & (left[l] == right[r])
    return cond


def interval_join(left: DataFrame, right: DataFrame, on: dict[str, str], left_ts: str, right_ts: str,
                  lower: timedelta, upper: timedelta, hot: bool = False) -> DataFrame:
    """Inner join on equal keys where ``right_ts`` is in ``left_ts + [lower, upper]``, inclusive.

    ``on`` maps left to right columns; column names must differ between the sides. On streams
    both sides need a watermark. ``hot`` is for keys with many rows on *both* sides: time slots
    join the equality, so a hot key is spread over its slots and only rows close in time meet.
    A slot is as wide as the interval, so a left row looks into two slots at most; it is meant
    for batch.
    """
    if not hot:
        gap = right[right_ts].between(left[left_ts] + F.expr(_literal(lower)),
                                      left[left_ts] + F.expr(_literal(upper)))
        return left.join(right, _all_equal(left, right, on) & gap)
    slot = max(micros(upper - lower), 1)
    lus = epoch_micros(F.col(left_ts))
    slots = F.sequence(F.floor((lus + micros(lower)) / slot), F.floor((lus + micros(upper)) / slot))
    l = left.withColumn("_lslot", F.explode(slots))
    r = right.withColumn("_rslot", F.floor(epoch_micros(F.col(right_ts)) / slot))
    gap = epoch_micros(r[right_ts]) - epoch_micros(l[left_ts])
    cond = _all_equal(l, r, on) & (l["_lslot"] == r["_rslot"]) & gap.between(micros(lower), micros(upper))
    return l.join(r, cond).drop("_lslot", "_rslot")


def _literal(d: timedelta) -> str:
    return f"make_dt_interval(0, 0, 0, {micros(d)} / 1e6BD)"


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, take: dict[str, str | Column],
           how: str = "left", fixed_size: bool = False) -> DataFrame:
    """Add dimension columns to ``df`` by id; ``take`` maps new names to dimension columns.

    ``how='left'`` keeps rows without a dimension row, ``'inner'`` drops them. The dimension
    must be unique by ``dim_key``. Only a dimension whose size cannot grow (``fixed_size``,
    such as regions or code lists) is broadcast by hint. For all others Spark compares the
    size with ``spark.sql.autoBroadcastJoinThreshold`` and else runs a sort-merge join, where
    AQE splits hot ids.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in take.items()])
    if fixed_size:
        side = F.broadcast(side)
    return df.join(side, df[key] == side["_dim_key"], how).drop("_dim_key")


def pair_by_occurrence(left: DataFrame, right: DataFrame, key: str, left_order: Sequence[str],
                       right_order: Sequence[str], policy: SplitPolicy | None = None) -> DataFrame:
    """Pair the n-th left row of a key with the n-th right row of the same key, one to one.

    The first column of each order is a time. Both sides must otherwise have distinct names.
    """
    rk = f"_{key}"
    l = with_ordered(left, [key], left_order[0], left_order[1:], policy, nth=position())
    r = with_ordered(right, [key], right_order[0], right_order[1:], policy, _nth=position())
    r = r.withColumnRenamed(key, rk)
    return l.join(r, (l[key] == r[rk]) & (l["nth"] == r["_nth"])).drop(rk, "_nth")


def co_process(left: DataFrame, right: DataFrame, keys: Sequence[str], each: Callable[[pa.Table, pa.Table], pa.Table],
               schema: str) -> DataFrame:
    """A function of two inputs: called once per key with the rows of both sides, as Arrow tables; a side may be empty.

    A key's rows of both sides must fit in a task; ``chunked_pairs`` cuts keys that may not.
    """
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(each, schema)


def chunked_pairs(left: DataFrame, right: DataFrame, key: str, left_order: Sequence[str], right_order: Sequence[str],
                  each: Callable[[pa.Table, pa.Table], pa.Table], schema: str, chunk: int = 10_000, policy: SplitPolicy | None = None,
                  call_rows: int | None = None) -> DataFrame:
    """``co_process`` for functions that put the n-th left row of a key next to its n-th right row.

    Rows get their position ``nth`` in the key first, and a call sees the positions of one chunk only, so a hot key is
    spread over as many calls as it has chunks. With ``call_rows``, calls get many chunks, of different keys too and about so
    many rows, for functions that tell keys apart: a call costs a millisecond, which is much for a few rows.
    """
    def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
        own = with_ordered(df, [key], order[0], order[1:], policy, nth=position())
        return own.withColumn("_chunk", F.floor((F.col("nth") - 1) / chunk))

    l, r = placed(left, left_order), placed(right, right_order)
    if call_rows is None:
        return co_process(l, r, [key, "_chunk"], each, schema)
    calls = -(-(left.count() + right.count()) // call_rows) or 1
    together = F.pmod(F.xxhash64(key, "_chunk"), F.lit(calls))

    def many(x: pa.Table, y: pa.Table) -> pa.Table:
        return each(x.drop_columns(["_call"]), y.drop_columns(["_call"]))

    return co_process(l.withColumn("_call", together), r.withColumn("_call", together), ["_call"], many, schema)


def coalesce_merge(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Full merge of two tables of one shape: the left value where there is one, else the right."""
    l, r = left.alias("l"), right.alias("r")
    merged = [F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c) for c in [key, *columns]]
    return l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}"), "full").select(*merged)


def tag_union(**sides: DataFrame) -> DataFrame:
    """Tables of different shapes side by side: a ``source`` column, absent columns null."""
    out = None
    for name, df in sides.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
