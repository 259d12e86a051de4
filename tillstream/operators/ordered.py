"""Ordered per-key values (positions, running values, neighbours) that survive hot keys.

A plain window over ``partitionBy(key)`` puts every row of a key into one task. Here a key
that holds more than ``1/share`` of all rows is cut into consecutive time chunks of about that
size; by default ``share`` is the session's number of shuffle partitions, so a chunk is about
what a task has anyway. Values are computed inside each (key, chunk), and the part that crosses a chunk border
(rows before, sum before, last or first row) comes from a table with one row per hot chunk.

Chunks follow the rows and not the clock: the time of a hot key is divided into many equal
cells, the rows of each cell are counted, and neighbouring cells are put together until a chunk
is full. A burst is thus cut finer than a quiet time.

The hot keys and their chunks are worked out once, before the values, into two small tables in the shared folder.
Without a hot key nothing else remains than one window over the rows, with one shuffle.

Bounds: at most ``share`` keys can hold more than ``1/share`` of the rows, and they have at
most ``2 * share`` chunks and ``2 * share * cells`` cells. All tables that get broadcast
therefore have a size fixed by the policy, whatever the size of the data. Rows are never
dropped; a key below the limit keeps its single group.

Any chunk table gives right results, as chunks only have to follow time. It may thus be taken
from another, cheaper table with the same keys (``hot=``), such as the raw input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.times import epoch_micros
from tillstream.session import stored

CHUNK = "_chunk"


@dataclass(frozen=True)
class SplitPolicy:
    """Keys above ``rows / share`` rows are cut into time chunks."""

    share: int | None = None
    cells: int = 32


DEFAULT_POLICY = SplitPolicy()


@dataclass(frozen=True)
class Value:
    """One ordered value: ``kind`` is position, sum, min, max, previous or next."""

    kind: str
    expr: Column | None = None
    where: Column | None = None


def position() -> Value:
    """1-based rank of the row in its key."""
    return Value("position")


def running(kind: str, expr: Column) -> Value:
    """Running ``sum``, ``min`` or ``max`` up to and including the row."""
    if kind not in ("sum", "min", "max"):
        raise ValueError(f"no running {kind}")
    return Value(kind, expr)


def previous(expr: Column, where: Column | None = None) -> Value:
    """The value of the row before; with ``where``, of the nearest such row before."""
    return Value("previous", expr, where)


def following(expr: Column, where: Column | None = None) -> Value:
    """The value of the row after; with ``where``, of the nearest such row after."""
    return Value("next", expr, where)


@dataclass(frozen=True)
class HotKeys:
    """The time span of every hot key and the chunk of each of its cells; no cells without a hot key."""

    spans: DataFrame
    cells: DataFrame | None


def hot_keys(df: DataFrame, keys: Sequence[str], ts: str, policy: SplitPolicy = DEFAULT_POLICY) -> HotKeys:
    """Find the keys above the limit and cut them into chunks.

    Reads the key and time columns only; counts are combined before their shuffle. Runs at once; without a
    hot key there is no second count.
    """
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(epoch_micros(F.col(ts))).alias("_lo"),
        F.max(epoch_micros(F.col(ts))).alias("_hi"),
    )
    share = policy.share or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fair = counts.agg(F.greatest(F.lit(1), F.ceil(F.sum("_n") / share)))
    limited = counts.withColumn("_limit", fair.scalar()).where(F.col("_n") > F.col("_limit"))
    names = [f"_hot_{k}" for k in keys]
    many = F.ceil(F.col("_n") / F.col("_limit")) * policy.cells
    spans = limited.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_lo", "_limit", many.alias("_many"),
                           F.ceil((F.col("_hi") - F.col("_lo") + 1) / many).alias("_width"))
    spans = stored(spans, "spans")  # at most `share` rows
    if spans.isEmpty():
        return HotKeys(spans, None)
    filled = _with_cell(df, spans, keys, ts, only_hot=True).groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    filled = filled.select(*[F.col(k).alias(f"_f_{k}") for k in keys], F.col("_cell").alias("_f_cell"), "_n")
    # Every cell gets a chunk, also an empty one: another table may have rows there.
    every = spans.select(*names, "_limit", F.explode(F.sequence(F.lit(0), F.col("_many") - 1)).alias("_cell"))
    same = every["_cell"] == filled["_f_cell"]
    for k, n in zip(keys, names):
        same = same & every[n].eqNullSafe(filled[f"_f_{k}"])
    before = F.sum("_n").over(Window.partitionBy(*names).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    chunk = F.floor(F.coalesce(before, F.lit(0)) / F.col("_limit"))
    cells = every.join(filled, same, "left").select(
        *[F.col(n).alias(f"_cut_{k}") for k, n in zip(keys, names)], F.col("_cell").alias("_cut_cell"), chunk.alias(CHUNK))
    return HotKeys(spans, stored(cells, "cells"))


def _with_cell(df: DataFrame, spans: DataFrame, keys: Sequence[str], ts: str, only_hot: bool) -> DataFrame:
    """Add the time cell of each row; null where the key is not hot."""

    def cell(span) -> Column:
        at = F.floor((epoch_micros(F.col(ts)) - span("_lo")) / span("_width"))
        # Rows outside the span belong to its outer cells; a row without a time sorts first.
        inside = F.greatest(F.lit(0), F.least(F.coalesce(at, F.lit(0)), span("_many") - 1))
        return F.when(span("_many").isNotNull(), inside)

    if not keys:
        tagged = df.withColumn("_span", spans.select(F.struct("_lo", "_width", "_many")).scalar())
        tagged = tagged.where(F.col("_span").isNotNull()) if only_hot else tagged
        return tagged.withColumn("_cell", cell(lambda n: F.col(f"_span.{n}"))).drop("_span")
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(spans[f"_hot_{k}"])
    joined = df.join(F.broadcast(spans), same, "inner" if only_hot else "left")
    return joined.select(*[df[c] for c in df.columns], cell(lambda n: spans[n]).alias("_cell"))


def _tag(df: DataFrame, hot: HotKeys, keys: Sequence[str], ts: str, only_hot: bool) -> DataFrame:
    """Add the chunk of every row (0 for all rows of a key that is not hot)."""
    placed = _with_cell(df, hot.spans, keys, ts, only_hot)
    same = placed["_cell"] == hot.cells["_cut_cell"]
    for k in keys:
        same = same & placed[k].eqNullSafe(hot.cells[f"_cut_{k}"])
    joined = placed.join(F.broadcast(hot.cells), same, "left")
    return joined.select(*[placed[c] for c in df.columns], F.coalesce(hot.cells[CHUNK], F.lit(0).cast("long")).alias(CHUNK))


class _Orders:
    """Window specifications of one call."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], cut: bool = True):
        parts = [*keys, CHUNK] if cut else [*keys]
        self.up = Window.partitionBy(*parts).orderBy(*order)
        self.down = Window.partitionBy(*parts).orderBy(*[F.col(c).desc() for c in order])
        # Chunk tables have one row per chunk, so a key's rows there are few by the policy.
        self.chunks_up = Window.partitionBy(*keys).orderBy(CHUNK)
        self.chunks_down = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _hit(v: Value) -> Column:
    """The value in a struct, so that a null value differs from no row."""
    held = F.struct(v.expr.alias("v"))
    return held if v.where is None else F.when(v.where, held)


def _local(v: Value, o: _Orders) -> Column:
    if v.kind == "position":
        return F.row_number().over(o.up).cast("long")
    if v.kind in ("sum", "min", "max"):
        return getattr(F, v.kind)(v.expr).over(o.up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if v.where is None:
        return (F.lag if v.kind == "previous" else F.lead)(_hit(v)).over(o.up)
    # Looking ahead is a running value in the opposite order, which stays linear.
    w = o.up if v.kind == "previous" else o.down
    return F.last(_hit(v), ignorenulls=True).over(_before(w))


def _summary(v: Value, order: Column) -> Column:
    if v.kind == "position":
        return F.count(F.lit(1))
    if v.kind in ("sum", "min", "max"):
        return getattr(F, v.kind)(v.expr)
    pick = F.max_by if v.kind == "previous" else F.min_by
    return pick(_hit(v), order if v.where is None else F.when(v.where, order))


def _carry(v: Value, name: str, o: _Orders) -> Column:
    if v.kind == "position":
        return F.sum(name).over(_before(o.chunks_up))
    if v.kind in ("sum", "min", "max"):
        return getattr(F, v.kind)(F.col(name)).over(_before(o.chunks_up))
    w = o.chunks_up if v.kind == "previous" else o.chunks_down
    return F.last(name, ignorenulls=True).over(_before(w))


def _combine(v: Value, name: str) -> Column:
    local, carry = F.col(name), F.col(f"_carry_{name}")
    if v.kind == "position":
        return local + F.coalesce(carry, F.lit(0).cast("long"))
    if v.kind == "sum":
        return F.coalesce(local + carry, local, carry)
    if v.kind in ("min", "max"):
        return (F.least if v.kind == "min" else F.greatest)(local, carry)
    return F.coalesce(local, carry)["v"]


def with_ordered(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[str],
    policy: SplitPolicy | None = None,
    hot: HotKeys | None = None,
    **values: Value,
) -> DataFrame:
    """Add ordered ``values`` per key; rows are ordered by ``ts`` and then by ``ties``.

    ``keys`` may be empty: the whole input is then one ordered sequence. One shuffle of the
    rows on (keys, chunk), after a key-only count that finds the hot keys unless ``hot`` is given.
    """
    if hot is None:
        hot = hot_keys(df, keys, ts, policy or DEFAULT_POLICY)
    order = [ts, *ties]
    if hot.cells is None:
        o = _Orders(keys, order, cut=False)
        return df.select("*", *[(c["v"] if v.kind in ("previous", "next") else c).alias(n) for n, v, c in ((n, v, _local(v, o)) for n, v in values.items())])
    o = _Orders(keys, order)
    local = _tag(df, hot, keys, ts, only_hot=False).select(
        "*", *[_local(v, o).alias(n) for n, v in values.items()])

    rank = F.struct(*[F.col(c) for c in order])
    carry = (
        _tag(df, hot, keys, ts, only_hot=True)
        .groupBy(*keys, CHUNK)
        .agg(*[_summary(v, rank).alias(n) for n, v in values.items()])
        .select(*[F.col(k).alias(f"_carry_key_{k}") for k in keys], F.col(CHUNK).alias("_carry_chunk"),
                *[_carry(v, n, o).alias(f"_carry_{n}") for n, v in values.items()])
    )
    same = local[CHUNK] == carry["_carry_chunk"]
    for k in keys:
        same = same & local[k].eqNullSafe(carry[f"_carry_key_{k}"])
    joined = local.join(F.broadcast(carry), same, "left")
    return joined.select(*df.columns, *[_combine(v, n).alias(n) for n, v in values.items()])
