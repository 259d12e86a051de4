"""Language model by context-tree weighting over bytes.

A text is its words, lower-cased, with one space between and a line feed as its end; the context of a byte is the
`DEPTH` bytes before it. Each byte is eight binary decisions. Every decision at every context of every depth has a
Krichevsky-Trofimov estimate, and the tree weighs at each node, by how well each codes the training data, between its
own estimate and those of the longer contexts. A decision's probability so mixes the estimates of all depths on its path
that training has met.

Counts are taken over all training texts, and no context is left out. The tree is a table of all (context, byte) pairs.
Contexts that share their last `SPLIT` bytes form a subtree; one task holds one subtree at a time, works out its weights
and hands their sums to the trunk, the contexts of fewer than `SPLIT` bytes. The trunk, whose size the alphabet bounds,
goes to all tasks, and a second walk over the subtrees gives probabilities. Those of the most frequent pairs (`ENTRIES` at
most) go to the tasks that score; any other gram is looked up in its subtree by a shuffle. How many pairs are sent changes
the traffic, not the result.

The unigram base needs the count of every word. The counts of the most frequent words go to all tasks (`WORDS` at
most); the others are joined by a shuffle.

Cases: a null or empty text is its end alone; ids may repeat or be null; without training texts every decision has
probability 1/2, and the base has N = V = 0; texts are scored whole; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.words import SPACES, Words, blocks
from tillstream.session import stored

DEPTH = 5
#: Contexts shorter than this are the trunk; those that share so many last bytes are one subtree.
SPLIT = 3
ENTRIES = 1 << 19
#: Rows of whole subtrees that a task works off together.
CHUNK = 1 << 16
WORDS = 1 << 20
#: Different keys that a counting task holds before it hands them on.
HELD = 1 << 20
END = 10
U = np.uint64


def contexts(words: Words, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text: the `depth` bytes before it and itself, in one number; and bytes of each text."""
    texts = np.diff(words.first)
    sizes = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(words.ends - words.starts + 1, out=(total := np.zeros(len(words.starts) + 1, np.int64))[1:])
    sizes = total[words.first[1:]] - total[words.first[:-1]]
    full = np.maximum(sizes, 1)
    begins = np.cumsum(full + depth) - full
    out = np.full(int((full + depth).sum()), END, np.uint8)  # before each text stand ends of a text
    out[np.arange(total[-1]) + np.repeat(begins - total[words.first[:-1]], sizes)] = words.joined()
    out[begins + full - 1] = END
    wide = out.astype(np.uint64)
    gram = wide[: len(wide) - depth]
    for k in range(1, depth + 1):
        gram = gram << U(8) | wide[k : len(wide) - depth + k]
    own = np.arange(int(full.sum())) + np.repeat(begins - depth - np.concatenate([[0], np.cumsum(full)])[:-1], full)
    return gram[own], full


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = _runs(key)
    return key[first], np.add.reduceat(count, first) if len(first) else count


_tables: dict[str, Table] = {}


def _forget() -> None:
    """Drop the table of an earlier run from a worker process that goes on."""
    _tables.clear()


def counted(docs: DataFrame, text: str, depth: int = DEPTH) -> DataFrame:
    """(`kind`, `key`, `n`): kind 0 counts contexts with their byte, kind 1 the hashes of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        held: list[list] = [[], []]
        sums: list[list] = [[], []]

        def fold(kind: int) -> None:
            key, n = np.unique(np.concatenate(held[kind]), return_counts=True)
            held[kind].clear()
            sums[kind].append((key, n))
            if sum(len(k) for k, _ in sums[kind]) > HELD:
                sums[kind][:] = [_merged([k for k, _ in sums[kind]], [c for _, c in sums[kind]])]

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            key, n = _merged([k for k, _ in sums[kind]], [c for _, c in sums[kind]])
            sums[kind].clear()
            for at in range(0, len(key), 1 << 16):
                own = key[at : at + (1 << 16)]
                yield pa.record_batch({"kind": pa.array(np.full(len(own), kind, np.int32)), "key": pa.array(own.view(np.int64)), "n": pa.array(n[at : at + len(own)])})

        for batch in batches:
            texts = batch.column(0)
            for begin, end in blocks(texts, 1 << 20):
                words = Words(texts[begin:end], SPACES)
                held[0].append(contexts(words, depth)[0])
                held[1].append(words.hashes())
                for kind in (0, 1):
                    if sum(map(len, held[kind])) > HELD // 2:
                        fold(kind)
            for kind in (0, 1):  # a task that meets too many different keys hands on what it has
                if sum(len(k) for k, _ in sums[kind]) > HELD:
                    yield from out(kind)
        for kind in (0, 1):
            if held[kind]:
                fold(kind)
            if sums[kind]:
                yield from out(kind)

    parts = docs.select(F.col(text)).mapInArrow(run, "kind int, key long, n long")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 1/2, by Stirling's series from x + 8 on."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives to data with a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1.0)


@dataclass
class Nodes:
    """The decisions after the same number of bits, at all contexts of one depth, by context and bits so far."""

    keys: np.ndarray
    zeros: np.ndarray | None
    ones: np.ndarray | None
    one: np.ndarray | None = None  # probability of a one: the node's estimate, then the mixture if no longer context is known

    def settle(self) -> None:
        """Keep the estimate in place of the counts."""
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        self.zeros = self.ones = None


@dataclass
class Model:
    """keys, values: for each depth, context and byte and the log2 of its probability; nodes: by depth and bits."""

    depth: int
    keys: list[np.ndarray]
    values: list[np.ndarray]
    nodes: list[list[tuple[np.ndarray, np.ndarray]]]


def _levels(keys: np.ndarray, counts: np.ndarray) -> list[Nodes]:
    out = []
    for bits in range(8):
        node = keys >> U(8 - bits)
        first = _runs(node)
        bit = (keys >> U(7 - bits) & U(1)).astype(np.float64)
        total, ones = np.add.reduceat(counts, first), np.add.reduceat(counts * bit, first)
        out.append(Nodes(node[first], total - ones, ones))
    return out


def _ups(tree: list[list[Nodes]], first: int = 0) -> list[list[np.ndarray]]:
    """For each depth after `first`: where each node's shorter context is."""
    return [[np.searchsorted(short.keys, long.keys & U((1 << (8 * (first + d) + bits)) - 1)).astype(np.int32)
             for bits, (short, long) in enumerate(zip(tree[d], tree[d + 1], strict=True))] for d in range(len(tree) - 1)]


def _shares(tree: list[list[Nodes]], ups: list[list[np.ndarray]], below_all: list[np.ndarray] | None = None) -> tuple[list[list[np.ndarray]], list[np.ndarray]]:
    """The weight of each node's own estimate, and the log probabilities of the data at the first depth's nodes.

    below_all: log probabilities of the data below each node of the last depth, if it has longer contexts.
    """
    last = len(tree) - 1
    own_share: list[list[np.ndarray]] = [[] for _ in tree]
    longer: list[np.ndarray] = []  # log probabilities of the data below each node of the next depth
    for d in range(last, -1, -1):
        weighted = []
        for bits in range(8):
            node = tree[d][bits]
            kt = _log_kt(node.zeros, node.ones)
            share = np.ones(len(kt))
            if d < last:
                up, below, n = ups[d][bits], tree[d + 1][bits], len(kt)
                split = np.bincount(up, longer[bits], n)
                has = np.bincount(up, minlength=n) > 0
                rest0 = np.maximum(node.zeros - np.bincount(up, below.zeros, n), 0)
                rest1 = np.maximum(node.ones - np.bincount(up, below.ones, n), 0)
                split = split + _log_kt(rest0, rest1)
                both = np.logaddexp(kt, split) - math.log(2)
                share = np.where(has, np.exp(kt - math.log(2) - both), 1.0)
                kt = np.where(has, both, kt)
            elif below_all is not None:
                both = np.logaddexp(kt, below_all[bits]) - math.log(2)
                share, kt = np.exp(kt - math.log(2) - both), both
            weighted.append(kt)
            own_share[d].append(share.astype(np.float32))
            if d < last:
                below.settle()
        longer = weighted
    for node in tree[0]:
        node.settle()
    return own_share, longer


def _mixed(tree: list[list[Nodes]], ups: list[list[np.ndarray]], own_share: list[list[np.ndarray]], tables: list[tuple[np.ndarray, np.ndarray]],
           before: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """log2 of the probability of each context and byte; and for nodes of the last depth, what longer contexts go on from."""
    values: list[np.ndarray] = []
    for d in range(len(tree)):
        value = np.zeros(len(tables[d][0]))
        after = []
        for bits in range(8):
            node, (mixed, left) = tree[d][bits], before[bits]
            estimate, share = node.one, own_share[d][bits]
            node.one = mixed + left * estimate
            at = np.searchsorted(node.keys, tables[d][0] >> U(8 - bits))
            bit = (tables[d][0] >> U(7 - bits) & U(1)).astype(bool)
            value += np.log2(np.where(bit, node.one[at], 1 - node.one[at]))
            after.append((mixed + left * share * estimate, left * (1 - share)))
            if d < len(tree) - 1:
                after[bits] = (after[bits][0][ups[d][bits]], after[bits][1][ups[d][bits]])
        values.append(value)
        before = after
    return values, before


def _model(tree: list[list[Nodes]], tables: list[tuple[np.ndarray, np.ndarray]], values: list[np.ndarray]) -> Model:
    return Model(len(tables) - 1, [k for k, _ in tables], values, [[(n.keys, n.one.astype(np.float32)) for n in level] for level in tree])


class Table:
    """Grams and their values in a hash table with one place for each; those that lose their place count as missed."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(len(keys) * 4).bit_length())
        place = self._place(keys)
        self.slot = np.full(1 << self.bits, U(2**64 - 1))
        self.value = np.zeros(1 << self.bits, np.float32)
        self.slot[place] = keys
        self.value[place] = values

    def _place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * U(0x9E3779B97F4A7C15) >> U(64 - self.bits)).astype(np.int64)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each gram, and which have none."""
        place = self._place(grams)
        return self.value[place].astype(np.float64), np.flatnonzero(self.slot[place] != grams)


class Scorer:
    """A model with its longest contexts in a hash table."""

    def __init__(self, model: Model):
        self.model = model
        self.table = Table(model.keys[-1], model.values[-1])

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 of the probability of each byte after its context."""
        out, missed = self.table.find(grams)
        if len(missed):
            unique, inverse = np.unique(grams[missed], return_inverse=True)
            out[missed] = self._looked_up(unique)[inverse]
        return out

    def _looked_up(self, grams: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(grams)), np.arange(len(grams))
        for d in range(self.model.depth, -1, -1):
            keys = self.model.keys[d]
            own = grams[open_] & U((1 << 8 * (d + 1)) - 1)
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[at] == own
            out[open_[hit]] = self.model.values[d][at[hit]]
            roots = self.model.nodes[d][0][0]
            known = roots[np.minimum(np.searchsorted(roots, own >> U(8)), len(roots) - 1)] == own >> U(8)
            odd = ~hit & known  # the context is known, but not with this byte
            out[open_[odd]] = self._by_bits(grams[open_[odd]], d)
            open_ = open_[~hit & ~known]
        out[open_] = -8.0  # nothing is known at all
        return out

    def _by_bits(self, grams: np.ndarray, depth: int) -> np.ndarray:
        """Each decision at the longest context that has met the bits before it."""
        out = np.zeros(len(grams))
        for bits in range(8):
            one, open_ = np.full(len(grams), 0.5), np.arange(len(grams))
            for d in range(depth, -1, -1):
                keys, ones = self.model.nodes[d][bits]
                if not len(keys):
                    continue
                own = (grams[open_] & U((1 << 8 * (d + 1)) - 1)) >> U(8 - bits)
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[at] == own
                one[open_[hit]] = ones[at[hit]]
                open_ = open_[~hit]
                if not len(open_):
                    break
            bit = (grams >> U(7 - bits) & U(1)).astype(bool)
            out += np.log2(np.where(bit, one, 1 - one))
        return out


def _threshold(sizes: DataFrame, most: int) -> int:
    """1, or the least power of two so that rows with a `total` from there on hold `most` entries at most."""
    level = F.floor(F.log2("total")).cast("int").alias("level")
    rows = sorted(sizes.groupBy(level).agg(F.sum("entries").alias("entries")).collect(), reverse=True)  # 63 rows at most
    used, least = 0, 62
    for level, entries in rows:
        if used + entries > most:
            return 1 << least
        used, least = used + entries, level
    return 1


def _mask(n: int) -> int:
    return (1 << 8 * n) - 1


def _by_subtree(rows: DataFrame, split: int, each: Callable[[np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """What `each` makes of `key` and `n` of whole subtrees: all rows whose contexts end in the same `split` bytes."""
    group = F.shiftright("key", 8).bitwiseAND(F.lit(_mask(split)).cast("long"))
    dealt = rows.select(group.alias("group"), "key", "n").repartition("group").sortWithinPartitions("group")
    chunk = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, enough = [], 0, chunk
        for batch in batches:
            held.append([batch.column(k).to_numpy() for k in range(3)])
            size += batch.num_rows
            if size < enough:
                continue
            group, key, n = (np.concatenate(c) for c in zip(*held, strict=True))
            cut = int(np.searchsorted(group, group[-1]))  # the last subtree may go on
            if cut:
                yield each(key[:cut].view(np.uint64), n[:cut])
            held, size = [[group[cut:], key[cut:], n[cut:]]], len(group) - cut
            enough = max(chunk, 2 * size)
        if size:
            _, key, n = (np.concatenate(c) for c in zip(*held, strict=True))
            yield each(key.view(np.uint64), n)

    return dealt.mapInArrow(run, schema)


def _tables_of(keys: np.ndarray, counts: np.ndarray, first: int, last: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted contexts with their byte and their counts, for depths from first to last."""
    return [_merged([keys & U(_mask(d + 1))], [counts]) for d in range(first, last + 1)]


@dataclass
class Trunk:
    """Contexts of fewer than `split` bytes; after: for nodes of the longest of them, what the subtrees go on from."""

    split: int
    model: Model
    after: list[tuple[np.ndarray, np.ndarray]]


def trunk(full: DataFrame, depth: int, split: int = SPLIT) -> Trunk:
    """Of all counts (`key`, `n`): the subtrees' log probabilities, summed at the nodes that they hang from."""
    split = min(split, depth)
    short = full.groupBy(F.col("key").bitwiseAND(F.lit(_mask(split)).cast("long")).alias("key")).agg(F.sum("n").alias("n")).toArrow() if split else None
    if not split or not len(short):
        return Trunk(split, Model(split - 1, [np.zeros(0, np.uint64)] * split, [np.zeros(0)] * split, [[(np.zeros(0, np.uint64), np.zeros(0, np.float32))] * 8] * split), [])

    def sums(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        tree = [_levels(k, n.astype(np.float64)) for k, n in _tables_of(keys, counts, split, depth)]
        _, longer = _shares(tree, _ups(tree, split))
        out = [_merged([tree[0][bits].keys & U((1 << (8 * (split - 1) + bits)) - 1)], [longer[bits]]) for bits in range(8)]
        return pa.record_batch({"bits": pa.array(np.repeat(np.arange(8, dtype=np.int32), [len(k) for k, _ in out])),
                                "node": pa.array(np.concatenate([k for k, _ in out]).view(np.int64)), "longer": pa.array(np.concatenate([x for _, x in out]))})

    found = _by_subtree(full, split, sums, "bits int, node long, longer double").groupBy("bits", "node").agg(F.sum("longer").alias("longer")).toArrow()
    bits, node, longer = (found[c].to_numpy() for c in ("bits", "node", "longer"))
    tables = _tables_of(short["key"].to_numpy().view(np.uint64), short["n"].to_numpy(), 0, split - 1)
    tree = [_levels(k, n.astype(np.float64)) for k, n in tables]
    below = []
    for k in range(8):
        own = np.flatnonzero(bits == k)
        below.append(longer[own[np.argsort(node[own])]])
    ups = _ups(tree)
    shares, _ = _shares(tree, ups, below)
    values, after = _mixed(tree, ups, shares, tables, [(np.zeros(len(n.keys)), np.ones(len(n.keys))) for n in tree[0]])
    return Trunk(split, _model(tree, tables, values), after)


def _grown(base: Trunk, keys: np.ndarray, counts: np.ndarray, depth: int) -> Model:
    """The trunk with some whole subtrees."""
    if not len(keys):
        more = depth + 1 - base.split
        none = [(np.zeros(0, np.uint64), np.zeros(0, np.float32))] * 8
        return Model(depth, base.model.keys + [np.zeros(0, np.uint64)] * more, base.model.values + [np.zeros(0)] * more, base.model.nodes + [none] * more)
    tables = _tables_of(keys, counts, base.split, depth)
    tree = [_levels(k, n.astype(np.float64)) for k, n in tables]
    ups = _ups(tree, base.split)
    shares, _ = _shares(tree, ups)
    before = []
    for bits, node in enumerate(tree[0]):
        if base.split:
            at = np.searchsorted(base.model.nodes[-1][bits][0], node.keys & U((1 << (8 * (base.split - 1) + bits)) - 1))
            before.append((base.after[bits][0][at], base.after[bits][1][at]))
        else:
            before.append((np.zeros(len(node.keys)), np.ones(len(node.keys))))
    values, _ = _mixed(tree, ups, shares, tables, before)
    own = _model(tree, tables, values)
    return Model(depth, base.model.keys + own.keys, base.model.values + own.values, base.model.nodes + own.nodes)


def probabilities(full: DataFrame, wanted: DataFrame, base: Trunk, depth: int) -> DataFrame:
    """`gram` and `value`, the log2 of its probability, for each `key` of `wanted`, by all counts (`key`, `n`)."""
    shared = full.sparkSession.sparkContext.broadcast(base)

    def run(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        asked, seen = keys[counts == 0], counts > 0
        value = Scorer(_grown(shared.value, keys[seen], counts[seen], depth)).log2(asked) if len(asked) else np.zeros(0)
        return pa.record_batch({"gram": pa.array(asked.view(np.int64)), "value": pa.array(value)})

    return _by_subtree(full.union(wanted.select("key", F.lit(0).cast("long"))), base.split, run, "gram long, value double")


def _table(name: str, keys: np.ndarray, values: np.ndarray) -> Table:
    """One for each worker process and run."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = Table(keys, values)
    return _tables[name]


def score(docs: DataFrame, training: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
          entries: int = ENTRIES, frequent: int = WORDS) -> DataFrame:
    """One row per document of `docs`, scored by what `training` teaches.

    Columns: `doc_id`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` (log10 of the probability) and
    `bits_per_byte`, the code length. `entries` and `frequent` bound what is sent to all tasks and change no result.
    """
    counts = stored(counted(training, text, depth), "counts")
    ends = training.count()
    full = counts.where("kind = 0").select("key", "n")
    base = trunk(full, depth)
    often = _threshold(full.select(F.col("n").alias("total"), F.lit(1).alias("entries")), entries)
    sent = probabilities(full, full.where(F.col("n") >= often), base, depth).toArrow()
    table = uuid.uuid4().hex, sent["gram"].to_numpy().view(np.uint64), sent["value"].to_numpy().astype(np.float32)
    words = counts.where("kind = 1").select(F.col("key").alias("word"), "n")
    found = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = found[0] + ends, found[1] + (ends > 0)
    least = _threshold(words.select(F.col("n").alias("total"), F.lit(1).alias("entries")), frequent)
    head = words.where(F.col("n") >= least).toArrow()
    keys, n = head["word"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(keys)
    total = tokens + 0.1 * (kinds + 1)
    shared = docs.sparkSession.sparkContext.broadcast((table, keys[order], np.log10((n[order] + 0.1) / total)))
    end_value = math.log10((ends + 0.1) / total)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys, logs = shared.value
        known = _table(*table)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("_text")
            for begin, end in blocks(texts, 1 << 20):
                words = Words(texts[begin:end], SPACES)
                grams, sizes = contexts(words, depth)
                value, missed = known.find(grams)
                value[missed] = 0
                bits = np.add.reduceat(value, np.cumsum(sizes) - sizes)
                open_ = np.concatenate([[0], np.searchsorted(missed, np.cumsum(sizes))])
                hashes, each = words.hashes(), np.diff(words.first)
                at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
                hit = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                text = words.text_of()
                base = np.bincount(text[hit], logs[at[hit]], end - begin) + end_value
                rare = np.bincount(text[~hit], minlength=end - begin)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rare)]), pa.int32()), pa.array(hashes[~hit].view(np.int64)))
                yield pa.record_batch({
                    "_row": pa.array(np.arange(row, row + end - begin)), "doc_id": batch.column("doc_id")[begin:end],
                    "n_tokens": pa.array(each + 1), "_known": pa.array(each - rare + (1 if ends else 0)), "_base": pa.array(base),
                    "_bits": pa.array(bits), "_bytes": pa.array(sizes), "_rare": lists,
                    "_grams": pa.ListArray.from_arrays(pa.array(open_, pa.int32()), pa.array(grams[missed].view(np.int64)))})
                row += end - begin

    kind = own.schema["doc_id"].dataType.simpleString()
    parts = stored(own.mapInArrow(
        run, f"_row long, doc_id {kind}, n_tokens long, _known long, _base double, _bits double, _bytes long, _rare array<long>, _grams array<long>"), "scored")
    rare = parts.select("_row", F.explode("_rare").alias("word")).join(words.where(F.col("n") < least), "word", "left")
    value = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.1)) / F.lit(total))
    grams = parts.select("_row", F.explode("_grams").alias("gram"))
    found = stored(probabilities(full, grams.select(F.col("gram").alias("key")).distinct(), base, depth), "grams")
    more = rare.select("_row", value.alias("value"), F.col("n").isNotNull().cast("long").alias("also"), F.lit(0.0).alias("bits")).union(
        grams.join(found, "gram").select("_row", F.lit(0.0), F.lit(0).cast("long"), F.col("value")))
    tail = more.groupBy("_row").agg(F.sum("value").alias("_more"), F.sum("also").alias("_also"), F.sum("bits").alias("_left"))
    bits = F.col("_bits") + F.coalesce("_left", F.lit(0.0))
    return parts.drop("_rare", "_grams").join(tail, "_row", "left").select(
        "doc_id", "n_tokens", (F.col("_known") + F.coalesce("_also", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"), (bits * math.log10(2)).alias("score"), (-bits / F.col("_bytes")).alias("bits_per_byte"))
