"""Stateful per-key patterns on streams.

Rows of a key come unordered within a micro-batch. They wait in state until the watermark has
passed their time and are then taken in (time, sequence) order, so a stream gives the results
of the batch forms.

Waiting rows are kept in chunks by time slot: what comes in is added as a chunk, nothing that waits is written
again. Slots are worked off one after the other: a task holds the rows of one slot of one key at a time, not
those of a whole key, and gives its results row by row. The rest stays in the state store, on disk where it is
large. A key has one live timer, the earliest time at which it has something to do.

On a stream (`follow`) many keys share a group, dealt by a hash, with one timer and one set of slots (`Grouped`): what a
state store costs is paid per group and slot and not per key. The number of groups has to grow with the rows. Rows come to
a processor in packs, one Arrow table for the rows of a group in a stretch of the input, and wait as such: Spark hands rows
to a processor one by one, which costs more than all that is done with them. Neighbouring slots of a group may wait as one
chunk while they have few rows (``share``): the chunks then follow the rows, however long a time these are spread over.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY = 86_400_000_000  # microseconds

WAITING = "rows array<struct<us:bigint,seq:bigint,kind:string>>"

#: Groups that the keys of a stream are dealt to unless stated.
GROUPS = 128

#: A waiting row of a group, and by what rows are put in order (nulls first).
ROW = pa.schema([("us", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("key", pa.string())])
IN_ORDER = [(name, "ascending") for name in ROW.names]

#: Rows that a task holds until it packs them.
PACK_ROWS = 250_000


class InOrder(StatefulProcessor):
    """Feeds the rows of a key to ``step`` in time order and keeps one small memory per key.

    Subclasses name the fields of the memory, turn a row into output rows (``step``) and say
    which deadline the memory waits for (``deadline``) and what passing it gives (``expire``).
    Times are epoch microseconds; timers, which Spark keeps in milliseconds, are rounded up.
    """

    memory = "last long"
    fields = ("key", "seq", "outcome")
    output = "key string, seq long, outcome string"
    slot = timedelta(hours=1) // timedelta(microseconds=1)  # rows of a key in one slot must fit in memory
    hold = 100_000  # incoming rows of a key held before they go to state
    lead = 0  # by how much (microseconds) the watermark is behind what is worked off, so that results are not late for a next step
    event_time = ""  # the output's time column, if a next step needs one

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = [f.split()[0] for f in self.memory.split(", ")]
        self.attach(handle)
        self.waiting = handle.getMapState("waiting", "slot bigint, chunk int", WAITING)
        self.chunks = handle.getMapState("chunks", "slot bigint", "n int")
        self.kept = handle.getValueState("kept", self.memory)
        self.alarm = handle.getValueState("alarm", "ms bigint")

    def attach(self, handle: StatefulProcessorHandle) -> None:
        """States of a pattern's own; they may serve many keys."""

    def close(self) -> None:
        pass

    def step(self, key, mem: dict, us: int, seq: int, kind: str) -> Iterator[tuple]:
        raise NotImplementedError

    def deadline(self, mem: dict) -> int | None:
        return None

    def expire(self, key, mem: dict) -> Iterator[tuple]:
        return iter(())

    def _wake(self, us: int) -> None:
        """Have the key's one timer go off at this time, or earlier if it is set so."""
        at = -(-(us - self.lead) // 1000)
        old = self.alarm.get()[0] if self.alarm.exists() else None
        if old is not None and old <= at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def _add(self, slot: int, rows: list[tuple]) -> None:
        n = self.chunks.getValue((slot,))[0] if self.chunks.containsKey((slot,)) else 0
        self.waiting.updateValue((slot, n), (rows,))
        self.chunks.updateValue((slot,), (n + 1,))

    def _store(self, fresh: dict[int, list[tuple]]) -> None:
        for slot, rows in fresh.items():
            self._add(slot, rows)

    def _take(self, slot: int) -> list[tuple]:
        """The rows of a slot in order; they leave the state."""
        rows = []
        for n in range(self.chunks.getValue((slot,))[0]):
            rows += map(tuple, self.waiting.getValue((slot, n))[0])
            self.waiting.removeKey((slot, n))
        self.chunks.removeKey((slot,))
        return sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: dict[int, list[tuple]] = {}
        held, first = 0, None
        if key[1]:  # the end of the input: it moves the watermark and is nothing else
            return iter(())
        for r in rows:
            us = r["us"]
            fresh.setdefault(us // self.slot, []).append((us, r["seq"], r["kind"]))
            first = us if first is None else min(first, us)
            held += 1
            if held % self.hold == 0:
                self._store(fresh)
                fresh = {}
        self._store(fresh)
        if first is not None:
            self._wake(first)
        return iter(())

    def _due(self, mark: int) -> Iterator[tuple]:
        """Waiting rows up to the watermark in order; they leave the state."""
        slots = sorted(k[0] for k in self.chunks.keys())
        for slot in slots:
            if slot * self.slot > mark:
                self._wake(slot * self.slot)
                return
            rows = self._take(slot)
            left = [r for r in rows if r[0] > mark]
            yield from rows[: len(rows) - len(left)]
            if left:
                self._add(slot, left)
                self._wake(left[0][0])
                return

    def _outcomes(self, key, mem: dict, mark: int) -> Iterator[tuple]:
        for us, seq, kind in self._due(mark):
            # Deadlines before this row have passed first.
            while (limit := self.deadline(mem)) is not None and limit <= us:
                yield from self.expire(key, mem)
            yield from self.step(key, mem, us, seq, kind)
        while (limit := self.deadline(mem)) is not None and limit <= mark:
            yield from self.expire(key, mem)
        if limit is not None:
            self._wake(limit)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.alarm.clear()
        kept = self.kept.get() if self.kept.exists() else None
        mem = dict(zip(self.names, kept)) if kept else dict.fromkeys(self.names)
        for k, *rest in self._outcomes(key, mem, timerValues.getCurrentWatermarkInMs() * 1000 + self.lead):
            yield Row(**dict(zip(self.fields, (k, *rest), strict=True)))
        if any(v is not None for v in mem.values()):
            self.kept.update(tuple(mem[n] for n in self.names))
        else:
            self.kept.clear()


class NewVisitor(InOrder):
    """Keeps the mark ``1`` of a device's first marked row, corrects later ones to ``0``."""

    memory = "seen long"

    def step(self, key, mem, us, seq, kind):
        flag = kind
        if kind == "1":
            flag = "0" if mem["seen"] else "1"
            mem["seen"] = 1
        yield key[0], seq, flag


def _day_end(day: int | None, offset: int) -> int | None:
    """A day's memory is of no more use once the watermark has passed the day."""
    return None if day is None else (day + 1) * DAY - offset


class DailyVisit(InOrder):
    """The first row of each device and day (days in UTC, shifted by ``offset``)."""

    memory = "day long"

    def __init__(self, offset: timedelta = timedelta(0)):
        self.offset = offset // timedelta(microseconds=1)

    def deadline(self, mem):
        return _day_end(mem["day"], self.offset)

    def expire(self, key, mem):
        mem["day"] = None
        return iter(())

    def step(self, key, mem, us, seq, kind):
        day = (us + self.offset) // DAY
        if mem["day"] is None or day > mem["day"]:
            mem["day"] = day
            yield key[0], seq, kind


class Bounce(InOrder):
    """Entry pages (kind ``entry``) followed by another entry page or by nothing in time."""

    memory = "since long, seq long"

    def __init__(self, within: timedelta):
        self.within = within // timedelta(microseconds=1)

    def deadline(self, mem):
        return None if mem["since"] is None else mem["since"] + self.within

    def expire(self, key, mem):
        yield key[0], mem["seq"], "timeout"
        mem["since"] = mem["seq"] = None

    def step(self, key, mem, us, seq, kind):
        if mem["since"] is not None and kind == "entry":
            yield key[0], mem["seq"], "entry"
        mem["since"], mem["seq"] = (us, seq) if kind == "entry" else (None, None)


class LoginGuard(InOrder):
    """One alert per run of failures, at the first two of them within the time."""

    memory = "last long, alerted long"

    def __init__(self, within: timedelta):
        self.within = within // timedelta(microseconds=1)

    def deadline(self, mem):
        # A failure is forgotten after the time; a run that was reported is kept until its end.
        return None if mem["last"] is None or mem["alerted"] else mem["last"] + self.within

    def expire(self, key, mem):
        mem["last"] = None
        return iter(())

    def step(self, key, mem, us, seq, kind):
        if kind == "success":
            mem["last"] = mem["alerted"] = None
            return
        if mem["last"] is not None and not mem["alerted"] and us - mem["last"] < self.within:
            mem["alerted"] = 1
            yield key[0], seq, "alert"
        mem["last"] = us


class PayNext(InOrder):
    """A creation directly followed by a payment in time (``matched``), or by nothing (``timeout``)."""

    memory = "since long, seq long"

    def __init__(self, within: timedelta):
        self.within = within // timedelta(microseconds=1)

    def deadline(self, mem):
        return None if mem["since"] is None else mem["since"] + self.within

    def expire(self, key, mem):
        yield key[0], mem["seq"], "timeout"
        mem["since"] = mem["seq"] = None

    def step(self, key, mem, us, seq, kind):
        if mem["since"] is not None and kind == "pay":
            yield key[0], mem["seq"], "matched"
        mem["since"], mem["seq"] = (us, seq) if kind == "create" else (None, None)


class OrderWatch(InOrder):
    """Creation and payment of an order: normal, late, cancelled, or pay_only."""

    memory = "created long, paid long"

    def __init__(self, rule: timedelta, timer: timedelta):
        self.rule, self.timer = (d // timedelta(microseconds=1) for d in (rule, timer))

    def deadline(self, mem):
        # Two events exactly ``timer`` apart still meet, hence the extra microsecond.
        since = mem["created"] if mem["created"] is not None else mem["paid"]
        return None if since is None else since + self.timer + 1

    def expire(self, key, mem):
        yield key[0], 0, "cancelled" if mem["created"] is not None else "pay_only"
        mem["created"] = mem["paid"] = None

    def step(self, key, mem, us, seq, kind):
        mem["created" if kind == "create" else "paid"] = us
        if mem["created"] is not None and mem["paid"] is not None:
            yield key[0], 0, "normal" if mem["paid"] - mem["created"] <= self.rule else "late"
            mem["created"] = mem["paid"] = None


class ClickLimit(InOrder):
    """Clicks of a (user, advert) per day: ``normal`` below the limit, one ``alert`` at it, then ``dropped`` if wanted."""

    memory = "day long, n long"

    def __init__(self, limit: int, offset: timedelta = timedelta(0), rest: bool = False):
        self.limit, self.offset, self.rest = limit, offset // timedelta(microseconds=1), rest

    def deadline(self, mem):
        return _day_end(mem["day"], self.offset)

    def expire(self, key, mem):
        mem["day"] = mem["n"] = None
        return iter(())

    def step(self, key, mem, us, seq, kind):
        day = (us + self.offset) // DAY
        mem["n"] = mem["n"] + 1 if mem["day"] == day else 1
        mem["day"] = day
        if mem["n"] <= self.limit:
            yield key[0], seq, "normal" if mem["n"] < self.limit else "alert"
        elif self.rest:
            yield key[0], seq, "dropped"


class FailureRuns(InOrder):
    """Every sequence of two or more failures in a row that starts and ends within the time.

    A failure gives one row for each start that is still open. Starts are kept until the time has passed or a
    success ends the run, so the memory follows the failures within the time and not the length of a run.
    """

    memory = "pos long, starts array<struct<us:bigint,pos:bigint>>"
    fields = ("key", "first_pos", "last_pos", "start_us", "end_us")
    output = "key string, first_pos long, last_pos long, start_us long, end_us long"

    def __init__(self, within: timedelta):
        self.within = within // timedelta(microseconds=1)

    def step(self, key, mem, us, seq, kind):
        mem["pos"] = (mem["pos"] or 0) + 1
        if kind == "success":
            mem["starts"] = None
            return
        live = [(t, p) for t, p in mem["starts"] or () if us - t < self.within]
        for t, p in live:
            yield key[0], p, mem["pos"], t, us
        mem["starts"] = [*live, (us, mem["pos"])]


class Pairing(InOrder):
    """Pairs the n-th ``left`` row of a key with its n-th ``right`` row, whichever comes first.

    Rows without a partner wait in a queue. Its two ends, of ``part`` rows at most, are held with the memory of the key, what is
    between them in parts of their own that are written once. A row that has waited for ``wait`` is given alone and leaves;
    without such a time all wait until their partner comes.
    """

    memory = ("side string, nth long, last long, low long, high long, "
              "front array<struct<us:bigint,seq:bigint>>, back array<struct<us:bigint,seq:bigint>>")
    fields = ("key", "nth", "left_seq", "right_seq")
    output = "key string, nth long, left_seq long, right_seq long"
    part = 1000

    def __init__(self, wait: timedelta | None):
        self.wait = None if wait is None else wait // timedelta(microseconds=1)

    def attach(self, handle):
        self.queue = handle.getMapState("queue", "key string, n bigint", "rows array<struct<us:bigint,seq:bigint>>")

    def _push(self, key, mem, row):
        if not mem["front"]:
            mem["front"] = [row]
            return
        mem["back"].append(row)
        if len(mem["back"]) >= self.part:
            self.queue.updateValue((json.dumps(key[0]), mem["high"]), (mem["back"],))
            mem["high"], mem["back"] = mem["high"] + 1, []

    def _first(self, key, mem):
        """The first row that waits; it leaves the queue, whose front (kept last row first) is empty only if the queue is."""
        _, seq = mem["front"].pop()
        if not mem["front"] and mem["low"] < mem["high"]:
            at = (json.dumps(key[0]), mem["low"])
            mem["front"] = [tuple(r) for r in reversed(self.queue.getValue(at)[0])]
            self.queue.removeKey(at)
            mem["low"] += 1
        elif not mem["front"]:
            mem["front"], mem["back"] = mem["back"][::-1], []
        return seq

    def deadline(self, mem):
        if self.wait is None or mem["last"] is None:
            return None
        return self.wait + (mem["front"][-1][0] if mem["front"] else mem["last"])

    def expire(self, key, mem):
        if not mem["front"]:  # a key that rests is forgotten
            mem.update(dict.fromkeys(mem))
            return
        seq = self._first(key, mem)
        yield (key[0], None, seq, None) if mem["side"] == "left" else (key[0], None, None, seq)

    def step(self, key, mem, us, seq, kind):
        if mem["last"] is None:
            mem.update(nth=0, low=0, high=0, front=[], back=[])
        mem["last"] = us
        if mem["front"] and mem["side"] != kind:
            other = self._first(key, mem)
            mem["nth"] += 1
            yield (key[0], mem["nth"], seq, other) if kind == "left" else (key[0], mem["nth"], other, seq)
        else:
            mem["side"] = kind
            self._push(key, mem, (us, seq))


class VisitorMeasures(InOrder):
    """Five measures of a device's pages, with the new-visitor mark corrected: for window sums further down the stream.

    A row's ``kind`` is a JSON text: ``page`` and ``entry`` (whether it is one), ``is_new``, ``vc``, ``ch``, ``ar``, ``dur``. A page
    gives its view, its part of unique and entering visits and its duration at once, and one more row with a bounce when
    that is known, both at the page's own time. The watermark therefore stays ``within`` behind, and no result is late.
    """

    memory = "flagged long, day long, since long, fields string"
    fields = ("vc", "ch", "ar", "is_new", "at", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
    output = "vc string, ch string, ar string, is_new string, at timestamp, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long"
    event_time = "at"

    def __init__(self, within: timedelta, offset: timedelta = timedelta(0)):
        self.within, self.offset = (d // timedelta(microseconds=1) for d in (within, offset))
        self.lead = self.within + 1_000_000

    def deadline(self, mem):
        return None if mem["since"] is None else mem["since"] + self.within

    def expire(self, key, mem):
        yield (*json.loads(mem["fields"]), _utc(mem["since"]), 0, 0, 0, 1, 0)
        mem["since"] = mem["fields"] = None

    def step(self, key, mem, us, seq, kind):
        row = json.loads(kind)
        is_new = row.get("is_new")
        if is_new == "1":
            is_new = "0" if mem["flagged"] else "1"
            mem["flagged"] = 1
        if not row["page"]:
            return
        entry, own = row["entry"], [row.get("vc"), row.get("ch"), row.get("ar"), is_new]
        if mem["since"] is not None and entry:
            yield from self.expire(key, mem)
        day = (us + self.offset) // DAY
        yield (*own, _utc(us), int(mem["day"] is None or day > mem["day"]), 1, int(entry), 0, row.get("dur") or 0)
        mem["day"] = day
        mem["since"], mem["fields"] = (us, json.dumps(own)) if entry else (None, None)


def _utc(us: int) -> datetime:
    """A time for an output row; sessions of this package are in UTC."""
    return datetime(1970, 1, 1) + timedelta(microseconds=us)


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ROW) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _values(column: pa.ChunkedArray) -> list:
    """A column as Python values; text goes by way of Numpy, as do numbers, which would be floats there if some were null."""
    if pa.types.is_string(column.type):
        return column.to_numpy().tolist()
    values = column.fill_null(0).to_numpy().tolist()
    if column.null_count:
        for n in np.flatnonzero(column.is_null().to_numpy()).tolist():
            values[n] = None
    return values


def _spans(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """From where to where a sorted array holds the same value."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]).tolist() if len(values) else []
    return zip(starts, [*starts[1:], len(values)])


def _shared(spans: Iterable[tuple[int, int]], most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring spans as one, as long as it is no longer than ``most``."""
    low = end = 0
    for start, end in spans:
        if end - low > most and start > low:
            yield low, start
            low = start
    if end > low:
        yield low, end


def _packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their group, ``part``, as one row per group and so many rows; those that close the input are left out."""
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.take(pa.array(np.argsort(table["part"].to_numpy(), kind="stable"))).combine_chunks()
        parts, rows = table["part"].to_numpy(), table.select(ROW.names).cast(ROW)
        spans = list(_spans(parts))
        return pa.record_batch([pa.array([parts[low] for low, _ in spans], pa.int32()),
                                pa.array([_to_bytes(rows.slice(low, high - low)) for low, high in spans], pa.binary())], ["part", "pack"])

    held, n = [], 0
    for batch in batches:
        held.append(batch.filter(pc.invert(batch["closing"])))
        n += held[-1].num_rows
        if n >= PACK_ROWS:
            yield packed(held)
            held, n = [], 0
    if n:
        yield packed(held)


class Grouped(InOrder):
    """A pattern over many keys at once: the keys of a group share their slots, one timer and one entry of memories.

    Rows come in packs and wait as Arrow tables. A task holds one slot of one group, of which some rows at a time as
    Python objects, and the memories of its keys. A row is too late if the watermark was at its time or past it when its
    group was last worked off.

    A chunk holds neighbouring slots while they have ``share`` rows at most, and is found by the first of them. What a chunk
    has beyond the next chunk's first slot is held until that comes. Of rows that came in many parts, whose chunks are held
    together, the n-th part's share only an n-th.
    """

    batch = 20_000  # rows of a result frame, rows taken out of a slot at a time

    def __init__(self, pattern: InOrder, share: int = 0):
        self.pattern, self.slot, self.lead, self.event_time = pattern, pattern.slot, pattern.lead, pattern.event_time
        self.share = share
        self.fields, self.output = pattern.fields, pattern.output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = [f.split()[0] for f in self.pattern.memory.split(", ")]
        self.pattern.attach(handle)
        self.waiting = handle.getMapState("waiting", "slot bigint, chunk int", "rows binary")
        self.chunks = handle.getMapState("chunks", "slot bigint", "n int")
        self.kept = handle.getValueState("kept", "memories binary")
        self.done = handle.getValueState("done", "ms bigint")
        self.alarm = handle.getValueState("alarm", "ms bigint")

    def _add(self, slot: int, rows: pa.Table) -> None:
        n = (self.chunks.getValue((slot,)) or (0,))[0]
        self.waiting.updateValue((slot, n), (_to_bytes(rows),))
        self.chunks.updateValue((slot,), (n + 1,))

    def _take(self, slot: int) -> pa.Table:
        tables = []
        for n in range(self.chunks.getValue((slot,))[0]):
            tables.append(_from_bytes(self.waiting.getValue((slot, n))[0]))
            self.waiting.removeKey((slot, n))
        self.chunks.removeKey((slot,))
        return pa.concat_tables(tables)

    def _by_slot(self, tables: list[pa.Table], late: int | None, share: int) -> None:
        rows = pa.concat_tables(tables)
        us = rows["us"].to_numpy()
        order = np.argsort(us, kind="stable")
        if late is not None:
            order = order[us[order] > late]
        if not len(order):
            return
        rows, us = rows.take(pa.array(order)).combine_chunks(), us[order]
        slots = us // self.slot
        for low, high in _shared(_spans(slots), share):
            self._add(int(slots[low]), rows.slice(low, high - low))
        self._wake(int(us[0]))

    @staticmethod
    def _tables(frame: pd.DataFrame) -> list[pa.Table]:
        """The packs of a frame, or its rows, of which ``numbered``, ``known`` and ``named`` say what is not null."""
        if "pack" in frame:
            return [_from_bytes(pack) for pack in frame["pack"]]
        columns = [pa.array(frame["us"], pa.int64())]
        columns += [pa.array(frame[c], ROW.field(c).type, mask=~frame[there].to_numpy(bool), from_pandas=True)
                    for c, there in (("seq", "numbered"), ("kind", "known"), ("key", "named"))]
        return [pa.table(columns, schema=ROW)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done = self.done.get()
        late = None if done is None else done[0] * 1000
        tables, held, part = [], 0, 1
        for frame in rows:
            for table in self._tables(frame):
                tables.append(table)
                held += table.num_rows
                if held >= self.hold:
                    self._by_slot(tables, late, self.share // part)
                    tables, held, part = [], 0, part + 1
        if held:
            self._by_slot(tables, late, self.share // part)
        return iter(())

    def _due(self, mark: int) -> Iterator[pa.Table]:
        """Waiting rows up to the watermark in order, so many at a time; they leave the state."""
        slots = sorted(k[0] for k in self.chunks.keys())
        due = [slot for slot in slots if slot * self.slot <= mark]
        rest = ROW.empty_table()
        for slot, after in zip(due, [*due[1:], None]):
            rows = pa.concat_tables([rest, self._take(slot)]).combine_chunks()
            rows = rows.take(pc.sort_indices(rows, sort_keys=IN_ORDER, null_placement="at_start"))
            upto = mark if after is None else after * self.slot - 1
            cut = int(np.searchsorted(rows["us"].to_numpy(), upto, side="right"))
            for low in range(0, cut, self.batch):
                yield rows.slice(low, min(self.batch, cut - low))
            rest = rows.slice(cut)
        left = [slot * self.slot for slot in slots[len(due) :][:1]]
        if rest.num_rows:
            left.append(rest["us"][0].as_py())
            self._add(left[-1] // self.slot, rest)
        if left:
            self._wake(min(left))

    def _results(self, mems: dict, mark: int) -> Iterator[list[tuple]]:
        step, expire, deadline, new = self.pattern.step, self.pattern.expire, self.pattern.deadline, dict.fromkeys(self.names)
        for rows in self._due(mark):
            coded = rows["key"].combine_chunks().dictionary_encode("encode")
            own = [((key,), mems.setdefault((key,), dict(new))) for key in coded.dictionary.to_pylist()]
            found: list[tuple] = []
            for us, seq, kind, code in zip(_values(rows["us"]), _values(rows["seq"]), _values(rows["kind"]), coded.indices.to_numpy().tolist()):
                key, mem = own[code]
                # Deadlines of the key before this row have passed first.
                while (limit := deadline(mem)) is not None and limit <= us:
                    found += expire(key, mem)
                for result in step(key, mem, us, seq, kind):
                    found.append(result)
                    if len(found) >= self.batch:
                        yield found
                        found = []
            yield found
        first, found = None, []
        for key, mem in mems.items():
            while (limit := deadline(mem)) is not None and limit <= mark:
                found += expire(key, mem)
                if len(found) >= self.batch:
                    yield found
                    found = []
            if limit is not None and (first is None or limit < first):
                first = limit
        yield found
        if first is not None:
            self._wake(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        now, entry = timerValues.getCurrentWatermarkInMs(), self.kept.get()
        kept = {} if entry is None else pickle.loads(entry[0])
        mems = {k: dict(zip(self.names, values)) for k, values in kept.items()}
        for rows in filter(None, self._results(mems, now * 1000 + self.lead)):
            yield pd.DataFrame({name: pd.Series(column, dtype=object) for name, column in zip(self.fields, zip(*rows), strict=True)})
        self.done.update((now,))
        left = {k: tuple(mem.values()) for k, mem in mems.items() if any(v is not None for v in mem.values())}
        if left:
            self.kept.update((pickle.dumps(left),))
        elif entry is not None:
            self.kept.clear()


class PaneSums(StatefulProcessor):
    """Sums of sliding windows from slide-wide panes, of which a key holds ``size / slide`` at most.

    Each pane comes once, already summed. A window's sum is the one before, plus the pane that enters, less the one
    that leaves, so a window costs two panes and not ``size / slide``. A key without panes keeps nothing.
    """

    output = "key string, window_end long, total long"

    def __init__(self, size: timedelta, slide: timedelta):
        self.size, self.slide = (d // timedelta(microseconds=1) for d in (size, slide))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "start bigint", "n bigint")
        self.kept = handle.getValueState("kept", "next bigint, total bigint, alarm bigint")  # the next window's end, the sum of the one before

    def close(self) -> None:
        pass

    def _keep(self, at: int, total: int, alarm: int | None) -> None:
        """Remember the state, with one timer at the end of the next window."""
        due = -(-at // 1000)
        if alarm != due:
            if alarm is not None:
                self.handle.deleteTimer(alarm)
            self.handle.registerTimer(due)
        self.kept.update((at, total, due))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, total, alarm = self.kept.get() if self.kept.exists() else (None, 0, None)
        for r in rows:
            start = r["us"]
            old = self.panes.getValue((start,))[0] if self.panes.containsKey((start,)) else 0
            self.panes.updateValue((start,), (old + r["n"],))
            at = start + self.slide if at is None else min(at, start + self.slide) if total == 0 else at
        if at is not None:
            self._keep(at, total, alarm)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        at, total, _ = self.kept.get()
        starts = sorted(k[0] for k in self.panes.keys())
        while at <= mark:
            enters, leaves = (at - self.slide,), (at - self.slide - self.size,)
            if self.panes.containsKey(enters):
                total += self.panes.getValue(enters)[0]
            if self.panes.containsKey(leaves):
                total -= self.panes.getValue(leaves)[0]
                self.panes.removeKey(leaves)
                starts.remove(leaves[0])
            if total:
                yield Row(key=key[0], window_end=at, total=total)
                at += self.slide
            elif starts:
                at = max(at + self.slide, starts[0] + self.slide)
            else:
                self.kept.clear()
                return
        self._keep(at, total, None)


class Versions(StatefulProcessor):
    """Changes of keyed rows with the row before and after, on top of a snapshot that the state starts from.

    A change no newer than what is known is left out, so a log that overlaps the snapshot gives each version once.
    """

    output = "key string, version long, op string, before string, after string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "version bigint, value string")

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.update((initialState["version"], initialState["value"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old, before = self.known.get() if self.known.exists() else (None, None)
        for version, value in sorted(((r["version"], r["value"]) for r in rows), key=lambda r: (r[0], r[1] is not None, r[1] or "")):
            if old is not None and version <= old:
                continue
            if before is not None or value is not None:
                yield Row(key=key[0], version=version, op="insert" if before is None else "delete" if value is None else "update", before=before, after=value)
            old, before = version, value
        if old is not None:
            self.known.update((old, before))


def changes_on_snapshot(changes: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Both with ``key`` (text), ``version`` (long) and ``value`` (text; null for a deletion); the snapshot has a key once."""
    names = ["key", "version", "value"]
    return changes.select(*names).groupBy("key").transformWithState(
        Versions(), T.StructType.fromDDL(Versions.output), "Update", "None", snapshot.select(*names).groupBy("key"))


def pane_sums(panes: DataFrame, key: str, at: str, start: str, n: str, size: timedelta, slide: timedelta) -> DataFrame:
    """``key``, ``window_end`` (epoch microseconds) and ``total`` of all windows that hold rows.

    panes: one row per key (a text) and pane, with its watermarked time, its start in epoch microseconds and its sum.
    """
    rows = panes.select(F.col(key).alias("key"), F.col(at).alias("at"), F.col(start).alias("us"), F.col(n).cast("long").alias("n"))
    return rows.groupBy("key").transformWithState(PaneSums(size, slide), T.StructType.fromDDL(PaneSums.output), "Append", "EventTime")


def follow(df: DataFrame, key: str | Column, ts: str, seq: str | Column, kind: str | Column, delay: timedelta,
           processor: InOrder, slot: timedelta | None = None, closing: str | None = None, groups: int = GROUPS, share: int = 0) -> DataFrame:
    """Run a processor over a stream; gives its fields, the key as text.

    ``slot`` is the time slot waiting rows are kept by: short for busy keys, long for quiet ones. Rows where ``closing``
    holds move the watermark and are nothing else. Rows without a key are a key of their own. ``groups`` is how many groups the
    keys are dealt to; a task holds a slot of one at a time, so there should be one for some ten thousand rows of a
    micro-batch. It stays fixed for a checkpoint. Neighbouring slots of a group wait together while they have ``share`` rows
    at most, for rows that are spread over many slots.
    """
    from tillstream.functions.times import epoch_micros, interval_text

    if slot is not None:
        processor.slot = slot // timedelta(microseconds=1)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(
        as_column(key).cast("string").alias("key"), F.lit(False).alias("closing") if closing is None else F.coalesce(closing, F.lit(False)).alias("closing"),
        F.col(ts).cast("timestamp").alias("at"), epoch_micros(F.col(ts)).alias("us"),
        as_column(seq).cast("long").alias("seq"), as_column(kind).alias("kind"),
    ).withWatermark("at", interval_text(delay + timedelta(microseconds=processor.lead)))
    dealt = rows.where("us IS NOT NULL").select(
        F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("part"), "closing", "at", "us", "seq", "kind", "key")
    packed = dealt.select("part", "closing", "us", "seq", "kind", "key").mapInArrow(_packs, "part int, pack binary")
    return packed.groupBy("part").transformWithStateInPandas(
        Grouped(processor, share), T.StructType.fromDDL(processor.output), "Append", "EventTime", eventTimeColumnName=processor.event_time)
