"""Removal of repeated byte strings by a logarithmic family of sparse suffix arrays.

Suffixes are kept at anchors only.  An anchor is the k-gram with the least hash in a window of `length` bytes, so equal
windows have equal anchors at equal places.  Each anchor owns a run of consecutive windows; the bytes of the run are its
segment.  A task sorts the suffixes of each batch by their bytes, scans them against its levels byte for byte, and merges
levels of equal size.  What a task hands on of a segment that it saw first is a fingerprint (of the gram and of the segment, 128 bits
together) and where it stands, some 40 bytes however long the match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreframe.llm.common import materialise, row_key, slices

GRAM = 32
#: Bytes that make a batch; a longer document makes several, which overlap by a window.
BATCH_BYTES = 1 << 20
#: Entries in a task's levels, beyond which they're handed on and started anew.
TASK_ENTRIES = 2_000_000
#: Segments of an anchor beyond which its windows are spread over tasks: a task compares few groups at a time, an anchor's segments being one.
CROWDED = 1000
#: Such windows that a task holds to tell which is the first of each string: so one string has few rows of each task.
SINGLE = 100_000
#: Bytes of compressed texts that a task unpacks at a time.
PACKED_BYTES = 1 << 19
_LOW = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial fingerprints modulo 2^64 of any piece of a byte array, by prefix sums."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int) -> None:
        n = len(data)
        if base not in self._powers or len(self._powers[base][0]) <= n:
            size = max(n + 1, BATCH_BYTES + 4096)
            ups = np.full(size, base, np.uint64)
            downs = np.full(size, pow(base, -1, 1 << 64), np.uint64)
            ups[0] = downs[0] = 1
            self._powers[base] = np.cumprod(ups), np.cumprod(downs)
        self.up, self.down = self._powers[base]
        table = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base)) | np.uint64(1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * self.up[:n], out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        return _mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])

    def pieces(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


_ONE, _TWO = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def _segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of the pieces data[offsets[i]:offsets[i + 1]]: fingerprints of the anchor and of the segment, the anchor, first window and number of windows."""
    span = length - GRAM + 1
    first = Rolling(data, _ONE)
    grams = first.grams(GRAM)
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(keys) // span) + 1
    table = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    table[: len(keys)] = keys
    table = table.reshape(rows, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    owner = (np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]) & _LOW).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)
    np.add.at(valid, offsets[:-1], 1)
    np.add.at(valid, np.minimum(offsets[1:] - length + 1, n), -1)
    at = np.flatnonzero(np.cumsum(valid)[:n] > 0)
    own = owner[at]
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))))
    begin, many = at[new], np.diff(np.append(new, len(at)))
    return grams[own[new]], Rolling(data, _TWO).pieces(begin, begin + many - 1 + length), own[new], begin, many


#: at: where the suffix starts in the level's text; left, right: bytes of the segment before and from there; first: its first 8 bytes.
ENTRY = np.dtype([("first", np.uint64), ("at", np.int64), ("left", np.int32), ("right", np.int32), ("h", np.uint64), ("seg", np.uint64), ("doc", np.int64), ("row", np.int64), ("pos", np.int64), ("n", np.int32)])
_PAD = np.zeros(512, np.uint8)
_EIGHT = np.arange(8)


def _word(text: np.ndarray, entries: np.ndarray, k: int, steps: int) -> np.ndarray:
    """The k-th part of what entries are ordered by: the bytes of the segment from the anchor on, 8 at a time, its sizes, the bytes before."""
    if k == steps:
        return entries["right"].astype(np.uint64) << np.uint64(32) | entries["left"].astype(np.uint64)
    begin, size = (entries["at"], entries["right"]) if k < steps else (entries["at"] - entries["left"], entries["left"])
    at = 8 * (k if k < steps else k - steps - 1) + _EIGHT
    found = text[begin[:, None] + at]
    found[at[None, :] >= size[:, None]] = 0
    return np.ascontiguousarray(found).view(">u8").ravel().astype(np.uint64)


def _same(a_text: np.ndarray, a: np.ndarray, b_text: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the segments of a and b have the same bytes on both sides of their anchors; fingerprints that differ spare the look."""
    same = (a["h"] == b["h"]) & (a["seg"] == b["seg"]) & (a["left"] == b["left"]) & (a["right"] == b["right"])
    look = np.flatnonzero(same)
    for at in range(0, len(look), 4096):
        part = look[at : at + 4096]
        size = a["left"][part] + a["right"][part]
        step = np.arange(int(size.max()))
        alike = a_text[(a["at"] - a["left"])[part, None] + step] == b_text[(b["at"] - b["left"])[part, None] + step]
        same[part] = (alike | (step >= size[:, None])).all(axis=1)
    return same


#: Parts that are alike, from which on whole segments are compared before further parts.
_LONG = 4


def suffix_order(text: np.ndarray, entries: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the entries by their bytes, and the place of the first of those that are equal to each in it.

    Parts of 8 bytes are sorted one after another, each only where all before are alike.
    """
    order = np.argsort(entries["first"], kind="stable")
    keys = entries["first"][order]
    head = np.concatenate(([True], keys[1:] != keys[:-1])) if len(order) else np.zeros(0, bool)
    group = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0)) if len(order) else order
    slots = np.flatnonzero(~head | np.concatenate((~head[1:], [False])))
    for k in range(1, 2 * steps + 1):
        if k == _LONG and len(slots):
            equal = _same(text, entries[order[slots]], text, entries[order[group[slots]]])
            starts = np.flatnonzero(slots == group[slots])
            whole = np.logical_and.reduceat(equal, starts)
            slots = slots[~np.repeat(whole, np.diff(np.append(starts, len(slots))))]  # groups of equal ones are settled
        if not len(slots):
            break
        live, of = order[slots], group[slots]
        keys = _word(text, entries[live], k, steps)
        again = np.lexsort((keys, of))
        order[slots], keys = live[again], keys[again]
        head = np.concatenate(([True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])))
        group[slots] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        slots = slots[~head | np.concatenate((~head[1:], [False]))]
    return order, group


class Level:
    """A sparse suffix array: a text, and entries in the order of their bytes, no two of them equal."""

    def __init__(self, text: np.ndarray, entries: np.ndarray) -> None:
        self.text, self.entries = text, entries

    def _range(self, key: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, steps: int, right: bool) -> np.ndarray:
        """For each key the place in low..high from which on k-th parts aren't less than it (right: are greater)."""
        low, high = low.copy(), high.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) // 2
            its = _word(self.text, self.entries[middle], k, steps)
            before = its <= key[live] if right else its < key[live]
            low[live[before]] = middle[before] + 1
            high[live[~before]] = middle[~before]
            live = live[low[live] < high[live]]
        return low

    def equal(self, text: np.ndarray, entries: np.ndarray, steps: int) -> np.ndarray:
        """Scan sorted entries against this level: for each the place of an equal one, or -1.

        Both are in the same order, so what has the same beginning is a range here, which the next 8 bytes narrow down.
        """
        low = np.searchsorted(self.entries["first"], entries["first"], side="left")
        high = np.searchsorted(self.entries["first"], entries["first"], side="right")
        out = np.full(len(entries), -1)
        for k in range(1, 2 * steps + 1):
            if k == _LONG:
                single = np.flatnonzero(high - low == 1)
                equal = _same(text, entries[single], self.text, self.entries[low[single]])
                out[single[equal]] = low[single[equal]]
                high[single] = low[single]
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            key = _word(text, entries[live], k, steps)
            begin = self._range(key, low[live], high[live], k, steps, False)
            low[live], high[live] = begin, self._range(key, begin, high[live], k, steps, True)
        return np.where(low < high, low, out)


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of a stand before those of b: under a smaller id, in a row of it that sorts first, or in the same row further ahead."""
    return (a["doc"] < b["doc"]) | ((a["doc"] == b["doc"]) & ((a["row"] < b["row"]) | ((a["row"] == b["row"]) & (a["pos"] < b["pos"]))))


class Levels:
    """The levels of one task: suffix arrays whose sizes fall geometrically.

    add() sorts a batch, drops to `repeats` what stands earlier in it or in a level, scanning it against each, and merges
    levels of equal size.  An entry that turns out to stand before one in a level takes its place.
    """

    def __init__(self, length: int) -> None:
        self.steps = -(-(2 * length - GRAM) // 8)
        self.levels: list[Level] = []
        self.repeats: list[np.ndarray] = []

    def add(self, text: np.ndarray, batch: np.ndarray) -> None:
        text = np.concatenate((text, _PAD))
        batch = batch[np.lexsort((batch["pos"], batch["row"], batch["doc"]))]  # so that the first of equal ones stands first
        batch["first"] = _word(text, batch, 0, self.steps)
        order, group = suffix_order(text, batch, self.steps)
        batch = batch[order]
        first = batch[group]
        # the same place of two rows with the same id and text isn't a repeat
        self.repeats.append(batch[_before(first, batch)])
        batch = batch[group == np.arange(len(batch))]
        for level in self.levels:
            at = level.equal(text, batch, self.steps)
            mine, its = batch[at >= 0], at[at >= 0]
            other = level.entries[its]
            earlier = _before(mine, other)
            self.repeats += [other[earlier], mine[_before(other, mine)]]
            for name in ("doc", "row", "pos"):
                level.entries[name][its[earlier]] = mine[name][earlier]
            batch = batch[at < 0]
        if len(batch):
            self.levels.append(Level(text, batch))
        while len(self.levels) > 1 and len(self.levels[-1].entries) * 2 > len(self.levels[-2].entries):
            b, a = self.levels.pop(), self.levels.pop()
            b.entries["at"] += len(a.text)
            both, joined = np.concatenate((a.text, b.text)), np.concatenate((a.entries, b.entries))
            self.levels.append(Level(both, joined[suffix_order(both, joined, self.steps)[0]]))

    def __len__(self) -> int:
        return sum(len(level.entries) for level in self.levels)

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        """What stands first in this task, and runs of windows known to be repeats; then starts anew.

        Of an anchor with several segments one is handed on under the anchor (ALONE or, if there are others, MIXED); the
        others already know that they are to be compared (APART), so an anchor has a row for each task at most.
        """
        if self.levels:
            held = np.concatenate([level.entries for level in self.levels])
            held = held[np.argsort(held["h"], kind="stable")]
            new = np.concatenate(([True], held["h"][1:] != held["h"][:-1]))
            more = np.concatenate((~new[1:], [False]))
            kind = np.where(new, np.where(more, MIXED, ALONE), APART)
            yield _rows(np.where(new, held["h"], _spread(held)), np.where(new, held["seg"], held["h"]), held, held["n"], kind)
        if self.repeats:
            old = np.concatenate(self.repeats)
            old = old[np.lexsort((old["pos"], old["row"], old["doc"]))]
            doc, row, begin, end = old["doc"], old["row"], old["pos"], old["pos"] + old["n"]
            new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (begin[1:] > end[:-1])))) if len(old) else np.zeros(0, np.int64)
            if len(new):
                end = np.maximum.reduceat(end, new)
                old = old[new]
                yield _rows(_spread(old), np.zeros(len(old), np.uint64), old, end - old["pos"], np.full(len(old), KNOWN))
        self.levels, self.repeats = [], []


ALONE, MIXED, APART, KNOWN = range(4)
_ROWS = "k long, seg long, doc long, row long, place long"


def _spread(entries: np.ndarray) -> np.ndarray:
    return _mix(entries["row"].view(np.uint64) * np.uint64(_TWO) + entries["doc"].view(np.uint64) + (entries["pos"].astype(np.uint64) << np.uint64(20)))


def _rows(k: np.ndarray, seg: np.ndarray, entries: np.ndarray, n: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    """Entries as they're shuffled; place holds the first window, the number of windows and the kind."""
    place = (entries["pos"] << 32) | (n.astype(np.int64) << 2) | kind
    columns = (k.astype(np.uint64).view(np.int64), seg.astype(np.uint64).view(np.int64), entries["doc"], entries["row"], place)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x), pa.int64()) for x in columns], names=["k", "seg", "doc", "row", "place"])


def _batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bytes, offsets of the pieces, and the id, row and place of each; texts without a window are left out."""
    data, places, held = [], [], 0

    def done() -> tuple[np.ndarray, ...]:
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in data])))
        return np.frombuffer(b"".join(data), np.uint8), offsets, *np.array(places, np.int64).T

    for batch in batches:
        for part in slices(batch):
            for doc, row, text in zip(*[x.to_pylist() for x in part.columns], strict=True):
                raw = (text or "").encode()
                for at in range(0, len(raw) - length + 1, BATCH_BYTES):
                    piece = raw[at : at + BATCH_BYTES + length - 1]
                    if held and held + len(piece) > BATCH_BYTES:
                        yield done()
                        data, places, held = [], [], 0
                    data.append(piece)
                    places.append((doc, row, at))
                    held += len(piece)
    if held:
        yield done()


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Levels(length)
        for data, offsets, docs, rows, places in _batches(batches, length):
            h, seg, at, begin, many = _segments(data, offsets, length)
            piece = np.searchsorted(offsets, begin, side="right") - 1
            entries = np.zeros(len(h), ENTRY)
            entries["h"], entries["seg"], entries["n"], entries["at"] = h, seg, many, at
            entries["left"], entries["right"] = at - begin, begin + many - 1 + length - at
            entries["doc"], entries["row"], entries["pos"] = docs[piece], rows[piece], begin - offsets[piece] + places[piece]
            family.add(data, entries)
            if len(family) > TASK_ENTRIES:
                yield from family.hand_on()
        yield from family.hand_on()

    return run


def _windows(data: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each window."""
    return Rolling(data, _ONE).pieces(begin, begin + length), Rolling(data, _TWO).pieces(begin, begin + length)


def _behind(one: np.ndarray, two: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of windows: the indices of the first of each string, of those that stand behind another at a different place, and of the ones those follow."""
    order = np.lexsort((pos, row, doc, two, one))
    a, b = order[:-1], order[1:]
    again = np.concatenate(([False], (one[a] == one[b]) & (two[a] == two[b])))[: len(order)]
    moved = np.concatenate(([False], (doc[a] != doc[b]) | (row[a] != row[b]) | (pos[a] != pos[b])))[: len(order)]
    # rows with the same id and text stand at the same places: each of them follows what stands before all of them
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(order)))) if len(order) else order
    first = order[head]
    later = again & ((doc[first] != doc[order]) | (row[first] != row[order]) | (pos[first] != pos[order])) if len(order) else again & moved
    return order[~again], order[later], first[later]


def _runs(doc: np.ndarray, row: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Single windows as runs of consecutive ones."""
    order = np.lexsort((pos, row, doc))
    doc, row, pos = doc[order], row[order], pos[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (pos[1:] > pos[:-1] + 1)))) if len(doc) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(doc)) - 1
    return doc[new], row[new], pos[new], (pos[last] - pos[new] + 1 if len(new) else new)


_PARTS = ("h", "doc", "row", "pos", "n")


def _parts(*columns: np.ndarray, raw: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(x), pa.int64()) for x in columns], pa.array(raw, pa.binary())], names=[*_PARTS, "raw"])


def _cut_out(length: int):
    """Of the listed segments: n > 0: the bytes of the segment, by anchor; n = 0: a window of a crowded anchor, by fingerprint, of each string the
    first of the task (of SINGLE such windows at a time); n < 0: a run of -n windows that are repeats."""
    most = SINGLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        single: dict[tuple[int, int], tuple[int, int, int]] = {}

        def firsts() -> pa.RecordBatch:
            places = np.array(list(single.values()), np.int64).reshape(-1, 3)
            one, two = (np.array([k[i] for k in single], np.uint64) for i in range(2))
            return _parts(one.view(np.int64), *places.T, np.zeros(len(places)), raw=[x.tobytes() for x in two])

        for batch in batches:
            for part in slices(batch, "raw", PACKED_BYTES):
                few: list[tuple] = []
                many: list[tuple[np.ndarray, ...]] = []
                for doc, row, packed, runs in zip(*[part.column(x).to_pylist() for x in ("key", "row", "raw", "runs")], strict=True):
                    raw = unpack(packed)
                    few += [(r["h"], doc, row, r["pos"], r["n"], raw[r["pos"] : r["pos"] + r["n"] - 1 + length]) for r in runs if not r["crowded"]]
                    crowded = [np.arange(r["pos"], r["pos"] + r["n"]) for r in runs if r["crowded"]]
                    if crowded:
                        begin = np.concatenate(crowded)
                        many.append((*_windows(np.frombuffer(raw, np.uint8), begin, length), np.full(len(begin), doc), np.full(len(begin), row), begin))
                if few:
                    *columns, raws = zip(*few, strict=True)
                    yield _parts(*[np.array(x, np.int64) for x in columns], raw=list(raws))
                if many:
                    one, two, docs, rows, pos = (np.concatenate(x) for x in zip(*many, strict=True))
                    first, behind, _ = _behind(one, two, docs, rows, pos)
                    later = []
                    for key, place in zip(zip(one[first].tolist(), two[first].tolist(), strict=True), zip(docs[first].tolist(), rows[first].tolist(), pos[first].tolist(), strict=True), strict=True):
                        known = single.setdefault(key, place)
                        if place > known:
                            later.append(place)
                        elif place < known:
                            single[key] = place
                            later.append(known)
                    more = np.array(later, np.int64).reshape(-1, 3).T
                    docs, rows, pos, n = _runs(*(np.concatenate((x[behind], y)) for x, y in zip((docs, rows, pos), more, strict=True)))
                    if len(single) > most:
                        yield firsts()
                        single.clear()
                    if len(docs):
                        yield _parts(_mix(rows.view(np.uint64) * np.uint64(_TWO) + pos.astype(np.uint64)).view(np.int64), docs, rows, pos, -n, raw=[b""] * len(docs))
        if single:
            yield firsts()

    return run


def _alike(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the windows that start at a and b have the same bytes."""
    step = np.arange(length)
    parts = [(data[a[i : i + 8192, None] + step] == data[b[i : i + 8192, None] + step]).all(axis=1) for i in range(0, len(a), 8192)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _compared(parts: pa.Table, length: int) -> pa.RecordBatch | None:
    """Runs of windows (doc, row, pos, n) that stand behind an equal one, among parts that hold whatever shares an h with one of them."""
    h, doc, row, pos, n = (parts.column(x).to_numpy() for x in _PARTS)
    known, single, whole = n < 0, n == 0, np.flatnonzero(n > 0)
    raw = parts.column("raw").combine_chunks()
    out = [(doc[known], row[known], pos[known], -n[known])]
    if len(whole):
        raws = [x.as_py() for x in raw.take(pa.array(whole))]
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        starts, count = np.cumsum(sizes) - sizes, n[whole]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        docs, rows, places, begin = np.repeat(doc[whole], count), np.repeat(row[whole], count), np.repeat(pos[whole], count) + step, np.repeat(starts, count) + step
        data = np.frombuffer(b"".join(raws), np.uint8)
        _, behind, first = _behind(*_windows(data, begin, length), docs, rows, places)
        behind = behind[_alike(data, begin[behind], begin[first], length)]
        out.append(_runs(docs[behind], rows[behind], places[behind]))
    if single.any():
        two = np.frombuffer(b"".join([x.as_py() for x in raw.filter(pa.array(single))]), np.uint64)
        _, behind, _ = _behind(h[single].view(np.uint64), two, doc[single], row[single], pos[single])
        out.append(_runs(doc[single][behind], row[single][behind], pos[single][behind]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["doc", "row", "pos", "n"]) if len(columns[0]) else None


def _compare(length: int):
    """Parts come sorted by h; as many whole groups as there are in a few batches are compared at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in slices(batch, "raw", 1 << 19):
                h = part.column("h").to_numpy()
                begin = int(np.searchsorted(h, h[-1]))  # its last group may go on
                if begin == 0 and held and held[-1].column("h")[-1].as_py() != h[0]:
                    done, held = held, [part]
                elif begin:
                    done, held = [*held, part.slice(0, begin)], [part.slice(begin)]
                else:
                    held.append(part)
                    continue
                if out := _compared(pa.Table.from_batches(done), length):
                    yield out
        if held and (out := _compared(pa.Table.from_batches(held), length)):
            yield out

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are told apart by id and text: (key, row), in that order."""
    return docs.select(row_key().alias("key"), F.xxhash64(F.col("text").cast("string")).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _pack(docs: DataFrame) -> DataFrame:
    """(key, row, doc_id, raw): the text compressed, as it is to be shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch):
                raw = pa.array([pack((t or "").encode()) for t in part.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], raw], names=["key", "row", "doc_id", "raw"])

    return _keyed(docs).mapInArrow(run, "key long, row long, doc_id long, raw binary")


def _repeats(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows as tasks hand them on: runs that stand behind an equal one, and segments that share their anchor with an unequal one.

    Under an anchor there is a row for each task at most, so the window has no group that grows with the rows of a passage.
    """
    kind = F.col("place").bitwiseAND(F.lit(3))
    far = (kind >= APART).alias("far")
    group, line = Window.partitionBy("k", "far"), Window.partitionBy("k", "far").orderBy("seg", "doc", "row", "place")
    place = F.struct("doc", "row", F.shiftright("place", 32).alias("pos"))
    head = F.first(place).over(Window.partitionBy("k", "far", "seg").orderBy("doc", "row", "place"))
    seen = rows.select("*", far).select("*", F.lag("seg").over(line).alias("last"), head.alias("head"), F.min("seg").over(group).alias("lo"), F.max("seg").over(group).alias("hi"), F.max((kind == MIXED).cast("int")).over(group).alias("mixed"))
    same = F.col("last").eqNullSafe(F.col("seg"))
    again = (kind == KNOWN) | (~F.col("far") & same & (F.col("head") != place))
    apart = (kind == APART) | (~F.col("far") & ~same & ((F.col("lo") != F.col("hi")) | (F.col("mixed") == 1)))
    pos, n = F.shiftright("place", 32).alias("pos"), F.shiftright("place", 2).bitwiseAND(F.lit((1 << 30) - 1)).alias("n")
    kept = materialise(seen.where(again | apart).select(F.when(kind == APART, F.col("seg")).otherwise(F.col("k")).alias("h"), "doc", "row", pos, n, again.alias("again")), "repeats")
    return kept.where("again").select("doc", "row", "pos", "n"), kept.where("not again").select("h", "doc", "row", "pos", "n")


def repeated_windows(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc, row, pos, n): runs of n windows from pos on, in the row with this key, each of which also starts earlier.

    Every task is a writer of its own levels, so a passage that a third of all documents hold leaves a task once, and the last
    merge is Spark's shuffle by anchor.  Segments equal to an earlier one are repeats as a whole.  Where segments with one
    anchor differ, as at the ends of a match, their windows are compared one by one: beside each other where the anchor has
    few segments, else spread by window.
    """
    scanned = _keyed(docs).where(F.octet_length("text") >= length).select(F.col("key").alias("doc"), "row", "text")
    again, mixed = _repeats(scanned.mapInArrow(_scan(length), _ROWS))
    crowds = mixed.groupBy("h").agg(F.count("*").alias("many")).where(F.col("many") > CROWDED).select("h", F.lit(True).alias("crowded"))
    mixed = mixed.join(crowds, "h", "left").na.fill(False, ["crowded"])
    runs = mixed.groupBy("doc", "row").agg(F.collect_list(F.struct("h", "pos", "n", "crowded")).alias("runs")).withColumnRenamed("doc", "key")
    held = _pack(docs.where(F.octet_length("text") >= length)).select("key", "row", "raw").dropDuplicates(["key", "row"]).join(runs.hint("merge"), ["key", "row"]).select("key", "row", "raw", "runs")
    parts = held.mapInArrow(_cut_out(length), "h long, doc long, row long, pos long, n long, raw binary").repartition("h").sortWithinPartitions("h")
    return again.union(parts.mapInArrow(_compare(length), "doc long, row long, pos long, n long"))


def _merged(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Byte ranges that the windows of the runs cover, merged."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((r["pos"], r["pos"] + r["n"] - 1 + length) for r in runs or []):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def remove_repeats(docs: DataFrame, length: int = 100, with_bytes: bool = False) -> DataFrame:
    """Remove each byte of documents(doc_id, text) that lies in a string of `length` bytes that also starts earlier.

    Earlier: under a smaller doc_id, or in the same document at a smaller place.  Returns doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs) and kept_sha256, with_bytes also `kept`, the bytes that are left (they needn't be valid
    UTF-8).  A null text is empty; texts shorter than `length` lose nothing.  Rows without doc_id sort first, by a hash of their
    text.  Rows that share a doc_id but not a text are documents of their own, ordered by a hash of the text; rows with the same
    doc_id and text are one document: no place of it is earlier than itself, so they fare alike.  Other columns are ignored.
    """
    runs = repeated_windows(docs, length).groupBy("doc", "row").agg(F.collect_list(F.struct("pos", "n")).alias("runs")).withColumnRenamed("doc", "key")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_bytes]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in slices(batch, "raw", PACKED_BYTES):
                out = []
                for doc, packed, found in zip(*[part.column(x).to_pylist() for x in ("doc_id", "raw", "runs")], strict=True):
                    raw = unpack(packed)
                    spans = _merged(found, length)
                    kept = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(b for b, _ in spans), len(raw)], strict=True))
                    out.append((doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)[: len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types, strict=False)], names=names)

    return _pack(docs).join(runs.hint("merge"), ["key", "row"], "left").select("doc_id", "raw", "runs").mapInArrow(run, schema)
