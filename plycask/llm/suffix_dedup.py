"""Removal of long byte strings that occur more than once, by a logarithmic family of suffix arrays.

Texts are cut into segments, and those whose bytes recur as a whole are settled by counting (see
``repeats``).  The other segments with a recurring anchor meet by that anchor in a task of the suffix
index.  There, every batch that arrives gets a suffix array of its window starts: in the order of their bytes,
with the length of the prefix that each shares with the one before (as far as a window goes).  Neighbours that
share a whole window are long matches.  The array is then scanned against the levels that exist, as
windows that a level has too are long matches.  What is new becomes a level, and levels of about equal size
are merged, so that there are never more than logarithmically many and every entry is merged logarithmically often.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plycask.llm import repeats
from plycask.llm.scratch import Scratch
from plycask.llm.segments import Shape
from plycask.llm.words import freeing, mix, slices

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: A 64-bit hash of each byte.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass
class Level:
    """A suffix array: starts of different windows in the order of their bytes, the first eight bytes of each as a number, and the bytes each shares with the one before."""

    at: np.ndarray
    first: np.ndarray
    shared: np.ndarray

    def __len__(self) -> int:
        return len(self.at)


class LogarithmicIndex:
    """Levels of suffix arrays over a growing store of bytes, and which window starts were seen to repeat."""

    def __init__(self, shape: Shape):
        self.window = shape.window
        #: Where the eights of a window begin; the last ones may overlap.
        self.eights = [*range(0, self.window - 7, 8)] + ([self.window - 8] if self.window % 8 else [])
        self.store = np.zeros(1 << 16, np.uint8)
        self.repeated = np.zeros(1 << 16, bool)
        self.size = 0
        self.levels: list[Level] = []

    def _append(self, data: bytes) -> int:
        base, self.size = self.size, self.size + len(data)
        size = len(self.store)
        while self.size + 8 > size:
            size *= 2
        if size > len(self.store):
            for name in ("store", "repeated"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros(size - len(old), old.dtype)]))
        self.store[base : self.size] = np.frombuffer(data, np.uint8)
        return base

    def _keys(self, at: np.ndarray) -> np.ndarray:
        """The eight bytes at each place as a number in whose order they are."""
        return np.ndarray(len(self.store) - 7, ">u8", self.store.data, strides=(1,))[at].astype(np.uint64)

    def array(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window starts in the order of their bytes, eight more at a time for those that are alike so far, and the bytes that each shares with the one before."""
        at = at.copy()
        alike = np.ones(len(at), bool)  # with the one before, as far as was looked
        alike[:1] = False
        shared = np.zeros(len(at), np.int16)
        for offset in self.eights:
            open_ = np.flatnonzero(alike | np.append(alike[1:], False))
            if not len(open_):
                break
            group = np.cumsum(~alike[open_])
            keys = self._keys(at[open_] + offset)
            order = np.lexsort((keys, group))
            at[open_], keys = at[open_[order]], keys[order]
            inner = np.flatnonzero(alike[open_])
            differing = keys[inner] ^ keys[inner - 1]
            apart = differing != 0
            where = open_[inner[apart]]
            shared[where] = offset + (differing[apart].astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
            alike[where] = False
        shared[alike] = self.window
        return at, shared

    def _find(self, level: Level, at: np.ndarray) -> np.ndarray:
        """For each start the place in the level of the same window, -1 where it has none."""
        found = np.full(len(at), -1, np.int64)
        keys = self._keys(at)
        low, high = np.searchsorted(level.first, keys, "left"), np.searchsorted(level.first, keys, "right")
        left = np.flatnonzero(low < high)
        low, high = low[left], high[left]
        for offset in self.eights[1:]:
            if not len(left):
                break
            keys = self._keys(at[left] + offset)
            low, high = (self._bound(level, offset, keys, low, high, after) for after in (False, True))
            inside = low < high
            left, low, high = left[inside], low[inside], high[inside]
        found[left] = low
        return found

    def _bound(self, level: Level, offset: int, keys: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
        """Within each range the first place whose eight bytes at the offset are not less, or are greater, by bisection of all ranges at a time."""
        low, high = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            there = self._keys(level.at[middle] + offset)
            less = there <= keys[open_] if after else there < keys[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        return low

    def add(self, contents: list[bytes]) -> int:
        """Adds a batch and marks its windows, and those of the levels, that repeat; returns where it starts in the store."""
        data = b"".join(contents)
        base = self._append(data)
        sizes = np.fromiter(map(len, contents), np.int64, len(contents))
        n = np.maximum(0, sizes - self.window + 1)
        starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(np.cumsum(sizes) - sizes, n)
        at, shared = self.array(starts + base)
        # Within the batch: neighbours that share a window.
        twins = np.flatnonzero(shared == self.window)
        self.repeated[at[twins]] = True
        self.repeated[at[twins - 1]] = True
        at = at[shared < self.window]
        for level in self.levels:
            place = self._find(level, at)
            hit = place >= 0
            # The level and what is left of the batch have each window once; other starts of it in the batch are marked already.
            self.repeated[level.at[place[hit]]] = True
            self.repeated[at[hit]] = True
            at = at[~hit]
        self.levels.append(self._level(at))
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            self.levels.append(self._level(np.concatenate([self.levels.pop().at, self.levels.pop().at])))
        return base

    def _level(self, at: np.ndarray) -> Level:
        at, shared = self.array(at)
        return Level(at, self._keys(at), shared)


def _compared(segs: DataFrame, measure: repeats.Measure) -> DataFrame:
    """Spans of repeated windows in the segments that are not settled; all segments of an anchor are in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LogarithmicIndex(measure.shape)
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            units = batch.column("units").to_pylist()
            base = index.add(units)
            sizes = np.fromiter(map(len, units), np.int64, len(units))
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("node", "twin", "first", "windows")]
            open_ = columns[2] >= 0
            rows.append((*(column[open_] for column in columns), (base + np.cumsum(sizes) - sizes)[open_]))
        for node, twin, first, windows, at in rows:
            owner = np.repeat(np.arange(len(at)), windows)
            ahead = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            hit = index.repeated[at[owner] + ahead]
            owner, ahead = owner[hit], ahead[hit]
            new = np.append(True, (owner[1:] != owner[:-1]) | (ahead[1:] != ahead[:-1] + 1))[: len(owner)]
            start = np.flatnonzero(new)
            last = np.append(start[1:], len(owner))[: len(start)] - 1
            of = owner[start]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[of]), pa.array(twin[of]), pa.array(first[of] + ahead[start]), pa.array(first[of] + ahead[last] + measure.shape.window)], names=["node", "twin", "start", "stop"]
            )

    return segs.repartition("anchor").select("node", "twin", "first", "windows", "units").mapInArrow(freeing(run), repeats.FOUND)


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [text.encode() for text in texts]
    return _BYTES[np.frombuffer(b"".join(data), np.uint8)], np.array([len(x) for x in data], np.int64)


def _raw(texts: list[str]) -> bytes:
    return "".join(texts).encode()


def _finish(text: str) -> tuple[int, str]:
    data = text.encode()
    return len(data), repeats.sha256(data)


def repeated_spans(docs: DataFrame, window: int = 200, anchor: int = 32, hot: int = 500) -> tuple[DataFrame, DataFrame]:
    """The rows of texts with repeated windows, with their spans (of bytes), and the rows of all others, as repeats.send makes them."""
    measure = repeats.Measure(Shape(window, anchor), _units, _raw, hot=hot)
    scratch = Scratch(docs.sparkSession, "suffix")
    own = repeats.keyed(docs)
    second = repeats.send(own, repeats.states(own, measure, scratch), measure, scratch, _finish)
    scratch.drop("flags")
    segs = second.where("kind = 'segs'").groupBy("anchor", "content").agg(*(F.first(name).alias(name) for name in ("node", "twin", "first", "windows", "units")))
    found = scratch.save(_compared(segs, measure), "found")
    found = found.union(repeats.repeated_windows(second, measure, scratch).select("node", "twin", "start", "stop"))
    return repeats.with_spans(second, found, scratch), second.where("kind = 'done'")


def drop_repeats(docs: DataFrame, window: int = 200, anchor: int = 32, hot: int = 500, with_text: bool = False) -> DataFrame:
    """Every text without the bytes that a repeated string of window bytes covers.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the remaining bytes),
    and kept (binary) if with_text.  A string is repeated if it starts anywhere else too, in any text
    or the same one; strings lie within one text and are judged on the input.  A null text counts as
    empty; a null doc_id stays null; repeated rows each give a row and are copies of each other; an empty
    table gives no row.  Only doc_id and text are read.
    """
    some, none = repeated_spans(docs, window, anchor, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            rows = []
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), repeats.all_spans(batch), strict=True):
                data = text.encode()
                edges = [0, *spans.ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc_id, len(data), len(data) - len(kept), len(spans), repeats.sha256(kept), kept if with_text else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    cut = some.select("doc_id", "text", "spans", "more").mapInArrow(freeing(run), f"{SCHEMA}, kept binary")
    zero = F.lit(0).cast("long")
    whole = none.select("doc_id", F.col("n_units").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"))
    if not with_text:
        return cut.drop("kept").union(whole)
    texts = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("kept"), F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256")).distinct()
    return cut.union(whole.join(texts, ["doc_id", "kept_sha256"]).select(*cut.columns))
