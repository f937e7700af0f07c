"""What the operators share about text: blanks, words, batches of Arrow rows, memory of a task and 64-bit mixing."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Space, tab, line feed, vertical tab, form feed and carriage return: the only characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_U64 = np.uint64


def collapse(text: Column) -> Column:
    """text with each run of blanks as one space; null as the empty string."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " ")


def split_words(text: str | None) -> list[str]:
    """The words of a text, which str.split() would also cut at other Unicode blanks and at \\x1c-\\x1f."""
    if not text:
        return []
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    for blank in BLANKS[1:]:
        if blank in text:
            text = text.replace(blank, " ")
    return [word for word in text.split(" ") if word]


#: Bytes that an entry of a memo takes, about, and characters of the longest argument that is remembered.
_ENTRY, LONGEST_KEY = 200, 64


class Memo(dict):
    """A function's values by argument, in about ``most`` bytes: what was not asked for since half of that came in is forgotten.  Long arguments are not remembered."""

    def __init__(self, function, most: int = 24 << 20):
        super().__init__()
        self._function, self._limit = function, most // 2 // _ENTRY
        self._older: dict = {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._function(key)
            if len(key) > LONGEST_KEY:
                return value
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


def freeing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, after which the worker gives its free memory back: Spark keeps workers for the tasks of later stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)

    return task


def word_hashes(words: list[str], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype=_U64, count=len(words))


def hash_memo() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values after which every bit depends on all (the finaliser of SplitMix64)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def slices(whole: pa.RecordBatch, most: int = 4 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch with texts of about most bytes together, or a single row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < whole.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield whole.slice(at, stop - at)
        at = stop


def texts_of(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches, in slices of some megabytes, with their texts; a null text counts as empty."""
    for whole in batches:
        for batch in slices(whole, column=column):
            yield batch, [text or "" for text in batch.column(column).to_pylist()]
