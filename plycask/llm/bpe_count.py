"""Token counts by byte-pair merging, without producing identifiers.

A vocabulary of byte-pair pieces orders all merges by score.  A stretch of text starts as a
doubly linked list of characters; a heap holds the adjacent pairs that form a piece, and the
pair of lowest rank (the leftmost of equal ones) is popped and merged until none is left.
The count is the number of initial symbols less the number of merges, where a character
outside the vocabulary stands for as many symbols as it has UTF-8 bytes.

No piece of the vocabulary has the space mark after another character, so stretches that
begin with the marks before a word are independent of each other, and a bounded memo keeps
the counts of those already seen.  ``PieceVocabulary`` checks this when it is read and takes
each text as one stretch where it does not hold.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from plycask.llm.words import Memo, freeing, texts_of

SPACE_MARK = "▁"
#: Piece types of the model file: only these take part in merges (the others are unknown, control and single bytes).
_NORMAL, _USER_DEFINED, _UNUSED = 1, 4, 5

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = {1: 8, 5: 4}[kind]
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class PieceVocabulary:
    """Merge ranks of a piece model with byte fallback and no normalisation but marked spaces."""

    def __init__(self, model: bytes):
        pieces: list[tuple[str, float]] = []
        normaliser: dict[int, int | bytes] = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                if piece.get(3, _NORMAL) == _USER_DEFINED:
                    raise ValueError("user-defined pieces are matched before merging, which is not supported")
                if piece.get(3, _NORMAL) in (_NORMAL, _UNUSED):
                    pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0]))
            elif number == 3:
                normaliser = dict(_fields(value))
        if normaliser.get(1) != b"identity" or normaliser.get(4, 1):
            raise ValueError("only models that leave the text as it is are supported")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        order = {score: rank for rank, score in enumerate(sorted({score for _, score in pieces}, reverse=True))}
        #: Equal scores have equal ranks, so that the leftmost pair goes first.
        self.rank = {piece: order[score] for piece, score in pieces if len(piece) > 1}
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        merging = set("".join(self.rank))
        inner = any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in self.rank)
        alone = "".join(c for c in "\n\t\r" if c not in merging)
        alone = re.escape(alone)
        self.spaced = not inner
        self.stretches = re.compile(
            r"(?s).+" if inner else rf"{SPACE_MARK}*[^{SPACE_MARK}{alone}]+|{SPACE_MARK}+" + (rf"|[{alone}]" if alone else "")
        )

    def symbols(self, char: str) -> int:
        return 1 if char in self.single else len(char.encode())

    def count_stretch(self, text: str) -> int:
        """Initial symbols less merges."""
        n, rank, single = len(text), self.rank, self.single
        count = n
        for char in text:
            if char not in single:
                count += len(char.encode()) - 1
        if n < 2:
            return count
        heap = []
        left = text[0]
        for i in range(1, n):
            right = text[i]
            r = rank.get(left + right)
            if r is not None:
                heap.append((r, i - 1))
            left = right
        if not heap:
            return count
        symbol = list(text)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i = pop(heap)
            first = symbol[i]
            if first is None:
                continue
            j = after[i]
            if j >= n:
                continue
            merged = first + symbol[j]
            if rank.get(merged) != r:
                continue  # one of the two has been merged with another neighbour since
            symbol[i] = merged
            symbol[j] = None
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(merged + symbol[k])
                if r is not None:
                    push(heap, (r, i))
            h = before[i]
            if h >= 0:
                r = rank.get(symbol[h] + merged)
                if r is not None:
                    push(heap, (r, h))
        return count

    def counter(self):
        """A function from a text to its number of tokens."""
        stretch = Memo(self.count_stretch, 12 << 20).__getitem__
        stretches, prefix = self.stretches.findall, SPACE_MARK if self.dummy_prefix else ""

        def whole(text: str) -> int:
            return sum(map(stretch, stretches(text)))

        after_space = Memo(lambda chunk: whole(SPACE_MARK + chunk), 48 << 20).__getitem__

        def count(text: str) -> int:
            if not text:
                return 0
            if not self.spaced or not prefix or text[0] == " " or "  " in text or SPACE_MARK in text:
                return whole(prefix + text.replace(" ", SPACE_MARK))
            return sum(map(after_space, text.split(" ")))  # single spaces: each chunk has one mark before it

        return count


def _counter(path: str):
    with open(path, "rb") as file:
        return PieceVocabulary(file.read()).counter()


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Bytes and tokens of every whole text.

    model_path is a file of the machine image, on every executor.  Columns: doc_id, n_bytes (UTF-8),
    n_tokens, over_limit (n_tokens > limit).  A null text counts as empty, with no token; a null doc_id
    stays null; repeated rows each give a row; an empty table gives no row.  Only doc_id and text are read.
    One narrow stage, no shuffle; a worker keeps one batch and a bounded memo.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(model_path)
        for batch, texts in texts_of(batches):
            tokens = [count(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(freeing(run), SCHEMA)
