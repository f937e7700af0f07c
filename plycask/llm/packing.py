"""Packing of token sequences in tiers of context sizes.

Documents are tokenised and end with a separator.  What fills whole windows of the largest tier goes
there directly; the rest of a document is routed to the smallest tier that holds it.  Tiers are packed from
the longest down, each in windows of its own size: a rest opens a window, and the gap behind it is filled from
the shorter tiers, by the longest rest that fits, and where none does by part of a shorter one.  The
shortest tier's rests follow each other in its windows.  Only one window of a group of documents can
stay open; it is cut into sequences of powers of two, which need no padding.

Documents are packed in groups of bounded size as their partition streams by, so texts are never shuffled
and memory does not grow with the input.  Sequences are then dealt to step groups in rotation, tier by tier
over all partitions, so that any two groups of steps differ by at most one sequence of each length.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from plycask.llm.scratch import Scratch
from plycask.llm.words import Memo, freeing, texts_of

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, tier long, step_group long"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, partition long, rank long"
SEPARATOR = (0).to_bytes(4, "little")
#: The pattern by which this kind of vocabulary cuts a text before it merges: a fixed public value.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Marks that the pattern keeps apart from letters.
MARKS = ".,;:!?"
#: Blanks besides space and line feed.
_OTHER_BLANK = re.compile(r"[^\S \n]").search
_LAST = 1 << 60
#: Tokens of a group of documents that are packed together.
GROUP_TOKENS = 2_000_000


def _byte_of_char() -> dict[str, int]:
    """The characters by which byte-level vocabulary files write bytes: printable ones stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


def _little(ids: list[int]) -> bytes:
    """ids as little-endian unsigned 32-bit numbers."""
    return struct.pack("<%dI" % len(ids), *ids)


class ByteEncoder:
    """ids of a text as little-endian 32-bit numbers, by a byte-level vocabulary.

    A text in which every blank but single spaces keeps away from spaces is cut at its spaces, as no
    piece goes on past a space and none of its pieces then depends on what stands beyond; chunks that
    were seen before are remembered.  Any other text, and one with a special token's string, is cut or
    encoded as a whole.  Where the file's merges are in the order of its ids, the rank-based merging of
    tiktoken gives the same ids in less time.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, byte = model["vocab"], _byte_of_char()
        merged = [vocabulary["".join(merge if isinstance(merge, list) else merge.split(" "))] for merge in model["merges"]]
        if merged == sorted(set(merged)) and min(merged) >= 256 and not model.get("ignore_merges"):
            ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
            core = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})._core_bpe
            one = lambda piece: _little(core.encode_single_piece(piece.encode()))
        else:
            one = self.whole
        piece, cut = Memo(one, 12 << 20).__getitem__, regex.compile(PIECES).findall
        self.pieces = lambda text: b"".join(map(piece, cut(text)))
        marks = {mark: one(mark) for mark in MARKS}

        def spaced(chunk: str) -> bytes:
            """A chunk with the space before it.  Letters are one piece with it, and a mark behind them is one of its own."""
            if chunk.isalpha():
                return one(" " + chunk)
            if chunk[-1:] in marks and chunk[:-1].isalpha():
                return memo[chunk[:-1]] + marks[chunk[-1]]
            return self.pieces(" " + chunk)

        memo = Memo(spaced, 80 << 20)
        self.spaced = memo.__getitem__

    def whole(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return self.whole(text)
        if "  " in text or " \n" in text or "\n " in text or _OTHER_BLANK(text):
            return self.pieces(text)
        first, *rest = text.split(" ")
        return self.pieces(first) + b"".join(map(self.spaced, rest))


def power_parts(length: int) -> list[int]:
    """A length as falling powers of two."""
    return [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]


def pack_group(lengths: list[int], window: int, tiers: int = 4) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token of documents 0, 1, ... just once.

    All are as long as the window of a tier, but for at most one of each power of two below the shortest.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    sizes = [max(1, window >> i) for i in range(tiers)]
    #: Rests by length, then document and start.
    rests: list[tuple[int, int, int]] = []
    for doc, n in enumerate(lengths):
        whole = n // window * window
        sequences += [[(doc, at, window)] for at in range(0, whole, window)]
        if n > whole:
            rests.append((n - whole, doc, whole))
    rests.sort()

    def fill(pieces: list[tuple[int, int, int]], room: int) -> int:
        """Adds rests to the pieces of a window until it is full or there are none; returns the room that is left."""
        while room and rests:
            at = bisect.bisect_right(rests, (room, _LAST))
            n, doc, start = rests.pop(max(0, at - 1))
            pieces.append((doc, start, min(n, room)))
            if n > room:
                bisect.insort(rests, (n - room, doc, start + room))
            room -= min(n, room)
        return room

    pieces, room = [], 0
    for i, size in enumerate(sizes):
        # Rests of the tier are longer than the windows of the next one.
        shorter = sizes[i + 1] if i + 1 < tiers else 0
        while rests and rests[-1][0] > shorter:
            n, doc, start = rests.pop()
            pieces = [(doc, start, n)]
            room = fill(pieces, size - n)
            if not room:
                sequences.append(pieces)
    if room:  # the last window, and all rests are used up
        stream = deque(pieces)
        for size in power_parts(sum(piece[2] for piece in pieces)):
            sequence, left = [], size
            while left:
                doc, start, n = stream.popleft()
                sequence.append((doc, start, min(n, left)))
                if n > left:
                    stream.appendleft((doc, start + left, n - left))
                left -= min(n, left)
            sequences.append(sequence)
    return sequences


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, step_groups: int = 64, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all documents in sequences of at most window tokens.

    One row for each piece: doc_id, start (tokens of the document before it), length, ids_crc32 (of its
    ids as little-endian unsigned 32-bit numbers), doc_tokens (with the separator), sequence_id, offset
    (place in the sequence; gapless from 0), and besides sequence_tokens, tier (its context size, a power of two,
    which it fills) and step_group.  A null text counts as empty, which leaves the separator alone; a null doc_id stays
    null; repeated rows are packed each for itself; an empty table gives no row.  Only doc_id and text are
    read, texts of any length whole; of rests that are equally long the later document's is used first.
    sequence_id is unique: the partition in its high bits and a running number below.  window must be a power
    of two.  The pieces are written once, and dealt to step groups by how many sequences each partition has.
    """
    if window < 2 or window & (window - 1):
        raise ValueError(f"window {window} is no power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteEncoder(tokenizer_path)
        partition = TaskContext.get().partitionId()
        number = partition << 36
        ranks: defaultdict[int, int] = defaultdict(int)
        doc_ids: list[int | None] = []
        tokens: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            columns: list[list] = [[] for _ in range(10)]
            for sequence in pack_group([len(ids) // 4 for ids in tokens], window):
                size = sum(piece[2] for piece in sequence)
                rank = ranks[size]
                ranks[size] += 1
                offset = 0
                for doc, start, n in sequence:
                    ids = tokens[doc]
                    row = (doc_ids[doc], start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4, number, offset, size, partition, rank)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += n
                number += 1
            doc_ids.clear()
            tokens.clear()
            held = 0
            names = [field.split()[0] for field in _PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)

        for batch, texts in texts_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                doc_ids.append(doc_id)
                tokens.append(encode(text) + SEPARATOR)
                held += len(tokens[-1]) // 4
                if held >= group_tokens:
                    yield flush()
        if tokens:
            yield flush()

    pieces = Scratch(docs.sparkSession, "packing").save(docs.select("doc_id", "text").mapInArrow(freeing(run), _PIECES), "pieces")
    # How many sequences of a length the partitions before have: a row for each partition and length.
    sequences = pieces.where("offset = 0").groupBy("sequence_tokens", "partition").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("sequence_tokens").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    sequences = sequences.select("sequence_tokens", "partition", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    group = (F.col("before") + F.col("rank") + F.log2("sequence_tokens").cast("long") * 7) % step_groups
    return pieces.join(sequences, ["sequence_tokens", "partition"]).withColumns({"tier": F.col("sequence_tokens"), "step_group": group}).select(*(field.split()[0] for field in SCHEMA.split(", ")))
