"""Removal of recurring passages of words, located by sharded Aho-Corasick automata.

Passages are confirmed first.  Texts are cut into segments around anchors (see ``repeats``); segments that
recur as they are have all of their windows confirmed by the count of their content, and are removed on it.  Where segments
of an anchor differ, counting windows confirms which recur, and runs of windows that the same segments hold make the
recurring passages: a table in which each stands once, taken from one of its holders.

The table is then compiled into automata over word numbers, in shards of a bounded number of words, and the segments
of all documents that have an anchor of the shard and are not settled yet are streamed through them: in these, every
occurrence of every passage is located by the automata alone.  A segment whose anchor no passage has cannot
hold any and is passed by.  An anchor that very many segments or passages have is dealt out in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plycask.llm import repeats
from plycask.llm.scratch import Scratch
from plycask.llm.segments import Shape
from plycask.llm.words import freeing, hash_memo, slices, split_words, word_hashes

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"
#: Words of all passages of an automaton.
SHARD_WORDS = 400_000
#: Most passages of an anchor that come together with segments of it at a time.
PASSAGES = 2_000

def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    words = [split_words(text) for text in texts]
    lengths = np.array([len(x) for x in words], np.int64)
    return word_hashes(list(chain.from_iterable(words)), hash_memo()), lengths


def _finish(text: str) -> tuple[int, str]:
    words = split_words(text)
    return len(words), repeats.sha256(" ".join(words).encode())


def automata(passages: list[tuple[int, ...]], shard_words: int = SHARD_WORDS) -> Iterator[ahocorasick.Automaton]:
    """Automata over sequences of word numbers, of at most shard_words words (or one passage) each; one exists at a time."""
    at = 0
    while at < len(passages):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        size = 0
        while at < len(passages) and (not size or size + len(passages[at]) <= shard_words):
            automaton.add_word(passages[at], len(passages[at]))
            size += len(passages[at])
            at += 1
        automaton.make_automaton()
        yield automaton


def locate(texts: list[list[str]], passages: list[list[str]], shard_words: int = SHARD_WORDS) -> list[np.ndarray]:
    """For each text the disjoint spans of words that occurrences of the passages cover."""
    number: dict[str, int] = {}
    coded = sorted({tuple([number.setdefault(word, len(number) + 1) for word in passage]) for passage in passages})
    numbers = [tuple([number.get(word, 0) for word in text]) for text in texts]
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for automaton in automata(coded, shard_words):
        for text, spans in zip(numbers, found, strict=True):
            spans.extend((end + 1 - length, end + 1) for end, length in automaton.iter(text))
    return [repeats.spans_of(*np.array(spans, np.int64).reshape(-1, 2).T) for spans in found]


def runs(words: list[str], windows: list[dict], window: int) -> list[list[str]]:
    """The passages of a segment: windows that follow each other and have the same holders."""
    out: list[list[str]] = []
    before = None
    for x in sorted(windows, key=lambda x: x["place"]):
        here = x["place"], (x["holders"], x["n"])
        if before is not None and here == (before[0] + 1, before[1]):
            out[-1].append(words[x["place"] + window - 1])
        else:
            out.append(words[x["place"] : x["place"] + window])
        before = here
    return out


def _located(second: DataFrame, measure: repeats.Measure, shard_words: int, scratch: Scratch) -> DataFrame:
    """(node, twin, start, stop) of the passages' occurrences in the segments that counting has not settled.

    An anchor's passages and its segments come together in parts of bounded length; an automaton serves many anchors.
    """
    window = measure.shape.window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(anchor, " ".join(run)) for anchor, units, windows in zip(*(batch.column(x).to_pylist() for x in ("anchor", "units", "windows")), strict=True) for run in runs(units.decode().split(" "), windows, window)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.string())], names=["anchor", "words"])

    table = scratch.save(repeats.passages(second, scratch).mapInArrow(freeing(cut), "anchor long, words string"), "passages")
    patterns = repeats.dealt(table, PASSAGES, "words").groupBy("anchor", "part").agg(F.collect_list("words").alias("passages"))
    opens = second.where("kind = 'opens' AND first >= 0").select("anchor", "node", "twin", "first", "units")
    packs = repeats.dealt(opens, repeats.SEGMENTS, "node", "first").groupBy("anchor", "part").agg(F.collect_list(F.struct("node", "twin", "first", "units")).alias("rows"))
    pairs = scratch.save(packs, "packs").select("anchor", "rows").join(scratch.save(patterns, "patterns").select("anchor", "passages"), "anchor").select("rows", "passages")

    def search(group: list[tuple[list[dict], list[str]]]) -> pa.RecordBatch:
        rows = [row for some, _ in group for row in some]
        passages = [passage.split(" ") for _, some in group for passage in some]
        spans = locate([row["units"].decode().split(" ") for row in rows], passages, shard_words)
        out = [(row["node"], row["twin"], row["first"] + a, row["first"] + b) for row, found in zip(rows, spans, strict=True) for a, b in found.tolist()]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "twin", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[list[dict], list[str]]] = []
        size = 0
        for batch in batches:
            for rows, passages in zip(batch.column("rows"), batch.column("passages"), strict=True):
                group.append((rows.as_py(), passages.as_py()))
                size += window * (len(rows) + len(passages))
                if size > shard_words:
                    yield search(group)
                    group, size = [], 0
        if group:
            yield search(group)

    return pairs.mapInArrow(freeing(run), repeats.FOUND)


def drop_passages(docs: DataFrame, window: int = 35, anchor: int = 8, shard_words: int = SHARD_WORDS, with_text: bool = False) -> DataFrame:
    """Every text without the words that a recurring window of words covers.

    Columns: doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by one space, in UTF-8),
    and kept (those words so joined) if with_text.  Words are what stands between blanks, unchanged.  A window
    recurs if its words also start anywhere else, in any text or the same one; windows lie within one text and
    are judged on the input.  A null text has no words; a null doc_id stays null; repeated rows each give a
    row and are copies of each other; an empty table gives no row.  Only doc_id and text are read.
    """
    measure = repeats.Measure(Shape(window, anchor), _units, words=split_words)
    scratch = Scratch(docs.sparkSession, "phrase")
    own = repeats.keyed(docs)
    second = repeats.send(own, repeats.states(own, measure, scratch), measure, scratch, _finish)
    scratch.drop("flags")
    confirmed = repeats.with_spans(second, scratch.save(_located(second, measure, shard_words, scratch), "located"), scratch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), repeats.all_spans(batch), strict=True):
                    x = split_words(text)
                    edges = [0, *spans.ravel().tolist(), len(x)]
                    kept = list(chain.from_iterable(x[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    joined = " ".join(kept)
                    rows.append((doc_id, len(x), len(x) - len(kept), repeats.sha256(joined.encode()), joined if with_text else None))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    located = confirmed.select("doc_id", "text", "spans", "more").mapInArrow(freeing(run), f"{SCHEMA}, kept string")
    done = second.where("kind = 'done'").select("doc_id", F.col("n_units").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    if not with_text:
        return located.drop("kept").union(done)
    texts = docs.select("doc_id", F.array_join(F.expr(r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), w -> w <> '')"), " ").alias("kept"))
    texts = texts.withColumn("kept_sha256", F.sha2(F.encode("kept", "UTF-8"), 256)).distinct()
    return located.union(done.join(texts, ["doc_id", "kept_sha256"]).select(*located.columns))
