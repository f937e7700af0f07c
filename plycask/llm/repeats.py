"""Which windows of a corpus's texts start more than once: the jobs that op4 and op7 share.

1. Every text is cut into segments (see ``segments``); anchors that occur once in the corpus are put aside.
2. For recurring anchors, segments are counted by content.  Repeated contents are repeated as a whole.
   Where an anchor has several contents, each content is `open` to comparison window by window, and those
   that occur once have still to be `settled`.
3. Texts get their segments' states.  Open segments are sent on once for each content: whole, to be
   compared by their anchor (``segs``), or, where an anchor has more than ``hot`` contents, window by
   window (``wins``), so that no anchor, however common, has to fit in one task.
4. The comparison gives back the places of repeated windows in unsettled segments.

All counting is done by aggregations that combine before they shuffle, and every join is between plain
tables, so that Spark can split a hot key's rows.  Names of contents are 64-bit hashes that must agree
together with the anchor's, 128 bits in all; documents are named by two hashes of their id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plycask.llm.scratch import Scratch
from plycask.llm.segments import Ladder, Segments, Shape, cut
from plycask.llm.words import freeing, mix, slices

#: States of a segment in a text: repeated; repeated and sent on for comparison; to be settled.
WHOLE, SENT, UNSETTLED, HOT = 1, 2, 3, 8
#: Units that are hashed together; longer texts are cut with an overlap of a window, which only splits segments.
GROUP = 1 << 19

#: Most names, and segments, of an anchor that come together in a task at a time.
NAMES, SEGMENTS = 20_000, 200

FOUND = "node long, twin long, start long, stop long"
OCCURRENCES = "node long, anchor long, content long, n int"
SECOND = "kind string, doc_id long, node long, twin long, text string, n_units long, spans binary, sha string, anchor long, content long, first long, windows int, units binary, name long, place int"


@dataclass(frozen=True)
class Measure:
    """How texts are taken apart: shape, and a function of a batch's texts to an array of unit hashes and the number of units of each text."""

    shape: Shape
    units: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    #: The units themselves as bytes, for segments that are compared whole; None where only names of windows are.
    raw: Callable[[list[str]], bytes] | None = None
    #: The words of a text, for segments that are searched for passages instead of windows by their names.
    words: Callable[[str], list[str]] | None = None
    #: Contents of an anchor from which its windows are compared one by one.
    hot: int = 500


def pieces(texts: list[str], measure: Measure) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, Ladder, Segments]]:
    """Groups of texts: the first one's number, their lengths, starts in the group and starts in their text, the ladder and segments."""
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP):
            size += len(texts[stop])
            stop += 1
        units, lengths = measure.units(texts[at:stop])
        if stop == at + 1 and len(units) > 2 * GROUP:
            window = measure.shape.window
            for start in range(0, len(units) - window + 1, GROUP):
                part = units[start : start + GROUP + window - 1]
                ladder, segments = cut(part, np.array([len(part)]), measure.shape)
                yield at, lengths, np.array([0]), np.array([start]), ladder, segments
        else:
            ladder, segments = cut(units, lengths, measure.shape)
            yield at, lengths, np.cumsum(lengths) - lengths, np.zeros(len(lengths), np.int64), ladder, segments
        at = stop


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty), and the two hashes that name the row: of many copies of a text, one sends its segments.

    Where rows have the same name all the same, nothing is lost: segments are looked up by their content.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("node"), F.xxhash64(F.lit(7), "doc_id", text).alias("twin"))


def occurrences(docs: DataFrame, measure: Measure) -> DataFrame:
    """Segments of every text, equal ones of a text as one row with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            texts = batch.column("text").to_pylist()
            for at, _, _, _, _, s in pieces(texts, measure):
                if not len(s.first):
                    continue
                key = mix(s.content ^ mix(s.anchor + s.sequence.astype(np.uint64)))
                _, one, n = np.unique(key, return_index=True, return_counts=True)
                columns = nodes[at + s.sequence[one]], s.anchor[one].view(np.int64), s.content[one].view(np.int64), n.astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["node", "anchor", "content", "n"])

    return docs.select("node", "text").mapInArrow(freeing(run), OCCURRENCES)


def states(docs: DataFrame, measure: Measure, scratch: Scratch) -> DataFrame:
    """For each text with recurring segments (node): flags, the set of (content, state)."""
    every = scratch.save(occurrences(docs, measure), "occurrences")
    recurring = every.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")
    recurring = scratch.save(recurring, "anchors")
    found = scratch.save(every.join(recurring, "anchor"), "recurring")
    scratch.drop("occurrences")
    contents = scratch.save(found.groupBy("anchor", "content").agg(F.sum("n").alias("copies"), F.min("node").alias("sender")), "contents")
    variety = scratch.save(contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")), "variety")
    contents = scratch.save(contents.join(variety, "anchor").select("anchor", "content", "copies", "sender", "variants"), "judged")
    scratch.drop("contents")
    sent = F.when(F.col("copies") == 1, UNSETTLED).when(F.col("node") == F.col("sender"), SENT).otherwise(WHOLE)
    state = F.when(F.col("variants") == 1, WHOLE).otherwise(sent + F.when(F.col("variants") > measure.hot, HOT).otherwise(0))
    judged = found.join(contents, ["anchor", "content"]).select("node", F.struct("content", state.cast("byte").alias("state")).alias("flag"))
    flags = scratch.save(judged.groupBy("node").agg(F.collect_set("flag").alias("flags")), "flags")
    for name in ("anchors", "recurring", "variety", "judged"):
        scratch.drop(name)
    return flags


def spans_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Disjoint spans (start, end) in order, from any spans; those that touch are joined."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return np.stack([starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]], axis=1)


def _column(values, kind: pa.DataType, rows: int) -> pa.Array:
    return pa.nulls(rows, kind) if values is None else values if isinstance(values, pa.Array) else pa.array(values, kind)


def _second(rows: int, kind: str, **values) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in SECOND.split(", ")]
    values["kind"] = [kind] * rows
    return pa.RecordBatch.from_arrays([_column(values.get(name), kinds[of], rows) for name, of in fields], names=[name for name, _ in fields])


def send(docs: DataFrame, flags: DataFrame, measure: Measure, scratch: Scratch, finish: Callable[[str], tuple[int, str]]) -> DataFrame:
    """A table of rows of several kinds: ``done`` (texts without a repeated window: doc_id, n_units and the hash of what is kept, by finish),
    ``docs`` (texts with some, and the spans known so far), ``segs`` and ``wins`` (what is to be compared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = measure.shape.window
        for whole in chain.from_iterable(map(slices, batches)):
            flagged = np.array(whole.column("flags").is_valid())
            plain = whole.filter(pa.array(~flagged))
            if plain.num_rows:
                done = [finish(text) for text in plain.column("text").to_pylist()]
                yield _second(plain.num_rows, "done", doc_id=plain.column("doc_id").to_pylist(), n_units=[x[0] for x in done], sha=[x[1] for x in done])
            batch = whole.filter(pa.array(flagged))
            if not batch.num_rows:
                continue
            texts = batch.column("text").to_pylist()
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            twins = batch.column("twin").to_numpy(zero_copy_only=False)
            lists = batch.column("flags")
            flat = lists.flatten()
            contents = flat.field("content").to_numpy(zero_copy_only=False)
            marks = flat.field("state").to_numpy(zero_copy_only=False)
            borders = np.cumsum(np.append(0, np.array(lists.value_lengths())))
            known: list[list[np.ndarray]] = [[] for _ in texts]
            sizes = np.zeros(len(texts), np.int64)
            for at, lengths, starts, offsets, ladder, s in pieces(texts, measure):
                sizes[at : at + len(lengths)] = lengths
                low, high = borders[at], borders[at + len(lengths)]
                # The state of each segment, by its text and content.
                owner = np.repeat(np.arange(len(lengths), dtype=np.uint64), np.diff(borders[at : at + len(lengths) + 1]))
                keys = mix(contents[low:high].view(np.uint64) + mix(owner))
                order = np.argsort(keys)
                keys, wanted = keys[order], mix(s.content + mix(s.sequence.astype(np.uint64)))
                found = np.searchsorted(keys, wanted)
                there = found < len(keys)
                there[there] = keys[found[there]] == wanted[there]
                state = np.zeros(len(s.first), np.int64)
                state[there] = marks[low:high][order][found[there]]
                repeated = (state & 7 == WHOLE) | (state & 7 == SENT)
                shift = (offsets - starts)[s.sequence]
                # One gap between texts, so that spans at the end of one and the start of the next stay apart.
                of = s.sequence[repeated]
                joined = spans_of(s.first[repeated] + of, s.last[repeated] + window + of)
                of = np.searchsorted(starts + np.arange(len(starts)), joined[:, 0], side="right") - 1
                joined += (offsets - starts - np.arange(len(starts)))[of][:, None]
                for sequence, span in zip(of.tolist(), joined, strict=True):
                    known[at + sequence].append(span)
                opened = np.flatnonzero(state & 7 >= SENT)
                one = opened[(state[opened] & HOT) != 0] if measure.raw else opened
                if len(one):
                    yield from _windows(one, s, ladder, shift, state, nodes[at:], twins[at:], measure, texts[at : at + len(lengths)], starts, offsets)
                if measure.raw and len(rest := opened[(state[opened] & HOT) == 0]):
                    yield _segments(rest, s, shift, state, nodes[at:], twins[at:], measure.raw(texts[at : at + len(lengths)]), starts, offsets, window)
            spans = [spans_of(*np.array(x).T) if x else np.empty((0, 2), np.int64) for x in known]
            yield _second(
                len(texts), "docs", doc_id=batch.column("doc_id").to_pylist(), node=pa.array(nodes), twin=pa.array(twins), text=batch.column("text").cast(pa.string()), n_units=pa.array(sizes), spans=[x.tobytes() for x in spans]
            )

    joined = docs.join(flags, "node", "left").select("doc_id", "node", "twin", "text", "flags")
    return scratch.save(joined.mapInArrow(freeing(run), SECOND), "second", ["kind"])


def _windows(
    which: np.ndarray, s: Segments, ladder: Ladder, shift: np.ndarray, state: np.ndarray, nodes: np.ndarray, twins: np.ndarray, measure: Measure, texts: list[str], starts: np.ndarray, offsets: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The names of all windows of open segments, one a row, to be counted; and the segments again, to be looked up: the names of the unsettled ones or, where texts are of words, the words of all."""
    n = s.last[which] - s.first[which] + 1
    ends = np.cumsum(n)
    owner = np.repeat(which, n)
    place = np.arange(len(owner)) - np.repeat(ends - n, n)
    names = ladder.spans(place + s.first[owner], measure.shape.window).view(np.int64)
    yield _second(len(owner), "wins", anchor=pa.array(s.anchor[owner].view(np.int64)), content=pa.array(s.content[owner].view(np.int64)), name=pa.array(names), place=pa.array(place.astype(np.int32)))
    unsettled = state[which] & 7 == UNSETTLED
    wanted = np.arange(len(which)) if measure.words else np.flatnonzero(unsettled)
    if len(wanted):
        one = which[wanted]
        of = s.sequence[one]
        first = s.first[one] + shift[one]
        if measure.words:
            split, blobs = [measure.words(text) for text in texts], []
            for sequence, begin, size in zip(of.tolist(), first.tolist(), (n[wanted] + measure.shape.window - 1).tolist(), strict=True):
                blobs.append(" ".join(split[sequence][begin : begin + size]).encode())
        else:
            blobs = [names[a:b].tobytes() for a, b in zip((ends - n)[wanted].tolist(), ends[wanted].tolist(), strict=True)]
        # A place below zero: the windows of a repeated content may be passages, but are settled already.
        first = np.where(unsettled[wanted], first, -1)
        yield _second(
            len(one), "opens", node=pa.array(nodes[of]), twin=pa.array(twins[of]), anchor=pa.array(s.anchor[one].view(np.int64)), content=pa.array(s.content[one].view(np.int64)), first=pa.array(first), units=blobs
        )


def _segments(which: np.ndarray, s: Segments, shift: np.ndarray, state: np.ndarray, nodes: np.ndarray, twins: np.ndarray, raw: bytes, starts: np.ndarray, offsets: np.ndarray, window: int) -> pa.RecordBatch:
    of = s.sequence[which]
    base = s.first[which] + (offsets[0] if len(starts) == 1 else 0)
    units = [raw[a : a + n] for a, n in zip(base.tolist(), (s.last[which] - s.first[which] + window).tolist(), strict=True)]
    # A place below zero: the windows of a repeated content are compared with, but settled already.
    first = np.where(state[which] & 7 == UNSETTLED, s.first[which] + shift[which], -1)
    return _second(
        len(which), "segs", node=pa.array(nodes[of]), twin=pa.array(twins[of]), anchor=pa.array(s.anchor[which].view(np.int64)), content=pa.array(s.content[which].view(np.int64)),
        first=pa.array(first), windows=pa.array((s.last[which] - s.first[which] + 1).astype(np.int32)), units=units,
    )


def dealt(rows: DataFrame, most: int, *salt: str) -> DataFrame:
    """rows of an anchor in parts of about most rows each."""
    parts = rows.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    dealt = rows.join(parts, "anchor").withColumn("part", F.pmod(F.xxhash64(*salt), F.col("parts")))
    return dealt.repartition("anchor", "part")  # else the join's partitions by anchor would do for the grouping, with all parts in a task


def repeated_windows(second: DataFrame, measure: Measure, scratch: Scratch) -> DataFrame:
    """(node, twin, start, stop) of runs of windows, in the segments sent window by window, that other contents of their anchor have too.

    An anchor's repeated names and its unsettled segments come together as lists of bounded length, part by part.
    """
    wins = second.where("kind = 'wins'").select("anchor", "name", "content")
    shared = wins.groupBy("anchor", "name").agg(F.min("content").alias("low"), F.max("content").alias("high")).where("low <> high").select("anchor", "name")
    shared = scratch.save(shared, "shared")
    names = dealt(shared, NAMES, "name").groupBy("anchor", "part").agg(F.collect_list("name").alias("names"))
    opens = second.where("kind = 'opens'").select("anchor", "node", "twin", "first", "units")
    packs = dealt(opens, SEGMENTS, "node", "first").groupBy("anchor", "part").agg(F.collect_list(F.struct("node", "twin", "first", "units")).alias("rows"))
    pairs = scratch.save(packs, "packs").select("anchor", "rows").join(scratch.save(names, "names").select("anchor", "names"), "anchor").select("rows", "names")
    window = measure.shape.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for rows, listed in zip(batch.column("rows").to_pylist(), batch.column("names"), strict=True):
                wanted = np.sort(listed.values.to_numpy(zero_copy_only=False))
                for row in rows:
                    names = np.frombuffer(row["units"], np.int64)
                    hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, names), len(wanted) - 1)] == names)
                    if len(hit):
                        cut_ = np.flatnonzero(np.diff(hit) > 1)
                        starts, stops = hit[np.append(0, cut_ + 1)], hit[np.append(cut_, len(hit) - 1)]
                        out += [(row["node"], row["twin"], row["first"] + a, row["first"] + b + window) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "twin", "start", "stop"])

    return pairs.mapInArrow(freeing(run), FOUND)


def passages(second: DataFrame, scratch: Scratch) -> DataFrame:
    """(anchor, words): the recurring passages of anchors with several contents, confirmed by counting, once each.

    A passage is a run of windows of the least content that holds them, all of which the same contents hold: equal
    windows lie at the same distance from their anchor, so every holder of one of them has the passage whole.
    """
    wins = second.where("kind = 'wins'").select("anchor", "name", "content", "place", F.xxhash64("content").alias("h"))
    # Two sums of 31 bits of a hash name the holders; a row that is there twice adds to all windows of its segment alike.
    part = lambda shift: F.sum(F.shiftrightunsigned("h", shift).bitwiseAND(F.lit(2**31 - 1)))
    shared = wins.groupBy("anchor", "name").agg(F.min_by("place", "content").alias("place"), F.min("content").alias("content"), F.max("content").alias("high"), part(0).alias("holders"), part(32).alias("n"))
    runs = shared.where("content <> high").groupBy("anchor", "content").agg(F.collect_list(F.struct("place", "holders", "n")).alias("windows"))
    held = second.where("kind = 'opens'").groupBy("anchor", "content").agg(F.first("units").alias("units"))
    return runs.join(held, ["anchor", "content"]).select("anchor", "units", "windows")


def with_spans(second: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """The ``docs`` rows, with the spans found by comparison (more)."""
    listed = scratch.save(found.groupBy("node", "twin").agg(F.collect_set(F.struct("start", "stop")).alias("more")), "more")
    return second.where("kind = 'docs'").select("doc_id", "node", "twin", "text", "n_units", "spans").join(listed, ["node", "twin"], "left")


def all_spans(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Disjoint spans of units that repeated windows cover, for each row of with_spans."""
    out = []
    for spans, more in zip(batch.column("spans").to_pylist(), batch.column("more").to_pylist(), strict=True):
        known = np.frombuffer(spans, np.int64).reshape(-1, 2)
        if more:
            known = np.concatenate([known, np.array([(x["start"], x["stop"]) for x in more], np.int64)])
        out.append(spans_of(known[:, 0], known[:, 1]))
    return out


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
