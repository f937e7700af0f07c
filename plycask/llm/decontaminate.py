"""Benchmark decontamination: every passage of the documents queries an index of the test items.

The items' inverted index holds, for each term, its items with their BM25 contributions as shares of the
item's score for its own text, so that one threshold suits items of any length.  Items are in blocks, and
each list knows the largest contribution in a block.  Items are classed by length (powers of two); passages
are overlapping windows of twice a class's length, so each item lies whole in one of its class, and which
other items are in the benchmark decides nothing.

The lists of an item's rarest terms, which hold more of its score than the threshold leaves to the others, are
gone through for all passages at once: a passage in which they do not add up to what the others cannot make
up for cannot reach the threshold.  Every other passage queries the index by block-max WAND, which retrieves
every item above the threshold.  A retrieved item is a leak when both its question
and its answer overlap with the passage.  An item of prose, which marks neither, is also a leak when enough of
its tokens lie in n-grams that the passage has, wherever they stand: a copy that stops early or differs in a word.

The index is broadcast, in shards of a bounded number of bytes, one of which the driver makes at a time: a
larger benchmark takes more passes over the documents, not larger executors.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plycask.llm.scratch import Scratch
from plycask.llm.words import freeing, texts_of

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
_TOKENS = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
_NO_ITEM = 1 << 60


@dataclass(frozen=True)
class Leak:
    """score: least share of the item's own BM25 score; overlap: least share of n-grams of question and of answer; covered: least share of a prose item's tokens in shared n-grams; shard_bytes: of the items' text in a broadcast index."""

    score: float = 0.5
    overlap: float = 0.5
    covered: float = 2 / 3
    ngram: int = 5
    k1: float = 1.2
    b: float = 0.75
    block: int = 4
    shard_bytes: int = 8 << 20


def tokens(text: str | None) -> list[str]:
    return _TOKENS.findall(text.lower()) if text else []


def marked_parts(text: str) -> tuple[list[str], list[str]] | None:
    """Question and answer of an item that marks them: the answer follows `answer:` or the last question mark."""
    marked = re.split(r"(?i)\banswer\s*:", text, maxsplit=1)
    if len(marked) == 2 and tokens(marked[0]) and tokens(marked[1]):
        return tokens(marked[0]), tokens(marked[1])
    asked, _, answer = text.rpartition("?")
    if tokens(asked) and tokens(answer):
        return tokens(asked), tokens(answer)
    return None


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's parts: as marked, else the answer is the last sentence, else the last quarter."""
    marked = marked_parts(text)
    if marked:
        return marked
    sentences = [sentence for sentence in _SENTENCE_END.split(text) if tokens(sentence)]
    if len(sentences) > 1:
        last = tokens(sentences[-1])
        every = tokens(text)
        if len(every) > len(last):
            return every[: len(every) - len(last)], last
    every = tokens(text)
    cut = max(1, len(every) - max(1, len(every) // 4))
    return every[:cut], every[cut:] or every


class BlockMaxIndex:
    """BM25 postings of items, in blocks, with block-max WAND retrieval."""

    #: Share of the threshold that an item's terms without a list for bounds may have together.
    _REST = 0.6
    #: Entries of rare lists that are gone through at a time.
    _MOST = 1_000_000

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_length: float, how: Leak):
        self.how = how
        counted = [(item_id, text, Counter(tokens(text))) for item_id, text in items]
        # Items of a class stand together, so that a class is a range of numbers.
        kept = sorted(((max(0, sum(count.values()) - 1).bit_length(), item_id, text, count) for item_id, text, count in counted if count), key=lambda x: x[0])
        self.item_ids = [item_id for _, item_id, _, _ in kept]
        self.stride = np.array([1 << x[0] for x in kept], np.int64)
        self.vocabulary = {term: i for i, term in enumerate(sorted(set(chain.from_iterable(x[3] for x in kept))))}
        idf = {term: math.log(1 + (n_items - df.get(term, 1) + 0.5) / (df.get(term, 1) + 0.5)) for term in self.vocabulary}
        terms, shares = [], []
        for _, _, _, count in kept:
            size = how.k1 * (1 - how.b + how.b * sum(count.values()) / mean_length)
            own = np.array([idf[term] * tf * (how.k1 + 1) / (tf + size) for term, tf in count.items()])
            terms.append(np.array([self.vocabulary[term] for term in count], np.int64))
            shares.append(own / own.sum())
        self.postings = self._lists(terms, shares)
        blocks: list[np.ndarray] = []
        best: list[np.ndarray] = []
        for term in range(len(self.vocabulary)):
            items_of, scores = self._list(self.postings, term)
            at = np.flatnonzero(np.append(True, items_of[1:] // how.block != items_of[:-1] // how.block))
            blocks.append(items_of[at] // how.block)
            best.append(np.maximum.reduceat(scores, at))
        self.block_max = np.cumsum([0, *map(len, blocks)]), np.concatenate([np.empty(0, np.int32), *blocks]), np.concatenate([np.empty(0), *best])
        # Each item's rarest terms, until the others have but a part of the threshold.
        self.need = np.zeros(len(kept))
        for i, share in enumerate(shares):
            order = np.argsort(-share, kind="stable")
            rest = 1 - np.cumsum(share[order])
            n = int(np.argmax(rest <= self._REST * how.score + 1e-12)) + 1
            self.need[i] = how.score - max(0.0, rest[n - 1]) - 2e-9
            terms[i], shares[i] = terms[i][order[:n]], share[order[:n]]
        self.rare = self._lists(terms, shares)
        self.parts = [tuple(np.array([self.vocabulary[t] for t in part], np.int32) for part in question_and_answer(text)) for _, _, text, _ in kept]
        #: The ids of a prose item; none for one that marks question and answer.
        self.prose = [np.array([] if marked_parts(text) else [self.vocabulary[t] for t in tokens(text)], np.int32) for _, _, text, _ in kept]

    def _lists(self, terms: list[np.ndarray], shares: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each term where its list begins, and the lists of items and shares one after the other, by item."""
        every = np.concatenate([np.empty(0, np.int64), *terms])
        order = np.argsort(every, kind="stable")
        items = np.repeat(np.arange(len(terms), dtype=np.int32), [len(x) for x in terms])
        return np.searchsorted(every[order], np.arange(len(self.vocabulary) + 1)), items[order], np.concatenate([np.empty(0), *shares])[order]

    @staticmethod
    def _list(lists: tuple[np.ndarray, np.ndarray, np.ndarray], term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = lists[0][term], lists[0][term + 1]
        return lists[1][a:b], lists[2][a:b]

    def _cursor(self, term: int, low: int, high: int) -> list | None:
        """Where a list stands (item and place), its items and shares in the range, the largest share, and the largest in each block."""
        items, scores = self._list(self.postings, term)
        a, b = np.searchsorted(items, [low, high])
        if a == b:
            return None
        items, scores = items[a:b].tolist(), scores[a:b].tolist()
        blocks, best = self._list(self.block_max, term)
        return [items[0], 0, items, scores, max(scores), dict(zip(blocks.tolist(), best.tolist(), strict=True))]

    def retrieve(self, terms: list[int], low: int = 0, high: int = _NO_ITEM) -> list[tuple[int, float]]:
        """All items of the range whose score for the distinct terms reaches the threshold, by block-max WAND."""
        least, block = self.how.score - 1e-9, self.how.block
        cursors = [cursor for cursor in (self._cursor(t, low, high) for t in terms) if cursor]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, cursor in enumerate(cursors):
                bound += cursor[4]
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            here = item // block
            if sum(cursor[5].get(here, 0.0) for cursor in cursors[: pivot + 1]) < least:
                # Nothing in this block before the next list begins: go on behind the block or at that list.
                to = min((here + 1) * block, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else _NO_ITEM)
                moved = cursors[: pivot + 1]
            elif cursors[0][0] == item:
                score = sum(cursor[3][cursor[1]] for cursor in cursors[: pivot + 1])
                if score >= least:
                    found.append((item, score))
                to, moved = item + 1, cursors[: pivot + 1]
            else:
                to, moved = item, cursors[:pivot]
            for cursor in moved:
                if cursor[0] < to:
                    cursor[1] = bisect_left(cursor[2], to, cursor[1])
                    cursor[0] = cursor[2][cursor[1]] if cursor[1] < len(cursor[2]) else _NO_ITEM
            cursors = [cursor for cursor in cursors if cursor[0] < _NO_ITEM]
        return found

    def overlap(self, part: np.ndarray, there: set[tuple[int, ...]], passage: list[int]) -> float:
        """The share of the part's n-grams that the passage has; there are the passage's n-grams."""
        part = part.tolist()
        n = min(self.how.ngram, len(part))
        if n < self.how.ngram:
            there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
        grams = {tuple(part[i : i + n]) for i in range(len(part) - n + 1)}
        return len(grams & there) / len(grams)

    def covered(self, item: np.ndarray, there: set[tuple[int, ...]], passage: list[int]) -> float:
        """The share of the item's tokens that lie in n-grams which the passage has; 0 of no tokens."""
        item = item.tolist()
        if not item:
            return 0.0
        n = min(self.how.ngram, len(item))
        if n < self.how.ngram:
            there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
        shared, end = 0, 0
        for i in range(len(item) - n + 1):
            if tuple(item[i : i + n]) in there:
                shared += i + n - max(i, end)
                end = i + n
        return shared / len(item)

    def leaks(self, texts: list[str]) -> list[dict[int, tuple[float, float, float]]]:
        """For each text the items it leaks: the best passage's score and overlaps."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        if not self.item_ids:
            return found
        size = 0
        group: list[tuple[int, np.ndarray, int]] = []
        for at, text in enumerate(texts):
            ids = np.fromiter(map(self.vocabulary.get, tokens(text), repeat(-1)), np.int64)
            for piece, stop in self._pieces(ids):
                group.append((at, piece, stop))
                size += self._listed(piece)
                if size > self._MOST or len(group) > 10_000:
                    self._search(group, found)
                    group, size = [], 0
        if group:
            self._search(group, found)
        return found

    def _listed(self, ids: np.ndarray) -> int:
        """About how many entries it takes to go through the rare lists of all tokens."""
        known = ids[ids >= 0]
        return len(ids) // 8 + int((self.rare[0][known + 1] - self.rare[0][known]).sum())

    def _pieces(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """A document's tokens in pieces that are not too many entries, and before which place in it the windows of a piece begin; a piece goes on for the longest window."""
        parts = -(-self._listed(ids) // self._MOST)
        longest = int(self.stride.max())
        step = max(1, len(ids) // parts // longest) * longest if parts > 1 else max(1, len(ids))
        for start in range(0, len(ids), step):
            yield ids[start : start + step + longest], step

    def reachable(self, ids: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
        """Document, start and stride of every window in which an item of that stride may reach the threshold; ids of all documents, -1 for unknown ones."""
        ends = np.cumsum(lengths)
        place = np.flatnonzero(ids >= 0)
        n = self.rare[0][ids[place] + 1] - self.rare[0][ids[place]]
        place, n = place[n > 0], n[n > 0]
        if not len(place):
            return []
        term = ids[place]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.rare[0][term], n)
        place, term = np.repeat(place, n), np.repeat(term, n)
        item, share = self.rare[1][at].astype(np.int64), self.rare[2][at]
        first = (ends - lengths)[np.searchsorted(ends, place, side="right")]
        stride = self.stride[item]
        # An item's cells, by where they begin, and of each its distinct terms.
        total = len(ids) + 1
        cells, of = np.unique(item * total + first + (place - first) // stride * stride, return_inverse=True)
        _, one = np.unique(of * len(self.vocabulary) + term, return_index=True)
        sums = np.bincount(of[one], share[one], len(cells))
        item, start = cells // total, cells % total
        stride = self.stride[item]
        document = np.searchsorted(ends, start, side="right")
        first, end = (ends - lengths)[document], ends[document]

        def at_cell(keys: np.ndarray, there: np.ndarray) -> np.ndarray:
            found = np.minimum(np.searchsorted(cells, keys), len(cells) - 1)
            return np.where(there & (cells[found] == keys), sums[found], 0.0)

        after = sums + at_cell(cells + stride, start + stride < end) >= self.need[item]
        before = (start - stride >= first) & (sums + at_cell(cells - stride, start - stride >= first) >= self.need[item])
        windows = np.concatenate([np.stack([document, start - first, stride])[:, after], np.stack([document, start - stride - first, stride])[:, before]], axis=1)
        return list(map(tuple, np.unique(windows, axis=1).T.tolist()))

    def _search(self, group: list[tuple[int, np.ndarray, int]], found: list[dict]) -> None:
        lengths = np.array([len(ids) for _, ids, _ in group])
        for number, start, stride in self.reachable(np.concatenate([ids for _, ids, _ in group]), lengths):
            at, ids, stop = group[number]
            if start >= stop:
                continue
            passage = ids[start : start + 2 * stride].tolist()
            low, high = np.searchsorted(self.stride, [stride, stride + 1]).tolist()
            retrieved = self.retrieve(sorted({term for term in passage if term >= 0}), low, high)
            if not retrieved:
                continue
            there = {tuple(passage[i : i + self.how.ngram]) for i in range(len(passage) - self.how.ngram + 1)}
            for item, score in retrieved:
                question, answer = (self.overlap(part, there, passage) for part in self.parts[item])
                both = question >= self.how.overlap and answer >= self.how.overlap
                if both or self.covered(self.prose[item], there, passage) >= self.how.covered - 1e-9:
                    best = found[at].get(item)
                    if best is None or score > best[0]:
                        found[at][item] = (score, question, answer)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each text, one after the other."""
    for _, texts in texts_of(batches):
        yield pa.RecordBatch.from_arrays([pa.array([term for text in texts for term in set(tokens(text))], pa.string())], names=["term"])


def _document_frequencies(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("text").mapInArrow(_terms, "term string").groupBy("term").count()


def indexes(benchmark: DataFrame, how: Leak = Leak()) -> Iterator[BlockMaxIndex]:
    """Indexes of the items in shards of about shard_bytes of text each, one at a time; frequencies and mean length are those of all items."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.avg(F.size(F.split("text", r"\s+"))).alias("mean")).head()
    if not size.n:
        return
    shards = max(1, math.ceil(size.bytes / how.shard_bytes))
    if shards > 1:
        scratch = Scratch(benchmark.sparkSession, "decontaminate")
        frequencies = scratch.save(_document_frequencies(items), "frequencies")
        items = scratch.save(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")), "items", ["shard"])
    for shard in range(shards):
        rows = (items if shards == 1 else items.where(F.col("shard") == shard)).collect()
        pairs = sorted(((row.item_id, row.text) for row in rows), key=lambda pair: (pair[0] is None, pair))
        if shards == 1:
            df = Counter(term for _, text in pairs for term in set(tokens(text)))
        else:
            wanted = items.where(F.col("shard") == shard).select("text").mapInArrow(_terms, "term string").distinct()
            df = {row.term: row["count"] for row in frequencies.join(wanted, "term", "left_semi").collect()}
        yield BlockMaxIndex(pairs, df, size.n, float(size.mean), how)


def contamination(docs: DataFrame, benchmark: DataFrame, how: Leak = Leak()) -> DataFrame:
    """One row for each document and test item that it leaks.

    Columns: doc_id, item_id, score (of the best passage, as a share of the item's own), question_overlap
    and answer_overlap (shares of their n-grams; of a prose item, found by its tokens as a whole, either may be
    small).  Null texts leak nothing, null or empty items are not
    looked for; null ids stay null; repeated rows each give their rows; empty tables give none.  Only
    doc_id and text, item_id and text are read.  One narrow stage for each shard of the index.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], SCHEMA)
    for index in indexes(benchmark, how):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch, texts in texts_of(batches):
                ids = batch.column("doc_id").to_pylist()
                found = index.leaks(texts)
                rows = [(doc_id, index.item_ids[item], *values) for doc_id, leaks in zip(ids, found, strict=True) for item, values in sorted(leaks.items())]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.union(docs.select("doc_id", "text").mapInArrow(freeing(run), SCHEMA))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, how: Leak = Leak()) -> DataFrame:
    """The documents that leak no test item, with their own columns."""
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    kept = docs.toDF(*names)
    for index in indexes(benchmark, how):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch, texts in texts_of(batches, text):
                found = index.leaks(texts)
                yield batch.filter(pa.array([not leaks for leaks in found], pa.bool_()))

        kept = kept.mapInArrow(freeing(run), kept.schema)
    return kept.toDF(*docs.columns)
