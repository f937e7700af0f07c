"""Near-duplicates by DartMinHash signatures, banded joining and exact confirmation.

A document is the weighted set of its word shingles.  Every element of the universe has darts thrown at
the plane of weight and rank: for each cell of a fixed grid of regions (doubling in weight and in rank)
hashing gives the number of darts, their places and their identifiers, the same ones for every document.
A dart hits a document where it lies below the element's weight, and counts where its rank is below the
document's horizon, t over the total weight, so that about t = k ln k + 2k darts are looked at whatever the
size of the set.  Each dart belongs to one of k coordinates, and the earliest of a coordinate is its
signature: two documents agree in it with the probability of their weighted Jaccard similarity.

Signatures are cut into bands, and documents that share a band's bucket are candidates.  Each is compared
with one other first, which joins most of what is alike into components.  Then every bucket that has
members of several components is gone through for links across them: small buckets as pairs, larger ones
in blocks, of which a task takes two at a time and gives just enough links to connect components.  So no link that
banding offers is lost, while pairs within a component are never made, and pairs across are never written.
Links are confirmed on the sets themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plycask.llm.components import components
from plycask.llm.scratch import Scratch
from plycask.llm.words import collapse, freeing, hash_memo, mix, split_words, word_hashes

_U64 = np.uint64
#: Members of a bucket up to which its pairs are compared as rows; beyond, in blocks of so many members and shingles.
SMALL, BLOCK_MEMBERS, BLOCK_SHINGLES = 6, 500, 400_000
SKETCH = "doc_id long, node long, bands array<long>, shingles array<int>"


@dataclass(frozen=True)
class Near:
    """Words of a shingle, least Jaccard similarity of a link, and bands times rows of the signature.

    At a similarity of 0.8, 25 bands of 5 rows miss a pair with a probability of 5e-5.
    """

    words: int = 5
    similarity: float = 0.8
    bands: int = 25
    rows: int = 5


@lru_cache(maxsize=256)
def _poisson(area: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... darts on an area."""
    p, total, out = math.exp(-area), 0.0, []
    for n in range(int(area + 12 * math.sqrt(area) + 24)):
        total += p
        out.append(total)
        p *= area / (n + 1)
    return np.array(out)


class DartMinHash:
    """Signatures of k coordinates of weighted sets of 64-bit elements."""

    #: Height of the lowest region of ranks; the regions above it double, up to an area of _AREA.
    _LOW, _AREA = 0.25, 32.0

    def __init__(self, k: int, seed: int = 1):
        self.k, self.seed = k, seed
        self.t = k * math.log(k) + 2 * k

    def _regions(self, heaviest: float, horizon: float) -> Iterator[tuple[int, float, float, float, float]]:
        """Number, weights from and to, and ranks from and to of the regions that sets can be hit in."""
        column, left = 0, 0.0
        while left < heaviest:
            right = 1.0 if column == 0 else 2 * left
            row, low = 0, 0.0
            while low < horizon:
                high = self._LOW if row == 0 else low + min(low, max(self._AREA / (right - left), self._LOW))
                yield column << 32 | row, left, right, low, high
                row, low = row + 1, high
            column, left = column + 1, right

    def darts(self, elements: np.ndarray, weights: np.ndarray, horizon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Identifiers and ranks of the darts that hit the elements below their horizons, and the elements' places."""
        ids, ranks, owners = [np.empty(0, _U64)], [np.empty(0)], [np.empty(0, np.int64)]
        for number, left, right, low, high in self._regions(float(weights.max()), float(horizon.max())):
            reached = np.flatnonzero((horizon > low) & (weights > left))
            cell = mix(elements[reached] ^ mix(np.array([(number * 0x9E3779B9 + self.seed) & 0xFFFFFFFFFFFFFFFF], _U64)))
            count = np.searchsorted(_poisson((right - left) * (high - low)), (cell >> _U64(11)).astype(np.float64) / 2.0**53, side="right")
            some = np.flatnonzero(count)
            n = count[some]
            owner = np.repeat(some, n)
            which = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            dart = mix(cell[owner] + (which + 1).astype(_U64) * _U64(0x9E3779B97F4A7C15))
            place = mix(dart ^ _U64(0xD1B54A32D192ED03))
            rank = low + (place >> _U64(32)).astype(np.float64) / 2.0**32 * (high - low)
            weight = left + (place & _U64(0xFFFFFFFF)).astype(np.float64) / 2.0**32 * (right - left)
            owner = reached[owner]
            hit = (rank < horizon[owner]) & (weight < weights[owner])
            ids.append(dart[hit])
            ranks.append(rank[hit])
            owners.append(owner[hit])
        return np.concatenate(ids), np.concatenate(ranks), np.concatenate(owners)

    def signatures(self, sets: list[np.ndarray], weights: list[np.ndarray] | None = None) -> np.ndarray:
        """A row for each set: the earliest dart of each coordinate.  Elements are distinct and not none; weights are positive, 1 by default."""
        out = np.zeros((len(sets), self.k), _U64)
        weights = [np.ones(len(x)) for x in sets] if weights is None else weights
        horizons = [self.t / float(w.sum()) for w in weights]
        todo = sorted(range(len(sets)), key=lambda i: len(sets[i]))  # sets of like size have like horizons
        while todo:
            again = []
            for group in self._groups(todo, sets):
                of = np.repeat(np.arange(len(group)), [len(sets[i]) for i in group])
                ids, ranks, owners = self.darts(np.concatenate([sets[i] for i in group]), np.concatenate([weights[i] for i in group]), np.array([horizons[i] for i in group])[of])
                slot = of[owners] * self.k + (((ids >> _U64(32)) * _U64(self.k)) >> _U64(32)).astype(np.int64)
                # The order of positive floats is that of their bits; the lowest of these make room for the dart's place.
                bits = max(1, int(len(ids)).bit_length())
                packed = (ranks.view(_U64) >> _U64(bits) << _U64(bits)) | np.arange(len(ids), dtype=_U64)
                best = np.full(len(group) * self.k, np.iinfo(_U64).max, _U64)
                np.minimum.at(best, slot, packed)
                empty = (best == np.iinfo(_U64).max).reshape(len(group), self.k).any(axis=1)
                done = np.flatnonzero(~empty)
                first = (best & _U64((1 << bits) - 1)).reshape(len(group), self.k)[done].astype(np.int64)
                out[np.array(group)[done]] = ids[first]
                for i in np.array(group)[empty].tolist():  # a coordinate without a dart: throw further
                    horizons[i] *= 2
                    again.append(i)
            todo = again
        return out

    @staticmethod
    def _groups(order: list[int], sets: list[np.ndarray]) -> Iterator[list[int]]:
        """Runs of at most 128 sets and about 100,000 elements."""
        group, size = [], 0
        for i in order:
            if group and (len(group) == 128 or size + len(sets[i]) > 100_000):
                yield group
                group, size = [], 0
            group.append(i)
            size += len(sets[i])
        if group:
            yield group

    def signature(self, elements: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return self.signatures([elements], None if weights is None else [weights])[0]


def shingles(words: list[str], size: int, memo) -> np.ndarray:
    """Distinct hashes of all runs of size words; of all words together where there are fewer."""
    if not words:
        return np.empty(0, _U64)
    hashes = word_hashes(words, memo)
    n = max(1, len(hashes) - size + 1)
    total = np.zeros(n, _U64)
    for i in range(min(size, len(hashes))):
        total = mix(total + hashes[i : i + n] * _U64(2 * i + 3))
    return np.unique(total)


def _bands(signatures: np.ndarray, near: Near) -> np.ndarray:
    """The keys of all bands, a row for each signature."""
    rows = signatures.reshape(len(signatures), near.bands, near.rows)
    key = np.broadcast_to(np.arange(near.bands, dtype=_U64), rows.shape[:2])
    for i in range(near.rows):
        key = mix(key * _U64(31) + rows[:, :, i])
    return key.view(np.int64)


def node_of(text: Column) -> Column:
    """What names a text: a hash of its words, by which copies count once from here on."""
    return F.xxhash64(F.trim(collapse(text)))


def sketches(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, node, band keys (none without a word) and 32 bits of each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, memo = DartMinHash(near.bands * near.rows), hash_memo()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                elements = [shingles(split_words(text), near.words, memo) for text in batch.column("text").to_pylist()]
                some = [i for i, x in enumerate(elements) if len(x)]
                bands = [np.empty(0, np.int64)] * len(elements)
                for i, keys in zip(some, _bands(hasher.signatures([elements[i] for i in some]), near), strict=True):
                    bands[i] = keys
                sets = [np.unique(x >> _U64(32)).astype(np.uint32).view(np.int32) for x in elements]
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate([np.empty(0, kind), *values]).astype(kind)))
                    for values, kind in ((bands, np.int64), (sets, np.int32))
                ]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("node"), *lists], names=["doc_id", "node", "bands", "shingles"])

    return docs.select("doc_id", node_of(F.col("text")).alias("node"), "text").mapInArrow(freeing(run), SKETCH)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least the similarity."""
    size_a, size_b = F.size("set_a"), F.size("set_b")
    sized = sets.select("node", F.size("shingles").alias("n"))
    # Sizes first: sets that differ too much in size are not fetched.
    near = pairs.join(sized.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a").join(sized.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
    near = near.where(F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")).select("a", "b")
    with_a = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    with_both = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return with_both.where(shared >= similarity * (size_a + size_b - shared)).select("a", "b")


def _labels(nodes: DataFrame, merged: DataFrame, before: DataFrame | None) -> DataFrame:
    """(node, label) after components were merged; before has the labels until then, by default each node's own name."""
    now = before if before is not None else nodes.select("node", F.col("node").alias("label"))
    moved = now.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
    return moved.select("node", F.coalesce("to", "label").alias("label"))


def _across_small(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links across the components of buckets of at most SMALL members, pair by pair."""
    other = members.select("bucket", F.col("node").alias("b"), F.col("label").alias("label_b"))
    pairs = members.join(other, "bucket").where("node < b AND label <> label_b").select(F.col("node").alias("a"), "b").distinct()
    return _confirmed(pairs, sets, similarity)


def links_between(a: list[tuple[int, int, np.ndarray]], b: list[tuple[int, int, np.ndarray]], similarity: float) -> list[tuple[int, int]]:
    """For two blocks of (node, label, set) as many links as it takes to connect all labels that links connect."""
    values = [np.concatenate([x[2] for x in block]) for block in (a, b)]
    owners = [np.repeat(np.arange(len(block)), [len(x[2]) for x in block]) for block in (a, b)]
    shared = np.intersect1d(values[0], values[1])
    common = np.zeros((len(a), len(b)), np.float32)
    columns = [np.searchsorted(shared, v) for v in values]
    present = [np.append(shared, 0)[c] == v for c, v in zip(columns, values, strict=True)]
    present = [p & (c < len(shared)) for p, c in zip(present, columns, strict=True)]
    for low in range(0, len(shared), 4096):
        parts = []
        for block, owner, column, there in zip((a, b), owners, columns, present, strict=True):
            here = there & (column >= low) & (column < low + 4096)
            part = np.zeros((len(block), min(4096, len(shared) - low)), np.float32)
            part[owner[here], column[here] - low] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T
    sizes = [np.array([len(x[2]) for x in block], np.float64) for block in (a, b)]
    alike = common >= similarity * (sizes[0][:, None] + sizes[1][None, :] - common.astype(np.float64))
    names, number = np.unique([x[1] for block in (a, b) for x in block], return_inverse=True)
    of_a, of_b = number[: len(a)], number[len(a) :]
    in_a, in_b = ([np.flatnonzero(of == label) for label in range(len(names))] for of in (of_a, of_b))
    # A walk over the labels, from each to those it has a link with and that were not reached yet.
    reached = np.zeros(len(names), bool)
    found = []
    for start in range(len(names)):
        stack = [] if reached[start] else [start]
        reached[start] = True
        while stack:
            label = stack.pop()
            for i in in_a[label]:
                for j in np.flatnonzero(alike[i] & ~reached[of_b]):
                    if not reached[of_b[j]]:
                        reached[of_b[j]] = True
                        stack.append(of_b[j])
                        found.append((a[i][0], b[j][0]))
            for j in in_b[label]:
                for i in np.flatnonzero(alike[:, j] & ~reached[of_a]):
                    if not reached[of_a[i]]:
                        reached[of_a[i]] = True
                        stack.append(of_a[i])
                        found.append((a[i][0], b[j][0]))
    return found


def _across_large(members: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """The same for larger buckets, block by block: blocks are bounded in members and bytes, and a task
    compares two at a time and gives a forest of links between components, never their pairs."""
    spark = members.sparkSession
    sized = members.join(sets, "node")
    weight = sized.groupBy("bucket").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_MEMBERS, F.sum(F.size("shingles")) / BLOCK_SHINGLES)).alias("blocks"))
    weight = scratch.save(weight, "weights")
    dealt = sized.join(weight, "bucket").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")))
    dealt = dealt.repartition("bucket", "block")  # else the join's partitions by bucket would do for the grouping, with all blocks in a task
    blocks = scratch.save(dealt.groupBy("bucket", "block").agg(F.collect_list(F.struct("node", "label", "shingles")).alias("rows")), "blocks")
    pairs = blocks.join(blocks.select("bucket", F.col("block").alias("block_b"), F.col("rows").alias("rows_b")), "bucket").where("block <= block_b").select("rows", "rows_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for name_a, name_b in zip(batch.column("rows"), batch.column("rows_b"), strict=True):
                a, b = ([(x["node"].as_py(), x["label"].as_py(), x["shingles"].values.to_numpy(zero_copy_only=False)) for x in block] for block in (name_a, name_b))
                links += links_between(a, b, similarity)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4")  # rows of up to a block's size each
    try:
        return scratch.save(pairs.mapInArrow(freeing(run), "a long, b long"), "large-links")
    finally:
        spark.conf.set(setting, before)


def classes(docs: DataFrame, near: Near = Near(), scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, node, label): rows with the same label are near-duplicates, directly or by way of others."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "minhash")
    sketch = scratch.save(sketches(docs, near), "sketches")
    bands = sketch.where(F.size("bands") > 0).groupBy("node").agg(F.first("bands").alias("bands"))
    every = scratch.save(bands.select("node", F.explode("bands").alias("bucket")), "every")
    shared = scratch.save(every.groupBy("bucket").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1"), "shared")
    entries = scratch.save(every.join(shared, "bucket"), "entries")
    scratch.drop("every")
    nodes = entries.select("node").distinct()
    sets = sketch.select("node", "shingles").join(nodes, "node").groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = scratch.save(sets, "sets")
    scratch.drop("shared")

    # First each node with the first member of one of its buckets, which joins most of what is alike.
    first = entries.where("node <> first").groupBy("node").agg(F.min("first").alias("b")).withColumnRenamed("node", "a")
    links = scratch.save(_confirmed(first, sets, near.similarity), "first-links")
    labels = scratch.save(_labels(nodes, components(links, scratch, "first"), None), "first-labels")
    # Then, in buckets that still have several components, every pair across them.
    placed = scratch.save(entries.select("bucket", "node", "members").join(labels, "node"), "placed")
    scratch.drop("entries")
    divided = scratch.save(placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket"), "divided")
    open_ = scratch.save(placed.join(divided, "bucket"), "open")
    scratch.drop("placed")
    links = scratch.save(_across_small(open_.where(F.col("members") <= SMALL), sets, near.similarity).union(_across_large(open_.where(F.col("members") > SMALL), sets, near.similarity, scratch)), "more-links")
    if not links.isEmpty():
        of_a, of_b = (labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
        between = links.join(of_a, "a").join(of_b, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        labels = scratch.save(_labels(nodes, components(between, scratch, "more"), labels), "more-labels")
    scratch.drop("sets")
    found = sketch.select("doc_id", "node").join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label"))
    return scratch.save(found, "classes")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """For every row its class of near-duplicates.

    Columns: doc_id, class_id (smallest doc_id of the class), class_size (rows), representative (doc_id is
    class_id).  Texts are near-duplicates when the Jaccard similarity of their sets of shingles is at least
    near.similarity; texts of fewer words than a shingle have one shingle of all their words; texts
    without a word (null, empty, blank) are copies of each other.  Null doc_ids come after all others;
    a class without any other has a null class_id.  An empty table gives no row.  Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    found = classes(docs, near, scratch)
    sizes = scratch.save(found.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "sizes")
    return found.join(sizes, "label").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("representative"))


def drop_near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row of each class, with the columns of docs: of those with the smallest doc_id, one with the smallest node."""
    scratch = Scratch(docs.sparkSession, "minhash")
    found = classes(docs, near, scratch)
    kept = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("kept")).select("kept.node", F.col("kept.doc_id").alias("kept_id"))
    kept = scratch.save(kept, "kept")
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    own = docs.toDF(*names).withColumn("node", node_of(F.col(at["text"])))
    one = own.join(kept, "node").where(F.col(at["doc_id"]).eqNullSafe(F.col("kept_id"))).dropDuplicates(["node"])
    return one.select(*(F.col(name).alias(own_name) for name, own_name in zip(names, docs.columns, strict=True)))
