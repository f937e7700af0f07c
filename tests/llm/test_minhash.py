import random

import numpy as np
import pytest

from plycask.llm import minhash
from plycask.llm.components import components
from plycask.llm.scratch import Scratch
from plycask.llm.words import split_words
from tests.llm.tables import documents, odd_rows


def brute(rows):
    """Smallest doc_id of the component of each document, all pairs compared."""
    sets = {}
    for i, text in rows:
        words = split_words(text)
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else {()}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                label[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_classes_against_all_pairs(spark):
    rng = random.Random(5)
    rows, next_id = [], 0
    for family in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 5, 30, 200, 400]))]
        for copy in range(rng.choice([1, 2, 9])):
            rows.append((next_id, edited(base, rng, copy % 4 if len(base) > 5 else 0)))
            next_id += 1
    rows.append((next_id, rows[0][1].replace(" ", " \n ")))
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert found == brute(rows)


def test_classes_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in found} == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(r.representative == (r.doc_id == r.class_id) for r in found)


def test_buckets_of_texts_that_are_not_alike_lose_no_link(spark):
    """With short signatures nearly everything meets in some bucket; pivots must still reach every pair."""
    rng = random.Random(7)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = [f"o{i}x{j}" for j in range(30)]
        rows += [(2 * i, " ".join(common + own)), (2 * i + 1, edited(common + own, rng, 1))]
    near = minhash.Near(bands=6, rows=1)
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(spark, rows), near).collect()}
    assert found == brute(rows)


def test_odd_rows(spark):
    found = minhash.near_duplicates(documents(spark, odd_rows())).collect()
    assert len(found) == len(odd_rows())
    classes = {r.doc_id: r.class_id for r in found if r.doc_id is not None}
    assert classes[4] == classes[5] == 3 and classes[7] == 6
    assert minhash.near_duplicates(documents(spark, odd_rows()).limit(0)).count() == 0


def test_dropping_keeps_one_row_and_all_columns(spark):
    docs = documents(spark, odd_rows())
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [10, 3, 6, 8, 9, None]


@pytest.mark.parametrize("n", [1, 3, 500, 4000])
def test_signatures_estimate_weighted_similarity(n):
    rng = np.random.default_rng(n)
    hasher = minhash.DartMinHash(400)
    elements = rng.integers(0, 2**63, n, dtype=np.uint64)
    a, b = rng.uniform(0.2, 5, n), rng.uniform(0.2, 5, n)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((hasher.signature(elements, a) == hasher.signature(elements, b)).mean() - truth) < 0.12
    assert (hasher.signature(elements) == hasher.signature(elements[::-1].copy())).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (10, 11), (7, 7)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 600 + i) for i in range(50)]
    found = dict(components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"), "t").collect())
    wanted = {1: 1, 2: 1, 3: 1, 9: 1, 10: 10, 11: 10} | {100 + i: 100 for i in range(41)} | {500: 500} | {600 + i: 500 for i in range(50)}
    assert found == wanted
