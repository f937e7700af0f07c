import pickle
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from plycask.llm.decontaminate import BlockMaxIndex, Leak, contamination, drop_contaminated, question_and_answer, tokens
from tests.llm.tables import documents, odd_rows

RNG = random.Random(11)
WORDS = ["the", "of", "and"] + [f"w{i}" for i in range(800)]


def sentence(n):
    return " ".join(RNG.choice(WORDS[:3] if RNG.random() < 0.3 else WORDS) for _ in range(n))


ITEMS = [(i, f"{sentence(20)}. {sentence(12)}.") for i in range(60)]
BENCHMARK = "item_id long, text string, score string"


def build(items, how=Leak()):
    df = Counter(t for _, text in items for t in set(tokens(text)))
    return BlockMaxIndex(items, df, len(items), sum(len(tokens(t)) for _, t in items) / len(items), how)


@pytest.mark.parametrize("threshold,block", [(0.05, 1), (0.1, 4), (0.2, 16), (0.5, 8)])
def test_wand_retrieves_what_full_scoring_does(threshold, block):
    index = build(ITEMS, Leak(score=threshold, block=block))
    for _ in range(200):
        words = set(tokens(sentence(60) + " " + (RNG.choice(ITEMS)[1] if RNG.random() < 0.5 else "")))
        terms = [index.vocabulary[w] for w in words if w in index.vocabulary]
        scores = Counter()
        for t in terms:
            for item, score in zip(*map(list, index._list(index.postings, t)), strict=True):
                scores[item] += score
        wanted = {item: score for item, score in scores.items() if score >= threshold - 1e-9}
        found = dict(index.retrieve(terms))
        assert set(found) == set(wanted) and all(abs(found[i] - wanted[i]) < 1e-9 for i in wanted)


def test_leaks(spark):
    rows, wanted = [], set()
    for i in range(40):
        text = sentence(RNG.choice([0, 5, 300]))
        if i % 3 == 0:
            item = RNG.choice(ITEMS)
            text = f"{text} {item[1] if i % 2 else item[1].upper().replace(' ', chr(10))} {sentence(40)}"
            wanted.add((i, item[0]))
        elif i % 3 == 1:
            text += " " + RNG.choice(ITEMS)[1].split(".")[0]  # the question alone
        rows.append((i, text))
    docs, benchmark = documents(spark, rows + odd_rows()[:4]), spark.createDataFrame([(*x, "s") for x in ITEMS] + [(99, None, "s"), (98, "", "s"), (None, "unseen words entirely", "s")], BENCHMARK)
    found = contamination(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    assert all(0.5 <= r.score <= 1 + 1e-9 and r.question_overlap >= 0.5 for r in found)
    for shard_bytes in (700, 1500):
        sharded = contamination(docs, benchmark, Leak(shard_bytes=shard_bytes)).collect()
        assert sorted(map(tuple, sharded)) == sorted(map(tuple, found))
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    leaking = {i for i, _ in wanted}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((row[0] for row in rows + odd_rows()[:4] if row[0] not in leaking or row in odd_rows()), key=str)
    assert contamination(docs.limit(0), benchmark).count() == 0
    assert contamination(docs, benchmark.limit(0)).count() == 0 and drop_contaminated(docs, benchmark.limit(0)).count() == docs.count()


def test_parts_of_an_item():
    assert question_and_answer("Question: a b? Answer: c") == (["question", "a", "b"], ["c"])
    assert question_and_answer("What is it? A thing.") == (["what", "is", "it"], ["a", "thing"])
    assert question_and_answer("One two. Three.") == (["one", "two"], ["three"])
    assert question_and_answer("a b c d") == (["a", "b", "c"], ["d"])
    assert question_and_answer("a") == (["a"], ["a"])


def test_every_item_of_the_test_table_that_is_there(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    wanted = {(r.doc_id, i) for r in docs.collect() for i, text in items if text in r.text}
    assert {(r.doc_id, r.item_id) for r in contamination(docs, benchmark).collect()} == wanted and wanted


def test_prose_cut_short_or_with_a_word_changed(spark):
    benchmark = spark.createDataFrame([(*x, "s") for x in ITEMS], BENCHMARK)
    short = [(100 + i, f"{sentence(14 + i)}. {sentence(3)}.") for i in range(20)]  # the last sentence is less than an n-gram
    marked = [(200, f"{sentence(24)}? {sentence(8)}."), (201, f"{sentence(24)}. Answer: {sentence(8)}")]
    rows, wanted = [], set()
    for item_id, text in short:
        words = text.split()
        rows.append((item_id, f"{sentence(80)} {text.split('.')[0]} {sentence(80)}"))
        for at in (0, len(words) // 2, len(words) - 1):
            rows.append((1000 * (at + 1) + item_id, f"{sentence(80)} {' '.join(words[:at] + ['changed'] + words[at + 1 :])} {sentence(80)}"))
    wanted = {(doc_id, doc_id % 1000) for doc_id, _ in rows}
    rows += [(900 + i, f"{sentence(80)} {' '.join(text.split()[: len(text.split()) // 2])} {sentence(80)}") for i, (_, text) in enumerate(short)]
    rows += [(950 + i, f"{sentence(80)} {text.replace('Answer:', '?').split('?')[0]} {sentence(80)}") for i, (_, text) in enumerate(marked)]
    benchmark = benchmark.union(spark.createDataFrame([(*x, "s") for x in short + marked], BENCHMARK))
    docs = documents(spark, rows)
    assert {(r.doc_id, r.item_id) for r in contamination(docs, benchmark).collect()} == wanted
    assert {r.doc_id for r in drop_contaminated(docs, benchmark).collect()} == {doc_id for doc_id, _ in rows} - {doc_id for doc_id, _ in wanted}


def plain(index, text):
    """Every item of every class against every window of its class, by full scoring."""
    ids = [index.vocabulary.get(t, -1) for t in tokens(text)]
    found = set()
    for item, stride in enumerate(index.stride.tolist()):
        at = np.flatnonzero(index.postings[1] == item)
        own = dict(zip((np.searchsorted(index.postings[0], at, side="right") - 1).tolist(), index.postings[2][at].tolist(), strict=True))
        for start in range(0, max(1, len(ids)), stride):
            if sum(own.get(t, 0.0) for t in set(ids[start : start + 2 * stride])) >= index.how.score - 1e-9:
                found.add((item, start, stride))
    return found


@pytest.mark.parametrize("score", [0.3, 0.5])
def test_no_window_that_reaches_the_threshold_is_left_out(score):
    items = [(i, sentence(RNG.choice([3, 9, 17, 40]))) for i in range(25)]
    index = build(items, Leak(score=score))
    for _ in range(25):
        parts = [RNG.choice([sentence(RNG.randrange(1, 50)), " ".join(RNG.sample(RNG.choice(items)[1].split(), 3)), RNG.choice(items)[1]]) for _ in range(4)]
        text = " ".join(parts)
        ids = np.array([index.vocabulary.get(t, -1) for t in tokens(text)])
        windows = {(start, stride) for _, start, stride in index.reachable(ids, np.array([len(ids)]))}
        wanted = plain(index, text)
        assert {(start, stride) for _, start, stride in wanted} <= windows


def test_other_items_decide_nothing(spark):
    item = (1, f"{sentence(20)}. {sentence(12)}.")
    docs = documents(spark, [(1, f"{sentence(200)} {item[1]} {sentence(500)}"), (2, sentence(300))])
    found = []
    for more in ([], [(2, sentence(600))], [(3, sentence(5)), (4, sentence(64))]):
        benchmark = spark.createDataFrame([(*x, "s") for x in [item, *more]], BENCHMARK)
        found.append([(r.doc_id, r.item_id, r.question_overlap, r.answer_overlap) for r in contamination(docs, benchmark).collect()])
    assert found == [[(1, 1, 1.0, 1.0)]] * 3


def test_many_short_items_take_little_memory():
    word = lambda: f"v{int(20_000 * RNG.random() ** 2)}"
    items = [(i, " ".join(word() for _ in range(12))) for i in range(20_000)]
    index = build(items)
    assert len(pickle.dumps(index)) < 40 << 20
    texts = [" ".join([*(word() for _ in range(4_000)), items[7][1], *(word() for _ in range(4_000))])] * 2
    tracemalloc.start()
    found = index.leaks(texts)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert all(7 in {index.item_ids[i] for i in x} for x in found)


def test_a_document_in_pieces(monkeypatch):
    index = build(ITEMS)
    text = " ".join([sentence(700), ITEMS[5][1], sentence(130), ITEMS[6][1], sentence(900), ITEMS[5][1]])
    whole = index.leaks([text, "", sentence(50)])
    monkeypatch.setattr(BlockMaxIndex, "_MOST", 300)
    assert index.leaks([text, "", sentence(50)]) == whole and len(whole[0]) == 2


def test_very_long_texts(spark):
    text = sentence(200_000)
    benchmark = spark.createDataFrame([(*x, "s") for x in ITEMS], BENCHMARK)
    docs = documents(spark, [(1, f"{text} {ITEMS[3][1]} {text[:100_000]}"), (2, text)])
    assert [(r.doc_id, r.item_id) for r in contamination(docs, benchmark).collect()] == [(1, 3)]
