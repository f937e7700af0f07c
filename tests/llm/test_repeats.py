import random

import numpy as np
import pytest

from plycask.llm import phrase_dedup, repeats, suffix_dedup
from plycask.llm.segments import Shape
from plycask.llm.suffix_dedup import LogarithmicIndex
from tests.llm import brute
from tests.llm.tables import documents, odd_rows


def corpus(rng, n=60):
    """Texts with shared passages of all lengths, copies, repetition within a text, and periodic stretches."""
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 5)))
    passages = [" ".join(word() for _ in range(rng.choice([20, 34, 35, 36, 50, 90, 200]))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(rng.choice([rng.choice(passages), " ".join(word() for _ in range(rng.randrange(60))), "x " * rng.randrange(90), rng.choice(passages)[: rng.randrange(1, 400)]]))
        texts.append(rng.choice([" ", "\n"]).join(parts))
    return texts + texts[:3] + ["", "z" * 900, "y" * 150]


def check(found, rows, wanted):
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, found), key=key) == sorted(((row[0], *x) for row, x in zip(rows, wanted, strict=True)), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, seed):
    rows = list(enumerate(corpus(random.Random(seed)))) + odd_rows()
    found = phrase_dedup.drop_passages(documents(spark, rows), shard_words=300).collect()
    check(found, rows, brute.words_kept([row[1] for row in rows], 35))


def test_the_automata_locate_the_passages():
    """Without passages in the table, nothing is found where segments of an anchor differ; with them, every occurrence."""
    words = [f"w{i}" for i in range(60)]
    windows = [{"place": i, "holders": 1 if i < 4 else 2, "n": 2} for i in (2, 3, 4, 5, 9)]
    passages = phrase_dedup.runs(words, windows, 35)
    assert passages == [words[2:38], words[4:40], words[9:44]]
    texts = [["x", *words[2:38], "y", *words[2:30]], words[1:40], words[9:44] * 2, [], words[3:37]]
    found = phrase_dedup.locate(texts, passages, shard_words=40)
    assert [x.tolist() for x in found] == [[[1, 37]], [[1, 39]], [[0, 70]], [], []]
    assert [x.tolist() for x in phrase_dedup.locate(texts, [], 40)] == [[]] * 5


def test_without_automata_rows_are_missing(spark, monkeypatch):
    rows = list(enumerate(corpus(random.Random(1))))
    docs = documents(spark, rows)
    whole = {r.doc_id: r.n_removed for r in phrase_dedup.drop_passages(docs).collect()}
    second = phrase_dedup.repeats.FOUND
    monkeypatch.setattr(phrase_dedup, "_located", lambda *_: spark.createDataFrame([], second))
    without = {r.doc_id: r.n_removed for r in phrase_dedup.drop_passages(docs).collect()}
    assert sum(without.values()) < sum(whole.values())


@pytest.mark.parametrize("hot", [500, 1])
def test_bytes_against_brute_force(spark, hot):
    rows = list(enumerate(corpus(random.Random(hot)))) + odd_rows()
    found = suffix_dedup.drop_repeats(documents(spark, rows), hot=hot).collect()
    check(found, rows, brute.bytes_kept([row[1] for row in rows], 200))


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    rng = random.Random(9)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(4000))
    rows = [(1, long), (2, "new " + long[5000:9000] + " end"), (3, long[100:20000])]
    monkeypatch.setattr(repeats, "GROUP", 3000)
    measure = repeats.Measure(Shape(200, 32), suffix_dedup._units, suffix_dedup._raw)
    for text in (long, long[:7000]):
        seen = [s.first + offsets[0] for _, _, _, offsets, _, s in repeats.pieces([text], measure)]
        ends = [s.last + offsets[0] for _, _, _, offsets, _, s in repeats.pieces([text], measure)]
        starts = np.concatenate([np.arange(a, b + 1) for x, y in zip(seen, ends, strict=True) for a, b in zip(x, y, strict=True)])
        assert (starts == np.arange(len(text) - 199)).all()
    found = suffix_dedup.drop_repeats(documents(spark, rows)).collect()
    check(found, rows, brute.bytes_kept([row[1] for row in rows], 200))


def test_texts_that_stay(spark):
    rows = [(1, "a b c"), (2, " ".join(f"w{i}" for i in range(50))), (3, "x " + " ".join(f"w{i}" for i in range(40)))]
    kept = {r.doc_id: r.kept for r in phrase_dedup.drop_passages(documents(spark, rows), with_text=True).collect()}
    assert kept == {1: "a b c", 2: " ".join(f"w{i}" for i in range(40, 50)), 3: "x"}
    rows = [(1, "short"), (2, "é" * 150 + "tail"), (3, "b" + "é" * 130)]
    kept = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.drop_repeats(documents(spark, rows), with_text=True).collect()}
    assert kept == {1: "short", 2: "tail", 3: "b"}


def test_empty_tables(spark):
    empty = documents(spark, odd_rows()).limit(0)
    assert phrase_dedup.drop_passages(empty).count() == 0
    assert suffix_dedup.drop_repeats(empty).count() == 0


def test_levels_grow_geometrically_and_find_every_repeat():
    rng = random.Random(3)
    shape = Shape(24, 8)
    base = bytes(rng.randrange(4) for _ in range(3000))
    contents = [base[a : a + rng.randrange(24, 60)] for a in (rng.randrange(2900) for _ in range(400))]
    contents += [bytes(rng.randrange(256) for _ in range(50)) for _ in range(200)]
    rng.shuffle(contents)
    index, places = LogarithmicIndex(shape), []
    for at in range(0, len(contents), 25):
        start = index.add(contents[at : at + 25])
        for content in contents[at : at + 25]:
            places.append(start)
            start += len(content)
    for level in index.levels:  # real suffix arrays: by their bytes, with the lengths of shared prefixes
        windows = [index.store[at : at + shape.window].tobytes() for at in level.at.tolist()]
        assert windows == sorted(set(windows))
        for a, b, n in zip(windows, windows[1:], level.shared[1:].tolist(), strict=False):
            assert a[:n] == b[:n] and a[n] != b[n]
    sizes = [len(level) for level in index.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    flags = brute.covered(contents, shape.window)
    for content, at, wanted in zip(contents, places, flags, strict=True):
        got = np.zeros(len(content), bool)
        for i in np.flatnonzero(index.repeated[at : at + len(content)]):
            got[i : i + shape.window] = True
        assert got.tolist() == wanted
