import zlib

import numpy as np
from pyspark.sql import functions as F

from plycask.llm import language_id
from plycask.llm.language_id import ChunkScores, Fit, LanguageModel, features_of
from tests.llm.tables import documents, odd_rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(found) == len(lang)
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in lang)
    held = [i for i in lang if found[i].held_out]
    assert np.mean([found[i].lang_pred == lang[i] for i in held]) > 0.97
    assert all(0 <= found[i].score <= 1 for i in lang)


def test_predictions_read_whole_texts_and_nothing_else(spark):
    rows = [(i, ("the of and to in that " if i % 2 else "der die und ist nicht ein ") * 5, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "the of and " + "der die und ist " * 200, "xx"), (101, None, None), (102, "12 !!", None), (None, "the of and to", "en")]
    found = {r.doc_id: r for r in language_id.identify(documents(spark, rows)).collect()}
    assert found[100].lang_pred == "de" or found[100].lang_pred == "xx"
    assert found[101].lang_pred == found[102].lang_pred == "und" and found[101].score == 0
    assert found[None].held_out is False and found[None].lang_pred == "en"


def test_tables_without_labels(spark):
    unlabelled = documents(spark, [(i, t, None) for i, t, *_ in odd_rows()])
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    assert language_id.identify(documents(spark, odd_rows()).limit(0)).count() == 0
    assert len(language_id.identify(documents(spark, odd_rows())).collect()) == len(odd_rows())


def test_chunks_add_up_to_the_text():
    texts = ["Das ist, nicht-wahr? ein Test.", "der ÉTÉ die 12und"] * 6
    model = LanguageModel.train(texts, ["a", "b"] * 6, Fit(bits=10))
    for text in texts + ["zz\x1cß  x\ny", "lang" * 50 + " kurz"]:
        found = features_of(text, 10)
        sums = ChunkScores(model, most=500).sums(text)
        assert sums[0] == len(found)
        assert np.allclose(sums[1:], model.table[found].sum(axis=0, dtype=float), atol=1e-4)


def test_calibration_finds_the_temperature():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(20_000, 3)) * 2
    p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    wanted = np.array([rng.choice(3, p=x) for x in p])
    assert abs(LanguageModel.calibrate(scores * 3, wanted) - 3) < 0.2


def test_sparse_weights():
    texts = [f"{'the of and' if i % 2 else 'der die und'} w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    dense = LanguageModel.train(texts, ["e", "d"] * 100, Fit(bits=12, l1=0.0))
    sparse = LanguageModel.train(texts, ["e", "d"] * 100, Fit(bits=12, l1=0.3))
    assert 0 < (sparse.table != 0).sum() < (dense.table != 0).sum()


def test_rejecting(spark):
    rows = [(i, "the of and to in that", "en") for i in range(40)] + [(50, "1 2 3", "en"), (51, None, "en")]
    docs = documents(spark, rows)
    kept = language_id.reject_unknown(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(40))


def test_every_label_is_learned(spark):
    words = lambda i: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{c}q" for c in "aeiouy")
    rows = [(1000 * i + j, f"{words(i)} {words(i)}", f"l{i:02}") for i in range(80) for j in range(9 if i < 70 else 3)]
    rows += [(90_000 + j, "жщ " * (7_000 + j), "long") for j in range(3)]
    found = language_id.reject_unknown(documents(spark, rows))
    assert sorted(r.doc_id for r in found.collect()) == sorted(row[0] for row in rows)
    fit = Fit(max_weights=81 << 15)
    lang = {row[0]: row[2] for row in rows}
    for some in (Fit(), fit):
        judged = language_id.identify(documents(spark, rows), some).collect()
        assert np.mean([r.lang_pred == lang[r.doc_id] for r in judged]) > 0.97
        assert {r.lang_pred for r in judged} == set(lang.values())


def test_a_label_with_one_text_is_not_held_back():
    model = LanguageModel.train([chr(97 + i) * 9 for i in range(20)], [f"{i:02}" for i in range(20)], Fit(bits=12))
    assert [label for label, _ in model.predict([chr(97 + i) * 9 for i in range(20)], ChunkScores(model))] == [f"{i:02}" for i in range(20)]


def test_a_text_without_a_letter_has_no_language(spark):
    rows = [(i, ("the of and to in that " if i % 2 else "der die und ist nicht ein ") * 5, "en" if i % 2 else "de") for i in range(60)]
    odd = ["½ ²", "Ⅷ", "①", "12 !!", "_", "\u0301 \u0302", "\u20e3"]
    rows += [(100 + i, text, None) for i, text in enumerate(odd)] + [(200, "½ und die", None)]
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(documents(spark, rows)).collect()}
    assert all(found[100 + i] == ("und", 0.0) for i in range(len(odd)))
    assert found[200][0] == "de"


def test_predictions_against_plain_sums(spark):
    """Every document's label and score, recomputed from the features of its whole text one by one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learn = language_id.remainder(F.col("doc_id")) != 1
    model = language_id.train(docs, learn)
    wanted = {}
    for r in docs.collect():
        z = np.zeros(len(model.labels))
        features = features_of(r.text or "", model.fit.bits)
        for feature in features:
            z += model.table[feature]
        if not len(features):
            wanted[r.doc_id] = ("und", 0.0)
            continue
        z = (z / len(features) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        wanted[r.doc_id] = (model.labels[int(p.argmax())], p.max())
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[i][0] == wanted[i][0] and abs(found[i][1] - wanted[i][1]) < 1e-4 for i in wanted)


def test_the_sample_is_the_rows_of_least_hash(spark):
    """Whole against a plain sort, with a label that nearly all rows have and ids that repeat."""
    rows = [(i % 900, f"text {i}", "en" if i % 50 else "xx") for i in range(5000)] + [(7, f"same {i}", "yy") for i in range(300)]
    docs = documents(spark, rows)
    fit = Fit(max_train_docs=90, min_label_docs=8)
    found = language_id.sample(docs, F.lit(True), fit)
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(9)).alias("h")).distinct().collect()}
    for label in ("en", "xx", "yy"):
        wanted = sorted((hashed[i], i, text) for i, text, lang in rows if lang == label)[:30]
        assert sorted(text for text, lang in found if lang == label) == sorted(text for _, _, text in wanted)


def test_very_long_texts(spark):
    rows = [(i, ("the of and to in that " if i % 2 else "der die und ist nicht ein ") * 5, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "der die und " * 300_000 + "the " * 10, None), (101, "x" * 1_000_000 + " the of and to", None)]
    found = {r.doc_id: r for r in language_id.identify(documents(spark, rows)).collect()}
    assert found[100].lang_pred == "de" and found[101].lang_pred in ("de", "en")
