import hashlib
import math
import random
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from plycask.llm import pii
from tests.llm.tables import documents, odd_rows

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def holds(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(kind, m.start(), m.end()) for kind, p in PLAIN for m in re.finditer(p, text or "") if holds(kind, m[0])]


TEXTS = [
    "write to a.b+c@mail.example.com, or x@y.z.",
    "a@b.c_d@e.f @@ a@b a@b..c a@.b q@w.e-r.t..u",
    "😀 1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.002.003.004 and 0000000000255.1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1; 4111  1111 1111 1111",
    "call +49 (30) 123456-78, +1.2, +12345678, +1 234 567 89 01 234 5, ++44 20 7946 0958)",
    "a" * 50_000 + "@x.y " + "1." * 20_000 + " +1" + "-" * 30_000 + " z@a" + ".b" * 30_000,
    "1" * 30_000 + " " + "a.b@" * 5_000,
]


def check(df, texts):
    for row in df.collect():
        spans = brute(texts[row.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        base = [span for span in row.spans.split(",") if span and not span.startswith("term:")]
        assert ",".join(base) == joined
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(s[0] == kind for s in spans) for kind, _ in PLAIN)


def test_identifiers_against_plain_patterns(spark):
    texts = dict(enumerate(TEXTS))
    df = pii.digest(documents(spark, list(texts.items())))
    assert df.count() == len(texts)
    check(df, texts)


def test_identifiers_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(pii.digest(docs), {row.doc_id: row.text for row in docs.collect()})


def test_odd_rows(spark):
    rows = odd_rows()
    found = pii.digest(documents(spark, rows)).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, (r[0] for r in rows)))
    assert all(r.spans == "" for r in found)
    assert pii.digest(documents(spark, rows).limit(0)).count() == 0


def test_terms_that_reveal_an_entity(spark):
    rows = [(i, f"Zebulon wrote from zeb@example.org number") for i in range(4)]
    rows += [(10 + i, "others wrote from elsewhere with a number") for i in range(40)]
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).collect()}
    assert [(s.start, s.value) for s in found[0].revealing] == [(0, "Zebulon")]
    assert all(not found[10 + i].revealing for i in range(40))
    spans = pii.digest(documents(spark, rows)).where("doc_id = 0")
    text = documents(spark, rows).select("doc_id", "text")
    clean = spans.join(text, "doc_id").select(pii.sanitise(F.col("text"), F.col("spans")).alias("x")).head().x
    assert clean == " wrote from [EMAIL] number"


@pytest.mark.parametrize("share,revealed", [(0.5, True), (1.0, False)])
def test_threshold(spark, share, revealed):
    rows = [(i, "Quorum met at q@example.org") for i in range(4)] + [(50 + i, "Quorum met") for i in range(4)] + [(100 + i, "nothing here") for i in range(56)]
    found = pii.personal_data(documents(spark, rows), pii.Disclosure(disclosure=share)).where("doc_id = 0").head()
    assert bool(found.revealing) == revealed


def test_terms_of_any_length_and_script(spark):
    terms = ["Ann", "Wu", "李明", "user7", "48213", "हिन्दी", "Jose\u0301", "kim"]
    text = "😀 " + ", ".join(terms) + "; 4111 1111 1111 1111x +49 30 1234567@mail.example.org at 12"
    rows = [(i, text) for i in range(4)] + [(10 + i, "at 12 others x") for i in range(40)]
    spans = {r.doc_id: r.revealing for r in pii.personal_data(documents(spark, rows)).collect()}
    assert [(s.start, s.value) for s in spans[0]] == [(text.index(term), term) for term in terms]
    assert all(not spans[10 + i] for i in range(40))
    clean = pii.digest(documents(spark, rows)).where("doc_id = 0").select(pii.sanitise(F.lit(text), F.col("spans")).alias("x")).head().x
    assert not any(term in clean for term in terms) and "1234567" not in clean


def test_terms_beside_an_identifier(spark):
    rows = [(i, f"4111 1111 1111 1111Zeb 1111 {'1.2.3.4 ' * 3000}") for i in range(3)] + [(10 + i, "others") for i in range(40)]
    spans = pii.personal_data(documents(spark, rows)).where("doc_id = 0").head().revealing
    assert [(s.start, s.value) for s in spans] == [(19, "Zeb"), (23, "1111")]


def plain_terms(texts, how):
    """For each text the terms that reveal one of its entities, by counting every pair."""
    entities, terms = [], []
    for text in texts:
        found, masked = set(), list(text)
        for kind, pattern in PLAIN:
            for match in re.finditer(pattern, text):
                if holds(kind, match.group()):
                    found.add((kind, match.group().lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", match.group())))
                    masked[match.start() : match.end()] = " " * len(match.group())
        runs = regex.findall(r"[\p{L}\p{M}\p{N}]+", "".join(masked))
        entities.append(found)
        terms.append({run for run in runs if not (len(run) < how.min_letters and re.fullmatch("[a-z]+", run))})
    n_entity, n_term = Counter(e for x in entities for e in x), Counter(t for x in terms for t in x)
    both = Counter((e, t) for x, y in zip(entities, terms, strict=True) for e in x for t in y)
    n, revealed = len(texts), set()
    for (e, t), n_both in both.items():
        information = math.log2(n / n_entity[e])
        if n_both >= how.support and information > 0 and math.log2(n_both * n / (n_term[t] * n_entity[e])) >= how.disclosure * information:
            revealed.add((e, t))
    return [{t for t in y if any((e, t) in revealed for e in x)} for x, y in zip(entities, terms, strict=True)]


def test_terms_against_plain_counts(spark):
    rng = random.Random(4)
    names, words = [f"Name{i}" for i in range(12)], [f"w{i}x" for i in range(40)]
    texts = []
    for _ in range(150):
        who = rng.randrange(12)
        parts = [rng.choice(words) for _ in range(rng.randrange(8))]
        if rng.random() < 0.6:
            parts += [f"user{who}@host.org", *([names[who]] if rng.random() < 0.9 else []), *([f"Desk{who // 2}"] if rng.random() < 0.8 else [])]
        if rng.random() < 0.2:
            parts.append(rng.choice(names))
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    texts += texts[:5] + [" ".join(f"a{i}@b.cd t{i}z" for i in range(300))] * 3  # a long list, copied
    for how in (pii.Disclosure(), pii.Disclosure(support=2, disclosure=0.7)):
        docs = documents(spark, [(i % 150, text) for i, text in enumerate(texts)])
        found = sorted((r.doc_id, r.clean, tuple(r.found)) for r in pii.personal_data(docs, how).select("doc_id", F.lit("").alias("clean"), F.array_sort(F.array_distinct(F.transform("revealing", lambda x: x["value"]))).alias("found")).collect())
        wanted = sorted((i % 150, "", tuple(sorted(x))) for i, x in enumerate(plain_terms(texts, how)))
        assert found == wanted and sum(len(x[2]) for x in wanted) > 900
