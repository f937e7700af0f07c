import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plycask.llm import bpe_count, packing
from tests.llm.tables import documents, odd_rows

ODD = [
    "", " ", "  ", " a", "a  b   c\n\n\t x", "<s> hi </s> <0x41>", "▁▁x▁", "日本語テキスト😀 ok", "a" * 3000, "<|endoftext|> a <|endoftext|>",
    "é" * 50 + "\u0000 x", "don't we'll  \n  x   ", "x\n y \nz", "x \t y\r\n", "a\u00a0b \u3000c\u2009 d", "ends \n", "١٢٣ ½² x²", "\x1c \x1f a\x85b", "\ue000", "I'm 'S 's'", "tab\tnbsp\xa0 end ",
]


def texts(spark):
    table = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rng = random.Random(4)
    noise = ["".join(rng.choice("ab é\n\t.,'1▁😀 \u2003") for _ in range(60)) for _ in range(300)]
    return ODD + noise + table


def test_counts_of_the_library(spark):
    rows = list(enumerate(texts(spark))) + odd_rows()
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = bpe_count.token_counts(documents(spark, rows), path, 20).collect()
    wanted = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 20) for i, t, *_ in rows]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert bpe_count.token_counts(documents(spark, rows).limit(0), path).count() == 0


def test_pieces_hold_every_token_once(spark):
    rows = list(enumerate(texts(spark))) + [(None, "no name"), (None, None), (10**6, "x " * 3000)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows if i is not None}
    found = packing.pack(documents(spark, rows), path, group_tokens=5000).collect()
    sequences, pieces = {}, {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
        if r.doc_id is not None:
            pieces.setdefault(r.doc_id, []).append((r.start, r.length))
            part = ids[r.doc_id][r.start : r.start + r.length]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and len(ids[r.doc_id]) == r.doc_tokens
    assert set(pieces) == set(ids)
    for doc_id, parts in pieces.items():
        assert [start for start, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1].tolist()]
        assert sum(n for _, n in parts) == len(ids[doc_id])
    for parts in sequences.values():
        parts.sort()
        assert [offset for offset, _, _ in parts] == [0, *np.cumsum([n for _, n, _ in parts])[:-1].tolist()]
        total = sum(n for _, n, _ in parts)
        assert total <= 1024 and {size for _, _, size in parts} == {total} and total & (total - 1) == 0
    assert packing.pack(documents(spark, odd_rows()).limit(0), path).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_groups_are_packed_without_padding(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 100, 300, 700, 1024, 1500, 9000]) + rng.randrange(50) for _ in range(rng.randrange(1, 80))]
    sequences = packing.pack_group(lengths, 1024)
    sizes = [sum(n for _, _, n in sequence) for sequence in sequences]
    assert sum(sizes) == sum(lengths) and all(n & (n - 1) == 0 for n in sizes)
    rest = [n for n in sizes if n < 128]
    assert len(rest) == len(set(rest)) and all(n in (1024, 512, 256, 128) for n in sizes if n not in rest)


def test_each_tier_is_packed_in_its_own_windows():
    rng = random.Random(2)
    lengths = [rng.choice([2 * rng.randrange(1000), rng.randrange(1, 500), rng.randrange(1, 300), rng.randrange(1, 130), rng.randrange(1, 100)]) + 1 for _ in range(1000)]
    sequences = packing.pack_group(lengths, 1024)
    sizes = Counter(sum(n for _, _, n in sequence) for sequence in sequences)
    assert all(sizes[tier] > 10 for tier in (1024, 512, 256, 128)), sizes
    assert sum(size * n for size, n in sizes.items()) == sum(lengths)
    # A window of a tier begins with a rest that is routed there, whole; few documents are cut besides where windows are full.
    for sequence in sequences:
        total = sum(n for _, _, n in sequence)
        if total in (1024, 512, 256) and len(sequence) > 1:
            assert sequence[0][2] > total // 2
    pieces = Counter(doc for sequence in sequences for doc, _, _ in sequence)
    cut = sum(n - (lengths[doc] + 1023) // 1024 for doc, n in pieces.items())
    assert cut <= len(sequences) / 2


def test_step_groups_have_equal_loads(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(16)
    found = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    loads = [r.tokens for r in found.groupBy("step_group").agg(F.sum("length").alias("tokens")).collect()]
    assert len(loads) == 64 and max(loads) <= 1.2 * sum(loads) / 64


def test_window_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(documents(spark, odd_rows()), "", 1000)


def test_step_groups_are_balanced_over_many_partitions(spark):
    rows = [(i, "a b c d e f g h i j k") for i in range(48)]  # each a partition: one sequence of eight tokens and one of four
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 48), "doc_id long, text string")
    found = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), step_groups=8).select("sequence_id", "tier", "step_group").distinct()
    counts = {(r.tier, r.step_group): r["count"] for r in found.groupBy("tier", "step_group").count().collect()}
    tiers = {tier for tier, _ in counts}
    assert len(tiers) > 1 and counts == {(tier, group): 6 for tier in tiers for group in range(8)}
