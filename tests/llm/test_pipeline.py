"""The pipeline against plain versions of its stages, each on its own input."""

import pytest

import corpus_pipeline
from plycask.llm.scratch import Scratch
from tests.llm.test_exact_dedup import normal
from tests.llm.tables import documents, odd_rows
from tests.llm.test_minhash import brute as near_classes


@pytest.fixture(scope="module")
def stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    scratch = Scratch(spark, "test-pipeline")
    tables = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(scratch.save(stage(spark, tables[-1], sf_dir), name))
    return [table.collect() for table in tables], tables


def test_stages(spark, stages):
    (docs, language, exact, near, clean, packed), tables = stages
    columns = tables[0].columns
    assert all(table.columns == columns for table in tables[:-1])
    assert len(docs) - len(language) <= 0.05 * len(docs)
    wanted = {}
    for r in language:
        wanted[normal(r.text)] = min(r.doc_id, wanted.get(normal(r.text), r.doc_id))
    assert sorted(r.doc_id for r in exact) == sorted(wanted.values())
    classes = near_classes([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted(set(classes.values()))
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in near if not any(item in r.text for item in items))
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    by_id = {r.doc_id: r for r in docs}
    assert all(r == by_id[r.doc_id] for r in clean)


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    whole = {}
    for r in found.collect():
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole == {r.doc_id: r.doc_tokens for r in stages[0][-1]}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_empty_tables(spark, name, stage):
    """Null in any column, empty and very long texts, ties, repeated rows, and columns that clash with the operators' own."""
    sf_dir = "/root/testdata/sf0.001"
    rows = odd_rows() + [(100 + i, f"the same sentence of words stands here again {i % 2} and ends", "en") for i in range(6)] + [(200, "word and text " * 100_000, "en")]
    docs = documents(spark, rows)
    found = stage(spark, docs, sf_dir)
    ids = [r.doc_id for r in found.select("doc_id").collect()]
    empty = stage(spark, docs.limit(0), sf_dir)
    assert empty.count() == 0
    if name == "packing":
        assert {None, 3, 4, 200} <= set(ids)
        return
    assert found.columns == docs.columns == empty.columns
    assert set(ids) <= {row[0] for row in rows} and len(ids) <= len(rows)
    gone = {"language_id": {3, 4, 5, 10}, "exact_dedup": {102, 103, 104, 105}, "near_dedup": {102, 103, 104, 105}, "decontamination": set()}[name]
    assert not gone & set(ids) and {200, 100} <= set(ids)
    if name == "decontamination":
        assert len(ids) == len(rows)
