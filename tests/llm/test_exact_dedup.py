import hashlib
import re
from collections import defaultdict

import pytest

from plycask.llm import exact_dedup
from plycask.llm.scratch import Scratch
from tests.llm.tables import documents, odd_rows


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    ids = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids[normal(text)].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        group = ids[normal(text)]
        keep = min((i for i in group if i is not None), default=None)
        out.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = odd_rows() + [(20 + i, f"copy  {i % 3}") for i in range(30)] + [(90, " copy 1"), (91, "copy\x0b2")]


def test_groups(spark):
    found = sorted(map(tuple, exact_dedup.groups(documents(spark, ROWS)).collect()), key=str)
    assert found == brute(ROWS)
    assert exact_dedup.groups(documents(spark, ROWS).limit(0)).count() == 0


@pytest.mark.parametrize("digest_bytes", [1, 32])
def test_one_row_of_each_text_stays(spark, digest_bytes):
    """One byte makes different texts share a digest, which the comparison of contents must notice."""
    docs = documents(spark, ROWS)
    kept = exact_dedup.drop_copies(docs, digest_bytes)
    assert kept.columns == docs.columns
    texts = {normal(text) for _, text, *_ in ROWS}
    wanted = [(min((i for i, text, *_ in ROWS if normal(text) == one and i is not None), default=None), one) for one in texts]
    assert sorted(((r.doc_id, normal(r.text)) for r in kept.collect()), key=str) == sorted(wanted, key=str)


def test_state_goes_on_where_it_ended(spark):
    scratch = Scratch(spark, "test")
    schema = "doc_id long, digest binary, file string"
    for rows in ([(5, b"a", "f"), (6, b"b", "f")], [(3, b"a", "g"), (9, b"a", "g")]):
        spark.createDataFrame([(i, bytearray(d), f) for i, d, f in rows], schema).write.mode("append").parquet(scratch.at("landing"))
        exact_dedup.update_state(spark, scratch.at("landing"), spark.read.parquet(scratch.at("landing")).schema, scratch.at("checkpoint"), scratch.at("changes"))
    changes = spark.read.parquet(scratch.at("changes")).where("digest = X'61'").orderBy("batch").collect()
    assert [(r.keep_id, r.keep_file, r.group_size) for r in changes] == [(5, "f", 1), (3, "g", 3)]


def test_batches_over_a_durable_state(spark, tmp_path):
    """Later calls know what earlier ones added, and read the retained documents through their locators."""
    folder, seen = f"file://{tmp_path}/state", []
    batches = [[(i, f"text {i % 4}") for i in range(10, 20)], [(30, "text  1"), (3, "text 2"), (31, "new"), (32, None), (33, "")], [(40, "new"), (5, "text\n3")]]
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/in{number}")
        seen += rows
        found = exact_dedup.add_batch(spark.read.parquet(f"{tmp_path}/in{number}"), folder).collect()
        ids = {row[0] for row in rows}
        assert sorted((tuple(r)[:2] + tuple(r)[3:] for r in found), key=str) == [row for row in brute(seen) if row[0] in ids]
        assert all(f"in{number}" in r.keep_file for r in found if r.kept)
    # The retained document of `text 1` (11, in the first batch) is read again from its file.
    spark.createDataFrame([(i, "other") for i in range(10, 20)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/changed")
    for part in (tmp_path / "in0").glob("part-*"):
        part.write_bytes(next((tmp_path / "changed").glob("part-*")).read_bytes())
    for crc in (tmp_path / "in0").glob(".part-*"):
        crc.unlink()
    spark.createDataFrame([(50, "text 1")], "doc_id long, text string").write.parquet(f"{tmp_path}/in3")
    with pytest.raises(ValueError):
        exact_dedup.add_batch(spark.read.parquet(f"{tmp_path}/in3"), folder)
