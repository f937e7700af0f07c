"""Sources, sinks and streams on files."""

import io
import json
import zipfile

import pytest
import zstandard

from plycask.config import Config
from plycask.plans import pipelines
from plycask.sources import json_archives, landing, pgn, sinks, tables
from plycask.streaming import ingest

MOVES = "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O Be7 1-0"


def game(n, moves=MOVES, **tags):
    tags = {"Event": f"E{n}", "EventDate": "2020", "Site": "S", "Date": f"2020.01.{n % 28 + 1:02}", "White": f"W{n}", "Black": "B", "WhiteElo": 2600, "BlackElo": 2700, "TimeControl": "300+0"} | tags
    return "".join(f'[{k} "{v}"]\n' for k, v in tags.items()) + f"\n{moves}\n\n"


@pytest.fixture
def folder(tmp_path):
    text = "junk before\n\n" + "".join(game(i) for i in range(5))
    (tmp_path / "a.pgn").write_text(text.replace("\n", "\r\n"))
    (tmp_path / "b.pgn.zst").write_bytes(zstandard.compress("".join(game(i) for i in range(5, 8)).encode()))
    (tmp_path / "other.txt").write_text(game(99))
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("x/C.PGN", game(8) + game(9))
        z.writestr("readme.txt", game(98))
    return tmp_path


def test_games_of_files(spark, folder):
    plain = pgn.read_pgn(spark, str(folder)).orderBy("source_file", "block", "seq").collect()
    assert [r.pgn for r in plain] == [game(i).rstrip() for i in range(8)]
    zipped = pgn.read_zip(spark, str(folder)).orderBy("seq").collect()
    assert [r.pgn for r in zipped] == [game(8).rstrip(), game(9).rstrip()] and zipped[0].source_file.endswith("c.zip!C.PGN")
    short, long = pgn.too_long(pgn.read_pgn(spark, str(folder)), 10)
    assert short.isEmpty() and long.count() == 8
    assert sorted(r.games for r in pgn.count_games(pgn.read_pgn(spark, str(folder))).collect()) == [3, 5]


def test_a_file_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.pgn").write_text("".join(game(i) for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9999")
    try:
        df = pgn.read_pgn(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert [r.pgn for r in df.orderBy("source_file", "block", "seq").collect()] == [game(i).rstrip() for i in range(400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_of_a_text():
    assert pgn.split_records("x\r\n[Event \"1\"]\r\na [Event in text\n[Event \"2\"]\n") == ['[Event "1"]\na [Event in text', '[Event "2"]']


def test_archives(spark, tmp_path):
    many = {"UTCTime": "12:00:00"}
    games = [{"pgn": game(1, **many), "time_control": "300"}, {"pgn": game(1, **many), "time_control": "300"}, {"pgn": game(2, **many), "time_control": "1/86400"}, {"pgn": game(3), "time_control": "300"}]
    (tmp_path / "a.json").write_text(json.dumps({"games": games, "more": 1}))
    found = json_archives.ingested(json_archives.read_archives(spark, str(tmp_path)))
    assert [r.seq for r in found.collect()] == [0]
    leaders = spark.createDataFrame([([(("Ann",),), (("ann",),), (("Bob",),)],)], "leaders array<struct<user:struct<username:string>>>")
    users = json_archives.usernames(leaders)
    assert sorted(r.username for r in users.collect()) == ["ann", "bob"] and json_archives.complete(users, 2) and not json_archives.complete(users, 3)
    urls = json_archives.archive_urls(spark.createDataFrame([(["u1", "u2"],), ([],)], "archives array<string>"))
    status = json_archives.archive_status(users, urls, spark.createDataFrame([("bob",)], "username string")).head()
    assert tuple(status) == (2, 2, 1)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("18446744073709551615", "f1", 2, 1, 1, 0), ("9", "f2", 2, 2, 0, 0), ("5", "f3", 12, 12, 0, 0), ("7", "f4", 1, 0, 0, 1)], "hash string, fen string, occurrence long, white long, black long, draw long")
    sinks.write_stats(rows, str(tmp_path))
    names = {name: [r.fen for r in tables.read_stats(spark, f"{tmp_path}/{name}").collect()] for name in ("fens-all", "fens-withoutone", "fens-onlyrecurrent")}
    assert names == {"fens-all": ["f3", "f2", "f1", "f4"], "fens-withoutone": ["f3", "f2", "f1"], "fens-onlyrecurrent": ["f3"]}
    a, b = sinks.write_version(rows, f"{tmp_path}/v"), sinks.write_version(rows.limit(1), f"{tmp_path}/v")
    assert spark.read.parquet(a).count() == 4 and spark.read.parquet(b).count() == 1
    index = rows.selectExpr("hash AS hashFen", "fen", "'g' AS gameId", "1 AS maxElo", "1 AS official", "'d' AS date")
    sinks.write_index(index, f"{tmp_path}/i", 2)
    assert spark.read.option("sep", "\t").option("header", "true").csv(f"{tmp_path}/i").count() == 4
    sinks.write_index_table(index, f"{tmp_path}/t", 4)
    assert spark.read.parquet(f"{tmp_path}/t").where("hashFen = '9'").head().fen == "f2"
    (tmp_path / "x").write_bytes(b"text" * 100)
    sinks.compress(f"{tmp_path}/x", f"{tmp_path}/x.zst")
    sinks.decompress(f"{tmp_path}/x.zst", f"{tmp_path}/y")
    assert (tmp_path / "y").read_bytes() == b"text" * 100
    with pytest.raises(ValueError):
        sinks.decompress(f"{tmp_path}/x.gz", f"{tmp_path}/y")


def test_opening_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("eco\tname\tpgn\nA00\tX\t1. e4 e5\nbroken\n")
    (tmp_path / "own.tsv").write_bytes(b"eco\tname\tpgn\r\nB00\tY\t1. e4\r\n")
    rows = tables.read_opening_lines(spark, [f"{tmp_path}/a.tsv", f"{tmp_path}/own.tsv"]).orderBy("seq").collect()
    assert [(r.eco, r.name, r.pgn) for r in rows] == [("A00", "X", "1. e4 e5"), ("B00", "Y", "1. e4")]
    (tmp_path / "p.pv").write_text("one\n\ntwo\n")
    assert [r.value for r in tables.read_progress(spark, f"{tmp_path}/p.pv").collect()] == ["one", "two"]


def test_months_and_weeks(spark):
    assert [r.month for r in landing.months(spark, "2013-03").collect()] == ["2013-01", "2013-02", "2013-03"]
    assert landing.months(spark, "2012-12").isEmpty()
    assert landing.months(spark, "2013-01").head().file == "lichess_db_standard_rated_2013-01.pgn.zst"
    assert [r.week for r in landing.weeks(spark, 921).collect()] == [920, 921] and landing.weeks(spark, 919).isEmpty()


def test_a_stream_reads_each_file_once(spark, tmp_path):
    land, out, at = tmp_path / "land", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    land.mkdir()
    (land / "1.pgn").write_text(game(1) + game(2, TimeControl="60+1") + game(1))
    ingest.composite(pgn.stream_pgn(spark, str(land)), out, at)
    assert spark.read.parquet(out).count() == 2
    (land / "2.pgn").write_text(game(2) + game(3))
    ingest.composite(pgn.stream_pgn(spark, str(land)), out, at)
    assert spark.read.parquet(out).count() == 3
    ingest.monthly(pgn.stream_pgn(spark, str(land)), f"{tmp_path}/monthly", f"{tmp_path}/checkpoint2")
    assert spark.read.parquet(f"{tmp_path}/monthly/limited").count() == 4
    # Moves are no part of the key: of the games of a key the first by file and place stays; games without a key all do.
    (land / "3.pgn").write_text(game(5) + game(4, "1. d4 1-0") + game(4, "1. c4 1-0") + game(6, Black="") * 2)
    (land / "4.pgn").write_text(game(4, "1. e4 1-0") + game(3, "1. a3 1-0"))
    ingest.composite(pgn.stream_pgn(spark, str(land)), out, at)
    last = spark.read.parquet(f"{out}/batch=2")
    assert last.count() == 4 and last.where("dedupe_key IS NULL").count() == 2
    assert last.where("pgn LIKE '%W4%'").head().pgn.endswith("1. d4 1-0")


def test_the_whole_corpus(spark, folder, tmp_path):
    land = tmp_path / "monthly"
    land.mkdir()
    (land / "m.pgn").write_text(game(20) + game(21, WhiteElo=2000) + game(22, "1. e4 Ke4 2. a3 a6 3. b3 b6 4. c3 c6 5. d3 d6 1-0"))
    out = pipelines.build(spark, {"collections": str(folder), "monthly": str(land)}, f"{tmp_path}/out", Config())
    assert out["games"].count() == 11 and out["quarantine"].count() == 1
    start = out["stats"].orderBy("occurrence", ascending=False).head()
    assert start.occurrence == 11 == start.white
    people, engines = pipelines.without_engines(out["games"])
    assert people.count() == 11 and engines.isEmpty()


def test_zip_member_without_games(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.pgn", "nothing")
    (tmp_path / "a.zip").write_bytes(data.getvalue())
    assert pgn.read_zip(spark, str(tmp_path)).isEmpty()
