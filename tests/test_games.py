"""Headers, filters, deduplication and statistics on games written by hand."""

import json

import pytest
from pyspark.sql import functions as F

from plycask.config import Config
from plycask.functions import hashes, headers, moves
from plycask.operators import dedupe, filters, openings, positions, scrape, stats, tagging, union

CONFIG = Config()
M1 = "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O Be7 1-0"
M2 = "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O 1-0"
M3 = "1. e4 { [%eval 0.17] } 1... c5 { [%eval 0.2] } 2. Nf3 { [%eval 0.1] } 2... d6 { [%eval 0.3] } 3. d4 1-0"
M4 = "1. e4 {[%clk 0:03:00]} 1... e5 {[%clk 0:02:59.9]} 2. Nf3 {[%clk 0:02:58]} 1-0"
M5 = "1. e4 $1 e5 (1... c5 2. Nf3) 2. Nf3 *"


def game(movetext=M1, **tags):
    return "".join(f'[{k} "{v}"]\n' for k, v in ({"Event": "x"} | tags).items()) + "\n" + movetext


def frame(spark, games):
    return spark.createDataFrame([(i, text) for i, text in enumerate(games)], "k long, pgn string")


def values(spark, games, column):
    return [r[0] for r in frame(spark, games).orderBy("k").select(column).collect()]


def pgn():
    return F.col("pgn")


def test_counts_of_moves(spark):
    games = [game(m) for m in (M1, M2, M3, M4, M5)]
    assert values(spark, games, moves.count_plies(pgn())) == [10, 9, 7, 4, 4]
    assert values(spark, games, moves.count_moves(pgn()))[:4] == [10, 10, 18, 8]


LIMITS = [
    (2500, 2500, "180+0", M1, True, True, True),
    (2499, 2900, "300+0", M1, False, False, False),
    (2600, "?", "300+0", M1, False, False, False),
    (2600, 2600, "60+1", M1, True, False, False),
    (2600, 2600, "-", M1, True, False, False),
    (2600, 2600, "1/86400", M1, True, False, False),
    (2600, 2600, "300", M2, False, False, True),
    (2600, 2600, None, M1, True, False, False),
]


def test_filters_at_their_limits(spark):
    games = [game(m, WhiteElo=w, BlackElo=b, **({"TimeControl": tc} if tc else {})) for w, b, tc, m, *_ in LIMITS]
    control = F.nullif(headers.header(pgn(), "TimeControl"), F.lit(""))
    assert values(spark, games, filters.keep_all(pgn(), CONFIG)) == [x[4] for x in LIMITS]
    assert values(spark, games, filters.keep_limited(pgn(), CONFIG)) == [x[5] for x in LIMITS]
    assert values(spark, games, filters.keep_archived_limited(pgn(), control, CONFIG)) == [x[6] for x in LIMITS]
    evaluated = game(M3 + " 3... cxd4 4. Nxd4 Nf6 5. Nc3 a6", WhiteElo=2600, BlackElo=2600, TimeControl="60+1")
    assert values(spark, [evaluated, games[0]], filters.keep_evaluated(pgn(), CONFIG)) == [True, False]


def test_engine_events(spark):
    engines = ["TCEC S20", "CCC Season 5", "ccc semifinal", "World Computer Chess Ch", "WCCC 2019", "ICGA"]
    people = ["CCC 15", "Computer Open", "Tata Steel"]
    assert values(spark, [game(Event=e) for e in engines + people], filters.engine_event(pgn())) == [True] * 6 + [False] * 3


def test_headers(spark):
    text = game("1. e4 e5\n1-0\n", ID="", Source="Online", Date="2020.??.??", WhiteElo="25x", BlackElo="2600", TimeControl="300+5", White="A")
    row = frame(spark, [text]).select(
        headers.tag(pgn(), "ID"), headers.source(pgn()), headers.official(pgn()), headers.date(pgn()), headers.game_date(headers.date(pgn())), headers.elo(pgn(), "WhiteElo"),
        headers.leading_int(headers.header(pgn(), "WhiteElo")), headers.max_elo(pgn()), headers.base_seconds(headers.header(pgn(), "TimeControl")), headers.result(pgn()), headers.header(pgn(), "Black"),
    ).head()
    assert tuple(row) == (None, "Online", 0, "2020.??.??", None, None, 25, 2600, 300, "1-0", "")
    bare = frame(spark, ["1. e4"]).select(headers.source(pgn()), headers.official(pgn()), headers.date(pgn()), headers.max_elo(pgn()), headers.result(pgn())).head()
    assert tuple(bare) == ("Unknown", 1, "1900.01.01", 0, None)


def test_tagging_and_ratings(spark):
    text = game(WhiteElo=2000, BlackElo=2100, MaxElo=1)
    tagged = values(spark, [text], tagging.tagged(pgn(), F.lit("abc"), "Online"))[0]
    assert tagged.startswith('[ID "abc"]\n[Source "Online"]\n[MaxElo "2100"]\n[Event "x"]') and tagged.count("MaxElo") == 1
    wrong = tagged.replace('MaxElo "2100"', 'MaxElo "9"')
    fixed = {r.k: r for r in tagging.fixed_max_elo(frame(spark, [wrong, tagged, game(WhiteElo=3501), game(MaxElo=7)])).collect()}
    assert fixed[0].pgn == tagged and fixed[0].corrected and not fixed[1].corrected and 2 not in fixed
    assert "MaxElo" not in fixed[3].pgn  # no Source tag to put it behind
    typed = tagging.typed(frame(spark, [tagged])).head()
    assert (typed.id, typed.source, typed.official, typed.max_elo, typed.ply_count, typed.tags["WhiteElo"]) == ("abc", "Online", 0, 2100, 10, "2000")


def test_deduplication(spark):
    link = {"Link": "https://www.chess.com/game/live/42"}
    full = {"Site": "S", "Date": "2020.01.01", "White": "Ann", "Black": "Bob", "WhiteElo": 1, "BlackElo": 2}
    games = [
        game(**link, White="a"), game(M2, **link, White="b"),
        game(**full), game(M2, **(full | {"White": "ANN"})),
        game(White="Ann", Black="Bob"), game(White="Ann", Black="Bob"),
        game(**(full | {"White": ""})), game(**(full | {"White": ""})),
    ]
    kept = lambda df: sorted(r.k for r in df.collect())
    df = frame(spark, games)
    assert kept(dedupe.dedupe(df, ["k"])) == [0, 2, 4, 5, 6, 7]
    assert kept(dedupe.dedupe_archive(df, ["k"])) == [0]
    assert kept(dedupe.dedupe_content(frame(spark, [game(), game(M1 + "\n"), game(M1.replace("e5", "{c} e5")), game(M2)]), ["k"])) == [0, 2, 3]
    once = dedupe.dedupe(df, ["k"])
    assert kept(dedupe.dedupe(once, ["k"])) == kept(once)
    assert kept(dedupe.not_written(df, df.where("k = 0"), dedupe.link_key)) == [2, 3, 4, 5, 6, 7]
    assert tuple(dedupe.dedupe_counts(df, once).head()) == (8, 6, 2)


STATS = [
    ("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", 3, 1, 1, 1, "4052587420147612081"),
    ("rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq - 0 1", 2, 1, 1, 0, "7969150578191078269"),
    ("rnbqkbnr/pppppppp/8/8/3P4/8/PPP1PPPP/RNBQKBNR b KQkq - 0 1", 1, 0, 0, 1, "312488897385882434"),
    ("rnbqkbnr/pp1ppppp/8/2p5/4P3/8/PPPP1PPP/RNBQKBNR w KQkq - 0 1", 1, 0, 1, 0, "12846273627910090123"),
    ("rnbqkbnr/pppp1ppp/8/4p3/4P3/8/PPPP1PPP/RNBQKBNR w KQkq - 0 1", 1, 1, 0, 0, "15711376980980844373"),
]


def test_statistics(spark):
    games = [game("1. e4 e5 1-0", ID="a"), game("1. e4 c5 0-1", ID="b"), game("1. d4 1/2-1/2", ID="c"), game("1. e4 *", ID="d"), game("1. e4 1-0", ID="e", White="TCEC Bot"), game("1. e4 1-0")]
    found = positions.positions(frame(spark, games))
    table = stats.position_stats(found)
    rows = stats.ordered(table).collect()
    assert [(r.fen, r.occurrence, r.white, r.black, r.draw, r.hash) for r in rows] == STATS
    assert found.count() == 8 and all(r.occurrence == r.white + r.black + r.draw for r in rows)
    assert [r.occurrence for r in stats.ordered(stats.without_single(table)).collect()] == [3, 2] and stats.recurrent(table).isEmpty()
    index = positions.position_index(found)
    assert index.columns == ["hashFen", "fen", "gameId", "maxElo", "official", "date"] and index.count() == 8
    v2 = positions.position_index_v2(frame(spark, games))
    assert {r.gameId for r in v2.collect()} == {"a", "b", "c", "d"}
    assert values(spark, ["", "a"], hashes.city_key(pgn())) == ["11160318154034397263", "12917804110809363939"]


def test_validation(spark):
    bad = game("1. e4 Ke4 1-0")
    valid, quarantine = positions.valid_and_quarantine(frame(spark, [game(), bad, bad, game("1. e4 (")]), Config(max_record_chars=1000))
    assert [r.k for r in valid.collect()] == [0]
    assert [(r.error_class, r["count"]) for r in positions.error_histogram(quarantine, 10).collect()] == [("Invalid move in PGN", 2), ("Unbalanced variation", 1)]
    assert positions.checked(frame(spark, [game()]), Config(max_record_chars=3)).head().error == "Record too long"


def test_openings(spark):
    lines = spark.createDataFrame([("A00", "X", "1. e4 e5", 0), ("B00", "King's Pawn", "1. e4", 1), ("Z", "bad", "1. d4 Ke4", 2)], "eco string, name string, pgn string, seq long")
    rows = [tuple(r) for r in openings.openings(lines).collect()]
    assert rows == [
        ("B00", "King's Pawn", "1. e4", "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq - 0 1", 1),
        ("A00", "X", "1. e4 e5", "rnbqkbnr/pppp1ppp/8/4p3/4P3/8/PPPP1PPP/RNBQKBNR w KQkq - 0 2", 2),
        ("Z", "bad", "1. d4", "rnbqkbnr/pppppppp/8/8/3P4/8/PPP1PPPP/RNBQKBNR b KQkq - 0 1", 1),
    ]


def test_scraping(spark):
    pages = spark.createDataFrame([(1, '<a class="x" href="a/One.pgn">1</a><a href="http://h/Two.pgn">'), (2, '<a href="b/One.pgn"><a href=".pgn"><a href="x.zip">')], "page_id long, html string")
    assert sorted(map(tuple, scrape.links(pages, ".pgn", "http://base/").collect())) == [("One.pgn", "http://base/a/One.pgn"), ("Two.pgn", "http://h/Two.pgn")]
    assert pages.select(scrape.latest_number(F.col("html"))).head()[0] is None
    mixed = spark.createDataFrame([(1, None), (2, ""), (3, '<A\nHREF="a/One.pgn" ID=x>1</A><abbr href="no.pgn"><a href="X.PGN"><a name="b.pgn">'), (4, "a < b <a href=\"c.pgn\"")], "page_id long, html string")
    assert [tuple(r) for r in scrape.links(mixed, ".pgn", "http://base/").collect()] == [("One.pgn", "http://base/a/One.pgn")]


def test_results_tables(spark):
    heading, row = "<TR><Th>n</th></tr>", "<tr class=r><td><b>%s</b></TD><td>9</td></tr>"
    table = lambda *rows: f'<table class="x"><tr><td>5</td></tr></table><TABLE CLASS="a Results-Table b">{heading}{"".join(row % x for x in rows)}</Table>'
    pages = [table(" 1555 ", 2), table("1556abc", 2), table(7), table("none", 2), table("x1", 3), None, "", "<table class='results-table'>", heading, table(1, 2)[:-8], table("-3", 1) + table(8, 9)]
    found = spark.createDataFrame([(i, x) for i, x in enumerate(pages)], "i int, html string").select("i", scrape.latest_number(F.col("html")).alias("n")).orderBy("i").collect()
    assert [r.n for r in found] == [1555, 1556, None, None, None, None, None, None, None, None, -3]


def test_union_and_counters(spark):
    df, observation = union.observed(union.compiled([frame(spark, [game()]), frame(spark, [game(), game()])]), "n", second=F.col("source_ord") == 1)
    assert df.count() == 3 and observation.get == {"total": 3, "second": 2}
    with pytest.raises(ValueError):
        union.compiled([])


def test_configuration():
    config = Config.of_json(json.dumps({"minOnlineElo": 2400, "generateFen": False, "unknown": 1}))
    assert config.min_online_elo == 2400 and not config.generate_fen and config.min_ply_depth == 10
