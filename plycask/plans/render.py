"""Games made from the orders table, so that the operators on game texts can run, and be checked, on any scale of it.

Every attribute is a function of an order's columns, which SQL can compute without the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Move texts by the order's key modulo their number.  The third and fourth have evaluations, the sixth an en-passant capture, the last an illegal move.
BOOK = [
    "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O Be7",
    "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O",
    "1. e4 { [%eval 0.17] } 1... c5 { [%eval 0.2] } 2. Nf3 { [%eval 0.1] } 2... d6 { [%eval 0.3] } 3. d4",
    "1. d4 d5 2. c4 e6 3. Nc3 Nf6 4. Bg5 { [%eval 0.1] } Be7 5. e3 O-O",
    "1. e4 e6 2. d4 d5 3. e5 c5 4. c3 Nc6 5. Nf3 Qb6 6. a3",
    "1. e4 a6 2. e5 d5 3. exd6 cxd6 4. d4 Nf6 5. Nf3 Bg4",
    "1. e4",
    "1. d4 Nf6 2. Ke3",
]
EVENTS = ["Rated Blitz game", "TCEC S20", "CCC Season 5", "CCC 15", "World Computer Chess Ch", "Tata Steel", "ICGA Cup", "Computer Open"]
TIME_CONTROLS = ["180+0", "60+1", "300", "-", "1/86400"]


def _pick(values: list[str], index: str) -> Column:
    return F.get(F.array(*(F.lit(value) for value in values)), F.expr(index).cast("int"))


def _line(name: str, value: Column) -> Column:
    """A tag's line; the empty string where the value is null."""
    return F.coalesce(F.concat(F.lit(f'[{name} "'), value, F.lit('"]\n')), F.lit(""))


def games(orders: DataFrame) -> DataFrame:
    """k (the order's key), time_control and pgn."""
    when = lambda condition, value: F.when(F.expr(condition), value)
    text = lambda expression: F.expr(expression).cast("string")
    n = "(o_orderkey % 997)"
    result = F.when(F.expr("o_orderkey % 17 = 0"), "*").when(F.col("o_orderstatus") == "F", "1-0").when(F.col("o_orderstatus") == "O", "0-1").otherwise("1/2-1/2")
    time_control = _pick(TIME_CONTROLS, "(o_orderkey div 3) % 6")
    tags = [
        ("ID", when("o_orderkey % 23 <> 0", F.concat(F.lit("g"), text("o_orderkey")))),
        ("Source", when("o_orderkey % 19 <> 0", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Online").otherwise("Official"))),
        ("MaxElo", F.lit("2600")),
        ("Event", _pick(EVENTS, "(o_orderkey div 8) % 8")),
        ("Site", F.concat(F.lit("S"), text(f"{n} % 5"))),
        ("Date", when(f"{n} % 13 <> 0", F.date_format(F.expr(f"date_add(DATE'2020-01-01', cast({n} % 28 as int))"), "yyyy.MM.dd"))),
        ("White", F.concat(F.lit("P"), text(f"{n} % 40"))),
        ("Black", F.concat(F.lit("Q"), text(f"{n} % 37"))),
        ("Result", result),
        ("WhiteElo", F.when(F.expr(f"{n} % 11 = 0"), "?").otherwise(text(f"2300 + {n} % 400"))),
        ("BlackElo", text(f"2350 + {n} * 7 % 300")),
        ("TimeControl", time_control),
        ("UTCTime", F.concat(F.lit("12:00:0"), text(f"{n} % 10"))),
        ("Link", when("o_orderkey % 5 = 0", F.concat(F.lit("https://www.chess.com/game/live/"), text("o_orderkey div 10")))),
    ]
    pgn = F.concat(*(_line(name, value) for name, value in tags), F.lit("\n"), _pick(BOOK, f"o_orderkey % {len(BOOK)}"), F.lit(" "), result)
    # Always true, but not known to be: so that filters and keys read the text as they would a stored column, and do not each make it again.
    made = F.when(F.rand(1) >= 0, pgn)
    return orders.select(F.col("o_orderkey").alias("k"), time_control.alias("time_control"), made.alias("pgn"))


#: The same attributes for DuckDB, and what is known of the move texts: plies of the monthly count, moves of the archive's, evaluations, legality.
GAMES_SQL = f"""
    book(line, count_ply, count_moves, has_eval, valid) AS (VALUES
        (0, 10, 10, false, true), (1, 9, 10, false, true), (2, 7, 18, true, true), (3, 10, 12, true, true),
        (4, 11, 12, false, true), (5, 10, 10, false, true), (6, 1, 2, false, true), (7, 3, 4, false, false)),
    keyed AS (SELECT *, o_orderkey AS k, o_orderkey % 997 AS n FROM orders),
    games AS (
        SELECT k, n, o_orderkey % 8 AS line, count_ply, count_moves, has_eval, valid,
               CASE WHEN k % 23 <> 0 THEN 'g' || k END AS id,
               CASE WHEN k % 19 <> 0 THEN CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online' ELSE 'Official' END END AS source,
               list_extract({EVENTS!r}, CAST((k // 8) % 8 + 1 AS INTEGER)) AS event,
               'S' || (n % 5) AS site,
               CASE WHEN n % 13 <> 0 THEN strftime(DATE '2020-01-01' + CAST(n % 28 AS INTEGER), '%Y.%m.%d') END AS date,
               'P' || (n % 40) AS white, 'Q' || (n % 37) AS black,
               CASE WHEN n % 11 <> 0 THEN CAST(2300 + n % 400 AS INTEGER) END AS white_elo,
               CAST(2350 + n * 7 % 300 AS INTEGER) AS black_elo,
               CASE WHEN (k // 3) % 6 < 5 THEN list_extract({TIME_CONTROLS!r}, CAST((k // 3) % 6 + 1 AS INTEGER)) END AS time_control,
               CASE (k // 3) % 6 WHEN 0 THEN 180 WHEN 1 THEN 60 WHEN 2 THEN 300 WHEN 4 THEN 1 ELSE 0 END AS base_seconds,
               CASE WHEN k % 17 = 0 THEN '*' WHEN o_orderstatus = 'F' THEN '1-0' WHEN o_orderstatus = 'O' THEN '0-1' ELSE '1/2-1/2' END AS result,
               '12:00:0' || (n % 10) AS utc_time,
               CASE WHEN k % 5 = 0 THEN 'chesscom-' || (k // 10) END AS link
        FROM keyed JOIN book ON k % 8 = line)"""
