"""Typed games from their text, and the tags that ingestion puts before a game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plycask.config import Config
from plycask.functions import hashes, headers, moves

_MAX_ELO = r'\[MaxElo\s+"[^"]*"\]\n?'
_ORDER = ["source_file", "block", "seq"]


def typed(raw: DataFrame, source: str | None = None) -> DataFrame:
    """The table of games from texts: every tag in a map, those that queries need as typed columns.

    source names what the games come from; without it they must carry their own Source tag, as tagged files do.
    """
    pgn = F.col("pgn")
    named = F.lit(source) if source else headers.tag(pgn, "Source")
    return raw.select(
        F.coalesce(headers.tag(pgn, "ID"), hashes.game_id(F.coalesce(named, F.lit("Unknown")), pgn)).alias("id"),
        named.alias("source"),
        F.when(named == headers.ONLINE, 0).otherwise(1).alias("official"),
        headers.tag(pgn, "Event").alias("event"),
        headers.tag(pgn, "Site").alias("site"),
        headers.date(pgn).alias("date_raw"),
        headers.game_date(headers.date(pgn)).alias("game_date"),
        headers.tag(pgn, "White").alias("white"),
        headers.tag(pgn, "Black").alias("black"),
        headers.elo(pgn, "WhiteElo").alias("white_elo"),
        headers.elo(pgn, "BlackElo").alias("black_elo"),
        headers.max_elo(pgn).alias("max_elo"),
        headers.tag(pgn, "TimeControl").alias("time_control"),
        headers.base_seconds(headers.header(pgn, "TimeControl")).alias("base_seconds"),
        headers.result(pgn).alias("result"),
        moves.count_plies(pgn).alias("ply_count"),
        headers.all_tags(pgn).alias("tags"),
        headers.movetext(pgn).alias("movetext"),
        pgn,
        *(F.col(name) for name in _ORDER if name in raw.columns),
    )


def tagged(pgn: Column, identifier: Column, source: str) -> Column:
    """The text with ID, Source and MaxElo before its first Event tag, in place of any MaxElo it has."""
    bare = F.regexp_replace(pgn, _MAX_ELO, "")
    before = F.concat(F.lit('[ID "'), identifier, F.lit(f'"]\n[Source "{source}"]\n[MaxElo "'), headers.max_elo(pgn).cast("string"), F.lit('"]\n'))
    at = F.instr(bare, "[Event ")
    return F.when(at == 0, bare).otherwise(F.concat(F.substring(bare, F.lit(1), at - 1), before, F.substring(bare, at, F.length(bare))))


def with_max_elo(pgn: Column) -> Column:
    """The text with MaxElo recomputed behind its Source tag; without such a tag MaxElo goes and does not come back."""
    bare = F.regexp_replace(pgn, _MAX_ELO, "")
    return F.regexp_replace(bare, r'(\[Source\s+"[^"]*"\]\n)', F.concat(F.lit('$1[MaxElo "'), headers.max_elo(pgn).cast("string"), F.lit('"]\n')))


def fixed_max_elo(raw: DataFrame, config: Config = Config()) -> DataFrame:
    """Games with a right MaxElo, and whether it was wrong before (corrected); games rated above the limit are dropped."""
    old, new = headers.leading_int(headers.tag(F.col("pgn"), "MaxElo")), headers.max_elo(F.col("pgn"))
    found = raw.select("*", new.alias("max_elo"), (~old.eqNullSafe(new)).alias("corrected")).where(F.col("max_elo") <= config.max_elo)
    return found.withColumn("pgn", with_max_elo(F.col("pgn")))
