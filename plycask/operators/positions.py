"""Replay of games into positions: the one operator that needs Python, fed by native filters and read by native aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plycask.chess.replay import PgnError, Replayer
from plycask.functions import hashes, headers
from plycask.operators import filters

_REPLAYER = Replayer()


def explode(games: DataFrame, carried: list[str], max_ply: int | None = None) -> DataFrame:
    """A row for each position of each game: the carried columns, ply (from 0) and fen (counters normalised).

    Only pgn and the carried columns cross into Python, in Arrow batches; positions leave as one list a game
    and are exploded on the JVM's side, so a batch's memory is that of its games.
    """
    schema = ", ".join([*(f"`{name}` {games.schema[name].dataType.simpleString()}" for name in carried), "fens array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fens = [[f"{key} 0 1" for key in _REPLAYER.positions(text, max_ply)] if text else [] for text in batch.column("pgn").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in carried), pa.array(fens, pa.list_(pa.string()))], names=[*carried, "fens"])

    replayed = games.select(*dict.fromkeys([*carried, "pgn"])).mapInArrow(run, schema)
    return replayed.select(*carried, F.posexplode("fens").alias("ply", "fen"))


def positions(raw: DataFrame, max_ply: int | None = None) -> DataFrame:
    """Positions of the games that take part in the statistics, with result, game_id, max_elo, official and date.  The hash is left to who needs it."""
    pgn = F.col("pgn")
    games = raw.where(filters.countable(pgn)).select(
        headers.result(pgn).alias("result"), headers.tag(pgn, "ID").alias("game_id"), headers.max_elo(pgn).alias("max_elo"), headers.official(pgn).alias("official"), headers.date(pgn).alias("date"), pgn
    )
    return explode(games, ["result", "game_id", "max_elo", "official", "date"], max_ply)


def position_index(found: DataFrame, key=hashes.sha_key) -> DataFrame:
    """The index from positions to games, a row for each occurrence."""
    return found.select(key(F.col("fen")).alias("hashFen"), "fen", F.col("game_id").alias("gameId"), F.col("max_elo").alias("maxElo"), "official", "date")


def position_index_v2(raw: DataFrame) -> DataFrame:
    """The index of the second version: any result, White's rating, official by name, and of repeated tags the last."""
    pgn = F.col("pgn")
    games = raw.where(~filters.excluded(pgn) & headers.last_tag(pgn, "ID").isNotNull()).select(
        headers.last_tag(pgn, "ID").alias("gameId"),
        F.coalesce(headers.leading_int(headers.last_tag(pgn, "WhiteElo")), F.lit(0)).alias("whiteElo"),
        headers.official_by_name(pgn).alias("official"),
        F.coalesce(headers.last_tag(pgn, "Date"), F.lit(headers.DEFAULT_DATE)).alias("date"),
        pgn,
    )
    return explode(games, ["gameId", "whiteElo", "official", "date"]).select(hashes.sha_key(F.col("fen")).alias("hashFen"), "fen", "gameId", "whiteElo", "official", "date")


@F.udf(T.StringType(), useArrow=True)
def _error_of(text: str) -> str | None:
    if text is None:
        return "Missing game"
    try:
        _REPLAYER.load(text)
    except PgnError as e:
        return str(e)
    return None


def checked(raw: DataFrame, config=None) -> DataFrame:
    """raw with error (null for a valid game) and error_class (the error up to its first colon); records that are too long count as errors unread."""
    error: Column = _error_of(F.col("pgn"))
    if config is not None:
        error = F.when(filters.fits(F.col("pgn"), config), error).otherwise("Record too long")
    return raw.withColumn("error", error).withColumn("error_class", F.trim(F.substring_index("error", ":", 1)))


def valid_and_quarantine(raw: DataFrame, config=None) -> tuple[DataFrame, DataFrame]:
    """Valid games with their own columns, and the others as pgn, error and error_class."""
    both = checked(raw, config)
    return both.where("error IS NULL").drop("error", "error_class"), both.where("error IS NOT NULL").select("pgn", "error", "error_class")


def error_histogram(quarantine: DataFrame, top: int | None = None) -> DataFrame:
    """error_class and count, the most frequent first; ties by name."""
    counts = quarantine.groupBy("error_class").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "error_class")
    return counts.limit(top) if top else counts
