"""The jobs that the operators make up: ingestion by source, compilation, checking and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask.config import Config
from plycask.functions import hashes, headers
from plycask.operators import dedupe, filters, positions, stats, tagging, union
from plycask.sources import json_archives, pgn, sinks

_ORDER = ["source_file", "block", "seq"]


def with_tags(games: DataFrame, source: str) -> DataFrame:
    """Games with ID, Source and MaxElo before their Event."""
    return games.withColumn("pgn", tagging.tagged(F.col("pgn"), hashes.game_id(F.lit(source), F.col("pgn")), source))


def weekly(spark: SparkSession, path: str) -> DataFrame:
    """Games of the weekly archives."""
    return with_tags(pgn.read_zip(spark, path), headers.OFFICIAL)


def collections(spark: SparkSession, path: str) -> DataFrame:
    """Games of the collections, plain and in archives: with both players, and the first of each content."""
    raw = pgn.read_pgn(spark, path).union(pgn.read_zip(spark, path))
    return with_tags(dedupe.dedupe_content(raw.where(filters.has_players(F.col("pgn"))), _ORDER), headers.OFFICIAL)


def monthly(spark: SparkSession, path: str, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Limited and evaluated games of the monthly files."""
    raw = pgn.read_pgn(spark, path)
    return tuple(with_tags(raw.where(keep(F.col("pgn"), config)), headers.ONLINE) for keep in (filters.keep_limited, filters.keep_evaluated))  # type: ignore[return-value]


def archives(spark: SparkSession, path: str, config: Config = Config()) -> DataFrame:
    games = json_archives.ingested(json_archives.read_archives(spark, path), config)
    return with_tags(games.drop("time_control"), headers.ONLINE)


def without_engines(games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Games of people, and those of engine events."""
    of_engines = filters.engine_event(F.col("pgn"))
    return games.where(~of_engines), games.where(of_engines)


def statistics(games: DataFrame, path: str, key=hashes.sha_key) -> DataFrame:
    """Writes the index of positions and their statistics; positions are replayed once and kept as a table in between."""
    found = positions.positions(games)
    found.write.mode("overwrite").parquet(f"{path}/positions")
    found = games.sparkSession.read.parquet(f"{path}/positions")
    sinks.write_index_table(positions.position_index(found, key), f"{path}/index")
    stats.position_stats(found, key).write.mode("overwrite").parquet(f"{path}/stats")
    table = games.sparkSession.read.parquet(f"{path}/stats")
    sinks.write_stats(table, f"{path}/tsv")
    return table


def build(spark: SparkSession, inputs: dict[str, str], output: str, config: Config = Config()) -> dict[str, DataFrame]:
    """The whole corpus from landing folders by source (collections, weekly, monthly, archives; each may be missing).

    Official games are compiled and deduplicated; all are checked; then official and online games are
    compiled, without a look for copies across the two, and replayed to statistics.
    """
    official = [read(spark, inputs[name]) for name, read in (("collections", collections), ("weekly", weekly)) if name in inputs]
    online = []
    if config.with_online_game:
        if "archives" in inputs:
            online.append(archives(spark, inputs["archives"], config))
        if "monthly" in inputs:
            online.append(monthly(spark, inputs["monthly"], config)[0])
    parts, quarantined = [], []
    if official:
        parts.append(dedupe.dedupe(union.compiled(official), ["source_ord", *_ORDER]).drop("source_ord"))
    parts += online
    kept = []
    for i, part in enumerate(parts):
        part.write.mode("overwrite").parquet(f"{output}/part{i}")
        valid, bad = positions.valid_and_quarantine(spark.read.parquet(f"{output}/part{i}"), config)
        kept.append(valid)
        quarantined.append(bad)
    quarantine = quarantined[0]
    for bad in quarantined[1:]:
        quarantine = quarantine.union(bad)
    quarantine.write.mode("overwrite").parquet(f"{output}/quarantine")
    union.compiled(kept).write.mode("overwrite").parquet(f"{output}/games")
    games = spark.read.parquet(f"{output}/games")
    out = {"games": games, "quarantine": spark.read.parquet(f"{output}/quarantine")}
    if config.generate_fen:
        out["stats"] = statistics(games, f"{output}/fens")
    return out
