"""JSON documents of the archive source: players, lists of archives, and archives of games."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask import schema
from plycask.config import Config
from plycask.operators import dedupe, filters


def usernames(documents: DataFrame) -> DataFrame:
    """Distinct lower-case user names of leaderboards."""
    return documents.select(F.explode("leaders").alias("leader")).select(F.lower("leader.user.username").alias("username")).where("username IS NOT NULL").distinct()


def complete(names: DataFrame, target: int) -> bool:
    """Whether a list of names has at least 99 % of what was asked for, so that it need not be fetched again."""
    return names.count() >= 0.99 * target


def archive_urls(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode("archives").alias("url"))


def archived_games(documents: DataFrame) -> DataFrame:
    """source_file, block, seq, pgn and time_control of the games of archive documents (with columns source_file and games)."""
    return documents.select("source_file", F.lit(0).cast("long").alias("block"), F.posexplode("games").alias("place", "game")).select(
        "source_file", "block", F.col("place").cast("long").alias("seq"), "game.pgn", "game.time_control"
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    documents = spark.read.schema(schema.ARCHIVE).option("multiLine", "true").json(path)
    return archived_games(documents.select(F.col("_metadata.file_path").alias("source_file"), "games"))


def ingested(games: DataFrame, config: Config = Config()) -> DataFrame:
    """Games that pass the archive's filter, the first of each key; keys of games that fail are not remembered."""
    kept = games.where(filters.keep_archived_limited(F.col("pgn"), F.col("time_control"), config))
    return dedupe.dedupe_archive(kept, ["source_file", "block", "seq"])


def archive_status(users: DataFrame, urls: DataFrame, processed: DataFrame) -> DataFrame:
    """users, archives and pending_users (not among the processed), in one row."""
    pending = dedupe.not_processed(users, processed, "username")
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(users, "users").join(one(urls, "archives")).join(one(pending, "pending_users"))  # one row each
