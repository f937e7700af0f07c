"""Statistics of positions: how often each occurs and how the games went on.

The start position occurs in every game; its rows are combined before the shuffle, so it is one row a task.
Grouping is by the position itself; hashes are derived afterwards, once for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plycask.functions import hashes

#: Occurrences from which positions share the last band.
LAST_BAND = 10


def win_draw_loss(result: Column) -> list[Column]:
    count = lambda token: F.count_if(result == token)
    return [F.count(F.lit(1)).alias("occurrence"), count("1-0").alias("white"), count("0-1").alias("black"), count("1/2-1/2").alias("draw")]


def count_by(rows: DataFrame, keys: list[str], result: str = "result") -> DataFrame:
    return rows.groupBy(*keys).agg(*win_draw_loss(F.col(result)))


def combined(partial: list[DataFrame], keys: list[str]) -> DataFrame:
    """Statistics of several corpora from the statistics of each."""
    rows = partial[0]
    for more in partial[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in ("occurrence", "white", "black", "draw")))


def position_stats(found: DataFrame, key=hashes.sha_key) -> DataFrame:
    """hash, fen, occurrence, white, black, draw."""
    return count_by(found, ["fen"]).select(key(F.col("fen")).alias("hash"), "fen", "occurrence", "white", "black", "draw")


def prefixed(table: DataFrame, key=hashes.sha_key) -> DataFrame:
    """Rows with the hash of their fen in front, in place of any hash they have."""
    return table.select(key(F.col("fen")).alias("hash"), *(name for name in table.columns if name != "hash"))


def ordered(stats: DataFrame) -> DataFrame:
    """By occurrence, the most first, then by the number that the hash is: a total order."""
    return stats.orderBy(F.desc("occurrence"), hashes.numeric(F.col("hash")))


def top(stats: DataFrame, n: int) -> DataFrame:
    return ordered(stats).limit(n)


def recurrent(stats: DataFrame, least: int = LAST_BAND) -> DataFrame:
    return stats.where(F.col("occurrence") >= least)


def without_single(stats: DataFrame) -> DataFrame:
    return recurrent(stats, 2)


def banded(stats: DataFrame) -> DataFrame:
    """With band: the occurrences, those from ten on together."""
    return stats.withColumn("band", F.least("occurrence", F.lit(LAST_BAND)).cast("int"))


def band_sizes(stats: DataFrame) -> DataFrame:
    """band, positions and their occurrences."""
    return banded(stats).groupBy("band").agg(F.count(F.lit(1)).alias("positions"), F.sum("occurrence").alias("occurrences"))


def band_shares(stats: DataFrame) -> DataFrame:
    """Per cent of positions that occur ten times or more, two to nine times, and once; one row, null without positions."""
    share = lambda condition: F.round(100 * F.count_if(condition) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)
    n = F.col("occurrence")
    return stats.agg(share(n >= LAST_BAND).alias("pct_recurrent"), share(n.between(2, LAST_BAND - 1)).alias("pct_some"), share(n == 1).alias("pct_single"))


def output_counts(stats: DataFrame) -> DataFrame:
    """Rows of the three nested outputs, in one pass."""
    n = F.col("occurrence")
    return stats.agg(F.count(F.lit(1)).alias("all_positions"), F.count_if(n >= 2).alias("without_one"), F.count_if(n >= LAST_BAND).alias("only_recurrent"))


def games_of(index: DataFrame, stats: DataFrame) -> DataFrame:
    """Index rows with the statistics of their position."""
    return index.join(stats.select(F.col("fen"), "occurrence", "white", "black", "draw"), "fen")
