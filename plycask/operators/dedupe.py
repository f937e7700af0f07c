"""Deduplication in which the first game wins, and anti-joins with what was processed before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plycask.functions.headers import header, movetext

#: Fixed value of the data format: links that carry a game's number.
_LINK = r'\[Link\s+"https://www\.chess\.com/game/live/(\d+)"\]'


def link_key(text: Column) -> Column:
    number = F.nullif(F.regexp_extract(text, _LINK, 1), F.lit(""))
    return F.concat(F.lit("chesscom-"), number)


def _value(text: Column, name: str) -> Column:
    """A tag's value; the empty string where it is missing or empty."""
    return F.regexp_extract(text, rf'\[{name}\s+"([^"]+)"\]', 1)


def _joined(text: Column, names: list[str], needed: list[str]) -> Column:
    """The values of tags in lower case; null unless all needed ones are there."""
    values = F.array(*(_value(text, name) for name in names))
    places = [names.index(name) for name in needed]
    whole = F.transform(F.array(values), lambda v: F.when(F.least(*(F.length(v[i]) for i in places)) > 0, F.lower(F.array_join(v, "-"))))
    return whole[0]


def composite_key(text: Column) -> Column:
    """The link, else site, date, players and ratings; null (always kept) where players or date are missing.
    Moves are no part of it: two games of the same players on a day are one."""
    return F.coalesce(link_key(text), _joined(text, ["Site", "Date", "White", "Black", "WhiteElo", "BlackElo"], ["White", "Black", "Date"]))


def archive_key(text: Column) -> Column:
    """The link, else players, date and time; null (dropped) where any is missing."""
    names = ["White", "Black", "Date", "UTCTime"]
    return F.coalesce(link_key(text), _joined(text, names, names))


def content_key(text: Column) -> Column:
    """A digest of players, date, event and site and of the moves without comments and extra blanks."""
    tags = F.to_json(F.struct(*(F.nullif(header(text, name), F.lit("")).alias(name) for name in ("Event", "Site", "Date", "White", "Black"))))
    lines = F.filter(F.split(movetext(text), "\n"), lambda line: ~line.startswith("["))
    bare = F.transform(lines, lambda line: F.trim(F.regexp_replace(F.regexp_replace(line, r"\s+", " "), r"\{[^}]*\}", "")))
    return F.md5(F.encode(F.concat_ws("|", tags, F.array_join(bare, "")), "UTF-8"))


def first_wins(games: DataFrame, key: Column, order: list[str], keep_keyless: bool = True) -> DataFrame:
    """Of the games with a key the one that comes first in the order, a total one without nulls; those without are all kept, or dropped.

    Only keys and orders are counted, and combined before the shuffle, so a key that very many games share is no
    burden.  The keys that recur are then looked up: where they are few, Spark broadcasts them and no text is moved.
    Games without a key look for a name of their own, so that they are not one partition's work where it does not.
    """
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])
    keyed = games.withColumn("dedupe_key", key)
    recurring = keyed.where("dedupe_key IS NOT NULL").groupBy("dedupe_key").agg(F.min(place).alias("dedupe_first"), F.count(F.lit(1)).alias("dedupe_n")).where("dedupe_n > 1")
    recurring = recurring.select(F.col("dedupe_key").cast("string").alias("dedupe_name"), "dedupe_first")
    name = F.coalesce(F.col("dedupe_key").cast("string"), F.concat(F.lit("\0"), F.xxhash64(*order).cast("string")))
    met = keyed.withColumn("dedupe_name", name).join(recurring, "dedupe_name", "left")
    first = F.col("dedupe_first").isNull() | (F.col("dedupe_first") == place)
    return met.where(F.col("dedupe_key").isNull() | first if keep_keyless else F.col("dedupe_key").isNotNull() & first).select(*games.columns)


def dedupe(games: DataFrame, order: list[str]) -> DataFrame:
    """By link or composite key; games without a key stay."""
    return first_wins(games, composite_key(F.col("pgn")), order)


def dedupe_archive(games: DataFrame, order: list[str]) -> DataFrame:
    """Of games that have passed the archive's filter; those without a key go."""
    return first_wins(games, archive_key(F.col("pgn")), order, keep_keyless=False)


def dedupe_content(games: DataFrame, order: list[str]) -> DataFrame:
    return first_wins(games, content_key(F.col("pgn")), order)


def not_processed(items: DataFrame, processed: DataFrame, on: str) -> DataFrame:
    """Items whose name is not among the processed ones; a null name never is."""
    return items.join(processed.select(on).distinct(), on, "left_anti")


def not_written(games: DataFrame, written: DataFrame, key) -> DataFrame:
    """Games whose key no written game has; those without a key are kept."""
    keys = written.select(key(F.col("pgn")).alias("dedupe_key")).where("dedupe_key IS NOT NULL").distinct()
    return games.withColumn("dedupe_key", key(F.col("pgn"))).join(keys, "dedupe_key", "left_anti").drop("dedupe_key")


def dedupe_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """total, kept and duplicates, with total their sum."""
    total, kept = before.agg(F.count(F.lit(1)).alias("total")), after.agg(F.count(F.lit(1)).alias("kept"))
    return total.join(kept).withColumn("duplicates", F.col("total") - F.col("kept"))  # one row each
