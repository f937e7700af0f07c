"""Columns that read the tags and the result of a game's text.

All are built-in functions, so they run inside generated code; a missing value is null or the default
that is said.  Numbers are read with try_cast, as a plain cast of a malformed one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the data format.
DEFAULT_DATE = "1900.01.01"
ONLINE, OFFICIAL = "Online", "Official"
RESULT = r"(?m)\s+(1-0|0-1|1/2-1/2|\*)\s*$"


def _none(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def header(text: Column, name: str) -> Column:
    """A tag's value, which may be empty; the empty string where there is no such tag."""
    return F.regexp_extract(text, rf'\[{name}\s+"([^"]*)"\]', 1)


def tag(text: Column, name: str) -> Column:
    """The first value of a tag that is not empty; null without one."""
    return _none(F.regexp_extract(text, rf'\[{name}\s+"([^"]+)"\]', 1))


def last_tag(text: Column, name: str) -> Column:
    """The last value of a tag that is not empty; null without one."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(rf'(?m)^\s*\[{name}\s+"([^"]+)"\]'), 1), F.lit(-1))


def leading_int(text: Column) -> Column:
    """The number that a string begins with; null without one."""
    return _none(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)).try_cast("int")


def elo(text: Column, name: str) -> Column:
    """A rating that is written in digits only; null otherwise."""
    return _none(F.regexp_extract(text, rf'\[{name}\s+"(\d+)"\]', 1)).try_cast("int")


def max_elo(text: Column) -> Column:
    return F.greatest(F.coalesce(elo(text, "WhiteElo"), F.lit(0)), F.coalesce(elo(text, "BlackElo"), F.lit(0)))


def result(text: Column) -> Column:
    """The first result token at the end of a line, anywhere in the text, whatever the Result tag says."""
    return _none(F.regexp_extract(text, RESULT, 1))


def source(text: Column) -> Column:
    return F.coalesce(tag(text, "Source"), F.lit("Unknown"))


def official(text: Column) -> Column:
    """0 for a game whose source is Online; 1 for any other, or none."""
    return F.when(tag(text, "Source") == ONLINE, 0).otherwise(1)


def official_by_name(text: Column) -> Column:
    """1 where the text names one of the over-the-board collections: the second rule, of index version 2."""
    lower = F.lower(text)
    return F.when(lower.contains("twic") | lower.contains("pgnmentor"), 1).otherwise(0)


def date(text: Column) -> Column:
    return F.coalesce(tag(text, "Date"), F.lit(DEFAULT_DATE))


def game_date(raw: Column) -> Column:
    """A calendar date; null where parts of it are unknown."""
    return F.try_to_timestamp(raw, F.lit("yyyy.MM.dd")).cast("date")


def base_seconds(time_control: Column) -> Column:
    """The base time that a time control begins with; 0 without one."""
    return F.coalesce(_none(F.regexp_extract(time_control, r"^(\d+)", 1)).try_cast("int"), F.lit(0))


def all_tags(text: Column) -> Column:
    """All tags as a map; of repeated ones the last holds."""
    names = F.regexp_extract_all(text, F.lit(r'(?m)^\[(\w+)\s+"([^"]*)"\]'), 1)
    values = F.regexp_extract_all(text, F.lit(r'(?m)^\[(\w+)\s+"([^"]*)"\]'), 2)
    every = F.arrays_zip(names.alias("k"), values.alias("v"))
    unique = F.filter(every, lambda pair, i: ~F.exists(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), lambda k: k == pair["k"]))
    return F.map_from_entries(unique)


def movetext(text: Column) -> Column:
    """What follows the first empty line; the empty string without one."""
    at = F.instr(text, "\n\n")
    return F.when(at > 0, F.substring(text, at + 2, F.length(text))).otherwise("")


def normalised_fen(fen: Column) -> Column:
    """With its counters set to 0 and 1, so that equal positions have equal texts."""
    return F.concat_ws(" ", F.slice(F.split(fen, " "), 1, 4), F.lit("0"), F.lit("1"))
