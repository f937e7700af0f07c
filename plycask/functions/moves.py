"""Columns that count and render moves, each as the source that it serves does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plycask.functions.headers import movetext

_RESULTS = ("1-0", "0-1", "1/2-1/2", "*")


def count_plies(text: Column) -> Column:
    """Tokens of the move text of a monthly game.  Move numbers go first, then comments and variations; what `1...`
    leaves of its dots counts as a token, and so do glyphs."""
    moves = F.regexp_replace(movetext(text), r"\d+\.", " ")
    moves = F.regexp_replace(F.regexp_replace(moves, r"\{[^}]*\}", " "), r"\([^)]*\)", " ")
    return F.size(F.filter(F.split(moves, r"\s+"), lambda token: (token != "") & ~token.isin(*_RESULTS)))


def count_moves(text: Column) -> Column:
    """Twice the move numbers on lines of an archive game that are no tags or comments; a clock's decimals count too."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~F.ltrim(line).startswith("[") & ~F.ltrim(line).startswith("{"))
    return 2 * F.size(F.regexp_extract_all(F.array_join(lines, " "), F.lit(r"(\d+\.)"), 1))


def rendered(sans: Column) -> Column:
    """`1. e4 e5 2. Nf3` from an array of moves."""
    return F.array_join(F.transform(sans, lambda san, i: F.when(i % 2 == 0, F.concat((i / 2 + 1).cast("int").cast("string"), F.lit(". "), san)).otherwise(san)), " ")
