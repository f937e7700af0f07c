"""Links and numbers from the pages that list downloads.

A page is taken apart once, at its tags: each has a name in lower case (with a slash before it where it closes),
what else stands in it, and the text behind it.  Links and tables are read from this list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The class of the table that lists the numbers, and the fewest rows that it has when it is whole.
_TABLE_CLASS, _LEAST_ROWS = "results-table", 3


def _tags(html: Column) -> Column:
    def tag(piece: Column) -> Column:
        inside = F.substring_index(piece, ">", 1)
        name = F.lower(F.regexp_extract(inside, "^/?[A-Za-z][A-Za-z0-9]*", 0))
        return F.struct(name.alias("name"), inside.alias("inside"), F.substring(piece, F.length(inside) + 2, F.length(piece)).alias("text"))

    # What stands before the first tag is no tag, and what is not closed by a `>` neither.
    pieces = F.split(html, "<")
    return F.transform(F.filter(F.slice(pieces, 2, F.size(pieces)), lambda piece: piece.contains(">")), tag)


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, whatever the case of its name; empty without it."""
    return F.regexp_extract(tag["inside"], rf'(?i)\s{name}="([^"]*)"', 1)


def links(pages: DataFrame, suffix: str, base: str = "") -> DataFrame:
    """(name, url) of the links to files whose name ends in the suffix, one for each name: the first by page and place.

    Tags and attributes are recognised in any case; a file's name is compared as it is.  Relative links are put
    behind base.  pages has page_id and html; a null page has no links.
    """
    hrefs = F.transform(F.filter(_tags(F.col("html")), lambda tag: tag["name"] == "a"), lambda tag: _attribute(tag, "href"))
    found = pages.select("page_id", F.posexplode(hrefs).alias("place", "href"))
    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(base), F.col("href")))
    named = found.select(F.substring_index("href", "/", -1).alias("name"), url.alias("url"), F.struct("page_id", "place").alias("at"))
    named = named.where(F.col("name").endswith(suffix) & (F.length("name") > len(suffix)))
    return named.groupBy("name").agg(F.min_by("url", "at").alias("url"))


def latest_number(html: Column) -> Column:
    """The number that the first cell of the second row of the results table begins with; null without one, or in a table of too few rows."""

    def step(seen: Column, tag: Column) -> Column:
        name, inside = tag["name"], seen["state"] == 1
        begins = (seen["state"] == 0) & (name == "table") & F.lower(_attribute(tag, "class")).contains(_TABLE_CLASS)
        opened = seen["opened"] + F.when(inside & (name == "tr"), 1).otherwise(0)
        closed = seen["closed"] + F.when(inside & (name == "/tr"), 1).otherwise(0)
        first = inside & (seen["cell"] == 0) & (name == "td") & (opened == 2) & (closed == 1)
        cell = F.when(first, 1).when((seen["cell"] == 1) & (name == "/td"), 2).otherwise(seen["cell"])
        return F.struct(
            F.when(begins, 1).when(inside & (name == "/table"), 2).otherwise(seen["state"]).alias("state"),
            opened.alias("opened"),
            closed.alias("closed"),
            cell.alias("cell"),
            F.when(cell == 1, F.concat(seen["text"], tag["text"])).otherwise(seen["text"]).alias("text"),
        )

    start = F.struct(*(F.lit(0).alias(name) for name in ("state", "opened", "closed", "cell")), F.lit("").alias("text"))
    whole = lambda seen: (seen["state"] == 2) & (seen["closed"] >= _LEAST_ROWS) & (seen["cell"] == 2)
    number = lambda seen: F.nullif(F.regexp_extract(F.trim(seen["text"]), r"^[+-]?[0-9]+", 0), F.lit("")).try_cast("int")
    return F.aggregate(_tags(html), start, step, lambda seen: F.when(whole(seen), number(seen)))
