"""Tables in text files: statistics, openings and lists of what was processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask import schema


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.POSITION_STATS).option("sep", "\t").option("header", "true").csv(path)


def read_stats_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same, and apart from it the lines (source_file, line) that have not as many columns, or not numbers where these should be."""
    fields = [field.split() for field in schema.POSITION_STATS.split(", ")]
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("source_file"))
    lines = lines.where(F.col("line") != F.lit("\t".join(name for name, _ in fields)))  # the heading of every file
    parts = F.split("line", "\t")
    values = F.struct(*(F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)))
    rows = lines.withColumn("row", values)
    whole = (F.size(parts) == len(fields)) & F.forall(F.array(*(F.col(f"row.{name}").isNotNull() for name, _ in fields)), lambda there: there)
    return rows.where(whole).select("row.*"), rows.where(~whole).select("source_file", "line")


def read_opening_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """eco, name, pgn and seq of opening files, in the order of the paths and of their lines; a heading that begins with eco, and lines without three columns, are left out."""
    rows = None
    for i, path in enumerate(paths):
        text = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"), F.monotonically_increasing_id().alias("n"))
        parts = F.split("line", "\t")
        one = text.where(F.size(parts) >= 3).where(~F.col("line").startswith("eco")).select(parts[0].alias("eco"), parts[1].alias("name"), parts[2].alias("pgn"), (F.lit(i).cast("long") * (1 << 52) + F.col("n")).alias("seq"))
        rows = one if rows is None else rows.union(one)
    if rows is None:
        raise ValueError("no opening files")
    return rows


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One value a line; empty lines are none."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")
