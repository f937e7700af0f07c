"""Names of what the sources publish by month and by week; fetching is left to whoever fills the landing folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The first month of the monthly source and the first number of the weekly one.
FIRST_MONTH, FIRST_WEEK = "2013-01", 920


def next_month(month: Column) -> Column:
    """The month after a `YYYY-MM`."""
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), 1), "yyyy-MM")


def previous_month(day: Column) -> Column:
    """The last month that is over on a day."""
    return F.date_format(F.add_months(F.date_trunc("month", day), -1), "yyyy-MM")


def monthly_file(month: Column) -> Column:
    return F.format_string("lichess_db_standard_rated_%s.pgn.zst", month)


def weekly_file(number: Column) -> Column:
    return F.format_string("twic%dg.zip", number)


def months(spark: SparkSession, until: str, first: str = FIRST_MONTH) -> DataFrame:
    """month and file of all months from first to until, both included; none if until comes before."""
    span = spark.createDataFrame([(first + "-01", until + "-01")], "a string, b string").where("a <= b")
    every = span.select(F.explode(F.expr("sequence(to_date(a), to_date(b), interval 1 month)")).alias("day"))
    return every.select(F.date_format("day", "yyyy-MM").alias("month")).withColumn("file", monthly_file(F.col("month")))


def weeks(spark: SparkSession, latest: int, first: int = FIRST_WEEK) -> DataFrame:
    """week and file from first to latest, both included."""
    return spark.range(first, latest + 1).select(F.col("id").cast("int").alias("week")).withColumn("file", weekly_file(F.col("week")))
