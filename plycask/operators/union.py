"""Corpora put together, and the counters of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def compiled(inputs: list[DataFrame]) -> DataFrame:
    """All rows of all inputs, with the input's place (source_ord); nothing is filtered or deduplicated."""
    rows = None
    for i, df in enumerate(inputs):
        numbered = df.withColumn("source_ord", F.lit(i))
        rows = numbered if rows is None else rows.unionByName(numbered)
    if rows is None:
        raise ValueError("nothing to compile")
    return rows


def observed(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """df, and counters of it that fill as it is written: total, and rows for which each condition holds."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("total"), *(F.count_if(c).alias(k) for k, c in conditions.items())), observation
