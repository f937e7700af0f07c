"""Incremental ingestion: what has arrived since the last run, once each, with the checkpoint as the record of progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask.config import Config
from plycask.operators import dedupe, filters, stats

def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Writes what is there now as Parquet and ends; a later run goes on behind it."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def monthly(stream: DataFrame, path: str, checkpoint: str, config: Config = Config()) -> None:
    """Limited and evaluated games of the monthly files, each to its own folder, read once."""

    def write(batch: DataFrame, number: int) -> None:
        pgn = F.col("pgn")
        marked = batch.withColumns({"limited": filters.keep_limited(pgn, config), "evaluated": filters.keep_evaluated(pgn, config)}).where("limited OR evaluated").persist()
        for name in ("limited", "evaluated"):
            marked.where(name).drop("limited", "evaluated").write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        marked.unpersist()

    _each_batch(stream, write, checkpoint)


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Folders are named by the batch's number, so a batch that is repeated after a failure replaces what it wrote."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()


def _written(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """The keys of the batches before a number, None before the first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = [f"{path}/batch={n}" for n in range(number) if system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={n}/_SUCCESS"))]
    return spark.read.schema("dedupe_key string").parquet(*before).where("dedupe_key IS NOT NULL") if before else None


def first_of_each_key(stream: DataFrame, key: Column, path: str, checkpoint: str, order: tuple[str, ...] = ()) -> None:
    """Games whose key no earlier batch had, and of those of a batch the first in the order, then by place; games without a key all pass.

    Written with their dedupe_key, a folder for each batch: the table is its own record of the keys, from which a batch
    that is repeated after a failure leaves itself out, and games without a key are no part of it.  A batch
    reads the key column of those before; the games met there are few, so that texts are not moved for them.
    """

    def write(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("dedupe_key", key.cast("string")).withColumn("dedupe_place", F.monotonically_increasing_id())
        first = dedupe.first_wins(placed.withColumnRenamed("dedupe_key", "name"), F.col("name"), [*order, "dedupe_place"]).withColumnRenamed("name", "dedupe_key").drop("dedupe_place")
        before = _written(batch.sparkSession, path, number)
        if before is not None:
            met = before.join(placed.select("dedupe_key").distinct(), "dedupe_key", "left_semi").distinct()
            first = first.where("dedupe_key IS NOT NULL").join(met, "dedupe_key", "left_anti").unionByName(first.where("dedupe_key IS NULL"))
        first.write.mode("overwrite").parquet(f"{path}/batch={number}")

    _each_batch(stream, write, checkpoint)


def composite(stream: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = ("source_file", "block")) -> None:
    first_of_each_key(stream, dedupe.composite_key(F.col("pgn")), path, checkpoint, order)


def partial_stats(rows: DataFrame, keys: list[str], path: str, checkpoint: str) -> None:
    """Statistics of each batch, as a partial table that stats.combined adds up: no state grows with the number of positions."""

    def write(batch: DataFrame, number: int) -> None:
        stats.count_by(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    _each_batch(rows, write, checkpoint)
