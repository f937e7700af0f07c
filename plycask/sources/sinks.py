"""What is written, and how: Parquet for tables, text for exchange.  Nothing overwrites what it reads."""

from __future__ import annotations

import os
import tempfile

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask.operators import stats

#: Rows of a file of the position index.
ROWS_PER_FILE = 3_000_000


def append_games(games: DataFrame, path: str, partition_by: tuple[str, ...] = ("source",)) -> None:
    games.write.mode("append").partitionBy(*partition_by).parquet(path)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """Numbers of the versions under a path, in order, and whether each is complete."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    numbers = sorted(int(name.removeprefix("version=")) for name in names if name.startswith("version="))
    return [(n, system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={n:09d}/_SUCCESS"))) for n in numbers]


def write_version(df: DataFrame, path: str) -> str:
    """A new version beside the ones before, which stay as backups; returns its folder.  It is the current one from when its last file is there."""
    before = _versions(df.sparkSession, path)
    folder = f"{path}/version={before[-1][0] + 1 if before else 0:09d}"
    df.write.mode("errorifexists").parquet(folder)
    return folder


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version."""
    complete = [n for n, done in _versions(spark, path) if done]
    if not complete:
        raise ValueError(f"no complete version in {path}")
    return spark.read.parquet(f"{path}/version={complete[-1]:09d}")


def _tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("sep", "\t").option("header", "true").option("quote", "").option("escape", "").csv(path)


def write_index(index: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    index.write.mode("overwrite").option("sep", "\t").option("header", "true").option("maxRecordsPerFile", rows_per_file).csv(path)


def write_index_table(index: DataFrame, path: str, buckets: int = 256, parts: int = 16) -> None:
    """For look-ups by position: files by a hash of the key, sorted in them, so that a look-up reads one folder and few row groups.

    A bucket's rows are dealt by game to several tasks, so that a position which every game has is not one task's work.
    """
    df = index.withColumn("bucket", F.pmod(F.xxhash64("hashFen"), F.lit(buckets)))
    dealt = df.repartition("bucket", F.pmod(F.xxhash64("gameId"), F.lit(parts)))
    dealt.sortWithinPartitions("bucket", "hashFen").write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_stats(table: DataFrame, path: str) -> None:
    """The three nested outputs, in order: all positions, those that occur twice, those that occur ten times."""
    for name, kept in (("fens-all", table), ("fens-withoutone", stats.without_single(table)), ("fens-onlyrecurrent", stats.recurrent(table))):
        _tsv(stats.ordered(kept), f"{path}/{name}")


def write_bands(table: DataFrame, path: str) -> None:
    stats.banded(table).write.mode("overwrite").partitionBy("band").parquet(path)


def split_files(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_pgn(games: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Games as text, an empty line after each."""
    rows = games.orderBy(*order) if order else games
    rows.select(F.concat("pgn", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_openings(table: DataFrame, path: str) -> None:
    """Small, and in order: one file."""
    _tsv(table, path, one_file=True)


def compress(source: str, target: str, level: int = 12) -> None:
    """One exported file as .zst, as a stream."""
    with open(source, "rb") as a, open(target, "wb") as b:
        zstandard.ZstdCompressor(level=level).copy_stream(a, b)


def decompress(source: str, target: str) -> None:
    if not source.endswith(".zst"):
        raise ValueError(f"not a .zst file: {source}")
    with open(source, "rb") as a, open(target, "wb") as b:
        zstandard.ZstdDecompressor().copy_stream(a, b)


def compress_files(spark: SparkSession, folder: str, target: str, level: int = 12) -> int:
    """Each exported file of a folder as a .zst file in target, on whatever file system; one at a time, by way of the driver's disk.  Returns their number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    source, to = path(folder), path(target)
    system, there = source.getFileSystem(conf), to.getFileSystem(conf)
    names = sorted(status.getPath().getName() for status in system.listStatus(source) if not status.getPath().getName().startswith(("_", ".")))
    there.mkdirs(to)
    with tempfile.TemporaryDirectory() as local:
        plain, packed = os.path.join(local, "plain"), os.path.join(local, "packed")
        for name in names:
            system.copyToLocalFile(False, path(f"{folder}/{name}"), path(f"file://{plain}"), True)
            compress(plain, packed, level)
            there.copyFromLocalFile(True, True, path(f"file://{packed}"), path(f"{target}/{name}.pgn.zst"))
    return len(names)
