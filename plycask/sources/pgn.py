"""PGN files as DataFrames of one row a game.

Plain files are cut at the text that begins a record by Spark's own text source, so a large file is read by
many tasks; files compressed as .zst or .gz are decompressed as they are read.  Archives (.zip) are opened in
Python, a file a row.  Order within the corpus is (source_file, block, seq), which does not depend on the run.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT, ID = "[Event ", "[ID "
_RAW = "source_file string, block long, seq long, pgn string"


def _record(value: Column, start: str) -> Column:
    """A record from what stands between two starts: the file's first has its own, the others lost it; what precedes the first is none."""
    text = F.when(value.startswith(start), value).when(value.startswith('"'), F.concat(F.lit(start), value))
    return F.trim(F.regexp_replace(F.regexp_replace(text, "\r\n", "\n"), r"\s+\z", ""))


def _texts(reader, path: str, start: str, numbered: bool = True) -> DataFrame:
    seq = F.monotonically_increasing_id() if numbered else F.lit(0).cast("long")
    rows = reader.option("lineSep", "\n" + start).text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), seq.alias("seq"), _record(F.col("value"), start).alias("pgn"))
    return rows.where(F.col("pgn").isNotNull())


def read_pgn(spark: SparkSession, path: str, record_start: str = EVENT) -> DataFrame:
    """source_file, block, seq and pgn of the games in .pgn, .pgn.zst and .pgn.gz files; line ends become line feeds."""
    return _texts(spark.read.option("pathGlobFilter", "*.pgn*"), path, record_start)


def stream_pgn(spark: SparkSession, path: str, record_start: str = EVENT, files_per_batch: int = 100) -> DataFrame:
    """The same, of files as they arrive; seq is 0, as streams cannot number their rows."""
    reader = spark.readStream.option("pathGlobFilter", "*.pgn*").option("maxFilesPerTrigger", files_per_batch)
    return _texts(reader, path, record_start, numbered=False)


def split_records(text: str, start: str = EVENT) -> list[str]:
    """The records of a whole file; what precedes the first start at a line's beginning is dropped."""
    parts = ("\n" + text.replace("\r\n", "\n")).split("\n" + start)
    return [(start + part).rstrip() for part in parts[1:]]


def read_zip(spark: SparkSession, path: str, record_start: str = EVENT) -> DataFrame:
    """The games of the members that end in .pgn, whatever their case; source_file has the member behind a `!`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        if member.lower().endswith(".pgn"):
                            games = split_records(archive.read(member).decode("utf-8", "replace"), record_start)
                            n = len(games)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([f"{name}!{member.rsplit('/', 1)[-1]}"] * n, pa.string()), pa.array([0] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(games, pa.string())],
                                names=["source_file", "block", "seq", "pgn"],
                            )

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInArrow(run, _RAW)


def too_long(raw: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Records of up to limit characters, and the others."""
    return raw.where(F.length("pgn") <= limit), raw.where(F.length("pgn") > limit)


def count_games(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("games"))
