"""The table of openings: lines of moves collapsed by the position that they reach."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plycask.chess.replay import PgnError, Replayer, full_fens, sans_of
from plycask.functions import headers

_REPLAYER = Replayer()
_STEPS = "eco string, name string, seq long, ply int, pgn string, fen string, is_final boolean"


def _line(pgn: str) -> tuple[list[str], list[str], bool]:
    """Moves up to the first illegal one, their full FENs, and whether the line is legal to its end."""
    try:
        sans = sans_of(pgn)
    except PgnError:
        return [], full_fens([], [_REPLAYER.line([])[0]]), False
    legal = len(sans)
    for n in range(len(sans)):
        try:
            _REPLAYER.line(sans[: n + 1])
        except PgnError:
            legal = n
            break
    done = sans[:legal]
    return done, full_fens(done, _REPLAYER.line(done)), legal == len(sans)


def steps(lines: DataFrame) -> DataFrame:
    """eco, name, seq and, for each ply from 1 on, the rendered moves, the full FEN and whether it is the line's own position.

    An illegal move ends a line, which then has no position of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                sans, fens, whole = _line(row["pgn"] or "")
                text = ""
                for ply, (san, fen) in enumerate(zip(sans, fens[1:], strict=True), 1):
                    text += (" " if text else "") + (f"{ply // 2 + 1}. {san}" if ply % 2 else san)
                    rows.append((row["eco"], row["name"], row["seq"], ply, text, fen, whole and ply == len(sans)))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["eco", "name", "seq", "ply", "pgn", "fen", "is_final"])

    return lines.select("eco", "name", "pgn", "seq").mapInArrow(run, _STEPS)


def collapsed(found: DataFrame) -> DataFrame:
    """One row for each position: of the lines that end there the last, else of those that pass it the first.  first_seen is the order of output."""
    value = F.struct("eco", "name", "pgn", "ply")
    at = F.struct("seq", "ply")
    last = F.max_by(F.when(F.col("is_final"), value), F.when(F.col("is_final"), F.col("seq")))
    grouped = found.groupBy("fen").agg(F.coalesce(last, F.min_by(value, at)).alias("v"), F.min(at).alias("first_seen"))
    return grouped.select("v.eco", "v.name", "v.pgn", "fen", "v.ply", "first_seen")


def openings(lines: DataFrame) -> DataFrame:
    """eco, name, pgn, fen, ply, in the order in which positions were first met."""
    return collapsed(steps(lines)).orderBy("first_seen").drop("first_seen")


def identified(found: DataFrame, table: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Positions with the opening they belong to.  The table is broadcast up to max_rows rows; a larger one is left to the planner."""
    names = table.select("eco", "name", F.col("ply").alias("opening_ply"), headers.normalised_fen(F.col("fen")).alias("fen"))
    names = names.groupBy("fen").agg(F.min_by(F.struct("eco", "name", "opening_ply"), F.struct("opening_ply", "eco", "name")).alias("o")).select("fen", "o.*")
    if names.limit(max_rows + 1).count() <= max_rows:
        names = F.broadcast(names)
    return found.join(names, "fen")


def deepest_opening(found: DataFrame, table: DataFrame) -> DataFrame:
    """For each game_id the opening of the latest position that has one."""
    return identified(found, table).groupBy("game_id").agg(F.max_by(F.struct("eco", "name"), F.struct("ply", "eco", "name")).alias("o"), F.max("ply").alias("ply")).select("game_id", "o.eco", "o.name", "ply")
