"""Queries that write files and read them again: text formats, sizes of files, and streams."""

from __future__ import annotations

import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plycask.functions import headers
from plycask.operators import dedupe, openings, positions, stats
from plycask.plans import queries, render
from plycask.sources import json_archives, pgn, sinks, tables
from plycask.streaming import ingest


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the place that all executors share; a temporary one where none is named and all run on this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp()}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.games(spark.read.parquet(f"{sf_dir}/orders.parquet"))


@queries._query(queries._with("SELECT id, white, result FROM games WHERE id IS NOT NULL"))
def pgn_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged games written as text and read by their ID."""
    folder = _folder(spark, "pgn")
    text = F.col("pgn")
    sinks.write_pgn(_games(spark, sf_dir).where(headers.tag(text, "ID").isNotNull()), folder)
    raw = pgn._texts(spark.read, folder, pgn.ID)
    return raw.select(headers.tag(text, "ID").alias("id"), headers.tag(text, "White").alias("white"), headers.result(text).alias("result"))


@queries._query(queries._with("SELECT * FROM stats", queries._BOOK, queries._COUNTED, queries._FEN_STATS))
def stats_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics written as the three ordered outputs, the widest read again."""
    folder = _folder(spark, "stats")
    table = stats.position_stats(positions.positions(_games(spark, sf_dir)))
    sinks.write_stats(table, folder)
    return tables.read_stats(spark, f"{folder}/fens-all")


@queries._query("SELECT count(*) AS rows, true AS within_limit FROM lineitem")
def chunk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of at most 5000 rows."""
    folder = _folder(spark, "chunks")
    sinks.split_files(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), folder, 5_000)
    sizes = spark.read.parquet(folder).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("rows"), (F.max("n") <= 5_000).alias("within_limit"))


@queries._query(queries._with("SELECT CAST(least(occurrence, 10) AS INTEGER) AS band, hash FROM stats", queries._BOOK, queries._COUNTED, queries._FEN_STATS))
def band_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "bands")
    sinks.write_bands(stats.position_stats(positions.positions(_games(spark, sf_dir))), folder)
    return spark.read.parquet(folder).select("band", "hash")


def _stream(spark: SparkSession, sf_dir: str, name: str, folder: str) -> DataFrame:
    """A table as files that have landed in a folder."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    table.write.parquet(f"{folder}/landing")
    return spark.readStream.schema(table.schema).parquet(f"{folder}/landing")


@queries._query("SELECT DISTINCT user_id FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "stream-dedupe")
    users = _stream(spark, sf_dir, "events", folder).select("user_id")
    ingest.first_of_each_key(users, F.col("user_id").cast("string"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select("user_id")


@queries._query(queries._with("SELECT min(k) AS k FROM keys WHERE key IS NOT NULL GROUP BY key UNION ALL SELECT k FROM keys WHERE key IS NULL", f"keys AS (SELECT k, {queries._COMPOSITE} AS key FROM games)"))
def stream_dedupe_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "stream-games")
    ingest.composite(render.games(_stream(spark, sf_dir, "orders", folder)), f"{folder}/out", f"{folder}/checkpoint", ("k",))
    return spark.read.parquet(f"{folder}/out").select("k")


@queries._query("SELECT event_type, count(*) AS occurrence, count(*) FILTER (user_id % 3 = 0) AS white, count(*) FILTER (user_id % 3 = 1) AS black, count(*) FILTER (user_id % 3 = 2) AS draw FROM events GROUP BY 1")
def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "stream-stats")
    third = F.col("user_id") % 3
    rows = _stream(spark, sf_dir, "events", folder).select("event_type", F.when(third == 0, "1-0").when(third == 1, "0-1").otherwise("1/2-1/2").alias("result"))
    ingest.partial_stats(rows, ["event_type"], f"{folder}/out", f"{folder}/checkpoint")
    return stats.combined([spark.read.parquet(f"{folder}/out").drop("batch")], ["event_type"])


def _bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games that begin with their Event, as sources publish them."""
    return _games(spark, sf_dir).withColumn("pgn", F.regexp_replace("pgn", r"(?s)\A.*?(?=\[Event )", ""))


@queries._query(queries._with("SELECT event, white, black, result, count(*) AS games FROM games GROUP BY ALL"))
def pgn_event_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of games that are cut where an Event begins."""
    folder = _folder(spark, "events")
    sinks.write_pgn(_bare(spark, sf_dir), folder)
    text = F.col("pgn")
    found = pgn._texts(spark.read, folder, pgn.EVENT).select(headers.tag(text, "Event").alias("event"), headers.tag(text, "White").alias("white"), headers.tag(text, "Black").alias("black"), headers.result(text).alias("result"))
    return found.groupBy("event", "white", "black", "result").agg(F.count(F.lit(1)).alias("games"))


@queries._query(queries._with("SELECT CAST(count(*) AS BIGINT) AS games, true AS compressed FROM games"))
def zstd_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games exported as text, made into .pgn.zst files, read from these and counted file by file."""
    folder = _folder(spark, "zstd")
    sinks.write_pgn(_bare(spark, sf_dir), f"{folder}/text")
    sinks.compress_files(spark, f"{folder}/text", f"{folder}/zst")
    counted = pgn.count_games(pgn.read_pgn(spark, f"{folder}/zst"))
    return counted.agg(F.sum("games").alias("games"), F.min(F.col("source_file").endswith(".zst")).alias("compressed"))


@queries._query(queries._with("SELECT white, black, result, CAST(count(*) AS BIGINT) AS games FROM games GROUP BY ALL"))
def zip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of text files, as the weekly source has them."""
    folder = _folder(spark, "zip")
    sinks.write_pgn(_bare(spark, sf_dir), f"{folder}/text")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    with tempfile.TemporaryDirectory() as local:
        for i, status in enumerate(x for x in system.listStatus(path(f"{folder}/text")) if x.getPath().getName().startswith("part-")):
            system.copyToLocalFile(False, status.getPath(), path(f"file://{local}/plain"), True)
            with zipfile.ZipFile(f"{local}/{i}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
                archive.write(f"{local}/plain", f"games/twic{i}.{'PGN' if i % 2 else 'pgn'}")
                archive.writestr("readme.txt", '[Event "none"]')
            system.copyFromLocalFile(True, True, path(f"file://{local}/{i}.zip"), path(f"{folder}/zip/twic{i}g.zip"))
    text = F.col("pgn")
    found = pgn.read_zip(spark, f"{folder}/zip").select(headers.tag(text, "White").alias("white"), headers.tag(text, "Black").alias("black"), headers.result(text).alias("result"))
    return found.groupBy("white", "black", "result").agg(F.count(F.lit(1)).alias("games"))


@queries._query(queries._with("SELECT k, coalesce(source, 'Unknown') AS source FROM games"))
def games_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games in folders by source, put there in two runs."""
    folder = _folder(spark, "append")
    games = _games(spark, sf_dir).withColumn("source", headers.source(F.col("pgn")))
    for half in (0, 1):
        sinks.append_games(games.where(F.col("k") % 2 == half), folder)
    return spark.read.parquet(folder).select("k", "source")


@queries._query("SELECT c_custkey, c_name, CAST(c_nationkey + 2 AS INTEGER) AS c_nationkey FROM customer")
def version_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced twice; the versions before stay."""
    folder = _folder(spark, "version")
    table = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))
    sinks.write_version(table, folder)
    for _ in range(2):
        sinks.write_version(sinks.read_current(spark, folder).withColumn("c_nationkey", F.col("c_nationkey") + 1), folder)
    return sinks.read_current(spark, folder)


@queries._query(queries._with(f"SELECT {queries._sha_sql('fen')} AS hash, CAST(count(*) AS BIGINT) AS games FROM counted GROUP BY fen", queries._BOOK, queries._COUNTED))
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index as a table of buckets, and how many games each position has in it."""
    folder = _folder(spark, "index")
    sinks.write_index_table(positions.position_index(positions.positions(_games(spark, sf_dir))), folder)
    return spark.read.parquet(folder).groupBy(F.col("hashFen").alias("hash")).agg(F.count(F.lit(1)).alias("games"))


_PLACES = "SELECT CAST(row_number() OVER (ORDER BY occurrence DESC, CAST(hash AS UBIGINT)) AS INTEGER) AS place, hash, occurrence FROM stats"


def _in_order(df: DataFrame) -> DataFrame:
    """place: of the rows of files that are read in the order of their names."""
    return df.withColumn("place", F.row_number().over(Window.orderBy("source_file", "n"))).drop("source_file", "n")


@queries._query(queries._with(_PLACES, queries._BOOK, queries._COUNTED, queries._FEN_STATS))
def stats_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of the lines in the output of all positions."""
    folder = _folder(spark, "order")
    sinks.write_stats(stats.position_stats(positions.positions(_games(spark, sf_dir))), folder)
    rows = tables.read_stats(spark, f"{folder}/fens-all").select("hash", "occurrence", F.col("_metadata.file_name").alias("source_file"), F.monotonically_increasing_id().alias("n"))
    return _in_order(rows).select("place", "hash", "occurrence")


@queries._query(f"WITH {queries._BOOK}, {queries._NAMES}, {queries._COLLAPSED.replace('any_value(ply) AS ply FROM', 'any_value(ply) AS ply, min((seq, ply)) AS seen FROM')} SELECT CAST(row_number() OVER (ORDER BY seen) AS INTEGER) AS place, eco, name, full_fen AS fen, CAST(ply AS INTEGER) AS ply FROM table_")
def openings_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening lines from text files, collapsed, written in the order in which positions were first met, and read again."""
    folder = _folder(spark, "openings")
    lines = ["eco\tname\tpgn", *(f"{eco}\t{name}\t{render.BOOK[line]}" for eco, name, line in queries._LINES), "not a line"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/lines")
    sinks.write_openings(openings.openings(tables.read_opening_lines(spark, [f"{folder}/lines"])), f"{folder}/table")
    read = spark.read.schema("eco string, name string, pgn string, fen string, ply int").option("sep", "\t").option("header", "true").option("quote", "").csv(f"{folder}/table")
    return _in_order(read.select("eco", "name", "fen", "ply", F.col("_metadata.file_name").alias("source_file"), F.monotonically_increasing_id().alias("n"))).select("place", "eco", "name", "fen", "ply")


@queries._query("SELECT CAST(c_nationkey AS BIGINT) AS nation, 'game ' || c_custkey AS pgn, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '180+' || (c_custkey % 3) END AS time_control FROM customer")
def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents, one for each nation's customers, written as files, read and exploded."""
    folder = _folder(spark, "archives")
    game = F.struct(F.concat(F.lit("game "), F.col("c_custkey").cast("string")).alias("pgn"), F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("180+"), (F.col("c_custkey") % 3).cast("string"))).alias("time_control"))
    documents = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy("c_nationkey").agg(F.to_json(F.struct(F.collect_list(game).alias("games"))).alias("json"))
    documents.write.partitionBy("c_nationkey").text(folder)
    games = json_archives.read_archives(spark, folder)
    return games.select(F.regexp_extract("source_file", "c_nationkey=([0-9]+)", 1).cast("long").alias("nation"), "pgn", "time_control")


@queries._query("SELECT CAST(l_linenumber % 5 = 0 AS BOOLEAN) AS malformed, CAST(count(*) AS BIGINT) AS rows FROM lineitem GROUP BY 1")
def stats_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of statistics, of which some have a text for a number; these are put aside, not read as nulls."""
    folder = _folder(spark, "malformed")
    number = F.when(F.col("l_linenumber") % 5 == 0, "none").otherwise(F.col("l_partkey").cast("string"))
    line = F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.lit("fen w - -"), number, *(F.col("l_linenumber").cast("string") for _ in range(3)))
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(line.alias("hash\tfen\toccurrence\twhite\tblack\tdraw"))
    table.write.option("header", "true").option("sep", "\x01").option("quote", "").option("escape", "").csv(folder)
    good, bad = tables.read_stats_checked(spark, folder)
    one = lambda df, malformed: df.agg(F.lit(malformed).alias("malformed"), F.count(F.lit(1)).alias("rows")).where("rows > 0")
    return one(good, False).union(one(bad, True))


@queries._query("SELECT DISTINCT o_orderpriority AS dedupe_key, first_value(o_orderkey) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS o_orderkey FROM orders")
def first_of_each_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First wins where a key has a great share of all rows."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderpriority").alias("dedupe_key"))
    return dedupe.first_wins(orders.withColumnRenamed("dedupe_key", "priority"), F.col("priority"), ["o_orderkey"]).select("o_orderkey", F.col("priority").alias("dedupe_key"))
