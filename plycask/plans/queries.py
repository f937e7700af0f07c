"""A query for each operator over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask.config import Config
from plycask.functions import hashes, headers, moves
from plycask.operators import dedupe, filters, openings, positions, scrape, stats, tagging, union
from plycask.plans import render
from plycask.plans.book import POSITIONS
from plycask.sources import json_archives, landing
from plycask.sources import pgn as raw_pgn

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CONFIG = Config()


def _pgn() -> Column:
    return F.col("pgn")


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.games(_table(spark, sf_dir, "orders"))


def _with(select: str, *more: str) -> str:
    return f"WITH {', '.join([render.GAMES_SQL.strip(), *more])} {select}"


# Statistics with the tables' own keys for positions: part and line number for the position, order for the game.


def _occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    result = F.when(F.col("o_orderstatus") == "F", "1-0").when(F.col("o_orderstatus") == "O", "0-1").otherwise("1/2-1/2")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return lines.join(orders.select("o_orderkey", result.alias("result")), F.col("l_orderkey") == F.col("o_orderkey"))


def _surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.count_by(_occurrences(spark, sf_dir), ["l_partkey", "l_linenumber"])


_SURROGATE = """stats AS (
    SELECT l_partkey, l_linenumber, count(*) AS occurrence, count(*) FILTER (o_orderstatus = 'F') AS white,
           count(*) FILTER (o_orderstatus = 'O') AS black, count(*) FILTER (o_orderstatus = 'P') AS draw
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey, l_linenumber)"""


@_query(f"WITH {_SURROGATE} SELECT * FROM stats")
def position_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surrogate(spark, sf_dir)


@_query(f"WITH {_SURROGATE} SELECT * FROM stats WHERE occurrence >= 10")
def position_stats_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.recurrent(_surrogate(spark, sf_dir))


@_query(f"WITH {_SURROGATE} SELECT * FROM stats WHERE occurrence >= 2")
def position_stats_withoutone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.without_single(_surrogate(spark, sf_dir))


@_query(f"WITH {_SURROGATE} SELECT CAST(least(occurrence, 10) AS INTEGER) AS band, count(*) AS positions, CAST(sum(occurrence) AS BIGINT) AS occurrences FROM stats GROUP BY 1")
def position_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.band_sizes(_surrogate(spark, sf_dir))


@_query(
    f"""WITH {_SURROGATE} SELECT round(100 * count(*) FILTER (occurrence >= 10) / count(*), 2) AS pct_recurrent,
    round(100 * count(*) FILTER (occurrence BETWEEN 2 AND 9) / count(*), 2) AS pct_some, round(100 * count(*) FILTER (occurrence = 1) / count(*), 2) AS pct_single FROM stats"""
)
def position_band_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.band_shares(_surrogate(spark, sf_dir))


@_query(f"WITH {_SURROGATE} SELECT count(*) AS all_positions, count(*) FILTER (occurrence >= 2) AS without_one, count(*) FILTER (occurrence >= 10) AS only_recurrent FROM stats")
def output_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.output_counts(_surrogate(spark, sf_dir))


@_query(f"WITH {_SURROGATE} SELECT * FROM stats ORDER BY occurrence DESC, l_partkey, l_linenumber LIMIT 10")
def position_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surrogate(spark, sf_dir).orderBy(F.desc("occurrence"), "l_partkey", "l_linenumber").limit(10)


@_query(f"WITH {_SURROGATE} SELECT l_partkey, l_linenumber, l_orderkey AS game, occurrence, white, black, draw FROM lineitem JOIN stats USING (l_partkey, l_linenumber)")
def position_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber", F.col("l_orderkey").alias("game"))
    return index.join(_surrogate(spark, sf_dir), ["l_partkey", "l_linenumber"])


@_query(f"WITH {_SURROGATE} SELECT * FROM stats")
def position_stats_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _occurrences(spark, sf_dir)
    keys = ["l_partkey", "l_linenumber"]
    return stats.combined([stats.count_by(rows.where(f"l_orderkey % 3 = {i}"), keys) for i in range(3)], keys)


# Games as text.


@_query(
    _with(
        """SELECT k, id, coalesce(source, 'Unknown') AS source, CASE WHEN source = 'Online' THEN 0 ELSE 1 END AS official, event, site,
        coalesce(date, '1900.01.01') AS date_raw, replace(date, '.', '-') AS game_date, white, black, white_elo, black_elo,
        greatest(coalesce(white_elo, 0), black_elo) AS max_elo, time_control, CAST(base_seconds AS INTEGER) AS base_seconds, result FROM games"""
    )
)
def pgn_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.nullif(headers.date(_pgn()), F.lit(headers.DEFAULT_DATE))
    return _games(spark, sf_dir).select(
        "k",
        headers.tag(_pgn(), "ID").alias("id"),
        headers.source(_pgn()).alias("source"),
        headers.official(_pgn()).alias("official"),
        *(headers.tag(_pgn(), name).alias(name.lower()) for name in ("Event", "Site", "White", "Black")),
        headers.date(_pgn()).alias("date_raw"),
        headers.game_date(date).cast("string").alias("game_date"),
        headers.elo(_pgn(), "WhiteElo").alias("white_elo"),
        headers.elo(_pgn(), "BlackElo").alias("black_elo"),
        headers.max_elo(_pgn()).alias("max_elo"),
        headers.tag(_pgn(), "TimeControl").alias("time_control"),
        headers.base_seconds(headers.header(_pgn(), "TimeControl")).alias("base_seconds"),
        headers.result(_pgn()).alias("result"),
    )


@_query(_with("SELECT k, coalesce(id, '') <> '' AS has_id, source, max_elo, official, n_tags FROM (SELECT k, id, source, greatest(coalesce(white_elo, 0), black_elo) AS max_elo, CASE WHEN source = 'Online' THEN 0 ELSE 1 END AS official, CAST(9 + (id IS NOT NULL)::INT + (source IS NOT NULL)::INT + (date IS NOT NULL)::INT + (time_control IS NOT NULL)::INT + (link IS NOT NULL)::INT AS INTEGER) AS n_tags FROM games)"))
def typed_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _games(spark, sf_dir).withColumnRenamed("k", "seq")
    typed = tagging.typed(raw)
    return typed.select(F.col("seq").alias("k"), F.col("id").startswith("g").alias("has_id") & headers.tag(_pgn(), "ID").isNotNull(), "source", "max_elo", "official", F.size("tags").alias("n_tags")).toDF("k", "has_id", "source", "max_elo", "official", "n_tags")


@_query(_with("SELECT k, CAST(count_ply AS INTEGER) AS plies FROM games"))
def pgn_ply_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).select("k", moves.count_plies(_pgn()).alias("plies"))


@_query(_with("SELECT k, CAST(count_moves AS INTEGER) AS moves FROM games"))
def pgn_move_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).select("k", moves.count_moves(_pgn()).alias("moves"))


_ALL = "coalesce(white_elo, 0) >= 2500 AND black_elo >= 2500 AND count_ply >= 10"


@_query(_with(f"SELECT k FROM games WHERE {_ALL}"))
def pgn_filter_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.keep_all(_pgn(), CONFIG)).select("k")


@_query(_with(f"SELECT k FROM games WHERE {_ALL} AND base_seconds >= 180"))
def pgn_filter_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.keep_limited(_pgn(), CONFIG)).select("k")


@_query(_with(f"SELECT k FROM games WHERE {_ALL} AND has_eval"))
def pgn_filter_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.keep_evaluated(_pgn(), CONFIG)).select("k")


_ARCHIVED = "white_elo >= 2500 AND black_elo >= 2500 AND count_moves >= 10"


@_query(_with(f"SELECT k FROM games WHERE {_ARCHIVED}"))
def pgn_filter_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.keep_archived(_pgn(), CONFIG)).select("k")


@_query(_with(f"SELECT k FROM games WHERE {_ARCHIVED} AND base_seconds >= 180 AND NOT contains(time_control, '/')"))
def pgn_filter_archive_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.keep_archived_limited(_pgn(), F.col("time_control"), CONFIG)).select("k")


@_query(_with("SELECT k FROM games WHERE event IN ('Rated Blitz game', 'CCC 15', 'Tata Steel', 'Computer Open')"))
def pgn_engine_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(~filters.engine_event(_pgn())).select("k")


@_query(_with("SELECT k FROM games WHERE event <> 'TCEC S20' AND result <> '*' AND id IS NOT NULL"))
def pgn_countable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.countable(_pgn())).select("k")


@_query(_with("SELECT k, m AS max_elo, m <> 2600 AS corrected, CASE WHEN source IS NULL THEN 0 ELSE m END AS written FROM (SELECT k, source, greatest(coalesce(white_elo, 0), black_elo) AS m FROM games) WHERE m <= 2640"))
def pgn_maxelo_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = tagging.fixed_max_elo(_games(spark, sf_dir), Config(max_elo=2640))
    return fixed.select("k", "max_elo", "corrected", F.coalesce(headers.elo(_pgn(), "MaxElo"), F.lit(0)).alias("written"))


@_query(_with("SELECT k FROM games WHERE coalesce(white_elo, 0) >= 2500 AND black_elo >= 2500"))
def pgn_refilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _games(spark, sf_dir).where(filters.refiltered(_pgn())).select("k")


@_query(_with("SELECT k, 'o' || k AS id, 'Official' AS source, greatest(coalesce(white_elo, 0), black_elo) AS max_elo FROM games"))
def pgn_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = _games(spark, sf_dir).withColumn("pgn", F.regexp_replace("pgn", r"(?s)\A.*?(?=\[Event )", ""))
    tagged = bare.select("k", tagging.tagged(_pgn(), F.concat(F.lit("o"), F.col("k").cast("string")), headers.OFFICIAL).alias("pgn"))
    return tagged.select("k", headers.tag(_pgn(), "ID").alias("id"), headers.source(_pgn()).alias("source"), headers.elo(_pgn(), "MaxElo").alias("max_elo"))


@_query(_with("SELECT CAST(count(*) AS BIGINT) AS total, count(*) FILTER (event = 'TCEC S20') AS excluded, count(*) FILTER (id IS NULL) AS nameless FROM games"))
def pipeline_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that fill as the games are written."""
    seen, counters = union.observed(_games(spark, sf_dir), "counters", excluded=filters.excluded(_pgn()), nameless=headers.tag(_pgn(), "ID").isNull())
    seen.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(counters.get[name] for name in ("total", "excluded", "nameless"))], "total long, excluded long, nameless long")


@_query(_with("SELECT k, CAST(CASE WHEN source = 'Online' THEN 0 ELSE 1 END AS INTEGER) AS official, CAST(CASE WHEN k % 4 < 2 THEN 1 ELSE 0 END AS INTEGER) AS by_name FROM games"))
def official_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rules of what is an official game, over games of which half name a collection."""
    named = F.concat(_pgn(), F.when(F.col("k") % 4 == 0, "\n{ TWIC 920 }").when(F.col("k") % 4 == 1, "\n{ from PgnMentor }").otherwise(""))
    return _games(spark, sf_dir).select("k", headers.official(_pgn()).alias("official"), headers.official_by_name(named).alias("by_name"))


@_query(_with("SELECT k FROM games WHERE k % 10 > 1"))
def pgn_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that have both players."""
    torn = F.regexp_replace(_pgn(), F.when(F.col("k") % 10 == 0, r"\[White [^\n]*\n").when(F.col("k") % 10 == 1, r"\[Black [^\n]*\n").otherwise(r"\A\z"), F.lit(""))
    return _games(spark, sf_dir).select("k", torn.alias("pgn")).where(filters.has_players(_pgn())).select("k")


@_query("SELECT doc_id, length(text) <= 2000 AS kept FROM documents")
def record_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records up to a size, and those put aside."""
    kept, aside = raw_pgn.too_long(_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("pgn")), 2_000)
    return kept.select("doc_id", F.lit(True).alias("kept")).union(aside.select("doc_id", F.lit(False)))


# Deduplication and anti-joins.

_COMPOSITE = "CASE WHEN link IS NOT NULL THEN link WHEN date IS NOT NULL THEN lower(concat_ws('-', site, date, white, black, coalesce(CAST(white_elo AS VARCHAR), '?'), black_elo)) END"
_FIRST = "SELECT k FROM (SELECT k, key, row_number() OVER (PARTITION BY key ORDER BY k) AS place FROM keys) WHERE place = 1"


@_query(_with(f"{_FIRST} AND key IS NOT NULL UNION ALL SELECT k FROM keys WHERE key IS NULL", f"keys AS (SELECT k, {_COMPOSITE} AS key FROM games)"))
def dedupe_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe(_games(spark, sf_dir), ["k"]).select("k")


@_query(
    _with(
        f"{_FIRST} AND key IS NOT NULL",
        f"keys AS (SELECT k, CASE WHEN link IS NOT NULL THEN link WHEN date IS NOT NULL THEN lower(concat_ws('-', white, black, date, utc_time)) END AS key FROM games WHERE {_ARCHIVED} AND base_seconds >= 180 AND NOT contains(time_control, '/'))",
    )
)
def dedupe_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _games(spark, sf_dir).where(filters.keep_archived_limited(_pgn(), F.col("time_control"), CONFIG))
    return dedupe.dedupe_archive(kept, ["k"]).select("k")


@_query(_with(_FIRST, "keys AS (SELECT k, concat_ws('|', event, site, coalesce(date, ''), white, black, CASE WHEN line = 3 THEN '3' ELSE CAST(line AS VARCHAR) END, result) AS key FROM games)"))
def dedupe_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_content(_games(spark, sf_dir), ["k"]).select("k")


@_query("SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def dedupe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("digest"))
    return dedupe.first_wins(docs, F.col("digest"), ["doc_id"])


@_query(_with("SELECT count(*) AS total, count(DISTINCT key) + count(*) FILTER (key IS NULL) AS kept, count(*) - count(DISTINCT key) - count(*) FILTER (key IS NULL) AS duplicates FROM keys", f"keys AS (SELECT k, {_COMPOSITE} AS key FROM games)"))
def dedupe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _games(spark, sf_dir)
    return dedupe.dedupe_counts(games, dedupe.dedupe(games, ["k"]))


@_query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def anti_join_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    return dedupe.not_processed(_table(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey")


@_query(_with("SELECT k FROM games WHERE k % 2 = 0 AND (link IS NULL OR link NOT IN (SELECT link FROM games WHERE k % 2 = 1 AND link IS NOT NULL))"))
def anti_join_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _games(spark, sf_dir)
    return dedupe.not_written(games.where("k % 2 = 0"), games.where("k % 2 = 1"), dedupe.link_key).select("k")


@_query("SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS INTEGER) AS source_ord FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')")
def compile_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return union.compiled([orders.where(F.col("o_orderpriority") == p).select("o_orderkey") for p in ("1-URGENT", "2-HIGH", "5-LOW")])


# JSON documents and web pages.


@_query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def archive_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", "user_id", F.from_json("props", "k long").alias("p")).select("event_id", "user_id", "p.k")


@_query("SELECT conv_id, turn, text AS pgn, role AS time_control FROM conversations WHERE turn IS NOT NULL")
def archive_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as archive documents, written as JSON, parsed and exploded again."""
    turns = _table(spark, sf_dir, "conversations").where("turn IS NOT NULL")
    game = F.struct("turn", F.struct(F.col("text").alias("pgn"), F.col("role").alias("time_control")).alias("game"))
    documents = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(game)).alias("all"))
    written = documents.select("conv_id", F.col("all.turn").alias("turns"), F.to_json(F.struct(F.col("all.game").alias("games"))).alias("json"))
    read = written.select(F.col("conv_id").cast("string").alias("source_file"), "turns", F.from_json("json", "games array<struct<pgn:string,time_control:string>>").alias("d")).select("source_file", "turns", "d.games")
    games = json_archives.archived_games(read)
    places = read.select("source_file", F.posexplode("turns").alias("seq", "turn"))
    return games.join(places, ["source_file", "seq"]).select(F.col("source_file").cast("long").alias("conv_id"), "turn", "pgn", "time_control")


@_query("SELECT DISTINCT lower(c_mktsegment) AS username FROM customer")
def leaderboard_usernames(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.struct(F.struct(F.col("c_mktsegment").alias("username")).alias("user"))
    documents = _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_set(user).alias("leaders"))
    return json_archives.usernames(documents)


# Pages with links to games and tables of numbers put behind their own html, in upper and lower case, as the given pages have neither.


@_query("""SELECT page_id || '.pgn' AS name, 'https://index.example/files/' || page_id || '.pgn' AS url FROM pages
    UNION ALL SELECT DISTINCT 'p' || (page_id % 50) || '.pgn', 'https://h.example/p' || (page_id % 50) || '.pgn' FROM pages""")
def link_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("page_id").cast("string")
    more = ['<A CLASS="x" HREF="/files/', number, '.pgn">a</A><a\nhref="https://h.example/p', (F.col("page_id") % 50).cast("string"), '.pgn">b</a><a href="UPPER.PGN"></a><a href=".pgn"></a><a name="', number, '.pgn"></a>']
    html = F.concat(F.coalesce("html", F.lit("")), *(F.lit(x) if isinstance(x, str) else x for x in more))
    return scrape.links(_table(spark, sf_dir, "pages").select("page_id", html.alias("html")), ".pgn", "https://index.example")


@_query("SELECT page_id, CAST(CASE WHEN page_id % 4 >= 2 AND page_id % 7 <> 0 THEN page_id END AS INTEGER) AS latest FROM pages")
def table_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of one to four rows besides their heading, some without a number."""
    row = F.format_string('<TR class="r"><td align=left><B>%s</b> of</TD><td>x</td></tr>', F.when(F.col("page_id") % 7 == 0, "none").otherwise(F.col("page_id").cast("string")))
    rows = F.concat(row, F.repeat(F.lit("<tr><td>7</td></tr>"), (F.col("page_id") % 4).cast("int") - 1))
    table = F.concat(F.lit('<table class="other"><tr><td>1</td></tr></table><TABLE id="t" CLASS="a Results-Table">\n<tr><th>number</th></tr>'), F.when(F.col("page_id") % 4 > 0, rows).otherwise(""), F.lit("</TABLE><table><tr><td>2</td></tr></table>"))
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", scrape.latest_number(F.concat(F.regexp_replace(F.coalesce("html", F.lit("")), "(?i)</?table", "<p"), table)).alias("latest"))


# Validation.


@_query(_with("SELECT k, CASE WHEN NOT valid THEN 'Invalid move in PGN: Ke3' END AS error, CASE WHEN NOT valid THEN 'Invalid move in PGN' END AS error_class FROM games"))
def pgn_legality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.checked(_games(spark, sf_dir), CONFIG).select("k", "error", "error_class")


@_query(_with("SELECT 'Invalid move in PGN' AS error_class, count(*) AS count FROM games WHERE NOT valid HAVING count(*) > 0"))
def quarantine_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.error_histogram(positions.valid_and_quarantine(_games(spark, sf_dir))[1])


@_query("SELECT event_type AS error_class, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, error_class LIMIT 3")
def error_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.error_histogram(_table(spark, sf_dir, "events").withColumnRenamed("event_type", "error_class"), 3)


@_query(_with("SELECT k FROM games WHERE valid"))
def pgn_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.valid_and_quarantine(_games(spark, sf_dir))[0].select("k")


# Hashes and positions.

_LITTLE = "'0x' || " + " || ".join(f"substr(sha256({{0}}), {15 - 2 * i}, 2)" for i in range(8))


def _sha_sql(column: str) -> str:
    return f"CAST(CAST({_LITTLE.format(column)} AS UBIGINT) AS VARCHAR)"


@_query(f"SELECT doc_id, {_sha_sql('text')} AS hash FROM documents")
def sha256_hash64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", hashes.sha_key(F.col("text")).alias("hash"))


@_query("SELECT r_regionkey, CASE r_regionkey % 2 WHEN 0 THEN '11160318154034397263' ELSE '12917804110809363939' END AS hash FROM region")
def city_hash64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the empty text and of `a`, whose values are published."""
    text = F.when(F.col("r_regionkey") % 2 == 0, "").otherwise("a")
    return _table(spark, sf_dir, "region").select("r_regionkey", hashes.city_key(text).alias("hash"))


@_query(f"SELECT {_sha_sql('p_name')} AS hash, p_partkey, p_name AS fen FROM part")
def hash_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.prefixed(_table(spark, sf_dir, "part").select(F.lit("old").alias("hash"), "p_partkey", F.col("p_name").alias("fen")))


def _normal(fen: str) -> str:
    return " ".join([*fen.split()[:4], "0", "1"])


_BOOK = "fens(fen_line, ply, full_fen, fen) AS (VALUES " + ", ".join(f"({line}, {ply}, '{fen}', '{_normal(fen)}')" for line, ply, fen in POSITIONS) + ")"
_COUNTED = "counted AS (SELECT * FROM games JOIN fens ON line = fen_line WHERE event <> 'TCEC S20' AND result <> '*' AND id IS NOT NULL)"
_FEN_STATS = f"stats AS (SELECT {_sha_sql('fen')} AS hash, fen, count(*) AS occurrence, count(*) FILTER (result = '1-0') AS white, count(*) FILTER (result = '0-1') AS black, count(*) FILTER (result = '1/2-1/2') AS draw FROM counted GROUP BY fen)"


@_query(_with("SELECT k, ply, fen FROM games JOIN fens ON line = fen_line", _BOOK))
def replay_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.explode(_games(spark, sf_dir), ["k"])


@_query(f"WITH {_BOOK} SELECT l_orderkey, l_linenumber, fen FROM lineitem JOIN fens ON l_orderkey % 8 = fen_line AND l_linenumber = ply")
def fen_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full FENs with other counters than the book's, one for each line item whose game has the ply."""
    book = spark.createDataFrame([(line, ply, fen) for line, ply, fen in POSITIONS], "line long, ply int, fen string")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    full = F.concat_ws(" ", F.substring_index("fen", " ", 4), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"))
    found = lines.join(F.broadcast(book), (F.col("l_orderkey") % 8 == F.col("line")) & (F.col("l_linenumber") == F.col("ply")))
    return found.select("l_orderkey", "l_linenumber", headers.normalised_fen(full).alias("fen"))


@_query(_with("SELECT * FROM stats", _BOOK, _COUNTED, _FEN_STATS))
def fen_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.position_stats(positions.positions(_games(spark, sf_dir)))


@_query(_with("SELECT * FROM stats ORDER BY occurrence DESC, CAST(hash AS UBIGINT) LIMIT 10", _BOOK, _COUNTED, _FEN_STATS))
def fen_stats_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top(stats.position_stats(positions.positions(_games(spark, sf_dir))), 10)


_DATE = "coalesce(date, '1900.01.01') AS date"
_OFFICIAL = "CASE WHEN source = 'Online' THEN 0 ELSE 1 END AS official"


@_query(_with(f"SELECT {_sha_sql('fen')} AS \"hashFen\", fen, id AS \"gameId\", greatest(coalesce(white_elo, 0), black_elo) AS \"maxElo\", {_OFFICIAL}, {_DATE} FROM counted", _BOOK, _COUNTED))
def fen_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.position_index(positions.positions(_games(spark, sf_dir)))


@_query(_with(f"SELECT {_sha_sql('fen')} AS \"hashFen\", fen, id AS \"gameId\", coalesce(white_elo, 0) AS \"whiteElo\", 0 AS official, {_DATE} FROM games JOIN fens ON line = fen_line WHERE event <> 'TCEC S20' AND id IS NOT NULL", _BOOK))
def fen_index_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.position_index_v2(_games(spark, sf_dir))


@_query(_with("SELECT fen, id AS game_id, ply, occurrence FROM counted JOIN stats USING (fen) WHERE occurrence < 10000000", _BOOK, _COUNTED, _FEN_STATS))
def fen_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games that reach each position, with how often it occurs: the join of index and statistics."""
    found = positions.positions(_games(spark, sf_dir))
    return stats.games_of(found, stats.position_stats(found)).select("fen", "game_id", "ply", "occurrence")


# Openings: the regions' book lines, the last two with a name that comes later for a position met before.

_LINES = [("C60", "Ruy Lopez", 0), ("C65", "Ruy Lopez, castled", 1), ("B50", "Sicilian", 2), ("D60", "Queen's Gambit", 3), ("C02", "French", 4), ("B00", "St George", 5), ("B00", "King's Pawn", 6)]


def _opening_table(spark: SparkSession) -> DataFrame:
    rows = [(eco, name, render.BOOK[line], seq) for seq, (eco, name, line) in enumerate(_LINES)]
    return openings.collapsed(openings.steps(spark.createDataFrame(rows, "eco string, name string, pgn string, seq long")))


_NAMES = (
    "names(seq, eco, name, line, plies) AS (VALUES "
    + ", ".join(f"({seq}, '{eco}', '{name.replace(chr(39), chr(39) * 2)}', {line}, {max(p for l, p, _ in POSITIONS if l == line)})" for seq, (eco, name, line) in enumerate(_LINES))
    + ")"
)
_COLLAPSED = """passed AS (SELECT seq, eco, name, ply, full_fen, fen, ply = plies AS is_final FROM names JOIN fens ON line = fen_line WHERE ply > 0),
    table_ AS (SELECT full_fen, any_value(fen) AS fen, coalesce(arg_max(eco, seq) FILTER (is_final), arg_min(eco, seq)) AS eco,
                      coalesce(arg_max(name, seq) FILTER (is_final), arg_min(name, seq)) AS name, any_value(ply) AS ply FROM passed GROUP BY full_fen)"""


@_query(f"WITH {_BOOK}, {_NAMES}, {_COLLAPSED} SELECT eco, name, full_fen AS fen, ply FROM table_")
def openings_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _opening_table(spark).select("eco", "name", "fen", "ply")


@_query(_with("SELECT id AS game_id, arg_max(table_.eco, counted.ply) AS eco, arg_max(table_.name, counted.ply) AS name, max(counted.ply) AS ply FROM counted JOIN table_ USING (fen) GROUP BY id", _BOOK, _COUNTED, _NAMES, _COLLAPSED))
def opening_identify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return openings.deepest_opening(positions.positions(_games(spark, sf_dir)), _opening_table(spark))


@_query("SELECT o_orderkey, array_to_string(list_transform(range(o_orderkey % 9), lambda i: CASE WHEN i % 2 = 0 THEN (i // 2 + 1) || '. ' ELSE '' END || 'm' || (o_orderkey + i)), ' ') AS pgn FROM orders")
def moves_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    sans = F.expr("transform(slice(sequence(0, 8), 1, cast(o_orderkey % 9 as int)), i -> concat('m', o_orderkey + i))")
    return _table(spark, sf_dir, "orders").select("o_orderkey", moves.rendered(sans).alias("pgn"))


# Months and weeks of the sources.


@_query("SELECT strftime(m, '%Y-%m') AS month, 'lichess_db_standard_rated_' || strftime(m, '%Y-%m') || '.pgn.zst' AS file FROM generate_series(TIMESTAMP '2013-01-01', (SELECT date_trunc('month', max(o_orderdate)) + INTERVAL 25 YEAR FROM orders), INTERVAL 1 MONTH) AS t(m)")
def month_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = _table(spark, sf_dir, "orders").agg(F.date_format(F.add_months(F.max("o_orderdate"), 300), "yyyy-MM").alias("m")).head().m
    return landing.months(spark, last)


@_query("SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m') AS next, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS previous FROM orders")
def month_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    return _table(spark, sf_dir, "orders").select("o_orderkey", landing.next_month(month).alias("next"), landing.previous_month(F.col("o_orderdate")).alias("previous"))


@_query("SELECT CAST(w AS INTEGER) AS week, 'twic' || w || 'g.zip' AS file FROM generate_series(920, 920 + (SELECT count(*) FROM nation)) AS t(w)")
def week_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.weeks(spark, 920 + _table(spark, sf_dir, "nation").count())
