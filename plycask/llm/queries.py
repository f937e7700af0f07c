"""One query for each operator of this subpackage, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plycask.llm import bpe_count, decontaminate, exact_dedup, language_id, minhash, packing, phrase_dedup, pii, suffix_dedup, url_filter

RULES = [
    url_filter.Rule("com", "/en/", url_filter.BLOCK),
    url_filter.Rule("example.com", "/en/7", url_filter.ALLOW),
    url_filter.Rule("net", "/de/", url_filter.BLOCK),
    url_filter.Rule("example.net", "/de/8", url_filter.BLOCK),
    url_filter.Rule("org", "/es/", url_filter.BLOCK),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), RULES)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_table(spark, sf_dir, "documents"))


def op4_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.drop_passages(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_url_filter": op2_url_filter,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_phrase_dedup": op4_phrase_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_pii": op10_pii,
}

ORACLE_SQL = {
    # All pairs of texts that share a shingle, and what is reached from a text over links.
    "op1_minhash": r"""
        WITH RECURSIVE texts AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
        shingles AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i : i + 4], ' ')) AS shingle FROM texts, unnest(range(1, greatest(len(words) - 3, 2))) AS t(i)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        sets AS MATERIALIZED (SELECT min(doc_id) AS node, content FROM (SELECT doc_id, md5(string_agg(shingle, '' ORDER BY shingle)) AS content FROM shingles GROUP BY doc_id) GROUP BY content),
        same AS MATERIALIZED (SELECT doc_id, node FROM (SELECT doc_id, md5(string_agg(shingle, '' ORDER BY shingle)) AS content FROM shingles GROUP BY doc_id) JOIN sets USING (content)),
        few AS MATERIALIZED (SELECT doc_id AS node, shingle, n FROM shingles JOIN sizes USING (doc_id) SEMI JOIN sets ON doc_id = node),
        links AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM few a JOIN few b ON a.shingle = b.shingle AND a.node <> b.node AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) GROUP BY a.node, b.node HAVING 10 * count(*) >= 8 * (any_value(a.n) + any_value(b.n) - count(*))),
        reach AS (SELECT node, node AS other FROM sets UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
        labels AS (SELECT node, min(other) AS label FROM reach GROUP BY node),
        found AS (SELECT texts.doc_id, coalesce(label, -1) AS label FROM texts LEFT JOIN same USING (doc_id) LEFT JOIN labels USING (node))
        SELECT doc_id, min(doc_id) OVER w AS class_id, count(*) OVER w AS class_size, doc_id = min(doc_id) OVER w AS representative FROM found WINDOW w AS (PARTITION BY label)""",
    "op2_url_filter": """
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages),
        rules(rule_host, rule_path, rule_verdict) AS (
            VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
        fits AS (
            SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)""",
    "op3_exact_dedup": r"""
        WITH normal AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM normal WINDOW w AS (PARTITION BY text_sha256)""",
    "op4_phrase_dedup": r"""
        WITH texts AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
        windows AS (SELECT doc_id, i, md5(array_to_string(words[i : i + 34], ' ')) AS content FROM texts, unnest(range(1, len(words) - 33)) AS t(i)),
        repeated AS (SELECT doc_id, i FROM windows SEMI JOIN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1) AS twice USING (content)),
        covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts) ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(texts.words) AS n_words, len(texts.words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (doc_id)""",
    "op7_suffix_dedup": r"""
        WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS data, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        windows AS (SELECT doc_id, i, md5(substr(data, 2 * i + 1, 400)) AS content FROM texts, unnest(range(0, n - 199)) AS t(i)),
        repeated AS (SELECT doc_id, i FROM windows SEMI JOIN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1) AS twice USING (content)),
        marked AS (SELECT doc_id, i, coalesce(i - lag(i) OVER w > 200, true) AS begins FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        numbered AS (SELECT doc_id, i, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, span),
        gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans UNION ALL SELECT doc_id, max(b), max(n) FROM spans JOIN texts USING (doc_id) GROUP BY doc_id),
        cut AS (SELECT doc_id, string_agg(substr(data, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS data, sum(b - a) AS kept FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(n - coalesce(kept, n) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(cut.data, texts.data))) AS kept_sha256
        FROM texts LEFT JOIN cut USING (doc_id) LEFT JOIN counts USING (doc_id)""",
}
