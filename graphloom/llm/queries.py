"""The registered queries opN_<name>, thin digests of the operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, html_text, language_id, near_dedup, pii, pivot_index, substring_dedup, toxicity, url_filter, wu_manber


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def _learnable():
    """Rows that may teach; a null id has no remainder and teaches nothing."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.cut(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.classes(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).select("doc_id", "pii", F.filter("pii", lambda x: x["base"]).alias("base"))

    def count(k: int) -> Column:
        # The lambda has one parameter: Spark would pass a second, though it has a default, the element's index.
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")

    counts = map(count, range(4))
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("pii")).alias("spans"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.fit(docs.where(_learnable()), _table(spark, sf_dir, "labels").where(_learnable()))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), "score")
    return scored.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs, language_id.fit(docs.where(_learnable())))
    return found.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wu_manber.hits(docs, _table(spark, sf_dir, "benchmark"), n=10)
    return found.select(
        "doc_id",
        F.col("wm.n_words").alias("n_words"),
        F.col("wm.n_hit").alias("n_hit"),
        F.size("wm.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "wm.items"), 256).alias("items_sha256"),
        (F.col("wm.n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_pii": op4_pii,
    "op5_html_text": op5_html_text,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_language_id": op9_language_id,
    "op10_decontamination": op10_decontamination,
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": f"""
        WITH RECURSIVE words AS (
            SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT n, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS s
            FROM (SELECT n, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT n, count(*) AS size FROM shingles GROUP BY n),
        links AS (
            SELECT a.n AS a, b.n AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.n <> b.n
            JOIN sizes x ON x.n = a.n JOIN sizes y ON y.n = b.n
            GROUP BY a.n, b.n, x.size, y.size HAVING 100 * count(*) >= 80 * (x.size + y.size - count(*))
        ), reach(n, m) AS (
            SELECT n, n FROM words UNION SELECT reach.n, links.b FROM reach JOIN links ON reach.m = links.a
        ), least AS (SELECT reach.n AS n, min(words.doc_id) AS component_id FROM reach JOIN words ON reach.m = words.n GROUP BY reach.n)
        SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, component_id = doc_id AS kept
        FROM words JOIN least USING (n) LEFT JOIN sizes USING (n)""",
    "op2_substring_dedup": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), windows AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)
        ), firsts AS (SELECT w, min(doc_id * 1000000000 + i) AS first FROM windows GROUP BY w),
        again AS (
            SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh
            FROM windows JOIN firsts USING (w) WHERE doc_id * 1000000000 + i > first
        ), islands AS (
            SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM again) GROUP BY doc_id, island
        ), gaps AS (
            SELECT doc_id, b AS x, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1000000000) AS y FROM islands
            UNION ALL SELECT doc_id, 0, min(a) FROM islands GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (least(y, len(h) // 2) - x)), '' ORDER BY x) AS k FROM gaps JOIN d USING (doc_id) WHERE x < len(h) // 2 GROUP BY doc_id
        ), counts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM islands GROUP BY doc_id)
        SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
        FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op3_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT row_number() OVER () AS n, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), good AS (
            SELECT n, vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
            WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.n AS a, b.n AS b FROM good a JOIN good b ON a.n <> b.n AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
        ), reach(n, m) AS (SELECT n, n FROM v UNION SELECT reach.n, links.b FROM reach JOIN links ON reach.m = links.a),
        least AS (SELECT reach.n AS n, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.m = v.n GROUP BY reach.n),
        counts AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = vec_id AS kept
        FROM v JOIN least USING (n) LEFT JOIN counts USING (n)""",
    "op7_url_filter": f"""
        WITH rest AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT row_number() OVER () AS n, page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
        ), rules(verdict, r_host, r_path) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), best AS (
            SELECT n, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(verdict, length(r_host || r_path)) AS verdict
            FROM parts JOIN rules ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY n
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)""",
    "op10_decontamination": f"""
        WITH d AS (
            SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), patterns AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ), windows AS (
            SELECT n, i, m, array_to_string(w[i:i + m - 1], ' ') AS p
            FROM (SELECT n, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM patterns) WHERE len(w) >= m)
        ), found AS (
            SELECT n, i, windows.m AS m, item_id FROM windows JOIN patterns ON windows.p = patterns.p AND windows.m = patterns.m
        ), covered AS (
            SELECT n, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT n, unnest(range(i, i + m)) AS j FROM found) GROUP BY n
        ), items AS (
            SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT n, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY n
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (n) LEFT JOIN items USING (n)""",
}
