"""Thin queries over the operators of this subpackage, and SQL for those SQL can express.

Each query applies its operator with production parameters to its whole table and derives
the digest columns from the operator's own output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.bpe import round_trip

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.packing import added_tokens, pack_documents

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # the rank file holds the vocabulary of byte_bpe_50k.json and, with its added tokens, gives the same ids
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    out = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added, size=1024)
    return out.withColumnRenamed("id", "doc_id")


def op3_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.ctw import score_documents

    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.common import scratch_dir
    from quirework.llm.warc import RECORD_ID, read_archives, write_archives

    path = scratch_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, min_revisit=100)
    page = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("null")).cast("long")
    records = read_archives(spark, path, with_payload=False).where(F.col("record_id").startswith(RECORD_ID))
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, CAST(n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest AND d.n >= 100
"""

def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.licenses import scan_documents

    found = scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("sentences").cast("long").alias("n_license_sentences"),
        F.array_join("sentences", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.hostrules import judge_documents

    out = judge_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
win2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 7)) AS c FROM win),
gaps AS (SELECT doc_id, i, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS k FROM win2 WHERE c >= 2),
rep AS (SELECT doc_id, sum(k) AS n_repeat_words FROM gaps GROUP BY doc_id),
s AS (SELECT w.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s),
f AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
             OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)) AS failed FROM b),
h AS (SELECT source, count(*) AS n, count_if(failed) AS bad FROM f WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT sum(n) AS n, count(*) AS k, sum(bad) / sum(n) AS mean, sum(n * (bad / n) * (bad / n)) / sum(n) - (sum(bad) / sum(n)) ** 2 AS spread FROM h),
p AS (SELECT mean, greatest(2, CASE WHEN spread > 1e-12 AND spread < mean * (1 - mean) THEN least(n / k, mean * (1 - mean) / spread - 1) ELSE n / k END) AS weight FROM m),
r AS (SELECT source FROM h, p WHERE (bad + greatest(mean, 1e-6) * weight) / (n + (greatest(mean, 1e-6) + greatest(1 - mean, 1e-6)) * weight) > 0.8 AND bad > 0.8 * n)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM r)) AS kept
FROM b
"""


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.minhash import near_duplicates

    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
arcs AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM arcs UNION SELECT reach.a, arcs.b FROM reach JOIN arcs ON reach.b = arcs.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(least(d.doc_id, coalesce(m, d.doc_id)) AS BIGINT) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.secretscan import scan_documents, span_text

    found = scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = span_text(F.col("spans"), ("assign", "access", "hex"))
    return found.select(
        F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.kdtopk import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=20, scale=64.0, query_every=20)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

#: The rules of the URL query (verdict, host and path).
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirework.llm.urlglob import Rule, filter_urls

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = filter_urls(pages, [Rule(*r) for r in URL_RULES])
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(verdict, name, rhost, rpath) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')),
g(glob_re) AS (VALUES ('\.[^/]*/cgi-bin/.*'), ('.*/(wp-login|xmlrpc)\.php'), ('.*/(wp-admin|wp-json|checkout)/.*'), ('.*/(login|signin|signup|register|logout|cart|checkout|feed|feed/|rss\.xml|atom\.xml|robots\.txt)'),
  ('.*/sitemap[^/]*\.xml'), ('[^/]*/.*\.(css|js|json|jpg|jpeg|png|gif|svg|ico|webp|mp3|mp4|avi|zip|gz|exe|dmg|woff|woff2)')),
j AS (
  SELECT u.page_id, u.host, u.path,
         arg_max(struct_pack(name := r.name, verdict := r.verdict), length(r.name)) AS best
  FROM u LEFT JOIN r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)
  GROUP BY ALL)
SELECT page_id, host, path, best.name AS rule,
       CASE WHEN best.name IS NOT NULL THEN best.verdict
            WHEN EXISTS (SELECT 1 FROM g WHERE regexp_full_match('.' || j.host || j.path, '(?s)' || glob_re)) THEN 'block'
            ELSE 'allow' END AS verdict
FROM j
"""


def queries() -> dict:
    return {
        "op1_bpe": op1_bpe,
        "op2_packing": op2_packing,
        "op3_ctw": op3_ctw,
        "op4_warc": op4_warc,
        "op5_licenses": op5_licenses,
        "op6_quality_rules": op6_quality_rules,
        "op7_minhash": op7_minhash,
        "op8_secret_scan": op8_secret_scan,
        "op9_topk": op9_topk,
        "op10_url_filter": op10_url_filter,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": OP4_SQL, "op6_quality_rules": OP6_SQL, "op7_minhash": OP7_SQL, "op9_topk": OP9_SQL, "op10_url_filter": OP10_SQL}
