"""The queries opN_<name> over the whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .common import documents, pages
from .exact_dedup import exact_dedup, half
from .html_text import main_text
from .mixing import mix
from .near_dedup import near_dedup
from .sharding import shard
from .tiff import round_trip as tiff_round_trip
from .token_counts import count_with_edits
from .toxicity import score, train
from .warc import read_archive, write_archive


def op1_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(documents(spark, sf_dir), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), words=4)


OP2_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS x FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * c >= 80 * (u.n + v.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY ALL)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(pages(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), half())


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = pages(spark, sf_dir)
    out = read_archive(write_archive(own), "page_id", own.schema["page_id"].dataType.simpleString())
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS n, sha1(body) AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM g
"""


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 3 * source_size AS cap FROM per),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM weighed) - coalesce(sum(cap) OVER b, 0)) / ((SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT level FROM levels WHERE level * w <= cap ORDER BY cap / w, level LIMIT 1),
targets AS (SELECT source, source_size, coalesce(least((SELECT level FROM free) * w, CAST(cap AS DOUBLE)), 0.0) AS target FROM levels),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS fulls FROM targets),
parts AS (SELECT *, target - fulls * source_size AS budget FROM budgets),
run AS (
  SELECT s.*, p.source_size, p.target, p.fulls, p.budget, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS upto
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
gaps AS (SELECT source, max(budget) - coalesce(max(upto) FILTER (WHERE upto <= budget), 0) AS gap FROM run WHERE budget > 0 GROUP BY source),
units AS (SELECT r.source, r.h, g.gap, abs(sum(r.size) - g.gap) AS off FROM run r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source WHERE r.upto > r.budget GROUP BY r.source, r.h, g.gap),
closing AS (SELECT source, arg_min(h, (off, h)) AS h FROM units WHERE off < gap GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(r.size * (r.fulls + CASE WHEN r.budget > 0 AND (r.upto <= r.budget OR r.h = c.h) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run r LEFT JOIN closing c ON r.source IS NOT DISTINCT FROM c.source
"""

def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_with_edits(documents(spark, sf_dir))


def op10_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff_round_trip(documents(spark, sf_dir))


QUERIES = {
    "op1_vector_sharding": op1_vector_sharding,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_html_main_text": op4_html_main_text,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_warc_archive": op6_warc_archive,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_source_mixing": op8_source_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_tiff_media": op10_tiff_media,
}
ORACLE_SQL = {"op2_minhash_near_dedup": OP2_SQL, "op5_exact_dedup": OP5_SQL, "op6_warc_archive": OP6_SQL, "op8_source_mixing": OP8_SQL}
