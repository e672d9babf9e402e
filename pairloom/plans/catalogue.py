"""The registered queries of the parallel-corpus operators over the driver's tables, and their SQL.

A work is a conversation or a source, its sides are the user's and the assistant's turns, a page is a turn, and a
box is an event (x: its time, y: its value). Every query reads its whole tables.
"""

from __future__ import annotations

import functools
import io
import json
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..batches import small_batches
from ..functions import text as T
from ..operators import align, layout, tfidf, vote, works
from ..sources import providers, readers, sinks
from .engine import global_text, step_counts

LATIN = r"\x{c0}-\x{ff}"
#: Boundary between bands of events, in microseconds.
BAND_GAP = 12 * 3600 * 1_000_000
SWAPS = (("tion", "sion"), ("sions", "tions"), ("the ", "ye "), ("entre", "inter"), ("ung", "ing"))
SIDES = {"user": "source", "assistant": "target"}
_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, side, text: the turns of a side, joined."""
    turns = _table(spark, sf_dir, "conversations").filter(F.col("role").isin(*SIDES))
    side = F.when(F.col("role") == "user", "source").otherwise("target")
    return works.joined(turns.select("conv_id", side.alias("side"), "turn", "text"), ["conv_id", "side"], "turn")


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, side, pos, sentence: each side by its segmenter."""
    both = F.when(F.col("side") == "source", T.segment(F.col("text"))).otherwise(T.segment_plain(F.col("text")))
    return works.sentences(_raw(spark, sf_dir), ["conv_id", "side"], both)


def _sides(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(s.filter(F.col("side") == x).drop("side") for x in ("source", "target"))


_SQL_STRIP = rf"regexp_replace(%s, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _sql_segments(text: str, ends: str) -> str:
    parts = f"regexp_extract_all({text}, '[^{ends}]*[{ends}]|[^{ends}]+')"
    return f"list_filter(list_transform({parts}, lambda x: {_SQL_STRIP % 'x'}), lambda x: length(x) > 0)"


_HAN, _OTHER = "。！？.!?\\n", ".!?\\n"
_SQL_PLAIN = f"list_filter(list_transform(string_split(replace(text, chr(10), ' '), '.'), lambda x: {_SQL_STRIP % 'x'}), lambda x: length(x) > 0)"
_SQL_SENTENCES = f"""
raw AS (SELECT conv_id, CASE role WHEN 'user' THEN 'source' ELSE 'target' END AS side, string_agg(text, chr(10) ORDER BY turn) AS text
        FROM conversations WHERE role IN ('user', 'assistant') GROUP BY ALL),
lists AS (SELECT conv_id, side, CASE side WHEN 'source' THEN {_sql_segments('text', _HAN)} ELSE {_SQL_PLAIN} END AS l FROM raw),
sentences AS (SELECT conv_id, side, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM lists)
"""


def _sql_documents(segments: str) -> str:
    return f"WITH l AS (SELECT doc_id, {segments} AS l FROM documents) SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM l"


_SQL_WEIGHTS = (
    _SQL_SENTENCES
    + r""",
tf AS (SELECT conv_id, side, pos, term, count(*) AS tf FROM (SELECT conv_id, side, pos, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]{2,}')) AS term FROM sentences) GROUP BY ALL),
n AS (SELECT conv_id, count(*) AS n FROM sentences GROUP BY ALL),
df AS (SELECT conv_id, term, count(*) AS df FROM tf GROUP BY ALL),
raww AS (SELECT tf.*, tf.tf * (ln((1 + n.n) / (1 + df.df)) + 1) AS v FROM tf JOIN df USING (conv_id, term) JOIN n USING (conv_id)),
weights AS (SELECT conv_id, side, pos, term, v / sqrt(sum(v * v) OVER (PARTITION BY conv_id, side, pos)) AS w FROM raww)
"""
)
_SQL_COSINES = (
    _SQL_WEIGHTS
    + """,
cosines AS (SELECT a.conv_id, a.pos AS i, b.pos AS j, sum(a.w * b.w) AS sim
            FROM weights a JOIN weights b ON a.conv_id = b.conv_id AND a.term = b.term AND a.side = 'source' AND b.side = 'target' GROUP BY ALL)
"""
)

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def added(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return added


@query(_sql_documents(_sql_segments("text", _HAN)))
def q01_segment_han(spark, sf_dir):
    return works.sentences(_table(spark, sf_dir, "documents"), ["doc_id"], T.segment(F.col("text")))


@query(_sql_documents(_sql_segments("text", _OTHER)))
def q02_segment_regex_other(spark, sf_dir):
    return works.sentences(_table(spark, sf_dir, "documents"), ["doc_id"], T.segment_other(F.col("text")))


@query(_sql_documents(_SQL_PLAIN))
def q03_segment_fallback(spark, sf_dir):
    return works.sentences(_table(spark, sf_dir, "documents"), ["doc_id"], T.segment_plain(F.col("text")))


@query(
    r"""
SELECT doc_id, CAST(len(t) AS INT) AS n_words, CAST(len(list_filter(t, lambda x: regexp_matches(x, '\A(?:[A-Za-z0-9]|[^\p{L}\p{N}_])+\z'))) AS INT) AS n_noise
FROM (SELECT doc_id, regexp_split_to_array(text, '[\x09-\x0D\x20]+') AS t FROM documents WHERE text IS NOT NULL)"""
)
def q04_noise_filter(spark, sf_dir):
    words = F.split("text", r"[\x09-\x0D\x20]+")
    rows = _table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", words.alias("w"))
    return rows.select("doc_id", F.size("w").alias("n_words"), F.size(F.filter("w", T.is_noise)).alias("n_noise"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\x{c0}-\x{ff}]')) AS INT) AS score FROM documents")
def q05_char_class_score(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.count_class(F.col("text"), LATIN).alias("score"))


@query(
    r"""
WITH c AS (SELECT source, doc_id, text, CAST(len(regexp_extract_all(text, '[\x{c0}-\x{ff}]')) AS INT) AS score, NOT starts_with(text, 'The ') AS ok FROM documents WHERE text IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ok DESC, score DESC, doc_id) AS k FROM c)
SELECT source, doc_id, score, md5(text) AS text_md5 FROM r WHERE k = 1"""
)
def q06_vote_first_wins(spark, sf_dir):
    best = vote.vote(_table(spark, sf_dir, "documents"), ["source"], "doc_id", chars=LATIN, failure="The ")
    return best.select("source", "doc_id", "score", F.md5("text").alias("text_md5"))


def _boxes(spark, sf_dir):
    own = _table(spark, sf_dir, "events")
    return own.select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("cx"), F.col("value").alias("cy"), F.col("event_type").alias("text"))


_SQL_BANDS = f"""
WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS cx, value AS cy, event_type AS text FROM events),
s AS (SELECT *, CASE WHEN cx - lag(cx) OVER w > {BAND_GAP} THEN 1 ELSE 0 END AS start FROM e WINDOW w AS (PARTITION BY user_id ORDER BY cx, event_id)),
b AS (SELECT *, CAST(sum(start) OVER (PARTITION BY user_id ORDER BY cx, event_id) AS INT) AS band FROM s)
"""


@query(_SQL_BANDS + "SELECT user_id, band, count(*) AS n, CAST(min(cx) AS BIGINT) AS first_x, CAST(max(cx) AS BIGINT) AS last_x, CAST(sum(cx) // count(*) AS BIGINT) AS mean_x FROM b GROUP BY ALL")
def q07_bands(spark, sf_dir):
    rows = layout.bands(_boxes(spark, sf_dir), ["user_id"], order="event_id", gap=BAND_GAP)
    mean = F.floor(F.sum(F.col("cx").cast("decimal(38,0)")) / F.count("*")).cast("long")
    return rows.groupBy("user_id", "band").agg(F.count("*").alias("n"), F.min("cx").alias("first_x"), F.max("cx").alias("last_x"), mean.alias("mean_x"))


@query(_SQL_BANDS + "SELECT user_id, string_agg(text, chr(10) ORDER BY band DESC, cy, cx, event_id) AS text FROM b GROUP BY ALL")
def q08_reading_order(spark, sf_dir):
    return layout.page_text(layout.bands(_boxes(spark, sf_dir), ["user_id"], order="event_id", gap=BAND_GAP), ["user_id"], order="event_id")


def _sql_swaps() -> str:
    text = "text"
    for a, b in SWAPS:
        text = f"replace({text}, '{a}', '{b}')"
    return text


@query(f"SELECT doc_id, md5({_sql_swaps()}) AS text_md5, CAST(length({_sql_swaps()}) AS INT) AS n_chars FROM documents")
def q09_corrections(spark, sf_dir):
    text = T.correct(F.col("text"), SWAPS)
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(text).alias("text_md5"), F.length(text).alias("n_chars"))


@query(
    """
SELECT source, file_name, page_rank FROM (
  SELECT source, file_name, CAST(row_number() OVER (PARTITION BY source ORDER BY file_name) AS INT) AS page_rank
  FROM (SELECT source, 'page_' || doc_id || '.png' AS file_name FROM documents)) WHERE page_rank <= 3"""
)
def q10_first_n_per_work(spark, sf_dir):
    pages = _table(spark, sf_dir, "documents").select("source", F.concat(F.lit("page_"), F.col("doc_id"), F.lit(".png")).alias("file_name"))
    return works.first_pages(pages, 3, "source")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY ALL")
def q11_page_concat(spark, sf_dir):
    return works.joined(_table(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query("SELECT doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)")
def q12_pairing_inner(spark, sf_dir):
    return works.paired(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q13_pairing_anti(spark, sf_dir):
    return works.unpaired(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query(
    f"""
WITH {_SQL_SENTENCES}
SELECT conv_id, CAST(pos + 1 AS INT) AS pair_no, printf('pair_%04d', pos + 1) AS pair_id, coalesce(a.sentence, '') AS source_sentence, coalesce(b.sentence, '') AS target_sentence
FROM (SELECT * FROM sentences WHERE side = 'source') a FULL JOIN (SELECT * FROM sentences WHERE side = 'target') b USING (conv_id, pos)"""
)
def q14_positional_align(spark, sf_dir):
    return align.positional(*_sides(_sentences(spark, sf_dir)), "conv_id")


@query(f"WITH {_SQL_WEIGHTS} SELECT conv_id, side, pos, term, round(w, 6) AS w FROM weights")
def q15_tfidf_weights(spark, sf_dir):
    return tfidf.weights(_sentences(spark, sf_dir), "conv_id").withColumn("w", F.round("w", 6))


@query(f"WITH {_SQL_COSINES} SELECT conv_id, i, j, round(sim, 6) AS sim FROM cosines")
def q16_cosine_pairs(spark, sf_dir):
    return tfidf.cosines(tfidf.weights(_sentences(spark, sf_dir), "conv_id"), "conv_id").withColumn("sim", F.round("sim", 6))


#: Queries that are compared with all rows at a time, and neighbours that are reported of each.
QUERY_BLOCK, TOP = 2_048, 10
#: Rows whose similarities to a block of queries a worker holds at a time.
SLICE = 512


@query(
    """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(q.e, v.e), 6) AS sim FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS INT) AS rank FROM s)
SELECT * FROM r WHERE rank <= 10"""
)
def q17_embedding_cosine(spark, sf_dir):
    """The ten most similar vectors of each query vector (ids divisible by 50), against all, in blocks."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    blocks = max(1, -(-rows.filter("vec_id % 50 = 0").count() // QUERY_BLOCK))
    small_batches(spark)
    found = None
    for k in range(blocks):
        queries = rows.filter((F.col("vec_id") % 50 == 0) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k)).toArrow()
        ids = queries["vec_id"].to_numpy()
        if not len(ids):
            continue
        part = rows.mapInArrow(functools.partial(nearest, ids=ids, matrix=_vectors(queries["embedding"].combine_chunks())), "query_id long, vec_id long, sim double")
        if blocks > 1:  # the driver holds one block's vectors at a time
            part = sinks.stage(part, sinks.scratch(spark, "nearest"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, sim double")
    w = Window.partitionBy("query_id").orderBy(F.desc("sim"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TOP)


def nearest(batches: Iterable[pa.RecordBatch], ids: np.ndarray, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The TOP neighbours (query_id, vec_id, sim) of each query among all ``batches``; holds the similarities of SLICE rows at a time."""
    top_sim, top_id = np.full((len(ids), TOP), -np.inf), np.zeros((len(ids), TOP), np.int64)
    for b in batches:
        own, v = b.column(0).to_numpy(), _vectors(b.column(1))
        for at in range(0, len(own), SLICE):
            near = own[at : at + SLICE]
            sims = np.round(matrix @ v[at : at + SLICE].T, 6)
            sims[np.isnan(sims)] = np.inf  # as SQL sorts them
            sims[ids[:, None] == near] = -np.inf
            for q in np.flatnonzero(sims.max(axis=1) >= top_sim[:, -1]):
                k = np.flatnonzero((sims[q] >= top_sim[q, -1]) & (sims[q] > -np.inf))
                s, n = np.concatenate([top_sim[q], sims[q][k]]), np.concatenate([top_id[q], near[k]])
                order = np.lexsort((n, -s))[:TOP]
                top_sim[q], top_id[q] = s[order], n[order]
    q, k = np.nonzero(top_sim > -np.inf)
    sim = top_sim[q, k]
    sim[np.isinf(sim)] = np.nan
    yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(top_id[q, k]), pa.array(sim)], ["query_id", "vec_id", "sim"])


def _vectors(e: pa.ListArray) -> np.ndarray:
    """The vectors of a column, a row each, scaled to length 1."""
    if not len(e):
        return np.empty((0, 1))
    return _unit(e.values.to_numpy().astype(float)[e.offsets[0].as_py() : e.offsets[-1].as_py()].reshape(len(e), -1))


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


@query(
    f"""
WITH RECURSIVE {_SQL_COSINES},
sizes AS (SELECT conv_id, CAST(count(*) FILTER (WHERE side = 'source') AS INT) AS m, CAST(count(*) FILTER (WHERE side = 'target') AS INT) AS n FROM sentences GROUP BY ALL),
grid AS (SELECT conv_id, m, n, list(coalesce(round(sim, 6), 0.0) ORDER BY i, j) AS sims
         FROM (SELECT conv_id, m, n, i, unnest(range(n)) AS j FROM (SELECT conv_id, m, n, unnest(range(m)) AS i FROM sizes)) g LEFT JOIN cosines c USING (conv_id, i, j)
         GROUP BY ALL),
cells AS (
  SELECT conv_id, m, n, 1 AS i, 0 AS j, list_transform(range(n + 1), lambda x: x * 0.5::DOUBLE) AS prev, [0.5::DOUBLE] AS cur, 0 AS move FROM grid
  UNION ALL
  SELECT conv_id, m, n, i, j, prev, list_append(cur, least(pair, up, lft)) AS cur, CASE WHEN least(pair, up, lft) = pair THEN 1 WHEN least(pair, up, lft) = up THEN 2 ELSE 3 END AS move
  FROM (
    SELECT conv_id, m, n, i, j, prev, cur, prev[j] + (1.0::DOUBLE - sims[(i - 1) * n + j]) AS pair, prev[j + 1] + 0.5::DOUBLE AS up, cur[j] + 0.5::DOUBLE AS lft
    FROM (SELECT c.conv_id, c.m, c.n, CASE WHEN c.j < c.n THEN c.i ELSE c.i + 1 END AS i, CASE WHEN c.j < c.n THEN c.j + 1 ELSE 1 END AS j,
                 CASE WHEN c.j < c.n THEN c.prev ELSE c.cur END AS prev, CASE WHEN c.j < c.n THEN c.cur ELSE [(c.i + 1) * 0.5::DOUBLE] END AS cur, g.sims
          FROM cells c JOIN grid g USING (conv_id) WHERE c.i < c.m OR c.j < c.n))),
moves AS (SELECT conv_id, i, j, move FROM cells WHERE j > 0),
path AS (
  SELECT conv_id, m AS i, n AS j, 0 AS step, CAST(NULL AS INT) AS si, CAST(NULL AS INT) AS ti FROM sizes
  UNION ALL
  SELECT conv_id, CASE WHEN d < 3 THEN i - 1 ELSE i END, CASE WHEN d <> 2 THEN j - 1 ELSE j END, step + 1, CASE WHEN d < 3 THEN i - 1 END, CASE WHEN d <> 2 THEN j - 1 END
  FROM (SELECT p.conv_id, p.i, p.j, p.step, CASE WHEN p.i > 0 AND p.j > 0 THEN v.move WHEN p.i > 0 THEN 2 ELSE 3 END AS d
        FROM path p LEFT JOIN moves v ON v.conv_id = p.conv_id AND v.i = p.i AND v.j = p.j WHERE p.i > 0 OR p.j > 0)),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY step DESC) AS INT) AS pair_no FROM path WHERE step > 0)
SELECT p.conv_id, pair_no, printf('pair_%04d', pair_no) AS pair_id, coalesce(a.sentence, '') AS source_sentence, coalesce(b.sentence, '') AS target_sentence
FROM numbered p LEFT JOIN sentences a ON a.conv_id = p.conv_id AND a.side = 'source' AND a.pos = p.si LEFT JOIN sentences b ON b.conv_id = p.conv_id AND b.side = 'target' AND b.pos = p.ti"""
)
def q18_dp_align(spark, sf_dir):
    s = _sentences(spark, sf_dir)
    source, target = _sides(s)
    return align.dynamic(source, target, tfidf.cosines(tfidf.weights(s, "conv_id"), "conv_id"), "conv_id", digits=6).drop("error")


@query(
    """
WITH p AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) || chr(10) AS piece FROM conversations GROUP BY ALL)
SELECT conv_id, piece, CAST(coalesce(sum(length(piece)) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM p"""
)
def q19_global_concat(spark, sf_dir):
    return works.global_pieces(works.joined(_table(spark, sf_dir, "conversations"), ["conv_id"], "turn"), "conv_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def q20_json_navigate(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("SELECT event_id, user_id, value FROM events WHERE value >= 0.4")
def q21_confidence_filter(spark, sf_dir):
    return _table(spark, sf_dir, "events").filter(F.col("value") >= layout.CONFIDENCE).select("event_id", "user_id", "value")


@query(f"WITH {_SQL_WEIGHTS} SELECT conv_id, term, df FROM df")
def q22_union_corpus(spark, sf_dir):
    return tfidf.document_frequencies(tfidf.frequencies(_sentences(spark, sf_dir), "conv_id"), "conv_id")


@query(
    f"""
WITH {_SQL_SENTENCES},
a AS (SELECT conv_id, CAST(count(*) AS INT) AS m FROM sentences WHERE side = 'source' GROUP BY ALL),
t AS (SELECT conv_id, list(sentence ORDER BY pos) AS l FROM sentences WHERE side = 'target' GROUP BY ALL),
x AS (SELECT conv_id, m, l, CAST(unnest(range(m)) AS INT) AS pos FROM a JOIN t USING (conv_id))
SELECT conv_id, pos, coalesce(l[pos + 1], '') AS sentence FROM x"""
)
def q23_pad_truncate(spark, sf_dir):
    source, target = _sides(_sentences(spark, sf_dir))
    lists = target.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sentence"))), lambda s: s["sentence"]).alias("l"))
    both = source.groupBy("conv_id").agg(F.count("*").cast("int").alias("m")).join(lists, "conv_id")
    return works.sentences(both, ["conv_id"], T.pad_or_cut(F.col("l"), F.col("m")))


@query("SELECT event_id, (value + (value + 4) + (value + 4) + value) / 4 AS cx, (user_id + user_id + (user_id + 2.0::DOUBLE) + (user_id + 2.0::DOUBLE)) / 4 AS cy FROM events")
def q24_centroid(spark, sf_dir):
    x, y = F.col("value"), F.col("user_id").cast("double")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    poly = F.array(corner(x, y), corner(x + 4, y), corner(x + 4, y + 2), corner(x, y + 2))
    rows = _table(spark, sf_dir, "events").select("event_id", poly.alias("poly"))
    return rows.select("event_id", layout.centroid(F.col("poly"), "x").alias("cx"), layout.centroid(F.col("poly"), "y").alias("cy"))


def _detector():
    """Stands in for a model: a box for every line of the page's text."""

    def model(content: bytes):
        found = []
        for k, line in enumerate(content.decode().split("\n")):
            x, y = k * 137 % 1000, k * 61 % 500
            found.append(([(x, y), (x + 10, y), (x + 10, y + 10), (x, y + 10)], line, len(line) % 10 / 10))
        return found

    return model


def _teller():
    """Stands in for a recogniser that fails on some pages and reports a failure on others."""

    def model(content: bytes) -> str:
        if len(content) % 3 == 0:
            raise ValueError("unreadable")
        return f"{T.FAILURE}no text)" if len(content) % 3 == 1 else f"A:{content.decode()}"

    return model


def _reader():
    return bytes.decode


def _page_contents(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.lit("w").alias("work_id"), F.col("doc_id").alias("page"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))


def _recognised(spark, sf_dir, providers_):
    pages = _page_contents(spark, sf_dir)
    texts = vote.vote_all(providers.recognise(pages, providers_, "page"), pages, ["work_id", "page"])
    return texts.select(F.col("page").alias("doc_id"), F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


@query(
    r"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS k, unnest(l) AS line FROM l),
b AS (SELECT doc_id, k, line, k * 137 % 1000 + 5 AS cx, k * 61 % 500 + 5 AS cy FROM k
      WHERE CAST(length(line) % 10 AS DOUBLE) / 10 >= 0.4::DOUBLE AND NOT regexp_matches(line, '\A(?:[A-Za-z0-9]|[^\p{L}\p{N}_])+\z')),
s AS (SELECT *, CASE WHEN cx - lag(cx) OVER w > 90 THEN 1 ELSE 0 END AS start FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY cx, k)),
n AS (SELECT *, sum(start) OVER (PARTITION BY doc_id ORDER BY cx, k) AS band FROM s),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY band DESC, cy, cx, k) AS text FROM n GROUP BY ALL)
SELECT doc_id, md5(coalesce(t.text, '')) AS text_md5, CAST(length(coalesce(t.text, '')) AS INT) AS n_chars FROM documents LEFT JOIN t USING (doc_id)"""
)
def q25_box_recogniser(spark, sf_dir):
    """Detection, confidence, noise, centroids, bands and reading order, as one recogniser among the voters."""
    return _recognised(spark, sf_dir, [("boxes", _detector, "boxes")])


@query(
    """
WITH t AS (SELECT doc_id, CASE WHEN octet_length(encode(coalesce(text, ''))) % 3 = 2 THEN 'A:' || text ELSE coalesce(text, '') END AS text FROM documents)
SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INT) AS n_chars FROM t"""
)
def q26_ensemble_of_recognisers(spark, sf_dir):
    """Of two recognisers the first wins ties; where it fails, or reports a failure, the second does."""
    return _recognised(spark, sf_dir, [("first", _teller), ("second", _reader)])


def _vision():
    def call(content: bytes) -> str:
        if len(content) % 5 == 0:
            return json.dumps({"error": {"message": "quota"}})
        return json.dumps({"responses": [{"fullTextAnnotation": {"text": content.decode()}}]})

    return call


def _vertical():
    def call(content: bytes) -> str:
        if len(content) % 7 == 0:
            return json.dumps({"code": 5, "msg": "busy"})
        return json.dumps({"code": 0, "msg": "success", "data": [{"text": content.decode()}, "end", 7, {"other": 1}]})

    return call


@query(
    f"""
WITH t AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, coalesce(text, '') AS text FROM documents),
v AS (SELECT doc_id, CASE WHEN n % 5 = 0 THEN NULL ELSE {_SQL_STRIP % 'text'} END AS a, CASE WHEN n % 7 = 0 THEN NULL ELSE text || chr(10) || 'end' END AS b FROM t),
w AS (SELECT doc_id, coalesce(a, b, 'Tự Hán (Vision - API Error: quota)') AS text FROM v)
SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INT) AS n_chars FROM w"""
)
def q27_web_recognisers(spark, sf_dir):
    """The answers of two services are taken apart before the vote."""
    return _recognised(spark, sf_dir, [("vision", _vision, "vision"), ("vertical", _vertical, "vertical")])


@query(
    f"""
WITH {_SQL_SENTENCES}
SELECT conv_id, printf('pair_%04d', pos + 1) AS pair_id, coalesce(a.sentence, '') AS han_sentence, coalesce(b.sentence, '') AS viet_sentence
FROM (SELECT * FROM sentences WHERE side = 'source') a FULL JOIN (SELECT * FROM sentences WHERE side = 'target') b USING (conv_id, pos)"""
)
def q28_tsv_round_trip(spark, sf_dir):
    """Pairs written as tab-separated files with a header, a folder per work, and read again."""
    path = sinks.scratch(spark, "pairs_tsv")
    sinks.pairs_tsv(align.positional(*_sides(_sentences(spark, sf_dir)), "conv_id"), path, ["conv_id"])
    kept = spark.read.schema("pair_id string, han_sentence string, viet_sentence string, conv_id long")
    with readers.listing(spark):
        rows = kept.options(sep="\t", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return rows.select("conv_id", "pair_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("han_sentence", "viet_sentence")))


_SQL_WORKS = """
w AS (SELECT source AS work_id, string_agg(text, chr(10) ORDER BY doc_id) AS text FROM documents GROUP BY ALL)"""


def _works(spark, sf_dir):
    return works.joined(_table(spark, sf_dir, "documents"), ["source"], "doc_id").withColumnRenamed("source", "work_id")


@query(f"WITH {_SQL_WORKS}, l AS (SELECT work_id, {_sql_segments('text', _HAN)} AS l FROM w) SELECT work_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM l")
def q29_text_files(spark, sf_dir):
    """Raw texts are written as files, read and segmented; sentences are written as files of lines, and read back."""
    raw, lines = sinks.scratch(spark, "raw"), sinks.scratch(spark, "sentences")
    sinks.raw_files(_works(spark, sf_dir), raw)
    found = works.sentences(readers.raw_folders(spark, raw).withColumn("work_id", F.col("work_id").cast("string")), ["work_id"], T.segment(F.col("text")))
    sinks.sentence_files(found, lines)
    stored = readers.raw_folders(spark, lines).withColumn("work_id", F.col("work_id").cast("string"))
    parts = F.filter(F.transform(F.split("text", "\n"), T.strip), lambda x: F.length(x) > 0)
    return works.sentences(stored, ["work_id"], parts)


_ENDINGS = (".PNG", ".jpg", ".txt", ".jpeg", ".pdf", ".Pdf")


@query(
    f"""
WITH f AS (SELECT source AS work_id, 'Page_' || doc_id || {list(_ENDINGS)}[doc_id % 6 + 1] AS file_name FROM documents)
SELECT work_id, file_name, CAST(row_number() OVER (PARTITION BY work_id ORDER BY file_name) - 1 AS INT) AS page_no FROM f WHERE regexp_matches(file_name, '(?i)[.](png|jpe?g)$')"""
)
def q30_page_files(spark, sf_dir):
    """Images are told by their ending in any case, and numbered by name within a work."""
    ending = F.element_at(F.array(*map(F.lit, _ENDINGS)), (F.col("doc_id") % 6 + 1).cast("int"))
    path = F.concat(F.lit("/in/"), "source", F.lit("/Page_"), "doc_id", ending)
    files = _table(spark, sf_dir, "documents").select(F.col("source").alias("work_id"), T.file_name(path).alias("file_name"))
    return readers.numbered(files)


@query(
    f"""
SELECT source || '_' || doc_id AS work_id, CAST(0 AS INT) AS page_no, 'Mock content extracted from ' || source || '_' || doc_id || '.pdf' AS text
FROM documents WHERE ends_with({list(_ENDINGS)}[doc_id % 6 + 1], '.pdf')"""
)
def q31_translation_files(spark, sf_dir):
    """Translations are told by a lower-case ending; without a PDF library their page says where it is from."""
    ending = F.element_at(F.array(*map(F.lit, _ENDINGS)), (F.col("doc_id") % 6 + 1).cast("int"))
    files = _table(spark, sf_dir, "documents").select(F.concat("source", F.lit("_"), "doc_id", ending).alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    files = files.filter(F.endswith("path", F.lit(".pdf"))).withColumn("work_id", F.regexp_replace("path", readers.PDF, ""))
    return readers.pdf_pages(files)


@query(
    """
WITH t AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY ALL)
SELECT 'global' AS work_id, string_agg(text, chr(10) ORDER BY conv_id) || chr(10) AS text FROM t"""
)
def q32_global_target(spark, sf_dir):
    """The target side of all works as one text, which global mode segments and aligns."""
    target = _raw(spark, sf_dir).filter("side = 'target'")
    return global_text(target.select(F.col("conv_id").alias("work_id"), "text"))


def _corrector():
    def model(t: str) -> str:
        if len(t) % 2:
            raise ValueError("no answer")
        return f"  {t.replace('a', 'b')} "

    return model


@query(
    f"""
SELECT doc_id, md5(CASE WHEN length({_SQL_STRIP % 'text'}) > 0 AND length(text) % 2 = 0 THEN {_SQL_STRIP % 'r'} ELSE text END) AS text_md5
FROM (SELECT *, replace(text, 'a', 'b') AS r FROM documents)"""
)
def q33_corrector(spark, sf_dir):
    """A corrector's text where it has one, else the text as it is."""
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(providers.corrected(F.col("text"), _corrector)).alias("text_md5"))


def _translator():
    return lambda sentences: [f" {x}! " for x in sentences][:-1]


@query(
    f"""
WITH {_SQL_SENTENCES}
SELECT conv_id, pos, sentence, CASE WHEN pos = max(pos) OVER (PARTITION BY conv_id) THEN '' ELSE sentence || '!' END AS sentence_tr FROM sentences WHERE side = 'source'"""
)
def q34_translator(spark, sf_dir):
    """One call per work; what the translator leaves out at the end is padded with empty texts."""
    source, _ = _sides(_sentences(spark, sf_dir))
    return providers.translated(source, "conv_id", _translator)


def _sentence_model():
    def model(t: str) -> list[str]:
        if len(t) % 3 == 0:
            raise ValueError("too hard")
        return t.split(", ")

    return model


@query(
    f"""
WITH l AS (SELECT doc_id, CASE WHEN length(coalesce(text, '')) % 3 = 0 THEN {_SQL_PLAIN.replace('text', "coalesce(text, '')")}
           ELSE list_filter(list_transform(string_split(replace(text, chr(10), ' '), ', '), lambda x: {_SQL_STRIP % 'x'}), lambda x: length(x) > 0) END AS l FROM documents)
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM l"""
)
def q35_model_segmenter(spark, sf_dir):
    """Sentences of a model, and where it fails those between full stops."""
    return works.sentences(_table(spark, sf_dir, "documents"), ["doc_id"], providers.segmented(_sentence_model)(F.col("text")))


@query(
    f"""
WITH {_SQL_SENTENCES},
c AS (SELECT conv_id, count(*) FILTER (WHERE side = 'source') AS n_source, count(*) FILTER (WHERE side = 'target') AS n_target FROM sentences GROUP BY ALL)
SELECT *, greatest(n_source, n_target) AS n_pairs FROM c"""
)
def q36_step_counts(spark, sf_dir):
    """What a run's log tells of each work."""
    source, target = _sides(_sentences(spark, sf_dir))
    return step_counts(source, target, align.positional(source, target, "conv_id"), "conv_id")


@query(
    f"""
WITH {_SQL_SENTENCES}
SELECT conv_id, CAST(pos + 1 AS BIGINT) AS row_no, printf('pair_%04d', pos + 1) AS pair_id, coalesce(a.sentence, '') AS han_sentence, coalesce(b.sentence, '') AS viet_sentence
FROM (SELECT * FROM sentences WHERE side = 'source') a FULL JOIN (SELECT * FROM sentences WHERE side = 'target') b USING (conv_id, pos)"""
)
def q37_spreadsheets(spark, sf_dir):
    """Each work's pairs as a spreadsheet file, and what such a file holds when it is read again."""
    books = sinks.workbooks(align.positional(*_sides(_sentences(spark, sf_dir)), "conv_id"), "conv_id")

    def rows(batches):
        for b in batches:
            found = []
            for conv_id, content in zip(b["conv_id"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    sheet = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))
                for n, row in enumerate(x for x in sheet.iter() if x.tag.endswith("}row")):
                    if n:
                        found.append((conv_id, n, *(("".join(c.itertext())) for c in row)))
            yield pd.DataFrame(found, columns=["conv_id", "row_no", *sinks.HEADER])

    return books.mapInPandas(rows, "conv_id long, row_no long, pair_id string, han_sentence string, viet_sentence string")
