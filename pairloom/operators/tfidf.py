"""TF-IDF weights of sentences within a work, and cosines between its two sides.

Weights are tf * (ln((1 + n) / (1 + df)) + 1), scaled to length 1; n and df count the sentences of both sides.
Similarities come from an equi-join on (work, term): only pairs that share a term are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def frequencies(sentences: DataFrame, key: str) -> DataFrame:
    """key, side, pos, term, tf of sentences (key, side, pos, sentence)."""
    words = sentences.select(key, "side", "pos", F.explode(T.tokens(F.col("sentence"))).alias("term"))
    return words.groupBy(key, "side", "pos", "term").agg(F.count("*").alias("tf"))


def document_frequencies(tf: DataFrame, key: str) -> DataFrame:
    return tf.groupBy(key, "term").agg(F.count("*").alias("df"))


def weights(sentences: DataFrame, key: str = "work_id") -> DataFrame:
    """key, side, pos, term, w: one row per term of a sentence, of both sides together."""
    tf = frequencies(sentences, key)
    n = sentences.groupBy(key).agg(F.count("*").alias("n"))
    df = document_frequencies(tf, key).join(n, key)
    raw = tf.join(df, [key, "term"]).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    # the terms of a sentence are summed in their order, so that runs agree to the last bit
    parts = F.array_sort(F.collect_list(F.struct("term", "w")))
    rows = raw.groupBy(key, "side", "pos").agg(parts.alias("terms"))
    norm = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda a, t: a + t["w"] * t["w"]))
    rows = rows.withColumn("norm", norm)
    return rows.select(key, "side", "pos", "norm", F.explode("terms").alias("t")).select(key, "side", "pos", F.col("t.term").alias("term"), (F.col("t.w") / F.col("norm")).alias("w"))


def cosines(weighed: DataFrame, key: str = "work_id", source: str = "source", target: str = "target") -> DataFrame:
    """key, i, j, sim of the pairs that share a term; all others have 0."""
    a = weighed.filter(F.col("side") == source).select(key, "term", F.col("pos").alias("i"), F.col("w").alias("wa"))
    b = weighed.filter(F.col("side") == target).select(key, "term", F.col("pos").alias("j"), F.col("w").alias("wb"))
    return a.join(b, [key, "term"]).groupBy(key, "i", "j").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))
