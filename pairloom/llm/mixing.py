"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash of its id. For each source, tokens are summed by hash bucket; the bucket
in which the running sum passes the source's budget is refined into 1,024 smaller ones, until it holds one
hash. What lies below that threshold is taken, by a filter: no documents are sorted. Thresholds of smaller
budgets nest in those of larger ones. A budget over the source's size takes all documents so many whole
times, and the rest of it by the threshold. What the whole documents below the threshold miss is made
up by the one further document that fits best, if any brings the sum nearer; this one lies outside of the thresholds and
does not nest.

Nulls and edges: a null source is a source of its own, ordered last; a null text has no words; a null id
hashes as an empty string; rows with one id are taken or left together; a source without words has target
0; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_small, text_of, written

#: Bits of the hash that one level of the histogram resolves; six levels make 60 bits.
BITS, LEVELS = 10, 6
MOST = 3


def ranked(df: DataFrame, by: str) -> DataFrame:
    """Adds ``rank`` (from 0, nulls last): parts by range are sorted on their own, and their counts added up; no task sees all rows."""
    parts = written(df.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy(F.col(by).asc_nulls_last())
    return parts.withColumn("nth", F.row_number().over(within) - 1).join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("nth")).drop("part", "start", "nth")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = MOST) -> DataFrame:
    """Of (source, source_size): adds target double; one row per source.

    Weights repeat over the sources by code point, null last; all targets together are all sizes; none is
    over ``most`` times its source's size, and the excess is shared by weight among the others until none is: the level
    of a share rises, by sums over the sources that are below their cap, until it stays.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights))).cast("int") + 1)
    x = ranked(sources, "source").withColumn("w", weight.cast("long")).withColumn("cap", (F.col("source_size") * most).cast("long"))
    x = written(x.select("source", "source_size", "w", "cap"), "weighed")
    total, level = x.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0
    while True:
        over = F.col("cap") < F.lit(level) * F.col("w")
        capped, free = x.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)), F.sum(F.when(~over, F.col("w")).otherwise(0))).first()
        if not free:  # no source, or all at their caps
            level = float("inf")
            break
        higher = (total - capped) / free
        if higher <= level:
            break
        level = higher
    return x.select("source", "source_size", F.least(F.lit(level) * F.col("w"), F.col("cap").cast("double")).alias("target"))


def id_hash(id_col: str = "doc_id") -> Column:
    """60 bits of the MD5 of the id as text: the same in any engine, so reruns agree."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_key(source_col: str = "source") -> Column:
    """A key without nulls."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, k (its key), size (words), h (hash of the id) of each document, as a written table."""
    size = F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")
    return written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), source_key(source_col).alias("k"), size.alias("size"), id_hash(id_col).alias("h")), "sizes")


def decisions(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = MOST, limit: int | None = None) -> DataFrame:
    """What decides on the documents of each source: k, source_size, target, full, threshold, closing; ``rows`` as of ``sizes``."""
    key = source_key().alias("k")
    per = targets(rows.groupBy("k", "source").agg(F.sum("size").alias("source_size")).drop("k"), weights, most)
    per = per.select(key, "source_size", "target", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("full"))
    per = written(per.withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")), "targets")
    # (k, prefix, below): what is sought lies among hashes with this prefix; words below them
    edge = written(per.filter("budget > 0").select("k", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below")), "edge0")
    some = rows
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = join_small(some, edge, ["k"], "inner", ["h"], limit).filter(F.shiftrightunsigned("h", shift + BITS) == F.col("prefix"))
        if level == 2:  # from here on only the rows of boundary buckets are read
            some = written(inside.select(*rows.columns), "boundary")
            inside = join_small(some, edge, ["k"], "inner", ["h"], limit)
        sums = inside.groupBy("k", "budget", "below", F.shiftrightunsigned("h", shift).alias("bucket")).agg(F.sum("size").alias("sum"), F.min("h").alias("low"), F.max("h").alias("high"))
        running = F.sum("sum").over(Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        found = sums.withColumn("upto", F.col("below") + running).filter("upto > budget")
        found = found.groupBy("k", "budget").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("sum")).alias("below"), "low", "high", "sum")).alias("m"))
        edge = written(found.select("k", "budget", F.col("m.bucket").alias("prefix"), F.col("m.below").alias("below"), "m.low", "m.high", "m.sum"), f"edge{level}")
        if not len(edge.filter("low < high").head(1)):
            break
        edge = edge.select("k", "budget", "prefix", "below")
    # all hashes of a source below `low` fit the budget; without an edge all its documents do
    last = per.join(edge.select("k", F.col("low").alias("threshold"), "below"), "k", "left")
    last = written(last.withColumn("gap", F.col("budget") - F.col("below")), "thresholds")
    seen = join_small(rows, last.select("k", "threshold", "gap"), ["k"], "inner", ["h"], limit).filter("h >= threshold")
    # rows with one id are one unit; the unit whose words come nearest to the gap, if nearer than none
    units = seen.groupBy("k", "gap", "h").agg(F.sum("size").alias("size"))
    best = units.groupBy("k", "gap").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "h")).alias("b")).filter("b.off < gap")
    return written(last.join(best.select("k", F.col("b.h").alias("closing")), "k", "left").drop("below", "gap", "budget"), "decided")


def times(h: Column, full: Column, threshold: Column, closing: Column) -> Column:
    """How often a document with the hash ``h`` is taken; the other columns are its source's of ``decisions``."""
    once = F.coalesce((h < threshold) | F.coalesce(h == closing, F.lit(False)), F.lit(False))
    return (full + once.cast("int")).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", limit: int | None = None) -> DataFrame:
    """id_col, source, size, source_size, target, taken (words, repeats counted), times (repeats of the document)."""
    rows = sizes(docs, id_col, text_col, source_col)
    out = join_small(rows, decisions(rows, weights, most, limit), ["k"], "left", ["h"], limit).withColumn("times", times(*map(F.col, ("h", "full", "threshold", "closing"))))
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = MOST, limit: int | None = None) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it: the mixed corpus itself.

    Documents meet only the decision of their source, so with up to BROADCAST_ROWS sources no text is shuffled.
    """
    found = decisions(sizes(docs), weights, most, limit)
    inner = {c: f"_pairloom_{c}" for c in ("k", "full", "threshold", "closing")}
    keyed = docs.withColumns({"_pairloom_k": source_key(), "_pairloom_h": id_hash()})
    joined = join_small(keyed, found.select(*(F.col(c).alias(x) for c, x in inner.items())), ["_pairloom_k"], "inner", ["_pairloom_h"], limit)
    n = times(F.col("_pairloom_h"), *(F.col(inner[c]) for c in ("full", "threshold", "closing")))
    kept = joined.withColumn("_pairloom_n", n).filter("_pairloom_n > 0")
    return kept.select(*(kept[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("_pairloom_n").cast("int"))).alias("_pairloom_n")).drop("_pairloom_n")
