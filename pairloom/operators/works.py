"""Works, their pages and sides: pairing, first pages, joined texts, sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import sinks


def paired(works: DataFrame, translations: DataFrame, key: str = "work_id") -> DataFrame:
    """Works that have a translation of exactly their name."""
    return works.join(translations, key)


def unpaired(works: DataFrame, translations: DataFrame, key: str = "work_id") -> DataFrame:
    """Works to warn of: without a translation."""
    return works.join(translations, key, "left_anti")


def first_pages(pages: DataFrame, n: int | None, key: str = "work_id", order: str = "file_name") -> DataFrame:
    """The first ``n`` pages of each work by name (code points); placed before recognition, which is dear."""
    if n is None:
        return pages
    if n < 0:
        raise ValueError("the number of pages must not be negative")
    w = Window.partitionBy(key).orderBy(order)
    return pages.withColumn("page_rank", F.row_number().over(w)).filter(F.col("page_rank") <= n)


def joined(rows: DataFrame, by: list[str], order: str, text: str = "text", sep: str = "\n") -> DataFrame:
    """Texts of a group in order, with ``sep`` between them."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(parts, lambda s: s["t"]), sep).alias("text"))


def sentences(rows: DataFrame, keys: list[str], segmented: Column) -> DataFrame:
    """One row per sentence: keys, pos from 0, sentence."""
    return rows.select(*keys, F.posexplode(segmented).alias("pos", "sentence"))


def global_pieces(works: DataFrame, key: str = "work_id", text: str = "text") -> DataFrame:
    """The concatenation of all works, each followed by a line end, as pieces with their places.

    The whole would be one value that grows with the corpus; instead each piece says where it starts
    (``start``, in characters), so that any part of the whole can be put together. The running sum sees one
    number per work, not the texts, and no task sees all works.
    """
    piece = works.select(key, F.concat(F.coalesce(text, F.lit("")), F.lit("\n")).alias("piece"))
    starts = running(piece.select(key, F.length("piece").cast("long").alias("n")), key, "n")
    return piece.join(starts.select(key, F.col("before").alias("start")), key)


def running(rows: DataFrame, order: str, value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows that come earlier in ``order``.

    Ranges of the order are summed on their own and by their totals, of which there is one per range, so no task sees all rows.
    The ranges are stored, since a second run might draw them elsewhere.
    """
    ranges = sinks.stage(rows.repartitionByRange(order).withColumn("part", F.spark_partition_id()), sinks.scratch(rows.sparkSession, "ranges"))
    earlier = lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = ranges.groupBy("part").agg(F.sum(value).alias(value)).select("part", earlier(Window.orderBy("part")).alias("start"))
    inside = ranges.withColumn("inside", earlier(Window.partitionBy("part").orderBy(order)))
    return inside.join(F.broadcast(totals), "part").withColumn("before", (F.col("start") + F.col("inside")).cast("long")).drop("part", "start", "inside")
