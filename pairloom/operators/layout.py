"""Reading order of detected text boxes: filters, centroids, bands, lines, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

CONFIDENCE, GAP = 0.4, 90


def centroid(poly: Column, axis: str) -> Column:
    """Mean of one coordinate over the corners of a polygon."""
    return F.aggregate(poly, F.lit(0.0), lambda a, p: a + p[axis]) / F.size(poly)


def readable(boxes: DataFrame, least: float = CONFIDENCE) -> DataFrame:
    """Boxes sure enough (exactly ``least`` is) whose text is not noise."""
    return boxes.filter((F.col("conf") >= least) & ~T.is_noise(F.col("text")))


def bands(boxes: DataFrame, page: list[str], x: str = "cx", order: str = "box_no", gap: float = GAP) -> DataFrame:
    """Adds ``band``: a new one where the step from the box before, by x, is over ``gap``."""
    w = Window.partitionBy(*page).orderBy(x, order)
    step = F.col(x) - F.lag(x).over(w)
    start = F.when(step > gap, 1).otherwise(0)
    return boxes.withColumn("_start", start).withColumn("band", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_start")


def page_text(banded: DataFrame, page: list[str], x: str = "cx", y: str = "cy", order: str = "box_no", text: str = "text") -> DataFrame:
    """One text per page: bands from the last to the first, in a band by y, then x and number."""
    place = F.struct((-F.col("band")).alias("b"), F.col(y).alias("y"), F.col(x).alias("x"), F.col(order).alias("o"), F.col(text).alias("t"))
    lines = F.transform(F.array_sort(F.collect_list(place)), lambda s: s["t"])
    return banded.groupBy(*page).agg(F.array_join(lines, "\n").alias("text"))


def read_pages(boxes: DataFrame, page: list[str], gap: float = GAP, least: float = CONFIDENCE) -> DataFrame:
    """From boxes (poly, text, conf, box_no) to corrected page texts. A page without readable boxes has ""."""
    placed = readable(boxes, least).select(*page, "box_no", T.correct(F.col("text")).alias("text"), centroid(F.col("poly"), "x").alias("cx"), centroid(F.col("poly"), "y").alias("cy"))
    texts = page_text(bands(placed, page, gap=gap), page)
    return boxes.select(*page).distinct().join(texts, page, "left").withColumn("text", F.coalesce("text", F.lit("")))
