"""The choice among several recognisers' texts of a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def vote(results: DataFrame, page: list[str], order: str = "provider_no", text: str = "text", chars: str = T.CJK, failure: str = T.FAILURE, strict: bool = False) -> DataFrame:
    """The text with the most characters of a class; of equals, the first provider's.

    Failures count only where a page has nothing else (``strict``: never). One row per page: its columns,
    score, order, text. The best row is an aggregate, so no page is sorted.
    """
    rows = results.filter(F.col(text).isNotNull())
    failed = T.is_failure(F.col(text), failure)
    if strict:
        rows = rows.filter(~failed)
    best = F.max(F.struct((~failed).alias("ok"), T.count_class(F.col(text), chars).alias("score"), (-F.col(order)).alias("before"), F.col(text).alias("text")))
    found = rows.groupBy(*page).agg(best.alias("b"))
    return found.select(*page, F.col("b.score").alias("score"), (-F.col("b.before")).alias(order), F.col("b.text").alias(text))


def vote_all(results: DataFrame, pages: DataFrame, page: list[str], **options) -> DataFrame:
    """The same for all ``pages``; those without any result have ""."""
    found = vote(results, page, **options)
    return pages.select(*page).distinct().join(found, page, "left").withColumn("text", F.coalesce("text", F.lit("")))
