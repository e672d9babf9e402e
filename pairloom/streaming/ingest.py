"""Raw texts that arrive as files, segmented as they come.

Segmentation needs no state: each text is one row, so the stream has no shuffle and any batch can be run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators import works


def sentence_stream(spark: SparkSession, folder: str, schema: str = "work_id string, text string") -> DataFrame:
    """work_id, pos, sentence of the Parquet files of raw texts that arrive in ``folder``."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return works.sentences(rows, ["work_id"], T.segment(T.unix_lines(F.col("text"))))


def write_stream(sentences: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet table, each file once, and ends when all that is there has been read."""
    return sentences.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
