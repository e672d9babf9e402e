"""Sources: works, page images, translations, raw texts and sentences, through Spark's own readers."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

IMAGE = r"(?i)\.(png|jpe?g)\z"
PDF = r"(?i)\.pdf\z"
#: Tasks that list the folders of works, and Spark's setting for that: by itself it has a task for each folder, up to 10,000.
LISTS = 32
LISTS_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextlib.contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Within, tables of a folder per work are listed by at most LISTS tasks; afterwards the session is as it was."""
    before = spark.conf.get(LISTS_SETTING)
    spark.conf.set(LISTS_SETTING, str(min(LISTS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(LISTS_SETTING, before)


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").load(pattern)


def page_images(spark: SparkSession, folder: str, content: bool = True) -> DataFrame:
    """work_id, file_name, path, page_no (from 0, by name), content: images directly in each work's folder."""
    own = _files(spark, f"{folder.rstrip('/')}/*/*").filter(F.col("path").rlike(IMAGE))
    rows = own.select(F.element_at(F.split("path", "/"), -2).alias("work_id"), T.file_name(F.col("path")).alias("file_name"), "path", *(["content"] if content else []))
    numbers = rows.select("work_id", "file_name").groupBy("work_id").agg(F.array_sort(F.collect_list("file_name")).alias("f"))
    numbers = numbers.select("work_id", F.posexplode("f").alias("page_no", "file_name"))
    return rows.join(numbers, ["work_id", "file_name"])


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """work_id, file_name, path, content: as ``page_images``, without numbers, so that no content is shuffled."""
    own = _files(spark, f"{folder.rstrip('/')}/*/*").filter(F.col("path").rlike(IMAGE))
    return own.select(F.element_at(F.split("path", "/"), -2).alias("work_id"), T.file_name(F.col("path")).alias("file_name"), "path", "content")


def numbered(files: DataFrame, key: str = "work_id", name: str = "file_name") -> DataFrame:
    """key, name, page_no (from 0, by name) of the image files among ``files``; only names are shuffled."""
    own = files.filter(F.col(name).rlike(IMAGE)).select(key, name)
    return own.withColumn("page_no", F.row_number().over(Window.partitionBy(key).orderBy(name)) - 1)


def works(spark: SparkSession, folder: str) -> DataFrame:
    """work_id of every folder that holds a file, by its name."""
    return _files(spark, f"{folder.rstrip('/')}/*/*").select(F.element_at(F.split("path", "/"), -2).alias("work_id")).distinct()


def translations(spark: SparkSession, folder: str, exact: bool = False) -> DataFrame:
    """work_id, path, content of the PDF files of a folder; ``exact``: only those that end in lower-case .pdf."""
    own = _files(spark, f"{folder.rstrip('/')}/*").filter(F.endswith("path", F.lit(".pdf")) if exact else F.col("path").rlike(PDF))
    return own.select(F.regexp_replace(T.file_name(F.col("path")), PDF, "").alias("work_id"), "path", "content")


def pdf_pages(files: DataFrame) -> DataFrame:
    """work_id, page_no, text of each page that has any; without a PDF library one row that says so."""
    kind = files.schema["work_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            from PyPDF2 import PdfReader
        except ImportError:
            PdfReader = None  # noqa: N806
        import io

        for b in batches:
            for work_id, path, content in zip(b["work_id"], b["path"], b["content"], strict=True):
                if PdfReader is None:
                    texts = [f"Mock content extracted from {path.rpartition('/')[2]}"]
                else:
                    try:
                        texts = [p.extract_text() for p in PdfReader(io.BytesIO(content)).pages]
                    except Exception:  # a broken file has no text, and does not end the others
                        texts = []
                rows = [(work_id, k, t) for k, t in enumerate(texts) if t]
                yield pd.DataFrame(rows, columns=["work_id", "page_no", "text"])

    return files.select("work_id", "path", "content").mapInPandas(run, f"work_id {kind}, page_no int, text string")


def raw_folders(spark: SparkSession, path: str) -> DataFrame:
    """key and text of what ``sinks.raw_files`` or ``sinks.sentence_files`` wrote: a folder per work, with carriage returns as line ends."""
    with listing(spark):
        own = spark.read.text(path, wholetext=True)
    return own.withColumnRenamed("value", "text").withColumn("text", T.unix_lines(F.col("text")))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def raw_texts(spark: SparkSession, pattern: str, suffix: str) -> DataFrame:
    """work_id, text of files named work_id + ``suffix``, with carriage returns as line ends."""
    own = spark.read.text(pattern, wholetext=True).select(T.file_name(F.input_file_name()).alias("name"), "value")
    return own.filter(F.endswith("name", F.lit(suffix))).select(F.substring("name", F.lit(1), F.length("name") - len(suffix)).alias("work_id"), T.unix_lines(F.col("value")).alias("text"))


def persisted(sentences: DataFrame, keys: list[str]) -> DataFrame:
    """Sentences as they are read back from a file of lines: split at line ends, stripped, empty ones dropped, numbered anew."""
    order = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    text = F.array_join(F.transform(order, lambda s: s["sentence"]), "\n")
    lines = F.filter(F.transform(F.split(T.unix_lines(text), "\n"), T.strip), lambda x: F.length(x) > 0)
    return sentences.groupBy(*keys).agg(lines.alias("lines")).select(*keys, F.posexplode("lines").alias("pos", "sentence"))
