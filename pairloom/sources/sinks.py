"""Sinks: stage tables, tab-separated pairs, spreadsheets and plain texts."""

from __future__ import annotations

import io
import itertools
import re
import uuid
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

PAIR_COLUMNS = ["pair_id", "source_sentence", "target_sentence"]
HEADER = ("pair_id", "han_sentence", "viet_sentence")
_BAD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def stage(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Writes a stage as Parquet, partitioned by work, and reads it back: later steps start from it."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pairs_tsv(pairs: DataFrame, path: str, by: list[str] | None = None, header: tuple[str, str, str] = HEADER) -> None:
    """Pairs in order as tab-separated files with a header, quotes doubled, empty texts bare."""
    keys = by or []
    ordered = pairs.repartition(*keys).sortWithinPartitions(*keys, "pair_no") if keys else pairs.repartitionByRange("pair_no").sortWithinPartitions("pair_no")
    named = ordered.select(*keys, *(pairs[c].alias(h) for c, h in zip(PAIR_COLUMNS, header, strict=True)))
    writer = named.write.mode("overwrite").options(sep="\t", header=True, escape='"', emptyValue="")
    (writer.partitionBy(*keys) if keys else writer).csv(path)


#: Rows of a sheet, the header included, as the format has it.
SHEET_ROWS = 1_048_576
_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}  # fixed values of the format


def workbook(rows: Iterable[tuple[str, ...]]) -> bytes:
    """A spreadsheet file with one sheet of texts; characters that its format cannot hold are left out."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in _PARTS.items():
            z.writestr(name, text)
        with z.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
            for n, row in enumerate(rows):
                if n >= SHEET_ROWS:
                    raise ValueError(f"more than {SHEET_ROWS - 1} pairs do not fit in a spreadsheet; write them as text")
                cells = (f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", x or ""))}</t></is></c>' for x in row)
                sheet.write(f"<row>{''.join(cells)}</row>".encode())
            sheet.write(b"</sheetData></worksheet>")
    return out.getvalue()


def workbooks(pairs: DataFrame, key: str = "work_id", header: tuple[str, str, str] = HEADER) -> DataFrame:
    """key, content binary, error: each work's pairs as a spreadsheet, made where the work is; one that is too large has the error."""
    kind = pairs.schema[key].dataType.simpleString()

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("pair_no")
        try:
            content, error = workbook([header, *ordered[PAIR_COLUMNS].itertuples(index=False, name=None)]), None
        except ValueError as x:
            content, error = None, str(x)
        return pd.DataFrame({key: rows[key].iloc[:1], "content": [content], "error": [error]})

    return pairs.select(key, "pair_no", *PAIR_COLUMNS).groupBy(key).applyInPandas(one, f"`{key}` {kind}, content binary, error string")


def pairs_xlsx(pairs: DataFrame, path: str, header: tuple[str, str, str] = HEADER) -> None:
    """One work's pairs as a spreadsheet file of the driver, row by row."""
    rows = pairs.orderBy("pair_no").select(PAIR_COLUMNS).toLocalIterator()
    content = workbook(itertools.chain([header], rows))
    with open(path, "wb") as f:
        f.write(content)


def raw_files(texts: DataFrame, path: str, key: str = "work_id", text: str = "text") -> None:
    """One folder per work with its raw text."""
    texts.select(key, text).write.mode("overwrite").partitionBy(key).text(path)


def sentence_files(sentences: DataFrame, path: str, key: str = "work_id") -> None:
    """One folder per work with a file of its sentences, a line each."""
    rows = sentences.repartition(key).sortWithinPartitions(key, "pos")
    rows.select(key, "sentence").write.mode("overwrite").partitionBy(key).text(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder of ``spark.checkpoint.dir``; a local one only where that is unset and the session local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "/tmp/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
