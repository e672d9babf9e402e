"""Recognisers, correctors and translators as plug-in functions around Spark's partitions.

A recogniser maps image bytes to boxes or to a text. It is built once per Python worker by its factory, so a model
is loaded once and not per row. Models and services themselves are not part of this package.
"""

from __future__ import annotations

import base64
import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..batches import small_batches
from ..functions import text as T
from ..operators import layout

Boxes = list[tuple[list[tuple[float, float]], str, float]]
BOX_SCHEMA = "work_id string, page_no int, box_no int, poly array<struct<x:double,y:double>>, text string, conf double, error string"
PADDING, TIMEOUT = 50, 30


def prepared(image: np.ndarray) -> np.ndarray:
    """An image (height, width, 3: blue, green, red) framed in white, made grey, and turned counter-clockwise."""
    framed = np.pad(image, ((PADDING, PADDING), (PADDING, PADDING), (0, 0)), constant_values=255)
    grey = np.rint(framed @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)
    return np.rot90(np.repeat(grey[:, :, None], 3, axis=2))


@functools.lru_cache(maxsize=8)
def _built(factory: Callable[[], Callable]) -> Callable:
    return factory()


def framed(decode: Callable[[bytes], np.ndarray], factory: Callable[[], Callable[[np.ndarray], Boxes]]) -> Callable[[], Callable[[bytes], Boxes]]:
    """A factory of a detector of image bytes from a decoder and a detector of ``prepared`` images."""

    def built() -> Callable[[bytes], Boxes]:
        model = factory()
        return lambda content: model(prepared(decode(content)))

    return built


def detect(pages: DataFrame, factory: Callable[[], Callable[[bytes], Boxes]], page: str = "page_no") -> DataFrame:
    """Boxes of each page (work_id, ``page``, content); one without boxes has a row of number -1, one that fails such a row with the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _built(factory)
        for b in batches:
            rows = []
            for work_id, page_no, content in zip(b["work_id"], b[page], b["content"], strict=True):
                try:
                    found = model(bytes(content)) or []
                    rows += [(work_id, page_no, k, [{"x": float(x), "y": float(y)} for x, y in poly], text, float(conf), None) for k, (poly, text, conf) in enumerate(found)]
                    if not found:
                        rows.append((work_id, page_no, -1, [], None, None, None))
                except Exception as x:
                    rows.append((work_id, page_no, -1, [], None, None, repr(x)))
            yield pd.DataFrame(rows, columns=["work_id", page, "box_no", "poly", "text", "conf", "error"])

    small_batches(pages.sparkSession)
    own, kind = _pages(pages, page)
    return own.mapInPandas(run, BOX_SCHEMA.replace("page_no int", f"`{page}` {kind}"))


def _pages(pages: DataFrame, page: str) -> tuple[DataFrame, str]:
    kind = "int" if page == "page_no" else pages.schema[page].dataType.simpleString()
    return pages.select(F.col("work_id").cast("string"), F.col(page).cast(kind), "content"), kind


#: What a recogniser gives: a text, boxes, or a service's answer.
KINDS = ("text", "boxes", "vision", "vertical")


def recognise(pages: DataFrame, factories: list[tuple], page: str = "page_no") -> DataFrame:
    """work_id, ``page``, provider_no, provider, text: every provider in order; one that raises gives no row.

    A provider is (name, factory) or (name, factory, kind), by which boxes are read into lines and columns and answers of services are
    taken apart, both on the JVM. Providers of texts and services run in one pass.
    """
    every = [(k, *f, *("text",)[len(f) - 2 :]) for k, f in enumerate(factories)]
    if unknown := {x[3] for x in every} - set(KINDS):
        raise ValueError(f"no kind of recogniser is named {', '.join(sorted(unknown))}")
    told = [x for x in every if x[3] != "boxes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for work_id, page_no, content in zip(b["work_id"], b[page], b["content"], strict=True):
                for k, name, factory, _ in told:
                    try:
                        rows.append((work_id, page_no, k, name, _built(factory)(bytes(content))))
                    except Exception:  # noqa: S112  the others still vote
                        continue
            yield pd.DataFrame(rows, columns=["work_id", page, "provider_no", "provider", "text"])

    small_batches(pages.sparkSession)
    own, kind = _pages(pages, page)
    out = own.mapInPandas(run, f"work_id string, `{page}` {kind}, provider_no int, provider string, text string") if told or len(told) == len(every) else None
    if out is not None:
        of = {k: [x[0] for x in every if x[3] == k] for k in ("vision", "vertical")}
        text, number = F.col("text"), F.col("provider_no")
        out = out.withColumn("text", F.when(number.isin(of["vision"]), T.vision_text(text)).when(number.isin(of["vertical"]), T.vertical_text(text)).otherwise(text))
    for k, name, factory, how in every:
        if how == "boxes":
            texts = layout.read_pages(detect(pages, factory, page).filter("error is null"), ["work_id", page])
            texts = texts.select("work_id", page, F.lit(k).alias("provider_no"), F.lit(name).alias("provider"), "text")
            out = texts if out is None else out.unionByName(texts)
    return out


def web_provider(url: str, payload: Callable[[str], dict], name: str) -> Callable[[], Callable[[bytes], str]]:
    """A factory for a service that takes an image in base64 and answers in JSON; its answer is the text returned.

    The answers go through ``functions.text.vision_text`` or ``vertical_text``, on the JVM.
    """

    def factory() -> Callable[[bytes], str]:
        import urllib.request

        def call(content: bytes) -> str:
            body = json.dumps(payload(base64.b64encode(content).decode())).encode()
            request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
            try:
                with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
                    return answer.read().decode()
            except OSError as x:
                return json.dumps({"code": -1, "msg": "HTTP Error", "error": {"message": f"{name}: {x}"}})

        return call

    return factory


def corrected(text: Column, factory: Callable[[], Callable[[str], str]] | None = None) -> Column:
    """Texts through a corrector; blank ones, and those it fails on, stay as they are. None changes nothing."""
    if factory is None:
        return text
    small_batches(SparkSession.active())

    @F.pandas_udf(Ty.StringType())
    def run(texts: pd.Series) -> pd.Series:
        model = _built(factory)

        def one(t: str | None) -> str | None:
            if t is None or not t.strip():
                return t
            try:
                return model(t).strip()
            except Exception:
                return t

        return texts.map(one)

    return run(text)


def segmented(factory: Callable[[], Callable[[str], list[str]]]) -> Callable[[Column], Column]:
    """A segmenter by a model, for the engine: line ends count as spaces; where the model fails, full stops end sentences."""

    small_batches(SparkSession.active())

    @F.pandas_udf(Ty.ArrayType(Ty.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        try:
            model = _built(factory)
        except Exception:
            return pd.Series([None] * len(texts), dtype=object)

        def one(t: str | None) -> list[str] | None:
            try:
                return [x.strip() for x in model((t or "").replace("\n", " ")) if x.strip()]
            except Exception:
                return None

        return texts.map(one)

    return lambda text: F.coalesce(run(text), T.segment_plain(F.coalesce(text, F.lit(""))))


def translated(sentences: DataFrame, key: str, factory: Callable[[], Callable[[list[str]], list[str]]] | None = None) -> DataFrame:
    """Sentences (key, pos, sentence) with ``sentence_tr``: one call per work, padded or cut to its length.

    Without a model, or where it fails, a sentence is its own translation.
    """
    if factory is None:
        return sentences.withColumn("sentence_tr", F.col("sentence"))
    kind = sentences.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        own = rows["sentence"].tolist()
        try:
            got = [x.strip() for x in _built(factory)(own)][: len(own)]
            got += [""] * (len(own) - len(got))
        except Exception:
            got = own
        return rows.assign(sentence_tr=got)[[key, "pos", "sentence", "sentence_tr"]]

    return sentences.select(key, "pos", "sentence").groupBy(key).applyInPandas(run, f"`{key}` {kind}, pos int, sentence string, sentence_tr string")


def strict(results: DataFrame) -> DataFrame:
    """Provider results with ``status``: ok, or failed where the text reports a failure."""
    return results.withColumn("status", F.when(T.is_failure(F.col("text")), "failed").otherwise("ok"))
