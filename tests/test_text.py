"""Text columns against small Python definitions, on the cases where the JVM's own classes differ."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as T


def run(spark, values, column):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r.x for r in spark.createDataFrame(rows, "i int, t string").select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def py_segment(text, ends):
    return [s for s in (x.strip() for x in re.findall(f"[^{ends}]*[{ends}]|[^{ends}]+", text)) if s]


ALPHABET = "ab　 \t\n。！？.!?銀é\x85\xa0 漢"


def noise(seed, n=300):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_segments(spark):
    cases = {"你好！！": ["你好！", "！"], "3.14": ["3.", "14"], "a\n\n b": ["a", "b"], "　x　。": ["x　。"], "": []}
    assert run(spark, cases, T.segment) == list(cases.values())
    values = noise(1)
    assert run(spark, values, T.segment) == [py_segment(v, "。！？.!?\n") for v in values]
    assert run(spark, values, T.segment_other) == [py_segment(v, ".!?\n") for v in values]
    plain = [[s.strip() for s in v.replace("\n", " ").split(".") if s.strip()] for v in values]
    assert run(spark, values, T.segment_plain) == plain
    assert run(spark, ["A! B. C\nD."], T.segment_plain) == [["A! B", "C D"]]


def test_strip_and_noise(spark):
    values = noise(2) + ["ab-1", "***", "銀兩", "đ", "a_b", "", "　"]
    assert run(spark, values, T.strip) == [v.strip() for v in values]
    assert run(spark, values, T.is_noise) == [bool(re.fullmatch(r"[A-Za-z0-9\s\W]+", v)) for v in values]


def test_counts_corrections_and_names(spark):
    assert run(spark, ["銀a兩", "\U00020000", ""], T.count_class) == [2, 0, 0]
    assert run(spark, ["廣義脊四土", "稅案x"], T.correct) == ["廣義省田土", "稅粟x"]
    assert run(spark, ["Tự Hán (x)", "x", ""], T.is_failure) == [True, False, False]
    assert run(spark, ["/a/b.png"], T.file_name) == ["b.png"]
    assert run(spark, ["a\r\nb\rc"], T.unix_lines) == ["a\nb\nc"]
    got = spark.range(1).select(T.pair_id(F.lit(7)).alias("a"), T.pair_id(F.lit(10000)).alias("b")).first()
    assert (got.a, got.b) == ("pair_0007", "pair_10000")


def test_tokens(spark):
    values = ["The a to_do 漢字 é9 x", "ée x́"]
    assert run(spark, values, T.tokens) == [re.findall(r"\b\w\w+\b", v.lower()) for v in values]


def test_pad_or_cut(spark):
    x = spark.createDataFrame([(["a", "b"], 3), (["a", "b", "c", "d"], 3), ([], 2)], "l array<string>, n int")
    assert [r.x for r in x.select(T.pad_or_cut(F.col("l"), F.col("n")).alias("x")).collect()] == [["a", "b", ""], ["a", "b", "c"], ["", ""]]


@pytest.mark.parametrize(
    "body, text",
    [
        ('{"responses":[{"fullTextAnnotation":{"text":" 銀\\n兩 "}}]}', "銀\n兩"),
        ('{"responses":[{}]}', ""),
        ('{"error":{"message":"quota"}}', "Tự Hán (Vision - API Error: quota)"),
    ],
)
def test_vision(spark, body, text):
    assert run(spark, [body], T.vision_text) == [text]


@pytest.mark.parametrize(
    "body, text",
    [
        ('{"code":0,"data":[{"text":"一"},"二",5,{"x":1},"三"]}', "一\n二\n三"),
        ('{"code":1,"msg":"success","data":[]}', ""),
        ('{"code":2,"msg":"no credit"}', "Tự Hán (Vertical - no credit)"),
        ('{"code":2}', "Tự Hán (Vertical - API Error)"),
    ],
)
def test_vertical(spark, body, text):
    assert run(spark, [body], T.vertical_text) == [text]
