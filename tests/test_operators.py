from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import align, layout, tfidf, vote, works

BOX = "work_id string, page_no int, box_no int, poly array<struct<x:double,y:double>>, text string, conf double"


def square(x, y):
    return [(x - 1.0, y - 1.0), (x + 1.0, y - 1.0), (x + 1.0, y + 1.0), (x - 1.0, y + 1.0)]


def test_reading_order(spark):
    boxes = [
        ("w", 0, 0, square(0, 5), "一", 0.9), ("w", 0, 1, square(90, 1), "廣義脊", 0.4), ("w", 0, 2, square(180.5, 9), "三", 0.8), ("w", 0, 3, square(180.5, 9), "四", 0.8),
        ("w", 0, 4, square(200, 2), "五", 0.7), ("w", 0, 5, square(95, 0), "low", 0.39), ("w", 0, 6, square(95, 0), "ab-1", 0.9), ("w", 1, 0, square(0, 0), "***", 0.9),
    ]
    got = {r.page_no: r.text for r in layout.read_pages(spark.createDataFrame(boxes, BOX), ["work_id", "page_no"]).collect()}
    assert got == {0: "五\n三\n四\n廣義省\n一", 1: ""}
    placed = spark.createDataFrame([("p", k, x) for k, x in enumerate([0.0, 90.0, 180.5, 180.5, 271.0])], "p string, box_no int, cx double")
    assert [r.band for r in layout.bands(placed, ["p"]).orderBy("box_no").collect()] == [0, 0, 1, 1, 2]


def test_vote(spark):
    rows = [
        ("a", 0, "銀"), ("a", 1, "兩"), ("b", 0, "Tự Hán (銀銀)"), ("b", 1, ""), ("c", 0, "Tự Hán (x)"), ("c", 1, "Tự Hán (銀)"), ("e", 0, None),
    ]
    results = spark.createDataFrame(rows, "page string, provider_no int, text string")
    pages = spark.createDataFrame([(p,) for p in "abcde"], "page string")
    got = {r.page: r.text for r in vote.vote_all(results, pages, ["page"]).collect()}
    assert got == {"a": "銀", "b": "", "c": "Tự Hán (銀)", "d": "", "e": ""}
    got = {r.page: r.text for r in vote.vote_all(results, pages, ["page"], strict=True).collect()}
    assert got["c"] == ""


def sides(spark, a, b):
    frame = lambda s: spark.createDataFrame([("w", k, x) for k, x in enumerate(s)], "work_id string, pos int, sentence string")
    return frame(a), frame(b)


def test_positional(spark):
    got = align.positional(*sides(spark, ["a", "b"], ["c"])).orderBy("pair_no").collect()
    assert [(r.pair_id, r.source_sentence, r.target_sentence) for r in got] == [("pair_0001", "a", "c"), ("pair_0002", "b", "")]
    assert align.positional(*sides(spark, [], [])).collect() == []


def plain_steps(s):
    m, n = s.shape
    cost, move = np.zeros((m + 1, n + 1)), np.zeros((m + 1, n + 1), int)
    cost[:, 0], cost[0] = np.arange(m + 1) * 0.5, np.arange(n + 1) * 0.5
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            c = (cost[i - 1, j - 1] + (1.0 - s[i - 1, j - 1]), cost[i - 1, j] + 0.5, cost[i, j - 1] + 0.5)
            cost[i, j], move[i, j] = min(c), c.index(min(c)) + 1
    out, i, j = [], m, n
    while i or j:
        k = move[i, j] if i and j else 2 if i else 3
        i, j = i - (k < 3), j - (k != 2)
        out.append((i if k < 3 else -1, j if k != 2 else -1))
    return out[::-1]


def test_steps():
    assert align.steps(np.zeros((2, 4))) == [(-1, 0), (-1, 1), (0, 2), (1, 3)]
    assert align.steps(np.zeros((4, 2))) == [(0, -1), (1, -1), (2, 0), (3, 1)]
    assert align.steps(np.eye(3)) == [(0, 0), (1, 1), (2, 2)]
    assert align.steps(np.zeros((0, 2))) == [(-1, 0), (-1, 1)] and align.steps(np.zeros((0, 0))) == []
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = np.round(rng.random((rng.integers(0, 12), rng.integers(0, 12))) * rng.integers(0, 2), rng.integers(0, 3))
        assert align.steps(s) == plain_steps(s)


def test_dynamic_with_one_empty_side(spark):
    source, target = sides(spark, ["the cat sat", "dogs bark", "more words"], ["dogs bark loudly", "more words"])
    both = source.withColumn("side", F.lit("source")).unionByName(target.withColumn("side", F.lit("target")))
    pairs = align.dynamic(source, target, tfidf.cosines(tfidf.weights(both))).orderBy("pair_no").collect()
    assert [(r.source_sentence, r.target_sentence) for r in pairs] == [("the cat sat", ""), ("dogs bark", "dogs bark loudly"), ("more words", "more words")]
    empty = target.limit(0)
    pairs = align.dynamic(source, empty, spark.createDataFrame([], "work_id string, i int, j int, sim double")).collect()
    assert len(pairs) == 3 and all(r.target_sentence == "" and r.error is None for r in pairs)


def test_weights(spark):
    texts = {("source", 0): "Aa bb aa x", ("source", 1): "bb", ("target", 0): "aa CC cc cc", ("target", 1): "!"}
    rows = spark.createDataFrame([("w", s, p, t) for (s, p), t in texts.items()], "work_id string, side string, pos int, sentence string")
    words = {k: [w for w in t.lower().split() if len(w) > 1] for k, t in texts.items()}
    df = {w: sum(w in x for x in words.values()) for x in words.values() for w in x}
    want = {}
    for k, x in words.items():
        v = {w: x.count(w) * (math.log(5 / (1 + df[w])) + 1) for w in x}
        n = math.sqrt(sum(a * a for a in v.values()))
        want |= {(*k, w): a / n for w, a in v.items()}
    weighed = tfidf.weights(rows)
    got = {(r.side, r.pos, r.term): r.w for r in weighed.collect()}
    assert got == pytest.approx(want)
    sims = {(r.i, r.j): r.sim for r in tfidf.cosines(weighed).collect()}
    assert sims == pytest.approx({(0, 0): want["source", 0, "aa"] * want["target", 0, "aa"]})


def test_works(spark):
    a = spark.createDataFrame([("x", "page_10.png"), ("x", "page_2.png"), ("y", "p.png")], "work_id string, file_name string")
    b = spark.createDataFrame([("x",), ("X",)], "work_id string")
    assert works.paired(a.select("work_id").distinct(), b).collect()[0].work_id == "x"
    assert [r.work_id for r in works.unpaired(a, b).collect()] == ["y"]
    assert {(r.work_id, r.file_name) for r in works.first_pages(a, 1).collect()} == {("x", "page_10.png"), ("y", "p.png")}
    assert works.first_pages(a, None).count() == 3
    with pytest.raises(ValueError):
        works.first_pages(a, -1)
    r = random.Random(1)
    parts = [(f"w{k}", "t" * r.randint(0, 5)) for k in range(9)]
    pieces = works.global_pieces(spark.createDataFrame(parts, "work_id string, text string")).orderBy("start").collect()
    whole = "".join(t + "\n" for _, t in parts)
    assert all(whole[p.start : p.start + len(p.piece)] == p.piece for p in pieces) and "".join(p.piece for p in pieces) == whole


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_path_against_cell_by_cell(seed):
    """Longer than one stretch of diagonals, with ties, few similarities, and empty sides."""
    rng = np.random.default_rng(seed)
    m, n = [(0, 5), (7, 0), (90, 120), (300, 40), (1, 200), (150, 150)][seed]
    sims = np.where(rng.random((m, n)) < 0.2, rng.integers(0, 5, (m, n)) / 4, 0.0)
    assert align.steps(sims) == plain_steps(sims)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running_sums(spark, n):
    rng = np.random.default_rng(n)
    rows = [(f"w{k:04d}", int(rng.integers(0, 9))) for k in rng.permutation(n).tolist()]
    got = {r.k: r.before for r in works.running(spark.createDataFrame(rows, "k string, n long"), "k", "n").collect()}
    want, total = {}, 0
    for k, v in sorted(rows):
        want[k], total = total, total + v
    assert got == want
