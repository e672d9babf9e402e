from __future__ import annotations

import random

import duckdb
import pytest

from pairloom.llm.mixing import mix, mixed_documents, targets
from pairloom.llm.queries import OP8_SQL

SCHEMA = "doc_id long, text string, source string, h string, times string"


def brute(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    free, fixed, left = set(names), {}, float(sum(sizes.values()))
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return fixed | share
        for s in over:
            fixed[s] = most * sizes[s]
            left -= fixed[s]
        free -= over
    return fixed


def data(seed: int, n: int = 400) -> list[tuple]:
    r = random.Random(seed)
    names = ["b", "a", "Z", "é", None, "tiny", "zz"]
    out = [(i, " ".join("w" * r.randint(1, 60)), r.choice(names[:5]) if i % 3 else "a", "", "") for i in range(n)]
    return [*out, (None, "x y", "tiny", "", ""), (9999, None, "zz", "", ""), (5000, "q w e", "b", "", ""), (5000, "q w e", "b", "", "")]


@pytest.mark.parametrize("limit", [None, 0])
def test_against_sql_and_targets(spark, limit):
    rows = data(4)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix(docs, limit=limit).collect()
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r["size"]
    want = brute(sizes)
    for s, t in want.items():
        assert target[s] == pytest.approx(t)
        if s not in ("tiny", "zz"):
            assert abs(taken[s] - t) <= 30
    con = duckdb.connect()
    frame = docs.toPandas()
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, source FROM frame")
    sql = sorted(map(str, con.sql(OP8_SQL).fetchall()))
    mine = sorted(str((r.doc_id, r["size"], r.source_size, r.target, r.taken)) for r in got)
    assert mine == sql


def test_reruns_agree_and_documents_repeat(spark):
    docs = spark.createDataFrame(data(8), SCHEMA)
    first = sorted(map(str, mix(docs).collect()))
    assert first == sorted(map(str, mix(docs.repartition(7)).collect()))
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    times = {r.doc_id: r.times for r in mix(docs).collect()}
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    for i, k in times.items():
        assert seen.get(i, 0) == k * (2 if i == 5000 else 1)
    assert sorted(map(str, mixed_documents(docs, limit=0).collect())) == sorted(map(str, out.collect()))


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, "d": 0}
    got = {r.source: r.target for r in targets(spark.createDataFrame([*sizes.items()], "source string, source_size long")).collect()}
    assert got == pytest.approx(brute(sizes))


def test_empty(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
