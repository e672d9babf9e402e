from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from pairloom.llm.toxicity import Machine, clean, fit, score, text_terms, train

FILL = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "lu") for b in ("ra", "me", "si", "to") for c in ("n", "l", "sh", "")]


def corpus(n: int, seed: int) -> list[tuple]:
    """Toxic only where an insult and a group come together."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        insult, group = r.random() < 0.4, r.random() < 0.4
        words = [r.choice(FILL) for _ in range(r.randint(5, 60))]
        if insult:
            words.insert(r.randint(0, len(words)), r.choice(["Vermin,", "filthx", "SCUMBAG!"]))
        if group:
            words.insert(r.randint(0, len(words)), r.choice(["northerners", "(gardeners)"]))
        out.append((i, " ".join(words), int(insult and group)))
    return out


def test_pairs_are_learned_and_held_out_rows_are_not_seen(spark):
    rows = corpus(3000, 3)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows] + [(None, None, "x", "y"), (99_999, "", "x", "y"), (5, rows[5][1], "x", "y")], "doc_id long, text string, score string, _y string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(7, None), (None, 1), (123_456, 1)], "doc_id long, toxic int")
    machine = train(docs, labels)
    got = score(docs, machine).collect()
    assert len(got) == len(rows) + 3
    truth = {i: y for i, _, y in rows}
    hits = []
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.held_out and r.doc_id in truth:
            hits.append(r.predicted == truth[r.doc_id])
    assert len(hits) > 500 and np.mean(hits) > 0.97
    # other labels of held-out rows change nothing
    spoiled = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = train(docs, spoiled)
    assert again.bias == machine.bias and np.array_equal(again.weights, machine.weights) and np.array_equal(again.factors, machine.factors)
    kept = clean(docs, machine)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in got if r.predicted}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.doc_id not in bad)


def test_sample_is_bounded_and_one_class_works(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus(100, 1)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert all(r.score < 0.05 for r in score(docs, train(docs, labels)).collect())
    assert all(r.score < 0.05 for r in score(docs, train(docs, labels.limit(0))).collect())
    assert score(docs.limit(0), train(docs.limit(0), labels)).collect() == []
    train(docs, labels, sample=10)


def test_score_is_the_pairwise_sum():
    rng = np.random.default_rng(2)
    m = Machine(-0.3, np.arange(10, 20, dtype=np.int32), rng.normal(size=10), rng.normal(size=(10, 4)))
    ids = np.array([11, 13, 18], np.int32)
    k = ids - 10
    z = m.bias + m.weights[k].sum() + sum(m.factors[a] @ m.factors[b] for i, a in enumerate(k) for b in k[i + 1 :])
    assert abs(m.score(ids) - 1 / (1 + np.exp(-z))) < 1e-12
    assert fit([], np.array([]), np.array([], np.int32)).score(np.array([], np.int32)) < 0.01


def test_terms_do_not_depend_on_the_batch():
    texts = [b"Some words, here", None, b"", b"some WORDS here!", b"x " * 800_000 + b"tail", "é".encode()]
    whole = list(text_terms(texts))
    assert len(whole) == len(texts) and not len(whole[1]) and not len(whole[2])
    assert np.array_equal(whole[0], whole[3])
    for t, ids in zip(texts, whole, strict=True):
        assert np.array_equal(next(iter(text_terms([t]))), ids)
