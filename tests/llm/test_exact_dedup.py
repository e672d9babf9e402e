from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm.exact_dedup import BinaryFuse, build_filters, dedup_batch, drop_copies, exact_dedup, half, open_snapshot, screen, take_snapshot

SCHEMA = "doc_id long, text string, digest string, n string"


def rows(seed: int, n: int = 120) -> list[tuple]:
    r = random.Random(seed)
    texts = ["", None, "a", "b", "ab", "x" * 30_000, "é", "a "]
    out = [(r.randint(0, 60), r.choice(texts) if r.random() < 0.7 else f"t{r.randint(0, 30)}", "clash", "clash") for _ in range(n)]
    return [*out, (None, "a", "", ""), (None, "only", "", ""), (7, "same row", "", ""), (7, "same row", "", "")]


def brute(data: list[tuple]) -> dict:
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[t or ""].append(i)
    return groups


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("digest", ["sha", "weak"])
def test_against_brute_force(spark, limit, digest):
    data = rows(3)
    docs = spark.createDataFrame(data, SCHEMA)
    hashes = {"sha": lambda t: F.sha2(t, 256), "weak": lambda t: F.concat(F.lit("w"), F.length(t) % 3)}
    out = exact_dedup(docs, half(), digest=hashes[digest], limit=limit).collect()
    groups = brute(data)
    assert len(out) == len(data)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in out:
        ids = sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert r.doc_id in ids
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] += 1
    assert all(kept[s] == 1 for s in sha)


def test_snapshot_makes_no_difference(spark):
    docs = spark.createDataFrame(rows(5), SCHEMA)
    results = [
        sorted(map(str, exact_dedup(docs, part).select("doc_id", "keep_id", "group_size", "text_sha256").collect()))
        for part in (F.lit(True), F.lit(False), half(), F.col("doc_id") < 20)
    ]
    assert all(x == results[0] for x in results)


def test_empty(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA), half()).collect() == []


@pytest.mark.parametrize("limit", [None, 0])
def test_drop_copies_keeps_columns(spark, limit):
    data = rows(9)
    docs = spark.createDataFrame(data, SCHEMA)
    out = drop_copies(docs, limit)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(r.text or "" for r in got) == sorted(brute(data))


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 30_000):
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        f = BinaryFuse.from_bytes(BinaryFuse.build(keys).to_bytes())
        assert f.contains(keys).all()
        others = rng.integers(0, 2**63, 50_000).astype(np.uint64)
        assert f.contains(others).mean() < 0.01
        if n > 1000:
            assert len(f.table) < 1.3 * n


@pytest.mark.parametrize("digest", ["sha", "weak"])
@pytest.mark.parametrize("n", [0, 120])
def test_a_stored_snapshot_serves_later_batches(spark, tmp_path, digest, n):
    hashes = {"sha": lambda t: F.sha2(t, 256), "weak": lambda t: F.concat(F.lit("w"), F.length(t) % 3)}
    held = [(1000 + i if i is not None and i % 2 else i, *x) for i, *x in rows(2, n)] if n else []
    docs = spark.createDataFrame(held, SCHEMA)
    take_snapshot(docs, str(tmp_path / "s"), digest=hashes[digest])
    for seed in (7, 8):
        data = rows(seed)
        batch = spark.createDataFrame(data, SCHEMA)
        got = dedup_batch(batch, open_snapshot(spark, str(tmp_path / "s")), docs, digest=hashes[digest]).collect()
        new, old = brute(data), brute(held)
        sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in new}
        assert len(got) == len(data)
        kept = defaultdict(int)
        for r in got:
            t = sha[r.text_sha256]
            best = max((i for i in [*new[t], *old.get(t, [])] if i is not None), default=None)
            assert (r.keep_id, r.group_size) == (best, len(new[t]) + len(old.get(t, []))) and r.doc_id in new[t]
            kept[t] += r.kept
        for t, ids in new.items():
            lowest = -1
            best_new, best_old = (max((lowest if i is None else i for i in x), default=None) for x in (ids, old.get(t, [])))
            assert kept[t] == (best_old is None or best_new > best_old), t


def test_small_filters_screen_large_batches_in_parts(spark):
    keys = spark.range(300).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    keyed = keys.select("digest", F.lit(0).alias("bucket"), F.xxhash64("digest").alias("h64"))
    filters = build_filters(keyed.limit(40))
    known = {r.digest for r in keyed.limit(40).collect()}
    for parts in (1, 7):
        got = [r.digest for r in screen(keyed, filters, parts).collect()]
        assert known <= set(got) and len(got) == len(set(got)) < 60
        assert screen(keyed, filters.limit(0), parts).collect() == []
        assert screen(keyed.withColumn("bucket", F.lit(1)), filters, parts).collect() == []
