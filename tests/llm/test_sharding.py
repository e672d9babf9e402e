from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from pairloom.llm.sharding import pack, shard

SCHEMA = "doc_id long, text string, size string, shard string, key string"


def check(out, data, n_shards):
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, *_ in data)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    for s, x in slots.items():
        assert 0 <= s < n_shards and sorted(x) == list(range(len(x)))


def test_balance_with_a_hot_group(spark):
    r = random.Random(2)
    data = [(i, "the same text " * 20 if i % 3 == 0 else " ".join(f"w{r.randint(0, 999)}" for _ in range(r.randint(1, 200))), "", "", "") for i in range(3000)]
    docs = spark.createDataFrame(data, SCHEMA)
    out = shard(docs, 8, groups_per_cell=300, rows_per_slot_cell=500).collect()
    check(out, data, 8)
    texts = {i: t for i, t, *_ in data}
    size, count = np.zeros(8), np.zeros(8)
    for x in out:
        assert x.size == len(texts[x.doc_id].encode()) + 8
        assert x.text_crc32 == zlib.crc32(texts[x.doc_id].encode())
        size[x.shard] += x.size
        count[x.shard] += 1
    assert size.max() / size.mean() < 1.02 and size.min() / size.mean() > 0.98
    assert count.max() / count.mean() < 1.1


def test_equal_texts_stay_together_unless_hot(spark):
    data = [(i, f"text {i // 2} " * (i // 2 % 9 + 1), "", "", "") for i in range(2000)]
    out = {r.doc_id: r.shard for r in shard(spark.createDataFrame(data, SCHEMA), 6).collect()}
    assert all(out[i] == out[i + 1] for i in range(0, 2000, 2))


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    """Small tables, all of whose groups are placed by one rule: each goes, largest first, where the dot product is highest."""
    r = random.Random(seed)
    texts = [" ".join("word" for _ in range(r.randint(1, 12))) + f" t{k}" for k in range(r.randint(1, 20))]
    data = [(i, r.choice(texts), "", "", "") for i in range(r.randint(1, 60))]
    n = r.randint(1, 5)
    groups = {}
    for _, t, *_ in data:
        g = groups.setdefault(t, [0, 0, 0])
        for k, x in enumerate((len(t.encode()) + 8, len(t.split()), 1)):
            g[k] += x
    whole = [sum(g[k] for g in groups.values()) for k in range(3)]
    items = sorted((hashlib.sha256(t.encode()).digest(), [x / w for x, w in zip(g, whole)]) for t, g in groups.items())
    room, want = [[1 / n] * 3 for _ in range(n)], {}
    for key, v in sorted(items, key=lambda x: -max(x[1])):
        if max(v) * n > 1:
            want = None  # a group over a shard is cut: the invariants below hold
            break
        dots = [6 * q[0] * v[0] + q[1] * v[1] + q[2] * v[2] for q in room]
        at = max(range(n), key=lambda s: (round(dots[s], 12), -s))
        room[at] = [a - b for a, b in zip(room[at], v)]
        want[key] = at
    out = shard(spark.createDataFrame(data, SCHEMA), n).collect()
    check(out, data, n)
    by = dict(x[:2] for x in data)
    if want is not None:
        assert all(x.shard == want[hashlib.sha256(by[x.doc_id].encode()).digest()] for x in out)


def test_groups_below_a_shard_are_never_cut(spark):
    data = [(i, f"group {i % 5} " * 3, "", "", "") for i in range(500)]
    for n, cut in ((3, False), (4, False), (6, True)):  # a group is n / 5 of a shard
        out = {r.doc_id: r.shard for r in shard(spark.createDataFrame(data, SCHEMA), n).collect()}
        assert all((len({out[i] for i in range(k, 500, 5)}) > 1) == cut for k in range(5))
    single = [(i % 4, "the same text", "", "", "") for i in range(300)] + [(None, None, "", "", "")] * 300
    check(shard(spark.createDataFrame(single, SCHEMA), 4, rows_per_slot_cell=50).collect(), single, 4)


def test_nulls_repeats_and_empty(spark):
    data = [(None, None, "", "", ""), (None, "", "", "", ""), (1, "a", "", "", ""), (1, "a", "", "", ""), (2, "b" * 100_000, "", "", "")]
    check(shard(spark.createDataFrame(data, SCHEMA), 3).collect(), data, 3)
    assert shard(spark.createDataFrame([], SCHEMA), 3).collect() == []


def test_highest_dot_product_wins():
    where, room = pack(np.array([[0.1, 0.1, 0.1]]), np.array([[0.2, 0.2, 0.2], [0.5, 0.1, 0.1], [0.3, 0.3, 0.3]]))
    assert where[0] == 1 and np.allclose(room[1], [0.4, 0.0, 0.0])
