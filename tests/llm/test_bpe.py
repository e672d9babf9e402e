from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from pairloom.llm.bpe import Codec, boundary, cuts, decode, encode, round_trip
from pairloom.llm.common import tokenizer_path
from pairloom.llm.token_counts import TokenTree, apply_edits, build_trees, count_with_edits, edited, standing_edits

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    "", None, " ", "a", "Hello world", "don't we'll  it's\n\n x", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoft", "漢字かな交じり文 " * 200,
    " 　  x", "x" * 5000, "naïve café – “quotes” … 🙂👩‍👩‍👧 " * 50, "one two three " * 4000, "\t\r\n" * 100,
]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(tokenizer_path())
    return lambda s: t.encode(s, add_special_tokens=False).ids


def noise(r: random.Random) -> str:
    return "".join(r.choice(" ab'st\n\t é　漢1.!  ") if r.random() < 0.4 else r.choice(["the ", "and", " of", "wh. "]) for _ in range(r.randint(0, 300)))


def test_chunks_agree_with_the_library(library):
    r = random.Random(1)
    codec = Codec(tokenizer_path(), bits=5, cache_bytes=4096)
    for s in [*(t or "" for t in TEXTS), *(noise(r) for _ in range(400))]:
        ids = codec.encode(s.encode())
        assert ids.tolist() == library(s)
        assert codec.decode(ids) == s
    assert codec.held <= 4096


def test_shared_chunks_are_reused():
    codec = Codec(tokenizer_path())
    shared = " ".join(f"word{i}" for i in range(4000))
    codec.encode(f"one beginning {shared} one end".encode())
    before = codec.reused
    codec.encode(f"another and longer beginning here {shared} and another end".encode())
    assert codec.reused - before > 0.8 * len(shared)


def test_cuts_are_whole_and_follow_content():
    data = np.frombuffer(random.Random(2).randbytes(50_000), np.uint8)
    ends = cuts(data, 8, 2000)
    assert ends[-1] == len(data) and all(0 < b - a <= 2000 for a, b in zip([0, *ends], ends))
    moved = cuts(np.concatenate([data[:100], data]), 8, 2000)
    assert len({len(data) - e for e in ends} & {len(data) + 100 - e for e in moved}) > 0.8 * len(ends)


def test_operators(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (3, "a", "x")], "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs).collect()), key=str)
    want = []
    for r in docs.collect():
        ids, s = library(r.text or ""), r.text or ""
        want.append((r.doc_id is None, r.doc_id or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(s.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    texts = {r.doc_id: r.text for r in decode(encode(docs)).collect() if r.doc_id not in (None, 3)}
    assert texts == {i: t or "" for i, t in enumerate(TEXTS) if i != 3}
    assert round_trip(docs.limit(0)).collect() == []


def test_counts_follow_edits(spark, library):
    r = random.Random(5)
    codec = Codec(tokenizer_path())
    for _ in range(300):
        now = noise(r).encode()
        tree = TokenTree(codec, now, r.choice([8, 16, 64]))
        for _ in range(5):
            e = (r.randint(0, len(now) + 3), r.randint(0, 20), r.choice([b" x", b"", b"<|endoftext|>", b"  ", b"\n", "é".encode(), b"word " * 30]))
            tree.edit(*e)
            now = edited(now, *e)
            assert tree.text() == now and tree.n_bytes == len(now)
            assert tree.n_tokens == len(library(now.decode()))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for x in count_with_edits(docs).collect():
        now = (TEXTS[x.doc_id] or "").encode()
        assert x.n_tokens == len(library(now.decode()))
        for e in standing_edits(now):
            pass
        new = now
        for e in list(standing_edits(now)):
            new = edited(new, *e)
        assert x.n_tokens_edited == len(library(new.decode())) and x.n_bytes_edited == len(new)


def test_an_edit_encodes_a_part_only():
    codec = Codec(tokenizer_path())
    tree = TokenTree(codec, b"some words of a long text " * 4000)
    tree.encoded = 0
    tree.edit(50_000, 3, b"new")
    assert 0 < tree.encoded < 2000


def test_short_texts_are_reused():
    codec = Codec(tokenizer_path())
    text = "A short text of a few words, which other documents have too. ".encode() * 5
    want = codec.encode(text)
    assert np.array_equal(want, codec.direct(text))
    before = codec.reused
    assert np.array_equal(codec.encode(text), want)
    assert codec.reused - before == len(text)


def test_boundaries_hold_in_any_context(library):
    """Encoding both sides of a boundary apart gives what encoding them together does; they are found in any script."""
    codec = Codec(tokenizer_path())
    r = random.Random(9)
    signs = "ab' 1.\u00a0\u3000。，漢é\u0301\u200b\x1c\x85½Ⅷ٣\n\t!’🙂"
    for _ in range(300):
        s = "".join(r.choice(signs) for _ in range(r.randint(1, 30)))
        data, at = s.encode(), 1
        seen = []
        while (k := boundary(data, at)) > 0:
            assert library(s) == library(data[:k].decode()) + library(data[k:].decode())
            seen.append(k)
            at = k + 1
        back, at = [], len(data) - 1
        while at > 0 and (k := boundary(data, at, ahead=False)) > 0:
            back.append(k)
            at = k - 1
        assert back[::-1] == seen
    chinese = "".join(r.choice("这是一个段落没有空格文本里的许多汉字") if r.random() < 0.9 else r.choice("，。") for _ in range(8000))
    assert codec.encode(chinese.encode()).tolist() == library(chinese)
    codec.encode(("前" + chinese).encode())
    assert codec.reused > 0.7 * len(chinese.encode())
    assert boundary(b"x" * 5000, 1) == boundary("é".encode()[1:], 1) == -1
    tree = TokenTree(codec, chinese.encode())
    assert len(tree.runs) > 40
    tree.encoded = 0
    tree.edit(6000, 3, "新".encode())
    assert 0 < tree.encoded < 2000


def test_seams_without_boundaries_are_linear():
    codec = Codec(tokenizer_path(), bits=6)
    data = b"xyz" * 300_000
    assert np.array_equal(codec.encode(data), codec.direct(data))


def test_stored_trees_take_edits(spark, library):
    """Edits of stored trees encode what they touch, give the right counts and texts, and further edits can follow."""
    r = random.Random(11)
    texts = {i: noise(r) * r.randint(1, 30) for i in range(20)} | {20: "some words of a long text " * 4000}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(3, "another text of the id", "x"), (None, "no id", "x"), (3, texts[3], "x"), (50, None, "x")], "doc_id long, text string, n_tokens string")
    trees = build_trees(docs)
    assert {x.text_key: x.n_tokens for x in trees.collect() if x.doc_id == 20}.popitem()[1] == len(library(texts[20]))
    for limit in (None, 0):
        now, state = docs, trees
        want = {k: [texts.get(k) or ""] for k in (2, 20, 50)} | {3: [texts[3], texts[3], "another text of the id"]}
        for turn in range(2):
            edits = [(i, s, r.randint(0, 2000), r.randint(0, 9), r.choice(["new ", "é", "", "<|endoftext|>"]).encode()) for i in want for s in range(3)] + [(None, 0, 0, 1, b""), (77, 0, 0, 1, b"")]
            if turn:
                edits = edits[2:] + edits[:2]
            got = apply_edits(now, state, spark.createDataFrame(edits, "doc_id long, seq long, at long, delete long, insert binary"), limit=limit).collect()
            for i, old in want.items():
                for e in sorted(x[1:] for x in edits if x[0] == i):
                    old = [edited(t.encode(), *e[1:]).decode() for t in old]
                want[i] = old
            assert sorted((x.doc_id, x.text, x.n_tokens) for x in got) == sorted((i, t, len(library(t))) for i, ts in want.items() for t in ts)
            assert all(sum(x.sizes) == len(x.text.encode()) and sum(x.counts) == x.n_tokens for x in got)
            assert max(x.reencoded_bytes for x in got if x.doc_id == 20) < 4000
            now = spark.createDataFrame([(x.doc_id, x.text) for x in got], "doc_id long, text string")
            state = build_trees(now)
    assert apply_edits(docs, trees, spark.createDataFrame([], "doc_id long, seq long, at long, delete long, insert binary")).collect() == []
