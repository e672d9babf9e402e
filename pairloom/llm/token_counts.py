"""Edit-aware token counts: a segment tree of pre-token runs per document, stored as a table.

A document's leaves are runs of whole pre-tokens of about 256 bytes, each beginning at a boundary (see
``bpe``) that lies within no special token. The tree holds the sums of bytes and of tokens of its subtrees. An edit finds
the leaves it touches by descending the byte sums, takes in the neighbours (context) until both ends of the region
are boundaries of the edited text too, encodes that region alone, and updates the sums above it. A leaf that has grown
to four times its size is split, and the sums are formed anew, without encoding.

``build_trees`` stores a row per document with the bytes and tokens of its leaves, from which the sums follow by
addition. ``apply_edits`` brings documents, stored trees and a table of edits together, streams each document's
edits through its tree in order, and returns the trees after them, so further edits can follow.

Nulls and edges: a null text counts as empty (0 tokens); positions beyond the end mean the end; edits
that cut a character are widened to whole characters; null fields of an edit are 0 or empty; texts of any length are
counted whole, and any number of edits of one document is applied in one stream; documents that repeat an id are told
apart by their texts, and an edit of the id applies to all; an edit that equals the one before it, seq included, is the same and counts once; edits of unknown or null ids have no effect; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Codec, _bytes, _mapped, boundary, certain, codec
from .common import in_arrow, join_small, text_of, tokenizer_path, written

LEAF_BYTES = 256


class TokenTree:
    """Token counts of one text under edits of its UTF-8 bytes."""

    def __init__(self, codec: Codec, data: bytes, leaf_bytes: int = LEAF_BYTES, sizes: list[int] | None = None, counts: list[int] | None = None):
        """With ``sizes`` and ``counts`` of the leaves, as they were stored, nothing is encoded."""
        self.codec, self.leaf_bytes, self.encoded = codec, leaf_bytes, 0
        if sizes is not None and counts is not None and sum(sizes) == len(data) and len(sizes) == len(counts):
            ends = [0]
            for n in sizes:
                ends.append(ends[-1] + n)
            self._build([data[a:b] for a, b in zip(ends, ends[1:])], list(counts))
        else:
            runs = self._runs(data)
            self._build(runs, [self._count(r) for r in runs])

    def _runs(self, data: bytes) -> list[bytes]:
        """``data`` cut at the first boundary after every ``leaf_bytes``."""
        runs, start = [], 0
        while len(data) - start > self.leaf_bytes:
            k = boundary(data, start + self.leaf_bytes, apart=self.codec.apart)
            if k < 0:
                break
            runs.append(data[start:k])
            start = k
        return [*runs, data[start:]]

    def _count(self, data: bytes) -> int:
        self.encoded += len(data)
        return sum(1 if isinstance(x, int) else len(self.codec.direct(x)) for x in self.codec.parts(data))

    def _build(self, runs: list[bytes], counts: list[int]) -> None:
        self.runs = runs
        self.width = 1 << max(0, (len(runs) - 1).bit_length())
        self.size, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        self.size[self.width : self.width + len(runs)] = map(len, runs)
        self.tokens[self.width : self.width + len(runs)] = counts
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.size[i] = self.size[2 * i] + self.size[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_bytes(self) -> int:
        return self.size[1]

    @property
    def counts(self) -> list[int]:
        return self.tokens[self.width : self.width + len(self.runs)]

    def text(self) -> bytes:
        return b"".join(self.runs)

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds byte ``at``, and the offset in it."""
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.size[i] and self.size[i + 1]:
                at -= self.size[i]
                i += 1
        return i - self.width, at

    def edit(self, at: int, delete: int, insert: bytes) -> None:
        """Replaces ``delete`` bytes at ``at`` by ``insert``."""
        at = min(max(0, at), self.n_bytes)
        end = min(at + max(0, delete), self.n_bytes)
        first, a = self._leaf(at)
        last, b = self._leaf(end)
        b += sum(map(len, self.runs[first:last]))
        old = b"".join(self.runs[first : last + 1])
        while a > 0 and a < len(old) and old[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(old) and old[b] & 0xC0 == 0x80:
            b += 1
        # context: until each end is a boundary of the edited text, or an end of it
        head, tail = [old[:a] + insert + old[b:]], []
        while first > 0 and not self._apart(self._before(first), b"".join(head) or self._after(last)):
            first -= 1
            head.insert(0, self.runs[first])
        new = b"".join(head)
        while last + 1 < len(self.runs) and not self._apart(tail[-1] if tail else new or self._before(first), self._after(last)):
            last += 1
            if self.runs[last]:
                tail.append(self.runs[last])
        new += b"".join(tail)
        room = last - first + 1
        pieces = self._runs(new) if len(new) > 4 * self.leaf_bytes * room or room > 1 else [new]
        if len(pieces) > room:
            counts = [self._count(p) for p in pieces]
            own = self.counts
            self._build([*self.runs[:first], *pieces, *self.runs[last + 1 :]], [*own[:first], *counts, *own[last + 1 :]])
            return
        for k in range(room):
            run = pieces[k] if k < len(pieces) else b""
            i = self.width + first + k
            self.runs[first + k] = run
            self.size[i], self.tokens[i] = len(run), self._count(run)
            while i > 1:
                i //= 2
                self._sum(i)

    def _before(self, leaf: int) -> bytes:
        """The last characters before a leaf."""
        while leaf > 0:
            leaf -= 1
            if self.runs[leaf]:
                return self.runs[leaf][-4:]
        return b""

    def _after(self, leaf: int) -> bytes:
        """The first characters after a leaf."""
        while leaf + 1 < len(self.runs):
            leaf += 1
            if self.runs[leaf]:
                return self.runs[leaf][:4]
        return b""

    def _apart(self, before: bytes, after: bytes) -> bool:
        """Whether a boundary lies between; also where there is nothing on one side."""
        a, b = before[-4:].decode("utf-8", "ignore")[-1:], after[:4].decode("utf-8", "ignore")[:1]
        return not a or not b or certain(a, b) and a + b not in self.codec.apart


#: What the query's edits put into a text, by turns.
INSERTS = (b" revised", b"", "é".encode(), b"\n\n", b" the", b"X")


def standing_edits(data: bytes, n: int = 3) -> Iterable[tuple[int, int, bytes]]:
    """``n`` edits that follow from the text alone: places, deleted bytes and inserts from its digest."""
    d = hashlib.sha256(data).digest()
    for k in range(n):
        place, cut, what = int.from_bytes(d[4 * k : 4 * k + 4], "little"), d[16 + k] % 24, d[24 + k] % len(INSERTS)
        yield place % (len(data) + 1), cut, INSERTS[what]


def edited(data: bytes, at: int, delete: int, insert: bytes) -> bytes:
    """The bytes after one edit: the plain definition, for tests and for those who keep the text."""
    at = min(max(0, at), len(data))
    end = min(at + max(0, delete), len(data))
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    while end < len(data) and data[end] & 0xC0 == 0x80:
        end += 1
    return data[:at] + insert + data[end:]


def _key(text_col: str) -> F.Column:
    """What tells documents of one id apart."""
    return F.substring(F.sha2(text_of(text_col), 256), 1, 32)


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf_bytes: int = LEAF_BYTES, path: str | None = None) -> DataFrame:
    """id_col, text_key string, n_tokens long, sizes and counts array<int> (bytes and tokens of the leaves); one row per document."""

    def row(own: Codec, x: tuple) -> tuple:
        tree = TokenTree(own, _bytes(x[0]), leaf_bytes)
        return x[1].as_py(), tree.n_tokens, list(map(len, tree.runs)), tree.counts

    keyed = docs.select(F.col(id_col), F.col(text_col), _key(text_col).alias("text_key"))
    return _mapped(keyed, [id_col, text_col, "text_key"], "text_key string, n_tokens long, sizes array<int>, counts array<int>", row, path)


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int | None = None) -> DataFrame:
    """Applies ``edits`` (id_col, seq, at, delete, insert) in the order of seq to the documents that they name.

    ``docs`` and ``trees`` (of ``build_trees``) hold the state before. Returns a row per edited document: id_col, text_key,
    text (after), n_tokens, sizes, counts (the tree after), n_tokens_before, n_leaves_before, reencoded_bytes.
    Where few documents are edited, only these are shuffled.
    """
    touched = written(edits.filter(F.col(id_col).isNotNull()).select(id_col).distinct(), "touched")
    keys = join_small(trees.select(id_col, "text_key"), touched, [id_col], "left_semi", ["text_key"], limit)
    keyed = edits.join(keys.distinct(), id_col)
    if touched.count() <= MANY if limit is None else limit:
        docs, trees = (x.join(F.broadcast(touched), id_col, "left_semi") for x in (docs, trees))
    return stream_edits(docs, trees, keyed, id_col, text_col, path)


#: Edited documents up to which ``apply_edits`` sifts the documents by a broadcast of their ids.
MANY = 100_000


def stream_edits(docs: DataFrame, trees: DataFrame, keyed: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, texts: bool = True) -> DataFrame:
    """As ``apply_edits``, with edits that have their document's text_key; ``texts`` says whether texts are returned.

    A document, its tree and its edits come in this order in one sorted stream; beside the batch, one document is held.
    """
    path = path or tokenizer_path()
    kind_of_id = docs.schema[id_col].dataType.simpleString()
    none = {"seq": "long", "at": "long", "delete": "long", "data": "binary", "sizes": "array<int>", "counts": "array<int>"}

    def row(df: DataFrame, kind: int, key: F.Column, **has: F.Column) -> DataFrame:
        return df.select(F.col(id_col).alias("id"), key.alias("text_key"), F.lit(kind).alias("kind"), *(has.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items()))

    rows = row(docs, 0, _key(text_col), data=text_of(text_col))
    rows = rows.unionByName(row(trees, 1, F.col("text_key"), sizes=F.col("sizes"), counts=F.col("counts")))
    rows = rows.unionByName(row(keyed, 2, F.col("text_key"), seq=F.col("seq"), at=F.col("at"), delete=F.col("delete"), data=F.col("insert")))
    rows = rows.repartition("text_key", "id").sortWithinPartitions("text_key", "id", "kind", "seq", "at", "delete")
    names = [id_col, "text_key", "text", "n_tokens", "sizes", "counts", "n_tokens_before", "n_leaves_before", "n_bytes", "reencoded_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at, data, copies, tree, before, last, out, held = codec(path), None, b"", 0, None, None, None, [], 0
        kinds: list[pa.DataType] = []

        def done() -> int:
            if before is None or not copies:
                return 0
            text = tree.text() if texts else None
            out.extend([(*at, None if text is None else text.decode(), tree.n_tokens, list(map(len, tree.runs)) if texts else None, tree.counts if texts else None, *before, tree.n_bytes, tree.encoded)] * copies)
            return (len(text or b"") + 500) * copies

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for b in batches:
            kinds = [b.schema.field(0).type, pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 4]
            for k in range(b.num_rows):
                here = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                if here != at:
                    held += done()
                    at, data, copies, tree, before, last = here, b"", 0, None, None, None
                    if held > 4 << 20:
                        yield batch()
                        out, held = [], 0
                what = b.column(2)[k].as_py()
                if what == 0:
                    data, copies = _bytes(b.column(6)[k]), copies + 1
                elif what == 1:
                    tree = tree or TokenTree(own, data, LEAF_BYTES, b.column(7)[k].as_py(), b.column(8)[k].as_py())
                elif copies:
                    tree = tree or TokenTree(own, data)
                    before = before or (tree.n_tokens, len(tree.runs))
                    edit = b.column(3)[k].as_py(), b.column(4)[k].as_py() or 0, b.column(5)[k].as_py() or 0, _bytes(b.column(6)[k])
                    if edit != last:
                        tree.edit(*edit[1:])
                    last = edit
        done()
        if out:
            yield batch()

    schema = f"`{id_col}` {kind_of_id}, text_key string, text string, n_tokens long, sizes array<int>, counts array<int>, n_tokens_before long, n_leaves_before long, n_bytes long, reencoded_bytes long"
    return in_arrow(rows, run, schema)


def count_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 3, path: str | None = None) -> DataFrame:
    """id_col, n_tokens long, n_leaves long, n_tokens_edited long, n_bytes_edited long, reencoded_bytes long.

    Stores the trees of all documents, makes a table of each text's standing edits, and applies it to the stored trees;
    reencoded_bytes tells how many bytes the edits made it encode again.
    """
    trees = written(build_trees(docs, id_col, text_col, path=path), "trees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where, rows = [], []
            for k, x in enumerate(b.column(2)):
                for seq, e in enumerate(standing_edits(_bytes(x), edits)):
                    where.append(k)
                    rows.append((seq, *e))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(where, pa.int64())) for i in (0, 1)), *map(pa.array, columns, kinds)], [id_col, "text_key", "seq", "at", "delete", "insert"])

    kind = docs.schema[id_col].dataType.simpleString()
    once = docs.select(F.col(id_col), _key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    table = in_arrow(once, run, f"`{id_col}` {kind}, text_key string, seq long, at long, delete long, insert binary")
    out = stream_edits(docs, trees, table, id_col, text_col, path, texts=False)
    return out.select(id_col, F.col("n_tokens_before").alias("n_tokens"), F.col("n_leaves_before").alias("n_leaves"), F.col("n_tokens").alias("n_tokens_edited"), F.col("n_bytes").alias("n_bytes_edited"), "reencoded_bytes")
