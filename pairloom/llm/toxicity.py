"""Toxicity by a factorization machine over hashed terms.

Terms are words and their beginnings and ends (inflected insults share these), hashed to 24 bits; that a text
has one twice or three times are terms of their own. The machine adds to a bias and a weight per term the inner products of the terms' factors,
for every pair of terms in a text: a pair such as an insult and the mention of a group can score
although neither does alone, which linear weights cannot say.

It is fitted on the driver, over terms that tell the classes apart in the sample, on a sample of labelled
rows bounded by ``SAMPLE`` rows and ``HELD`` terms; scoring is one pass over all whole texts without a shuffle, with the model (at most
``TERMS`` terms) as a broadcast of bounded size.

Nulls and edges: null and empty texts have no terms and the score of the bias; null labels and labels without a
document are not learned from; a document labelled twice takes the larger label; a null id is not held out and
not learned from; without labels, or with one class only, the score is the share of that class; repeated rows
are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, written
from .words import Spans, batched, mapping, windows

#: Labelled rows that are learned from at most: those with the lowest hash of the id.
SAMPLE = 60_000
#: Terms that the machine knows at most, and how far (in standard deviations) a term's share must differ.
TERMS, SIGMAS, LEAST_ROWS = 8_192, 3.0, 2
#: REPEATS, BEGIN and END had the best area under the curve in a three-fold cross-validation over rows of 4,000 that may be learned
#: from; SIGMAS and EPOCHS the best sum of area and precision over tables of 87, 400 and 4,000 labels.
BITS, FACTORS, EPOCHS, RATE, L2 = 24, 4, 20, 0.1, 1e-5
#: Terms of the sample's rows, all together, that the driver takes at most (4 bytes each); of longer rows, fewer are taken.
HELD = 4_000_000
THRESHOLD = 0.3
_TABLE = mapping(also_space=bytes(b for b in range(33, 127) if not chr(b).isalnum()) + bytes(range(9)) + bytes(range(14, 32)))
#: Occurrences of a term in a text up to this number are told apart; a term's number is hash * 4 + occurrences - 1.
REPEATS = 3
#: Bytes of a word's beginning and end that are terms of their own.
BEGIN, END = (4, 6), (5,)


def _terms(s: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Places of words and the hashes of their terms, for one window."""
    where, out = [s.start], [s.hash(s.start, s.end)]
    length = s.end - s.start
    for kind, sizes in ((1, BEGIN), (2, END)):
        for n in sizes:
            long = np.flatnonzero(length > n)
            a = s.start[long] if kind == 1 else s.end[long] - n
            where.append(s.start[long])
            out.append(s.hash(a, a + n) * np.uint64(2 * n + kind | 1))
    return np.concatenate(where), (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int32)


def _leveled(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes, times 4, and again with 1 or 2 added where a hash is there twice or three times."""
    u, n = np.unique(hashes, return_counts=True)
    return np.sort(np.concatenate([u[n > k] * 4 + k for k in range(REPEATS)]))


def text_terms(texts: list[bytes | None], known: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The distinct terms of each text; with ``known`` (a bit per hash) only those of these hashes."""
    for group, joined in batched(texts, _TABLE):
        if len(group) == 1:
            ids = np.concatenate([x if known is None else x[known[x]] for x in (_terms(Spans(w))[1] for w in windows(joined))])
            yield _leveled(ids)
            continue
        where, ids = _terms(Spans(joined))
        if known is not None:
            use = known[ids]
            where, ids = where[use], ids[use]
        edges = np.cumsum([len(texts[i] or b"") + 1 for i in group])
        both = _leveled(np.searchsorted(edges, where, side="right").astype(np.int64) << BITS | ids)
        cut = np.searchsorted(both, np.arange(1, len(group) + 1, dtype=np.int64) << BITS + 2)
        a = 0
        for b in cut.tolist():
            yield (both[a:b] & ((1 << BITS + 2) - 1)).astype(np.int32)
            a = b


def hash_bits(terms: np.ndarray) -> np.ndarray:
    """For each hash whether it is that of a term."""
    bits = np.zeros(1 << BITS, bool)
    bits[terms >> 2] = True
    return bits


def among(ids: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The ``ids`` that are in ``terms`` (sorted)."""
    k = np.minimum(np.searchsorted(terms, ids), len(terms) - 1)
    return ids[terms[k] == ids] if len(terms) else ids[:0]


@dataclass
class Machine:
    """bias, and for each known term (sorted) a weight and factors."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, ids: np.ndarray) -> float:
        k = np.searchsorted(self.terms, among(ids, self.terms))
        v = self.factors[k]
        z = self.bias + float(self.weights[k].sum()) + 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by adaptive gradients over small batches; ``rows`` hold some of ``terms`` (sorted)."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    bias, w = float(np.log(share / (1 - share))), np.zeros(len(terms))
    v = rng.normal(0, 0.02, (len(terms), FACTORS))
    if not len(terms) or labels.min() == labels.max():
        return Machine(bias, terms, w, v)
    flat = np.searchsorted(terms, np.concatenate(rows)).astype(np.int32) if rows else np.empty(0, np.int32)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    gw, gv, gb = np.full(len(terms), 1e-6), np.full((len(terms), FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 512):
            batch = order[at : at + 512]
            n = starts[batch + 1] - starts[batch]
            doc = np.repeat(np.arange(len(batch)), n)
            ids = flat[np.repeat(starts[batch] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
            x = v[ids]
            sums = np.stack([np.bincount(doc, x[:, f], len(batch)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(doc, (x * x).sum(axis=1), len(batch))
            z = bias + np.bincount(doc, w[ids], len(batch)) + 0.5 * ((sums * sums).sum(axis=1) - squares)
            loss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) / len(batch)
            each = loss[doc]
            d = np.bincount(ids, each, len(terms)) + L2 * w
            gw += d * d
            w -= RATE * d / np.sqrt(gw)
            pull = each[:, None] * (sums[doc] - x)
            for f in range(FACTORS):
                d = np.bincount(ids, pull[:, f], len(terms)) + L2 * v[:, f]
                gv[:, f] += d * d
                v[:, f] -= RATE * d / np.sqrt(gv[:, f])
            d = loss.sum()
            gb += d * d
            bias -= RATE * d / np.sqrt(gb)
    return Machine(float(bias), terms, w, v)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text has remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, held: int = HELD
) -> Machine:
    spark = docs.sparkSession
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y")).withColumn("_h", F.xxhash64("_id"))
    known = written(known.orderBy("_h", "_id").limit(sample), "known")  # the documented bound of the sample
    rows = docs.join(F.broadcast(known), docs[id_col] == known["_id"]).select(known["_y"], docs[text_col].cast("binary").alias("text"), known["_h"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            ids, of = [], []
            for k, t in enumerate(text_terms(b.column(1).to_pylist())):
                ids.append(t)
                of.append(np.full(len(t), y[k] > 0))
            if not ids:
                continue
            ids, of = np.concatenate(ids), np.concatenate(of)
            u, at = np.unique(ids, return_inverse=True)
            n, n1 = np.bincount(at, minlength=len(u)), np.bincount(at, of, len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64)), pa.array(n1)], ["term", "n", "n1"])

    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("_y") > 0).cast("int")), F.lit(0)).alias("n1")).first()
    n, n1 = size["n"], size["n1"]
    p = n1 / max(1, n)
    off = F.greatest(F.abs(F.col("n1") - p * F.col("n")) - 0.5, F.lit(0.0))  # corrected for continuity: two rows tell little
    z = off / F.sqrt(F.col("n") * (p * (1 - p) + 1e-9))
    counts = in_arrow(rows, counted, "term int, n long, n1 long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    chosen = counts.filter(F.col("n") >= LEAST_ROWS).withColumn("z", z).filter(F.col("z") >= SIGMAS)
    terms = np.array(sorted(r["term"] for r in chosen.orderBy(F.desc("z"), "term").limit(TERMS).collect()), np.int32)
    shared = spark.sparkContext.broadcast(terms)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bits = shared.value, hash_bits(shared.value)
        for b in batches:
            ids = [among(t, own).tobytes() for t in text_terms(b.column(1).to_pylist(), bits)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), b.column(2)], ["y", "ids", "h"])

    own = written(in_arrow(rows, found, "y int, ids binary, h long"), "terms")
    total = (own.agg(F.sum(F.length("ids"))).first()[0] or 0) // 4
    if total > held:
        own = own.filter(F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < F.lit(int((1 << 20) * held / total)))
    own = own.select("y", "ids").toArrow()
    y = own["y"].to_numpy() > 0
    data = [np.frombuffer(x.as_buffer(), np.int32) for x in own["ids"]]
    order = sorted(range(len(data)), key=lambda i: (y[i], data[i].tobytes()))  # whatever the order in which rows came
    return fit([data[i] for i in order], y[order].astype(float), terms)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id_col, held_out, score double, predicted int: one row per document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        bits = hash_bits(own.terms)
        for b in batches:
            scores = [own.score(t) for t in text_terms(b.column(2).to_pylist(), bits)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], [id_col, "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    return in_arrow(rows, run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        bits = hash_bits(own.terms)
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            keep = [own.score(t) < threshold for t in text_terms(texts, bits)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return in_arrow(docs, run, docs.schema)
