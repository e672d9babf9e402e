"""Exact de-duplication with static binary-fuse filters per immutable snapshot.

A snapshot (what the corpus holds already) is reduced once to one row per digest and to one
binary-fuse filter per digest bucket (Graf and Lemire, "Binary Fuse Filters", 2022), which are stored and
serve all later batches. A batch of incoming rows is grouped by digest on its own, its digests stream past the filter
of their bucket (in parts, where the batch is the larger), and only the positives join the snapshot's exact buckets. Groups of more than one row are
checked byte by byte (least and greatest text of a digest are equal), and should two texts ever
share a digest, their rows are grouped by the texts themselves.

Nulls and edges: a null text counts as empty; a null id is lower than all others; rows that repeat
an id and a text form a group in which exactly one row is kept; empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, join_small, small_batches, text_of, written

#: Digests in one filter, on average.
KEYS_PER_FILTER = 20_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    for m in (_M1, _M2):
        h = (h ^ (h >> np.uint64(33))) * m
    return h ^ (h >> np.uint64(33))


class BinaryFuse:
    """A static three-way binary-fuse filter with 8-bit fingerprints over 64-bit keys."""

    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray):
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    @staticmethod
    def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _prints(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        """Peels the keys in rounds: all slots with one key left go at once; a new seed if stuck."""
        keys = np.unique(keys.astype(np.uint64))
        n = max(2, len(keys))
        segment = min(1 << 18, 1 << int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
        room = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)))
        segments = max(1, -(-room // segment) - 2)
        size = (segments + 2) * segment
        seed = 0
        while True:
            seed += 1
            h = _mixed(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
            slots = cls._slots(h, segment, segments)
            count = np.bincount(slots.ravel(), minlength=size)
            owner = np.zeros(size, np.int64)  # sum of the numbers of a slot's keys: with one left, its number
            for row in slots:
                np.add.at(owner, row, np.arange(len(keys)))
            order, left = [], len(keys)
            while True:
                single = np.flatnonzero(count == 1)
                if not len(single):
                    break
                k, at = np.unique(owner[single], return_index=True)
                order.append((k, single[at]))
                left -= len(k)
                for row in slots[:, k]:
                    np.subtract.at(count, row, 1)
                    np.subtract.at(owner, row, k)
            if not left:
                break
        table, prints = np.zeros(size, np.uint8), cls._prints(h)
        for k, at in reversed(order):
            s = slots[:, k]
            table[at] = 0
            table[at] = prints[k] ^ table[s[0]] ^ table[s[1]] ^ table[s[2]]
        return cls(seed, segment, segments, table)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mixed(keys.astype(np.uint64), self.seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
        a, b, c = self._slots(h, self.segment, self.segments)
        return (self.table[a] ^ self.table[b] ^ self.table[c]) == self._prints(h)

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.segments], "<i8").tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> BinaryFuse:
        seed, segment, segments = (int(x) for x in np.frombuffer(data[:24], "<i8"))
        return cls(seed, segment, segments, np.frombuffer(data[24:], np.uint8))


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def build_filters(digests: DataFrame) -> DataFrame:
    """One filter per bucket of ``digests`` (bucket int, h64 long): (bucket int, filter binary)."""

    def built(key: tuple, rows: pa.Table) -> pa.Table:
        data = BinaryFuse.build(_keys(rows["h64"])).to_bytes()
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([data], pa.binary())})

    small_batches(digests.sparkSession)
    return digests.select("bucket", "h64").groupBy("bucket").applyInArrow(built, "bucket int, filter binary")


def screen(digests: DataFrame, filters: DataFrame, parts: int = 1) -> DataFrame:
    """Of ``digests`` (digest, bucket, h64) the digests that the filter of their bucket lets pass: possible members.

    The digests of a bucket are dealt into ``parts``; to each goes a copy of the filter, past which they stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for b in batches:
            where, keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)), b.column(3).fill_null(0).to_numpy().view(np.uint64)
            ok = np.zeros(b.num_rows, bool)
            first = 0
            for i in [k for k in range(b.num_rows) if b.column(4)[k].is_valid] + [b.num_rows]:
                _passed(ok, keys, where, first, i, at, own)
                if i < b.num_rows:
                    at, own, first = where[i], BinaryFuse.from_bytes(b.column(4)[i].as_py()), i + 1
            yield pa.RecordBatch.from_arrays([b.column(2)], ["digest"]).filter(pa.array(ok))

    own = digests.select("bucket", F.pmod(F.hash("digest", F.lit("part")), F.lit(parts)).alias("part"), "digest", "h64", F.lit(None).cast("binary").alias("filter"))
    copies = filters.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("h64"), "filter")
    rows = copies.unionByName(own).repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.col("digest").asc_nulls_first())
    return in_arrow(rows, run, "digest string")


def _passed(ok: np.ndarray, keys: np.ndarray, where: list[tuple], first: int, end: int, at: tuple | None, own: BinaryFuse | None) -> None:
    """Marks the keys from ``first`` to ``end`` that the filter of the place ``at`` holds; those of other places have no filter."""
    while end > first and where[end - 1] != at:
        end -= 1
    if own is not None and end > first:
        ok[first:end] = own.contains(keys[first:end])


@dataclass
class Snapshot:
    """What is stored of a snapshot: (digest, top, n, h64) per digest, and (bucket, filter) with ``buckets`` buckets."""

    digests: DataFrame
    filters: DataFrame
    buckets: int


def _numbered(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], row: Column, *more: Column) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), row.alias("row"), digest(text).alias("digest"), F.sha2(text, 256).alias("text_sha256"), *more)


def _grouped(part: DataFrame) -> DataFrame:
    return part.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n")).withColumn("h64", F.xxhash64("digest"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash("digest"), F.lit(buckets)).alias("bucket")


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _stored(df: DataFrame, path: str | None, name: str) -> DataFrame:
    if path is None:
        return written(df, name)
    df.write.parquet(f"{path}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")


def _reduced(rows: DataFrame, path: str | None = None) -> Snapshot:
    digests = _stored(_grouped(rows), path, "digests")
    buckets = 1 << max(0, math.ceil(math.log2(max(1, digests.count()) / KEYS_PER_FILTER)))
    filters = build_filters(digests.select("digest", _bucket(buckets), "h64")).withColumn("buckets", F.lit(buckets))
    return Snapshot(digests, _stored(filters, path, "filters"), buckets)


def take_snapshot(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = _sha256) -> Snapshot:
    """Stores the digests and filters of ``docs`` under ``path``, once and for all batches to come."""
    return _reduced(_numbered(docs, id_col, text_col, digest, F.monotonically_increasing_id()), path)


def open_snapshot(spark: SparkSession, path: str) -> Snapshot:
    digests, filters = spark.read.parquet(f"{path}/digests"), spark.read.parquet(f"{path}/filters")
    return Snapshot(digests, filters, filters.agg(F.coalesce(F.max("buckets"), F.lit(1))).first()[0])


def _meeting(new: DataFrame, held: Snapshot) -> DataFrame:
    """Groups of the batch (written: digest, top, n, h64) with old_top, old_n of the snapshot's group of that digest, if there is one."""
    parts = max(1, math.ceil(new.count() / (held.buckets * KEYS_PER_FILTER)))
    passed = screen(new.select("digest", _bucket(held.buckets), "h64"), held.filters, parts).withColumn("screened", F.lit(True))
    tops = new.select("digest", F.col("top").alias("new_top"), F.col("n").alias("new_n")).join(passed, "digest", "left")
    tops = written(tops, "screened")
    # positives meet the exact buckets; all other batch groups are new
    exact = held.digests.select("digest", F.col("top").alias("old_top"), F.col("n").alias("old_n"))
    met = tops.filter("screened").join(exact, "digest", "left").drop("screened")
    return written(met.unionByName(tops.filter("screened is null").drop("screened"), allowMissingColumns=True), "met")


def _checked(rows: DataFrame, texts: DataFrame, groups: DataFrame, id_col: str, limit: int | None) -> DataFrame:
    """One row per row of ``rows``, by its group (digest, top, n), which is checked byte by byte over ``texts`` (id, row, text, digest, mine)."""
    groups = written(groups.filter("n > 1"), "groups")
    # byte check of every group: its least and greatest text are the same
    ends = join_small(texts.select("digest", "text"), groups.select("digest"), ["digest"], "left_semi", ["text"], limit)
    ends = ends.groupBy("digest").agg((F.min("text") != F.max("text")).alias("mixed"))
    mixed = written(ends.filter("mixed").select("digest"), "collisions")
    clashes = mixed.count() > 0
    if clashes:
        groups = groups.join(mixed, "digest", "left_anti")
    out = join_small(rows, groups, ["digest"], "left", ["id", "row"], limit).select("id", "row", "digest", "text_sha256", "top", "n")
    if clashes:  # two texts share a digest: their rows are grouped by the text itself
        split = written(texts.join(mixed, "digest", "left_semi"), "split")
        own = split.groupBy("text").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n"))
        split = split.filter("mine").join(own, "text").select("id", "row", "digest", F.sha2("text", 256).alias("text_sha256"), "top", "n")
        out = out.join(mixed, "digest", "left_anti").unionByName(split)
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.struct("id", "row") == F.col("top"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def _joint(joined: DataFrame) -> DataFrame:
    """Groups over batch and snapshot."""
    return joined.select("digest", F.greatest("new_top", "old_top").alias("top"), (F.col("new_n") + F.coalesce("old_n", F.lit(0))).alias("n"))


def dedup_batch(
    batch: DataFrame, held: Snapshot, held_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = _sha256, limit: int | None = None
) -> DataFrame:
    """One row per row of ``batch``, as of ``exact_dedup``, over the batch and a stored snapshot.

    The row with the largest id of a group stays, be it in the batch or in the snapshot (there, if both have that id).
    ``held_docs`` are the snapshot's documents; they are read for the byte check only.
    """
    rows = written(_numbered(batch, id_col, text_col, digest, -1 - F.monotonically_increasing_id()), "digests")
    joined = _meeting(written(_grouped(rows), "batch"), held)

    def texts(docs: DataFrame, row: Column, mine: bool) -> DataFrame:
        text = text_of(text_col)
        return docs.select(F.col(id_col).alias("id"), row.alias("row"), text.alias("text"), digest(text).alias("digest"), F.lit(mine).alias("mine"))

    both = texts(batch, -1 - F.monotonically_increasing_id(), True).unionByName(texts(held_docs, F.monotonically_increasing_id(), False))
    return _checked(rows, both, _joint(joined), id_col, limit)


def exact_dedup(
    docs: DataFrame, in_snapshot: Column, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = _sha256, limit: int | None = None
) -> DataFrame:
    """Groups equal texts of snapshot and incoming rows; the row with the largest id of a group stays.

    Returns one row per input row: id_col, keep_id, group_size long, kept boolean, text_sha256. ``in_snapshot`` says which
    rows are the snapshot. ``digest`` is replaced only by tests, to make collisions.
    """
    rows = written(_numbered(docs, id_col, text_col, digest, F.monotonically_increasing_id(), F.coalesce(in_snapshot, F.lit(False)).alias("old")), "digests")
    held = _reduced(rows.filter("old"))
    joined = _meeting(written(_grouped(rows.filter("not old")), "batch"), held)
    alone = held.digests.join(joined.filter("old_n is not null").select("digest"), "digest", "left_anti").select("digest", "top", "n")
    text = text_of(text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text.alias("text"), digest(text).alias("digest"), F.lit(True).alias("mine"))
    return _checked(rows, texts, _joint(joined).unionByName(alone), id_col, limit)


def half(id_col: str = "doc_id") -> Column:
    """The snapshot of the query: the half of the ids with an even hash, as if ingested before."""
    return F.pmod(F.xxhash64(id_col), F.lit(2)) == 0


def drop_copies(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops; columns and kept rows stay as they are.

    Only the ids and digests of what goes meet the documents, so no text is shuffled while these are few.
    """
    found = exact_dedup(docs, half(), limit=limit).filter("not kept")
    sha, name = "_pairloom_sha", "_pairloom_id"
    ident = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n"))
    gone = found.select(ident.alias(name), F.col("text_sha256").alias(sha), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("again"))
    gone = written(gone.distinct(), "gone")
    own = docs.withColumns({name: ident, sha: F.sha2(text_of(), 256)})
    out = join_small(own, gone.filter("not again").select(name, sha), [name, sha], "left_anti", ["text"], limit)
    again = gone.filter("again").select(name, sha)
    if len(again.head(1)):  # rows that repeat an id and its text: one of them stays
        once = join_small(out, again, [name, sha], "left_semi", ["text"], limit).dropDuplicates([name, sha])
        out = join_small(out, again, [name, sha], "left_anti", ["text"], limit).unionByName(once)
    return out.drop(name, sha)
