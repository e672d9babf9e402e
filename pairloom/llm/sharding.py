"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

The items are groups of equal texts with the vector (bytes, tokens, rows). Each group goes where the
dot product of its vector with the shards' residual capacity is highest. Groups of at least 1/64 of a
shard in any dimension are few by arithmetic (at most 3 * 64 * shards); the driver places them first,
largest first. Only a group over a whole shard, which fits in none, is cut into pieces. All others are dealt by hash into cells of
about 4,000 groups; each cell is packed on its own, against its share of what the large groups leave, so
no task and no driver holds more than a cell.

Groups are told by the SHA-256 of their text.

Nulls and edges: a null text has no bytes (size 8) and is grouped with the empty text; null or repeated
ids are placed like any others; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, text_of, written

#: A group with at least this part of a shard, in any dimension, is placed by the driver.
HEAVY = 1 / 64
#: Pieces into which a group over a whole shard is cut.
PIECES = 256
GROUPS_PER_CELL = 4_000
ROWS_PER_SLOT_CELL = 40_000
#: Bytes count most: the law that the query states is that the shards' bytes are near equal.
WEIGHTS = np.array([6.0, 1.0, 1.0])
DIMENSIONS = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places items (n x 3), largest first, into shards with residual capacity ``room`` (shards x 3).

    Each goes to the shard where the dot product with the residual is highest. Returns the shard
    of each item, and what room is left. Both are in parts of the whole capacity.
    """
    room, where = room.copy(), np.empty(len(items), np.int64)
    weighted = items * WEIGHTS
    for i in np.lexsort((np.arange(len(items)), -items.max(axis=1))) if len(items) else ():
        s = int(np.argmax(room @ weighted[i]))
        room[s] -= items[i]
        where[i] = s
    return where, room


def shard(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", groups_per_cell: int = GROUPS_PER_CELL, rows_per_slot_cell: int = ROWS_PER_SLOT_CELL) -> DataFrame:
    """id_col, size, tokens, text_crc32, shard int, slot long (from 0, without gaps, in each shard)."""
    spark, text = docs.sparkSession, text_of(text_col)
    rows = written(
        docs.select(
            F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    sums = (F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = written(rows.groupBy("key").agg(*sums), "groups")
    total = groups.agg(*(F.sum(x).alias(x) for x in DIMENSIONS), F.count("*").alias("n")).first()
    whole = np.array([max(1, total[x] or 0) for x in DIMENSIONS], float)
    part = F.greatest(*(F.col(x) * float(n_shards / w) for x, w in zip(DIMENSIONS, whole, strict=True)))
    piece = F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("row"))), F.lit(PIECES)).cast("int").alias("piece")
    heavy = [r for r in groups.filter(part >= HEAVY).withColumn("part", part).collect()]
    split = [bytes(r["key"]) for r in heavy if r["part"] > 1]  # fewer than 3 * shards
    items = [(bytes(r["key"]), -1, [r[x] for x in DIMENSIONS]) for r in heavy if r["part"] <= 1]
    if split:
        pieces = rows.filter(F.col("key").isin(split)).groupBy("key", piece).agg(*sums).collect()
        items += [(bytes(r["key"]), r["piece"], [r[x] for x in DIMENSIONS]) for r in pieces]
    items.sort()
    where, room = pack(np.array([x[2] for x in items], float).reshape(-1, 3) / whole, np.full((n_shards, 3), 1 / n_shards))
    share = np.maximum(room, 0)
    share /= np.maximum(share.sum(axis=0), 1e-300)
    schema = "key binary, piece int, shard int"
    placed = spark.createDataFrame([(k, p, int(s)) for (k, p, _), s in zip(items, where, strict=True)], schema)
    cells = max(1, -(-total["n"] // groups_per_cell))

    def packed(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("key")
        v = cell[list(DIMENSIONS)].to_numpy(float)
        v /= np.maximum(v.sum(axis=0), 1)
        turn = int(cell["cell"].iloc[0]) * 7 % n_shards  # not the same shard is best off in each cell
        at, _ = pack(v, np.roll(share, -turn, axis=0))
        return pd.DataFrame({"key": cell["key"], "shard": ((at + turn) % n_shards).astype("int32")})

    light = groups.filter(part < HEAVY).withColumn("cell", F.pmod(F.hash("key"), F.lit(cells)))
    light = light.groupBy("cell").applyInPandas(packed, "key binary, shard int")
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.col("row")))  # rows without an id are dealt too
    of_heavy = rows.withColumn("piece", F.when(F.col("key").isin(split), piece).otherwise(F.lit(-1))) if split else rows.withColumn("piece", F.lit(-1))
    marked = of_heavy.join(F.broadcast(placed), ["key", "piece"], "left")
    slot_cells = max(1, -(-(total["rows"] or 0) // rows_per_slot_cell))
    keep = ["id", "size", "tokens", "text_crc32", "shard", "salt"]
    dealt = marked.filter("shard is not null").select(*keep).unionByName(marked.filter("shard is null").drop("shard").join(light, "key").select(*keep))
    dealt = written(dealt.withColumn("cell", F.pmod(F.xxhash64("id", "text_crc32", "salt"), F.lit(slot_cells)).cast("int")), "dealt")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "cell").count().select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cell").orderBy("id", "text_crc32")
    numbered = dealt.withColumn("nth", F.row_number().over(within) - 1).join(starts, ["shard", "cell"])
    return numbered.select(F.col("id").alias(id_col), "size", "tokens", "text_crc32", "shard", (F.col("start") + F.col("nth")).cast("long").alias("slot"))
