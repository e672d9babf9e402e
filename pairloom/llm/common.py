"""Helpers shared by the training-data operators: scratch tables and skew-safe joins."""

from __future__ import annotations

import atexit
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..batches import small_batches

#: Most rows that are ever broadcast; counted before each broadcast. With rows of about
#: 100 bytes this bounds a broadcast at some 10 MB, whatever the size of the corpus.
BROADCAST_ROWS = 100_000
#: Copies of the small side of a join that is too large to broadcast.
SALTS = 32
#: Rows of one key from which ``join_counted`` leaves them where they are.
HOT_ROWS = 100_000
#: A word, as the contracts define it: ASCII white space separates.
WORD = r"[^\x20\x09-\x0D]+"

_made: list[tuple[SparkSession, str]] = []
_local: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where none is named, and only in local mode, one for this application."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local.setdefault(spark.sparkContext.applicationId, f"/tmp/checkpoints/{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors.

    The table lasts until ``drop_scratch`` or the end of the driver's process.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/pairloom-{uuid.uuid4().hex}/{name}"
    _made.append((spark, path.rpartition("/")[0]))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """The number of scratch tables so far, for ``drop_scratch``."""
    return len(_made)


@atexit.register
def drop_scratch(since: int = 0, keep: int = 0) -> None:
    """Deletes the scratch tables made after the mark ``since``, but for the last ``keep``; results that read them must be stored first."""
    end = len(_made) - keep
    gone, _made[since:end] = _made[since:end], []
    for spark, path in gone:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended: the folder's owner clears it
            return


def let_go(spark: SparkSession) -> None:
    """Frees what the driver holds of steps that are over: broadcast tables, settings sent with each scan, listings, plans, shuffles.

    Python's handles of these lie in cycles, and Spark drops broadcasts and shuffle files only after the JVM has collected its
    garbage. In an operator of a hundred jobs neither happens in time, and the heap grows to its limit. Tables stay as they are.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str, spread: list[str], limit: int | None = None) -> DataFrame:
    """Joins a table whose keys may be hot with one that has each key once.

    ``small`` (a written table) is counted: up to ``limit`` rows it is broadcast; beyond, both
    sides are shuffled with a salt taken from ``spread`` of the big side, so that the rows of
    one hot key go to many tasks. ``how`` is inner, left, left_semi or left_anti.
    """
    if len(small.head(1)) == 0:
        if how in ("inner", "left_semi"):
            return big.limit(0) if how == "left_semi" else big.join(F.broadcast(small), on, how)
        return big if how == "left_anti" else big.join(F.broadcast(small), on, how)
    if small.count() <= (BROADCAST_ROWS if limit is None else limit):
        return big.join(F.broadcast(small), on, how)
    salted = big.withColumn("_pairloom_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_pairloom_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*on, "_pairloom_salt"], how).drop("_pairloom_salt")


def join_counted(big: DataFrame, keyed: DataFrame, on: str, most: int = HOT_ROWS) -> DataFrame:
    """Inner join with a written table of one row per key and ``n``, the rows that ``big`` has of it.

    Keys of more than ``most`` rows, of which there is one for so many rows at most, are broadcast, so that their
    rows stay where they are; the others are shuffled.
    """
    hot = keyed.filter(F.col("n") > most)
    rest = big.join(F.broadcast(hot.select(on)), on, "left_anti").join(keyed.filter(F.col("n") <= most), on)
    return big.join(F.broadcast(hot), on).unionByName(rest)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` in batches of at most BATCH_BYTES and one row."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file lies; the folder is a parameter (PAIRLOOM_TOKENIZERS)."""
    folder = os.environ.get("PAIRLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))
