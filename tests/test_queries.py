"""Every registered query of the corpus operators against its SQL, on the smallest tables."""

from __future__ import annotations

import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from pairloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("documents", "conversations", "events", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, sql, name):
    got = catalogue.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = sql.sql(catalogue.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    mine = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    at = [want.columns.index(c) for c in columns]
    assert mine == sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nearest_holds_little(spark):
    """A block of queries against batches of many rows: the neighbours of brute force, without the whole table of similarities."""
    rng = np.random.default_rng(1)
    e = rng.integers(-3, 4, (20_000, 4)).astype(np.float32)  # many ties
    e[5] = np.nan
    ids = np.arange(0, 20_000, 10)
    column = pa.ListArray.from_arrays(np.arange(0, 80_001, 4, dtype=np.int32), e.ravel())
    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(20_000)), column], ["vec_id", "embedding"])
    matrix = catalogue._vectors(column.take(pa.array(ids)))
    tracemalloc.start()
    (got,) = catalogue.nearest([whole.slice(0, 9_000), whole.slice(9_000)], ids, matrix)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    for q in (0, 7, 1999):
        sims = np.round(matrix[q] @ catalogue._vectors(column).T, 6)
        sims[np.isnan(sims)] = np.inf
        order = [x for x in np.lexsort((np.arange(20_000), -sims)) if x != ids[q]][:10]
        assert sorted(got["vec_id"].to_numpy()[got["query_id"].to_numpy() == ids[q]]) == sorted(order)
