from __future__ import annotations

import gzip
import hashlib

import pytest

from pairloom.llm.warc import WarcReader, head, read_archive, read_files, write_archive

BIG = "<p>" + "word é " * 60_000
ROWS = [
    (1, "http://a/x", "small"), (2, "http://a/y", "small"), (3, "http://a/z", BIG), (4, None, BIG), (9, "http://a/ü\r\n x", BIG), (5, "u", None), (6, "u", ""),
    (7, "u", "x" * 1000), (8, "u", "x" * 1000), (10, "u", "y" * 999), (11, "u", "y" * 999), (None, "u", "x" * 1000), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 200),
]


@pytest.mark.parametrize("chunk_bytes", [700, 64 << 10])
@pytest.mark.parametrize("limit", [None, 0])
def test_round_trip(spark, chunk_bytes, limit):
    pages = spark.createDataFrame([(*r, "x", "y") for r in ROWS], "page_id long, url string, html string, id string, first string")
    chunks = write_archive(pages, chunk_bytes=chunk_bytes, limit=limit)
    got = {r.page_id: r for r in read_archive(chunks).collect()}
    assert len(got) == len(ROWS)
    for i, _, h in ROWS:
        body, r = (h or "").encode(), got[i]
        same = [k for k, _, x in ROWS if (x or "").encode() == body and k is not None]
        again = len(body) >= 1000 and i != max(same)
        assert r.intact
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", max(same)) if again else ("response", None))
        assert r.stored_bytes == (0 if again else len(body))
    rows = chunks.collect()
    assert max(len(r.data) for r in rows) <= chunk_bytes + 1000
    for r in rows:
        if r.chunk_no == 0:
            own = sorted((x for x in rows if x.rec == r.rec), key=lambda x: x.chunk_no)
            assert [x.last for x in own] == [False] * (len(own) - 1) + [True]


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archive(write_archive(pages)).collect() == []


def test_damage_is_seen(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 5000)], "page_id long, url string, html string")
    chunks = write_archive(pages, chunk_bytes=1000).toPandas()
    at = chunks.index[chunks["chunk_no"] == 2][0]
    chunks.at[at, "data"] = b"z" + bytes(chunks.at[at, "data"])[1:]
    (r,) = read_archive(spark.createDataFrame(chunks, "rec string, chunk_no int, last boolean, data binary, sha1 string")).collect()
    assert not r.intact


def test_files(spark, tmp_path):
    bodies = [b"first", b"", b"\r\n\r\n" * 50_000]
    records = [head("response", k, f"http://h/{k}", len(b), hashlib.sha1(b).hexdigest(), None) + b + b"\r\n\r\n" for k, b in enumerate(bodies)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, [info, *records])))
    got = read_files(spark, f"file://{tmp_path}/*").collect()
    for name in ("a.warc", "b.warc.gz"):
        mine = sorted((r for r in got if r.path.endswith(name)), key=lambda r: (r.record_no, r.chunk_no))
        data = {}
        for r in mine:
            data[r.record_no] = data.get(r.record_no, b"") + bytes(r.data)
        assert [data[k] for k in range(4)] == [b"abc", *bodies]
        assert mine[-1].sha1 == hashlib.sha1(bodies[-1]).hexdigest() and mine[-1].uri == "http://h/2"


def test_broken_files_give_what_they_hold_and_an_error(spark, tmp_path):
    good = head("response", 1, "http://h/1", 5, hashlib.sha1(b"first").hexdigest(), None) + b"first\r\n\r\n"
    long = head("response", 2, "http://h/2", 200_000, "00" * 20, None) + b"x" * 200_000
    broken = {
        "cut": good + long[:-50_000], "head": good + long[:20], "noise": good + b"HTTP/1.1 no record\r\n\r\n", "length": good + b"WARC/1.1\r\nContent-Length: x\r\n\r\n",
        "minus": good + b"WARC/1.1\r\nContent-Length: -4\r\n\r\n", "none": good + b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", "tail": good + long + b"no end", "gz.gz": gzip.compress(good) + gzip.compress(long)[:-30],
    }
    for name, data in {**broken, "good": good + good, "empty": b""}.items():
        (tmp_path / name).write_bytes(data)
    got = read_files(spark, f"file://{tmp_path}/*").collect()
    for name in broken:
        mine = [r for r in got if r.path.endswith(f"/{name}")]
        assert bytes(mine[0].data) == b"first" and [bool(r.error) for r in mine] == [False] * (len(mine) - 1) + [True], name
    assert not any(r.error for r in got if r.path.endswith(("/good", "/empty")))


def test_an_archive_that_stays(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", "same page " * 200) for k in range(5)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/archive"
    write_archive(pages, path=path)
    got = {r.page_id: (r.record_type, r.refers_to) for r in read_archive(spark.read.parquet(path)).collect()}
    assert got == {k: ("revisit", 4) for k in range(4)} | {4: ("response", None)}


def test_any_split_of_the_bytes_reads_alike():
    body = b"payload \r\n\r\n" * 30
    data = (head("response", 1, "u", len(body), hashlib.sha1(body).hexdigest(), None) + body + b"\r\n\r\n") * 2
    for size in (1, 7, 100, 10_000):
        reader, got = WarcReader(), []
        for at in range(0, len(data), size):
            got += list(reader.feed(data[at : at + size]))
        assert b"".join(x for e, x in got if e == "payload") == body * 2
        assert sum(e == "end" for e, _ in got) == 2
