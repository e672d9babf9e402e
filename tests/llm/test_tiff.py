from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest

from pairloom.llm.tiff import DEFLATE, LZW, NONE, PACKBITS, compressed, padded, read_each, read_pages, read_tiff, round_trip, store, write_tiff


@pytest.mark.parametrize("how", [NONE, LZW, DEFLATE, PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [0, 64])
def test_round_trip(how, predictor, tile):
    r = random.Random(how + predictor)
    for n in (0, 1, 575, 576, 577, 20_000):
        for data in (bytes(r.choice(b"aabbbbbcd \n") for _ in range(n)), r.randbytes(n)):
            data = padded(data)
            pages = list(read_tiff(write_tiff(data, how, predictor, page_rows=7, strip_rows=3, tile=tile)))
            assert b"".join(p.data for p in pages) == data
            assert len(pages) == -(-len(data) // 576 // 7) and [p.number for p in pages] == list(range(len(pages)))


def big_endian(image: np.ndarray, planar: int, big: bool) -> bytes:
    """A 16-bit colour image, uncompressed, high bytes first, in one strip for each plane."""
    h, w, s = image.shape
    planes = [image.astype(">u2").tobytes()] if planar == 1 else [np.ascontiguousarray(image[:, :, k]).astype(">u2").tobytes() for k in range(s)]
    start = 16 if big else 8
    places = [start + sum(map(len, planes[:k])) for k in range(len(planes))]
    tags = [(256, [w]), (257, [h]), (258, [16] * s), (259, [1]), (262, [2]), (273, places), (277, [s]), (278, [h]), (279, list(map(len, planes))), (284, [planar])]
    body, extra = b"".join(planes), b""
    code, room = ("Q", 8) if big else ("I", 4)
    at = start + len(body)
    entries = b""
    for tag, values in tags:
        kind = 16 if big else 4
        v = struct.pack(f">{len(values)}{code}", *values)
        if len(v) > room:
            place = at + len(extra)
            extra += v
            v = struct.pack(f">{code}", place)
        entries += struct.pack(">HH" + code, tag, kind, len(values)) + v
    directory = struct.pack(">Q" if big else ">H", len(tags)) + entries + struct.pack(f">{code}", 0)
    first = at + len(extra)
    head = struct.pack(">2sHHHQ", b"MM", 43, 8, 0, first) if big else struct.pack(">2sHI", b"MM", 42, first)
    return head + body + extra + directory


@pytest.mark.parametrize("planar", [1, 2])
@pytest.mark.parametrize("big", [False, True])
def test_big_endian_colour(planar, big):
    image = np.random.default_rng(1).integers(0, 65536, (5, 7, 3))
    (page,) = read_tiff(big_endian(image, planar, big))
    assert (page.width, page.height, page.samples, page.bits) == (7, 5, 3, 16)
    assert np.array_equal(np.frombuffer(page.data, "<u2").reshape(5, 7, 3), image)


def test_pages_and_broken_files(spark):
    good = write_tiff(padded(b"x" * 5000), page_rows=4)
    loop = bytearray(write_tiff(padded(b"y")))
    first = struct.unpack_from("<I", loop, 4)[0]
    struct.pack_into("<I", loop, len(loop) - 4, first)
    rows = [(1, good), (2, None), (3, b"not an image"), (4, bytes(loop)), (5, good[: len(good) // 2]), (None, good)]
    got = read_pages(spark.createDataFrame(rows, "doc_id long, media binary")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [p.page for p in by[1]] == [0, 1, 2] and len(by[None]) == 3
    assert sum(len(p.data) for p in by[1]) == 5184
    assert by[2][0].error and by[3][0].error
    assert [bool(p.error) for p in by[4]] == [False, True] and "loop" in by[4][1].error
    assert by[5][-1].error


def test_texts(spark):
    rows = [(1, "abc", "x"), (2, None, "x"), (3, "", "x"), (4, "é" * 700_000, "x"), (None, "abc", "x"), (1, "abc", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media string")
    got = round_trip(docs).collect()
    assert len(got) == len(rows)
    texts = {1: "abc", 2: "", 3: "", 4: "é" * 700_000, None: "abc"}
    for r in got:
        raw = texts[r.doc_id].encode()
        payload = padded(raw)
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-32:])
        if r.doc_id == 4:
            assert r.feature.startswith("pages=3;")
    same = {(r.media_bytes, r.media_sha256, r.feature) for r in got if texts[r.doc_id] == "abc"}
    assert len(same) == 1
    m = {r.doc_id: r.media for r in store(docs).collect()}
    assert hashlib.sha256(m[2]).hexdigest() in {r.media_sha256 for r in got}
    assert round_trip(docs.limit(0)).collect() == []


def chain(pages: list[tuple[dict[int, list[int]], list[bytes]]]) -> bytes:
    """A file of the given directories; the strips' places and sizes are added (as tiles where there is a tag 322)."""
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for tags, strips in pages:
        a, b = (324, 325) if 322 in tags else (273, 279)
        tags = tags | {a: [], b: list(map(len, strips))} if strips else tags
        for strip in strips:
            tags[a].append(len(out))
            out += strip
        entries = b""
        for tag, values in sorted(tags.items()):
            body = struct.pack(f"<{len(values)}I", *values)
            if len(body) > 4:
                body, place = struct.pack("<I", len(out)), body
                out += place
            entries += struct.pack("<HHI", tag, 4, len(values)) + body.ljust(4, b"\0")
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + entries + bytes(4)
        link = len(out) - 4
    return bytes(out)


@pytest.mark.parametrize("bits", [1, 2, 4])
@pytest.mark.parametrize("how", [NONE, LZW, DEFLATE, PACKBITS])
@pytest.mark.parametrize("planar, fill, tile", [(1, 1, 0), (2, 1, 0), (1, 2, 0), (1, 1, 16), (2, 2, 16)])
def test_samples_of_less_than_a_byte(bits, how, planar, fill, tile):
    h, w, s = 21, 19, 3
    image = np.random.default_rng(bits).integers(0, 1 << bits, (h, w, s)).astype(np.uint8)
    strips = []
    for part in [image] if planar == 1 else [image[:, :, k : k + 1] for k in range(s)]:
        blocks = [part[y : y + 8] for y in range(0, h, 8)]
        if tile:
            blocks = [np.pad(b := part[y : y + 16, x : x + 16], ((0, 16 - b.shape[0]), (0, 16 - b.shape[1]), (0, 0))) for y in (0, 16) for x in (0, 16)]
        for block in blocks:
            data = b""
            for row in block.reshape(len(block), -1).tolist():
                text = "".join(f"{v:0{bits}b}" for v in row)
                data += bytes(int(text[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(text), 8))
            data = compressed(data, how)
            strips.append(bytes(int(f"{c:08b}"[::-1], 2) for c in data) if fill == 2 else data)
    tags = {256: [w], 257: [h], 258: [bits] * s, 259: [how], 262: [2], 266: [fill], 277: [s], 284: [planar]}
    (page,) = read_tiff(chain([(tags | ({322: [16], 323: [16]} if tile else {278: [8]}), strips)]))
    assert (page.bits, page.samples, page.width, page.height) == (bits, s, w, h)
    assert page.data == image.tobytes()


def test_bad_pages_do_not_hide_others(spark):
    good = {256: [4], 257: [2], 258: [8], 259: [1], 277: [1], 278: [2]}
    data = [b"abcdefgh"]
    bad = [
        (good | {259: [7]}, data),
        (good | {259: [4]}, data),
        (good | {278: [0]}, data),
        (good | {322: [0], 323: [16]}, data),
        (good | {322: [16]}, data),
        (good | {322: [1 << 31], 323: [1 << 31]}, data),
        (good | {256: [1 << 20], 257: [1 << 20]}, data),
        (good | {277: [0]}, data),
        (good | {258: [12]}, data),
        (good, [b"short"]),
        (good, []),
        (good | {273: [], 279: []}, []),
        ({}, []),
    ]
    file = chain([(good, data), *[p for b in bad for p in (b, (good, data))]])
    got = sorted(read_pages(spark.createDataFrame([(1, file)], "doc_id long, media binary")).collect(), key=lambda r: r.page)
    assert [r.page for r in got] == list(range(2 * len(bad) + 1))
    assert [bool(r.error) for r in got] == [False] + [True, False] * len(bad)
    assert all((r.data is None) if r.error else (bytes(r.data) == data[0]) for r in got)


def test_any_broken_byte_ends_in_rows():
    file, r = chain([({256: [4], 257: [2], 258: [8], 259: [how], 277: [1], 278: [1], 317: [2]}, [compressed(b"abcd", how)] * 2) for how in (LZW, DEFLATE, PACKBITS)]), random.Random(1)
    for _ in range(3000):
        broken = bytearray(file)
        for _ in range(r.randint(1, 4)):
            broken[r.randrange(4, len(file))] = r.choice((0, 1, 255, r.randrange(256)))
        assert all((p is None) != (error is None) for _, p, error in read_each(bytes(broken)))


def plain_pages(data: bytes) -> list[bytes]:
    """The grey pages of a little-endian file in deflate strips, by the format's letter and none of the package's code."""
    at, pages = struct.unpack_from("<I", data, 4)[0], []
    while at:
        n, tags = struct.unpack_from("<H", data, at)[0], {}
        for k in range(n):
            tag, kind, count, value = struct.unpack_from("<HHII", data, at + 2 + 12 * k)
            size = {3: 2, 4: 4}[kind] * count
            place = value if size > 4 else at + 2 + 12 * k + 8
            tags[tag] = struct.unpack_from(f"<{count}{'H' if kind == 3 else 'I'}", data, place)
        assert tags[256] == (576,) and tags[258] == (8,) and tags[259] == (8,) and tags[262] == (1,)
        strips = [zlib.decompress(data[p : p + m]) for p, m in zip(tags[273], tags[279], strict=True)]
        assert all(len(x) == 576 * tags[278][0] for x in strips[:-1])
        pages.append(b"".join(strips))
        assert len(pages[-1]) == 576 * tags[257][0]
        at = struct.unpack_from("<I", data, at + 2 + 12 * n)[0]
    return pages


def test_a_second_decoder_and_the_features(spark):
    texts = ["", "abc", "line of text\n" * 60_000, "é漢" * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    media = {r.doc_id: bytes(r.media) for r in store(docs).collect()}
    for r in round_trip(docs).collect():
        payload = padded(texts[r.doc_id].encode())
        pages = plain_pages(media[r.doc_id])
        assert b"".join(pages) == payload
        counts = [payload.count(bytes([v])) for v in range(256)]
        mean = sum(v * c for v, c in enumerate(counts)) / len(payload)
        spread = math.sqrt(sum(c * (v - mean) ** 2 for v, c in enumerate(counts)) / len(payload))
        entropy = -sum(c / len(payload) * math.log2(c / len(payload)) for c in counts if c)
        got = dict(x.split("=") for x in r.feature.split(";"))
        assert (int(got["pages"]), got["size"]) == (len(pages), f"576x{len(payload) // 576}")
        assert abs(float(got["mean"]) - mean) < 1e-3 and abs(float(got["sd"]) - spread) < 1e-3 and abs(float(got["entropy"]) - entropy) < 1e-3
        assert [int(x) for x in got["bins"].split("-")] == [sum(counts[k : k + 16]) for k in range(0, 256, 16)]
