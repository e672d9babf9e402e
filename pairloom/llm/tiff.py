"""Media columns in TIFF: writes bytes as grey pages and reads files page by page, one row per page.

The reader walks the chain of image directories (classic and big files, either byte order), decodes
uncompressed, PackBits, LZW or deflate strips and tiles of 1, 2, 4, 8, 16 or 32 bits a sample in either fill
order, undoes the horizontal predictor, and joins planes. CCITT and JPEG data, samples of other or unequal sizes and
pages of more than ``MOST_BYTES`` are not decoded.
The writer makes pages of at most ``PAGE_ROWS`` rows in strips of ``STRIP_ROWS``, so that neither needs
more than one page at a time beside the stored file.

Nulls and edges: a null text counts as empty, and its payload is one row of padding; a null or broken file
gives one row that has only ``error``; a page that is broken or not decoded gives a row of its number and ``error``,
and the pages before and after it are still read; directories
that form a loop, or one whose successor cannot be read, end the walk with an error; null or repeated ids are kept as they are; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, written

WIDTH, STRIP_ROWS, PAGE_ROWS = 576, 64, 1024
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_CODES = {1: "B", 3: "H", 4: "I", 13: "I", 16: "Q", 18: "Q", 6: "b", 8: "h", 9: "i", 17: "q"}
#: A page is one value of a table, which holds no more bytes than this.
MOST_BYTES = (1 << 31) - (1 << 16)
#: Bytes of pages that are handed on at once.
BATCH = 4 << 20
#: What reading broken files can raise.
BROKEN = (ValueError, LookupError, ArithmeticError, TypeError, MemoryError, struct.error, zlib.error)
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


@dataclass
class Page:
    number: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    predictor: int
    data: bytes  # row by row, samples of a pixel together, little-endian; a byte for a sample of less than 8 bits


def pack_bits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = 1
        while run < 128 and i + run < n and data[i + run] == data[i]:
            run += 1
        if run > 2:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        start = i
        while i < n and i - start < 128 and not (i + 2 < n and data[i] == data[i + 1] == data[i + 2]):
            i += 1
        out.append(i - start - 1)
        out += data[start:i]
    return bytes(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size and i < len(data):
        k = data[i]
        if k < 128:
            out += data[i + 1 : i + 2 + k]
            i += 2 + k
        elif k > 128:
            out += data[i + 1 : i + 2] * (257 - k)
            i += 2
        else:
            i += 1
    return bytes(out)


def lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes from the high bit on, the width grows one code early."""
    bits, filled, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal bits, filled
        bits, filled = bits << width | code, filled + width
        while filled >= 8:
            filled -= 8
            out.append(bits >> filled & 255)
        bits &= (1 << filled) - 1

    table, width, seen = {bytes((i,)): i for i in range(256)}, 9, b""
    put(256, width)
    for i in range(len(data)):
        more = seen + data[i : i + 1]
        if more in table:
            seen = more
            continue
        put(table[seen], width)
        table[more] = len(table) + 2
        if len(table) + 2 == 1 << width:
            width += 1
        if len(table) + 2 >= 4095:
            put(256, 12)
            table, width = {bytes((i,)): i for i in range(256)}, 9
        seen = data[i : i + 1]
    if seen:
        put(table[seen], width)
        if len(table) + 2 == (1 << width) - 1:
            width = min(12, width + 1)
    put(257, width)
    if filled:
        out.append(bits << (8 - filled) & 255)
    return bytes(out)


def unlzw(data: bytes, size: int) -> bytes:
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, width, last, out = list(first), 9, b"", bytearray()
    bits = filled = 0
    for byte in data:
        bits, filled = bits << 8 | byte, filled + 8
        if filled < width:
            continue
        filled -= width
        code = bits >> filled
        bits &= (1 << filled) - 1
        if code == 257 or len(out) >= size:
            break
        if code == 256:
            table, width, last = list(first), 9, b""
            continue
        if code > len(table) or code == len(table) and not last:
            raise ValueError("an LZW code out of its table")
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last:
            table.append(last + entry[:1])
        last = entry
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return bytes(out)


def compressed(data: bytes, how: int) -> bytes:
    return {NONE: lambda: data, LZW: lambda: lzw(data), DEFLATE: lambda: zlib.compress(data, 1), PACKBITS: lambda: pack_bits(data)}[how]()


def expanded(data: bytes, how: int, size: int) -> bytes:
    if how == NONE:
        out = data[:size]
    elif how in (DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(data, size)
    elif how == LZW:
        out = unlzw(data, size)[:size]
    elif how == PACKBITS:
        out = unpack_bits(data, size)[:size]
    else:
        raise ValueError(f"compression {how} is not supported")
    if len(out) < size:
        raise ValueError(f"{len(out)} of {size} bytes in a strip or tile")
    return out


def write_tiff(payload: bytes, how: int = DEFLATE, predictor: int = 1, width: int = WIDTH, page_rows: int = PAGE_ROWS, strip_rows: int = STRIP_ROWS, tile: int = 0) -> bytes:
    """``payload`` (a multiple of ``width``) as 8-bit grey pages; ``tile`` (a multiple of 16) makes square tiles."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4  # where the place of the next directory goes
    image = np.frombuffer(payload, np.uint8).reshape(-1, width)
    for top in range(0, len(image), page_rows):
        page = image[top : top + page_rows]
        if tile:
            grid = [page[y : y + tile, x : x + tile] for y in range(0, len(page), tile) for x in range(0, width, tile)]
            blocks = [np.pad(b, ((0, tile - b.shape[0]), (0, tile - b.shape[1]))) for b in grid]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, len(page), strip_rows)]
        places, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((len(block), 1), np.uint8))
            data = compressed(block.tobytes(), how)
            places.append(len(out))
            sizes.append(len(data))
            out += data
        tags = [(256, 4, [width]), (257, 4, [len(page)]), (258, 3, [8]), (259, 3, [how]), (262, 3, [1]), (277, 3, [1]), (317, 3, [predictor])]
        tags += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, places), (325, 4, sizes)] if tile else [(273, 4, places), (278, 4, [strip_rows]), (279, 4, sizes)]
        entries = b""
        for tag, kind, values in sorted(tags):
            body = struct.pack(f"<{len(values)}{_CODES[kind]}", *values)
            if len(body) > 4:
                out += b"\0" * (len(out) % 2)
                place, extra = len(out), body
                out += extra
                body = struct.pack("<I", place)
            entries += struct.pack("<HHI", tag, kind, len(values)) + body.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries) // 12) + entries + b"\0\0\0\0"
        link = len(out) - 4
    return bytes(out)


def _directories(data: bytes) -> Iterator[tuple[int, str, bool, int, int]]:
    """Number, byte order, whether big, place of the first entry and count of entries, of each directory."""
    if data[:2] not in (b"II", b"MM"):
        raise ValueError("not a TIFF file")
    e = "<" if data[:2] == b"II" else ">"
    magic = struct.unpack_from(e + "H", data, 2)[0]
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    place = struct.unpack_from(e + ("Q" if big else "I"), data, 8 if big else 4)[0]
    seen: set[int] = set()
    while place:
        if place in seen:
            raise ValueError("the directories form a loop")
        seen.add(place)
        n = struct.unpack_from(e + ("Q" if big else "H"), data, place)[0]
        at, step = place + (8 if big else 2), 20 if big else 12
        yield len(seen) - 1, e, big, at, n
        place = struct.unpack_from(e + ("Q" if big else "I"), data, at + n * step)[0]


def _tags(data: bytes, e: str, big: bool, at: int, n: int) -> dict[int, tuple]:
    step, tags = 20 if big else 12, {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(e + ("HHQ" if big else "HHI"), data, at + i * step)
        if kind not in _CODES or count > len(data):
            continue
        inside, value = (8 if big else 4), at + (i + 1) * step - (8 if big else 4)
        if _SIZES[kind] * count > inside:
            value = struct.unpack_from(e + ("Q" if big else "I"), data, value)[0]
        tags[tag] = struct.unpack_from(f"{e}{count}{_CODES[kind]}", data, value)
    return tags


def read_tiff(data: bytes) -> Iterator[Page]:
    """The pages of a file, one by one; ends with an error at the first that cannot be read."""
    for number, e, *where in _directories(data):
        yield _page(data, _tags(data, e, *where), e, number)


def read_each(data: bytes) -> Iterator[tuple[int | None, Page | None, str | None]]:
    """Number, page and error of each page: bad pages are passed over, a broken walk gives a last error without number."""
    try:
        for number, e, *where in _directories(data):
            try:
                page, error = _page(data, _tags(data, e, *where), e, number), None
            except BROKEN as x:
                page, error = None, str(x) or type(x).__name__
            yield number, page, error
    except BROKEN as x:
        yield None, None, str(x) or type(x).__name__


def _samples(block: bytes, shape: tuple[int, int, int], bits: int) -> np.ndarray:
    """Samples of 1, 2 or 4 bits, high bits first and each row in whole bytes, as a byte each."""
    rows, w, each = shape
    packed, each_byte = np.frombuffer(block, np.uint8).reshape(rows, -1), 8 // bits
    out = np.empty((rows, packed.shape[1] * each_byte), np.uint8)
    for k in range(each_byte):
        out[:, k::each_byte] = packed >> (8 - bits * (k + 1)) & (1 << bits) - 1
    return out[:, : w * each].reshape(shape)


def _page(data: bytes, tags: dict[int, tuple], e: str, number: int) -> Page:
    one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
    width, height, samples, bits = one(256), one(257), one(277, 1), one(258, 1)
    how, predictor, apart = one(259, NONE), one(317, 1), one(284, 1) == 2
    if not width or not height or min(width, height, samples) < 1 or bits not in (1, 2, 4, 8, 16, 32) or len(set(tags.get(258, (bits,)))) > 1:
        raise ValueError(f"a page of {width} x {height} samples of {bits} bits is not supported")
    unit = max(1, bits // 8)
    if width * height * samples * unit > MOST_BYTES:
        raise ValueError("the page is too large")
    if predictor not in (1, 2) or predictor == 2 and bits < 8:
        raise ValueError(f"predictor {predictor} of {bits} bits is not supported")
    each, planes = (1, samples) if apart else (samples, 1)
    kind = np.dtype(f"{e}u{unit}")
    image = np.empty((planes, height, width, each), kind.newbyteorder("<"))
    tiled = 324 in tags
    if tiled:
        w, h, places, sizes = one(322), one(323), tags[324], tags[325]
    else:
        w, h, places = width, min(height, one(278, height)), tags[273]
        sizes = tags.get(279) or (len(data) - places[0],)
    if w < 1 or h < 1 or w * h * each * unit > MOST_BYTES:
        raise ValueError(f"strips or tiles of {w} x {h}")
    across, down = -(-width // w), -(-height // h)
    if len(places) < planes * across * down or len(sizes) < len(places):
        raise ValueError("strips or tiles are missing")
    if min(places) < 0 or min(sizes) < 0:
        raise ValueError("strips or tiles are before the file")
    for k in range(planes * across * down):
        plane, y, x = k // (across * down), k // across % down * h, k % across * w
        rows = h if tiled else min(h, height - y)
        raw = data[places[k] : places[k] + sizes[k]]
        block = expanded(raw.translate(_REVERSED) if one(266, 1) == 2 else raw, how, rows * -(-w * each * bits // 8))
        block = np.frombuffer(block, kind).reshape(rows, w, each) if bits >= 8 else _samples(block, (rows, w, each), bits)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
        image[plane, y : y + rows, x : x + w] = block[: height - y, : width - x]
    if planes > 1:
        image = np.ascontiguousarray(image.transpose(3, 1, 2, 0))
    return Page(number, width, height, samples, bits, how, predictor, image.tobytes())


def padded(data: bytes, unit: int = WIDTH) -> bytes:
    """``data`` with bytes 255 up to a positive multiple of ``unit``."""
    return data + b"\xff" * (max(unit, -(-len(data) // unit) * unit) - len(data))


def _value(x: pa.Scalar) -> bytes:
    return x.as_buffer().to_pybytes() if x.is_valid else b""


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: int = DEFLATE, predictor: int = 1) -> DataFrame:
    """id_col, n_bytes long, media binary: each text as a TIFF file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [_value(x) for x in part.column(1)]
                media = [write_tiff(padded(t), how, predictor) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return in_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_bytes long, media binary")


def read_pages(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per page: id_col, page, width, height, samples, bits, compression, predictor, data binary, error.

    A page that cannot be read has only its number and the error; a walk that cannot go on, only the error.
    """
    names = ["page", "width", "height", "samples", "bits", "compression", "predictor"]
    kind = media.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where, rows, held = [], [], 0

            def batch(ids: pa.Array = b.column(0)) -> pa.RecordBatch:
                columns = zip(*rows, strict=True)
                kinds = [pa.int32()] * len(names) + [pa.binary(), pa.string()]
                return pa.RecordBatch.from_arrays([ids.take(pa.array(where)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [id_col, *names, "data", "error"])

            for i in range(b.num_rows):
                for number, p, error in read_each(_value(b.column(1)[i])):
                    values = (p.number, p.width, p.height, p.samples, p.bits, p.compression, p.predictor, p.data) if p else (number, *[None] * 7)
                    where.append(i)
                    rows.append((*values, error))
                    held += 100 + (len(p.data) if p else 0)
                    if held > BATCH:
                        yield batch()
                        where, rows, held = [], [], 0
            if rows:
                yield batch()

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} int" for n in names) + ", data binary, error string"
    return in_arrow(media.select(id_col, media_col), run, schema)


def feature(counts: np.ndarray, pages: int, rows: int) -> str:
    """A short description of the grey values: pages, size, mean, deviation, entropy, sixteenths of the range."""
    n = max(1, int(counts.sum()))
    values, p = np.arange(256), counts / n
    mean = float((values * counts).sum()) / n
    spread = max(0.0, float((values * values * counts).sum()) / n - mean * mean) ** 0.5
    entropy = float(-(p[p > 0] * np.log2(p[p > 0])).sum())
    bins = "-".join(str(int(x)) for x in counts.reshape(16, 16).sum(axis=1))
    return f"pages={pages};size={WIDTH}x{rows};mean={mean:.4f};sd={spread:.4f};entropy={entropy:.4f};bins={bins}"


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text as TIFF in a written table, reads that table, and describes what is read back."""
    kind = docs.schema[id_col].dataType.simpleString()
    stored = written(store(docs, id_col, text_col), "media")
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for n, m in zip(b.column(1), b.column(2), strict=True):
                media, whole, tail, counts, pages = _value(m), hashlib.sha256(), b"", np.zeros(256, np.int64), 0
                size = 0
                for p in read_tiff(media):
                    whole.update(p.data)
                    tail = (tail + p.data[-32:])[-32:]
                    counts += np.bincount(np.frombuffer(p.data, np.uint8), minlength=256)
                    size, pages = size + len(p.data), pages + 1
                rows.append((n.as_py(), size, whole.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), feature(counts, pages, size // WIDTH)))
            if rows:
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, zip(*rows, strict=True))], [id_col, *names])

    return in_arrow(stored, run, f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
