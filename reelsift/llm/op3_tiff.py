"""TIFF pages: walk image directories, decode strips and tiles, undo predictors.

``pages`` reads a file of any byte order with grey or interleaved 8- or 16-bit
samples, uncompressed or in PackBits, LZW or deflate, in strips or tiles, and gives
one array a directory.  ``write_pages`` stores 8-bit pages the same ways.

The query stores each text's bytes as 64 samples wide pages and reads them back.
Codec, predictor and strips or tiles follow from the payload's digest, so that equal
texts give equal files and texts of every size meet LZW, PackBits and deflate alike.

Edge cases: null text counts as empty and gives one row of 64 zeros; a very long
text becomes many pages of 64 KiB; equal texts, and so ties and repeated rows, give
equal values, one row each; null ids keep their row; an empty table gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from reelsift.llm.common import read_table, tune

NONE, LZW, DEFLATE, DEFLATE_OLD, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, PAGE_ROWS, STRIP_ROWS, TILE = 64, 1024, 256, 32
_FORMATS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}


def unpack_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += 2 + n
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more as repeats, all between them as literals, 128 bytes a packet at most."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return b""
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    size = np.diff(np.append(first, len(a)))
    out, at = bytearray(), 0

    def literal(end: int) -> None:
        for i in range(at, end, 128):
            part = data[i : min(i + 128, end)]
            out.append(len(part) - 1)
            out.extend(part)

    for i, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
        literal(i)
        at, byte = i + n, data[i : i + 1]
        out += (b"\x81" + byte) * (n // 128)
        if n % 128 > 1:
            out += bytes((257 - n % 128,)) + byte
        elif n % 128:
            out += b"\0" + byte
    literal(len(data))
    return bytes(out)


#: Bits of the codes that follow a clear code: widths grow one code early, up to 12.
_WIDTHS = np.concatenate([np.full(n, w, np.int64) for n, w in ((254, 9), (512, 10), (1024, 11), (4096, 12))])
_STARTS = np.concatenate([[0], np.cumsum(_WIDTHS)])
_BYTES = [bytes((i,)) for i in range(256)]


def _codes_at(data: np.ndarray, at: int) -> np.ndarray:
    """The codes from bit ``at`` on, up to the next clear or end code, as after a clear."""
    n = min(len(_WIDTHS), int(np.searchsorted(_STARTS, 8 * (len(data) - 4) - at, side="right")) - 1)
    if n <= 0:
        return np.empty(0, np.int64)
    bit = at + _STARTS[:n]
    byte = bit >> 3
    four = (data[byte] << 24) | (data[byte + 1] << 16) | (data[byte + 2] << 8) | data[byte + 3]
    return (four >> (32 - (bit & 7) - _WIDTHS[:n])) & ((1 << _WIDTHS[:n]) - 1)


def lzw_decode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bit first; a segment from clear code to clear code at a time."""
    bits = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.int64)
    if not len(data) or int(bits[0]) << 1 | int(bits[1]) >> 7 != 256:
        raise ValueError("LZW data without a clear code")
    out: list[bytes] = []
    at = 9
    while True:
        codes = _codes_at(bits, at)
        stop = np.flatnonzero((codes == 256) | (codes == 257))
        last = int(stop[0]) if len(stop) else len(codes)
        table, old = [*_BYTES, b"", b""], b""
        size = 258
        for code in codes[:last].tolist():
            if old:
                word = table[code] if code < size else old + old[:1]
                table.append(old + word[:1])
                size += 1
            else:
                word = table[code]
            out.append(word)
            old = word
        if not len(stop) or codes[last] == 257:
            return b"".join(out)
        at += int(_STARTS[last + 1])


def lzw_encode(data: bytes) -> bytes:
    codes, segments = [256], [1]  # segments: codes up to and with each clear code
    table: dict[int, int] = {}
    size, old = 258, -1
    for byte in data:
        if old < 0:
            old = byte
            continue
        key = old << 8 | byte
        code = table.get(key)
        if code is not None:
            old = code
            continue
        codes.append(old)
        table[key] = size
        size += 1
        if size == 4094:
            codes.append(256)
            segments.append(len(codes))
            table = {}
            size = 258
        old = byte
    if old >= 0:
        codes.append(old)
    codes.append(257)
    segments.append(len(codes))
    width = np.concatenate([[9], *(_WIDTHS[: b - a] for a, b in zip(segments, segments[1:]))])
    end = np.cumsum(width)
    value = np.array(codes, np.int64)
    bits = np.zeros(int(end[-1]), np.uint8)
    for k in range(12):  # from the lowest bit of each code
        some = width > k
        bits[end[some] - 1 - k] = (value[some] >> k) & 1
    return np.packbits(bits).tobytes()


def decompress(data: bytes, codec: int) -> bytes:
    if codec == NONE:
        return data
    if codec == LZW:
        return lzw_decode(data)
    if codec in (DEFLATE, DEFLATE_OLD):
        return zlib.decompress(data)
    if codec == PACKBITS:
        return unpack_bits(data)
    raise ValueError(f"compression {codec} isn't supported")


def compress(data: bytes, codec: int) -> bytes:
    return {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 6), PACKBITS: pack_bits}[codec](data)


def directories(data: bytes) -> Iterator[dict[int, tuple]]:
    """Tags of each image directory, in the file's chain; a loop ends it."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen = set()
    while at and at not in seen:
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        tags: dict[int, tuple] = {0: (order,)}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if (f := _FORMATS.get(kind)) is None:
                continue
            size = struct.calcsize(f) * count
            where = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
            tags[tag] = struct.unpack_from(f"{order}{count}{f}", data, where)
        yield tags
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def page(data: bytes, tags: dict[int, tuple]) -> np.ndarray:
    """(height, width, samples) of one directory."""
    one = lambda tag, default=None: tags.get(tag, (default,))[0]
    width, height, samples, codec, predictor = one(256), one(257), one(277, 1), one(259, NONE), one(317, 1)
    bits = set(tags.get(258, (1,)))
    if len(bits) != 1 or next(iter(bits)) not in (8, 16) or one(284, 1) != 1 or predictor not in (1, 2):
        raise ValueError("unsupported sample layout")
    kind = np.dtype({8: "u1", 16: tags[0][0] + "u2"}[next(iter(bits))])
    out = np.zeros((height, width, samples), kind.newbyteorder("="))
    if 324 in tags:
        w, h, offsets, sizes = one(322), one(323), tags[324], tags[325]
    else:
        w, h, offsets, sizes = width, min(one(278, height), height), tags[273], tags[279]
    across = -(-width // w)
    for i, (at, size) in enumerate(zip(offsets, sizes)):
        y, x = i // across * h, i % across * w
        rows = h if 324 in tags else min(h, height - y)
        raw = decompress(data[at : at + size], codec)
        block = np.frombuffer(raw, kind, rows * w * samples).reshape(rows, w, samples).astype(out.dtype)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=out.dtype)
        out[y : y + rows, x : x + w] = block[: height - y, : width - x]
    return out


def pages(data: bytes) -> Iterator[np.ndarray]:
    for tags in directories(data):
        yield page(data, tags)


def write_pages(images: list[np.ndarray], codec: int, predictor: int = 1, tiled=lambda k: False) -> bytes:
    """A little-endian file of 8-bit grey pages."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for k, image in enumerate(images):
        height, width = image.shape
        if tiled(k):
            blocks = []
            for y in range(0, height, TILE):
                for x in range(0, width, TILE):
                    b = np.zeros((TILE, TILE), np.uint8)
                    part = image[y : y + TILE, x : x + TILE]
                    b[: part.shape[0], : part.shape[1]] = part
                    blocks.append(b)
        else:
            blocks = [image[y : y + STRIP_ROWS] for y in range(0, height, STRIP_ROWS)]
        offsets, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.diff(b, axis=1, prepend=np.uint8(0))
            packed = compress(b.tobytes(), codec)
            offsets.append(len(out))
            sizes.append(len(packed))
            out += packed
        tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8]), (259, 3, [codec]), (262, 3, [1]), (277, 3, [1]), (317, 3, [predictor])]
        tags += [(322, 4, [TILE]), (323, 4, [TILE]), (324, 4, offsets), (325, 4, sizes)] if tiled(k) else [(273, 4, offsets), (278, 4, [STRIP_ROWS]), (279, 4, sizes)]
        entries = b""
        for tag, kind, values in sorted(tags):
            value = struct.pack(f"<{len(values)}{_FORMATS[kind]}", *values)
            if len(value) > 4:
                if len(out) % 2:
                    out += b"\0"
                at, value = len(out), value
                out += value
                value = struct.pack("<I", at)
            entries += struct.pack("<HHI", tag, kind, len(values)) + value.ljust(4, b"\0")
        if len(out) % 2:
            out += b"\0"
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def layout(payload: bytes) -> tuple[int, int, int]:
    """Codec, predictor and whether odd (1) or even (0) pages are tiled, by the payload's digest.

    Each of the twelve forms takes payloads of every size, and equal payloads the same one.
    """
    h = hashlib.sha256(b"form" + payload).digest()
    return (LZW, PACKBITS, DEFLATE)[h[0] % 3], 1 + h[1] % 2, h[2] % 2


def stored(text: str | None) -> tuple[int, bytes]:
    """Unpadded bytes and the file of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    padded = raw + b"\0" * (-len(raw) % WIDTH or (WIDTH if not raw else 0))
    samples = np.frombuffer(padded, np.uint8).reshape(-1, WIDTH)
    images = [samples[y : y + PAGE_ROWS] for y in range(0, len(samples), PAGE_ROWS)]
    codec, predictor, odd = layout(padded)
    return len(raw), write_pages(images, codec, predictor, lambda k: k % 2 == odd)


def feature(images: list[np.ndarray]) -> str:
    """Pages, mean, deviation and entropy (bits a sample) of all samples."""
    n = sum(np.bincount(i.ravel(), minlength=256) for i in images)
    p = n / n.sum()
    mean = float(p @ np.arange(256))
    dev = float(np.sqrt(max(0.0, p @ np.arange(256) ** 2 - mean**2)))
    some = p[p > 0]
    return f"{len(images)}:{mean:.4f}:{dev:.4f}:{float(-(some * np.log2(some)).sum()):.4f}"


def media(spark: SparkSession, docs: DataFrame) -> DataFrame:
    tune(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                n, file = stored(text)
                images = list(pages(file))
                payload = b"".join(i.tobytes() for i in images)
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(file), hashlib.sha256(file).hexdigest(), feature(images)))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def page_rows(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, page, height, width, samples, mode bits, data) of every page of binary files (path, content).

    A file that can't be read gives one row with null page and the error.
    """
    tune(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("path", "page", "height", "width", "samples", "bits", "data", "error")
        types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                rows = []
                try:
                    for k, p in enumerate(pages(content or b"")):
                        rows.append((path, k, *p.shape, p.itemsize * 8, p.tobytes(), None))
                except (ValueError, struct.error, zlib.error, IndexError, KeyError, TypeError) as e:
                    rows.append((path, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return files.select("path", "content").mapInArrow(run, "path string, page int, height int, width int, samples int, bits int, data binary, error string")


def op3_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media(spark, read_table(spark, sf_dir, "documents"))
