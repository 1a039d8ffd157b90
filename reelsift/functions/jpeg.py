"""Baseline JPEG of BGR frames in NumPy, for data URLs and image files.

Huffman codes have equal lengths (4 bits for the 12 differences of block means, 8 for
the runs), so that both tables follow from a rule; files grow by about a half over
fitted codes, pixels are the same.
"""

from __future__ import annotations

import struct

import numpy as np

# --- fixed values: the quantisation steps that the standard gives as examples, row by row
LUMA = np.array([
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
]).reshape(8, 8)
CHROMA = np.full((8, 8), 99)
CHROMA[:4, :4] = [[17, 18, 24, 47], [18, 21, 26, 66], [24, 26, 56, 99], [47, 66, 99, 99]]

#: Places of a block in the order of its diagonals, alternately up and down.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_K = np.arange(8)
DCT = np.cos((2 * _K[None] + 1) * _K[:, None] * np.pi / 16) * np.where(_K[:, None] == 0, np.sqrt(1 / 8), 0.5)
_DC = list(range(12))
_AC = [0x00, 0xF0] + [run << 4 | size for run in range(16) for size in range(1, 11)]
_AC_CODE = np.zeros(256, np.int64)
_AC_CODE[_AC] = np.arange(len(_AC))


def steps(table: np.ndarray, quality: int) -> np.ndarray:
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((table * scale + 50) // 100, 1, 255)


def _coefficients(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Quantised blocks of one plane in zigzag order; edges are repeated to full blocks."""
    h, w = plane.shape
    p = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge") - 128.0
    blocks = p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).transpose(0, 2, 1, 3).reshape(-1, 8, 8)
    return np.rint(DCT @ blocks @ DCT.T / table).astype(np.int64).reshape(-1, 64)[:, ZIGZAG]


def _sizes(v: np.ndarray) -> np.ndarray:
    return np.frexp(np.abs(v).astype(np.float64))[1].astype(np.int64)


def _symbols(blocks: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(order, code, bits) of every code and its extra bits; ``at`` are the blocks' places in the scan."""
    out = []

    def add(places, codes, lengths, values, sizes):
        low = np.where(values < 0, values + (1 << sizes) - 1, values)
        out.append((places, (codes << sizes) | low, lengths + sizes))

    diff = np.diff(blocks[:, 0], prepend=0)
    size = _sizes(diff)
    add(at * 1024, size, np.full(len(at), 4), diff, size)
    row, col = np.nonzero(blocks[:, 1:])
    col += 1
    before = np.concatenate([[0], col[:-1]]) if len(col) else col
    before[np.flatnonzero(np.diff(row, prepend=-1))] = 0
    gap, value = col - before - 1, blocks[row, col]
    size = _sizes(value)
    add(at[row] * 1024 + col * 16 + 15, _AC_CODE[(gap % 16) << 4 | size], np.full(len(row), 8), value, size)
    for k in range(3):  # runs of sixteen zeros
        r, c = row[gap >= 16 * (k + 1)], before[gap >= 16 * (k + 1)]
        zero = np.zeros(len(r), np.int64)
        add(at[r] * 1024 + (c + 1) * 16 + k, zero + _AC_CODE[0xF0], zero + 8, zero, zero)
    last = np.zeros(len(blocks), np.int64)
    np.maximum.at(last, row, col)
    short = at[last < 63]
    zero = np.zeros(len(short), np.int64)
    add(short * 1024 + 1023, zero + _AC_CODE[0], zero + 8, zero, zero)
    return tuple(np.concatenate(x) for x in zip(*out))


def _table(kind: int, symbols: list[int], length: int) -> bytes:
    counts = [0] * 16
    counts[length - 1] = len(symbols)
    body = bytes([kind, *counts, *symbols])
    return b"\xff\xc4" + struct.pack(">H", len(body) + 2) + body


def encode(frame: np.ndarray, quality: int = 85) -> bytes:
    """JPEG bytes of a uint8 frame, grey (h, w) or BGR (h, w, 3), at full colour resolution."""
    if frame.ndim == 3 and frame.shape[2] == 1:
        frame = frame[..., 0]
    if frame.ndim == 2:
        planes, tables = [frame.astype(np.float64)], [LUMA]
    else:
        b, g, r = (frame[..., i].astype(np.float64) for i in range(3))
        y = 0.299 * r + 0.587 * g + 0.114 * b
        planes, tables = [y, (b - y) / 1.772 + 128, (r - y) / 1.402 + 128], [LUMA, CHROMA, CHROMA]
    tables = [steps(t, quality) for t in tables]
    n = len(planes)
    parts = []
    for i, (p, t) in enumerate(zip(planes, tables)):
        blocks = _coefficients(p, t)
        parts.append(_symbols(blocks, np.arange(len(blocks)) * n + i))
    place, code, length = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(place, kind="stable")
    code, length = code[order], length[order]
    ends = np.cumsum(length)
    within = np.arange(ends[-1]) - np.repeat(ends - length, length)
    bits = (np.repeat(code, length) >> (np.repeat(length, length) - 1 - within)) & 1
    bits = np.concatenate([bits, np.ones(-len(bits) % 8, np.int64)])
    scan = np.packbits(bits.astype(np.uint8)).tobytes().replace(b"\xff", b"\xff\x00")
    out = b"\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00"
    for i, t in enumerate(tables[:2]):
        out += b"\xff\xdb\x00\x43" + bytes([i]) + t.ravel()[ZIGZAG].astype(np.uint8).tobytes()
    sampled = b"".join(bytes([i + 1, 0x11, min(i, 1)]) for i in range(n))
    out += b"\xff\xc0" + struct.pack(">HBHHB", 8 + 3 * n, 8, *frame.shape[:2], n) + sampled
    out += _table(0x00, _DC, 4) + _table(0x10, _AC, 8)
    scanned = b"".join(bytes([i + 1, 0]) for i in range(n))
    return out + b"\xff\xda" + struct.pack(">HB", 6 + 2 * n, n) + scanned + b"\x00\x3f\x00" + scan + b"\xff\xd9"
