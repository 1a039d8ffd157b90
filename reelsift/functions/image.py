"""Pixel kernels: NumPy for frames of any size, expressions for small grey arrays."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsift.functions.hashing import let


def of_samples(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Raw samples as a frame: grey ones have two dimensions, an alpha channel is left off."""
    f = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return f[..., 0] if channels == 1 else f[..., :3]


def grey(frame: np.ndarray) -> np.ndarray:
    """Luma of a BGR frame, rounded to 8 bits."""
    if frame.ndim == 2:
        return frame
    b, g, r = (frame[..., i].astype(np.float64) for i in range(3))
    return np.floor(0.114 * b + 0.587 * g + 0.299 * r + 0.5).astype(np.uint8)


def laplacian(g: np.ndarray) -> np.ndarray:
    p = np.pad(g.astype(np.float64), 1, mode="reflect")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def colourfulness(frame: np.ndarray) -> float:
    b, g, r = (frame[..., i].astype(np.float32) for i in range(3))
    rg, yb = np.abs(r - g), np.abs(0.5 * (r + g) - b)
    return float(np.sqrt(rg.var(dtype=np.float64) + yb.var(dtype=np.float64)) + 0.3 * np.sqrt(rg.mean(dtype=np.float64) ** 2 + yb.mean(dtype=np.float64) ** 2))


def edges(g: np.ndarray, low: float = 100, high: float = 200) -> np.ndarray:
    """Edge mask: Sobel gradients, thinning along the gradient, two thresholds."""
    p = np.pad(g.astype(np.int32), 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    mag = np.abs(gx) + np.abs(gy)
    q = np.pad(mag, 1)
    ax, ay = np.abs(gx), np.abs(gy)
    flat, steep = ay * 2.414 < ax, ay > 2.414 * ax
    diagonal = np.where((gx ^ gy) < 0, 1, 0).astype(bool)
    at = lambda dy, dx: q[1 + dy : q.shape[0] - 1 + dy, 1 + dx : q.shape[1] - 1 + dx]
    left = np.where(flat, at(0, -1), np.where(steep, at(-1, 0), np.where(diagonal, at(-1, 1), at(-1, -1))))
    right = np.where(flat, at(0, 1), np.where(steep, at(1, 0), np.where(diagonal, at(1, -1), at(1, 1))))
    ridge = (mag > left) & (mag >= right)
    strong, weak = ridge & (mag > high), ridge & (mag > low)
    while True:
        s = np.pad(strong, 1)
        near = np.zeros_like(strong)
        for dy in range(3):
            for dx in range(3):
                near |= s[dy : dy + strong.shape[0], dx : dx + strong.shape[1]]
        grown = strong | (near & weak)
        if (grown == strong).all():
            return strong
        strong = grown


def frame_metrics(frame: np.ndarray) -> dict[str, float]:
    """All measures of one BGR frame; grey is computed once."""
    g = grey(frame)
    return {
        "blur": float(laplacian(g).var()), "brightness": float(g.mean()), "contrast": float(g.std()),
        "colorfulness": colourfulness(frame) if frame.ndim == 3 else 0.0, "text_area": float(edges(g).mean()),
    }


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over the exact source area of each target pixel."""

    def weights(n: int, m: int) -> np.ndarray:
        edge = np.arange(m + 1) * (n / m)
        lo, hi = np.maximum(edge[:-1, None], np.arange(n)), np.minimum(edge[1:, None], np.arange(1, n + 1))
        return np.maximum(hi - lo, 0) * (m / n)

    a, b = weights(image.shape[0], height), weights(image.shape[1], width)
    out = np.einsum("yi,ij...,xj->yx...", a, image.astype(np.float64), b)
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8) if image.dtype == np.uint8 else out


def centre_square(frame: np.ndarray, resolution: int) -> np.ndarray:
    side = min(frame.shape[:2])
    y, x = (frame.shape[0] - side) // 2, (frame.shape[1] - side) // 2
    return area_resize(frame[y : y + side, x : x + side], resolution, resolution)


def frame_hash(frame: np.ndarray, size: int = 8) -> str:
    if size < 2:
        raise ValueError("hash size must be at least 2")
    small = area_resize(grey(frame), size, size)
    value = int("".join("1" if v else "0" for v in (small >= np.median(small)).ravel()), 2)
    return f"{value:0{size * size // 4}x}"


def signature_part(frame: np.ndarray) -> bytes:
    """What one frame adds to a signature: its shape and its channel means in single precision."""
    means = frame.reshape(-1, frame.shape[-1] if frame.ndim == 3 else 1).mean(0)
    return str(frame.shape).encode() + means.astype(np.float32).tobytes()


def frame_signature(frames: list[np.ndarray]) -> str:
    return hashlib.sha1(b"".join(map(signature_part, frames))).hexdigest()


def hsv(frame: np.ndarray) -> np.ndarray:
    """Hue (0-179, half degrees), saturation and value of a BGR frame, in 8 bits."""
    b, g, r = (frame.astype(np.float64),) * 3 if frame.ndim == 2 else (frame[..., i].astype(np.float64) for i in range(3))
    top = np.maximum(np.maximum(b, g), r)
    spread = top - np.minimum(np.minimum(b, g), r)
    some = np.maximum(spread, 1)
    sector = np.where(top == r, (g - b) / some, np.where(top == g, 2 + (b - r) / some, 4 + (r - g) / some))
    hue = np.where(spread > 0, np.floor((sector * 30) % 180 + 0.5) % 180, 0)
    saturation = np.floor(255 * spread / np.maximum(top, 1) + 0.5)
    return np.stack([hue, saturation, top], -1).astype(np.uint8)


def content_change(before: np.ndarray, after: np.ndarray) -> float:
    """Mean over hue, saturation and value of their mean absolute differences."""
    return float(np.abs(hsv(after).astype(np.int16) - hsv(before)).mean((0, 1)).mean())


def block_motion(before: np.ndarray, after: np.ndarray, block: int = 8, reach: int = 7) -> float:
    """Median displacement of blocks by least absolute difference; stands in for dense flow."""
    a, b = grey(before).astype(np.int32), grey(after).astype(np.int32)
    shifts = sorted(((dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1)), key=lambda s: s[0] ** 2 + s[1] ** 2)
    h, w = (a.shape[0] // block) * block, (a.shape[1] // block) * block
    if not h or not w:
        return float(np.abs(a - b).mean() > 0)
    best, size = None, None
    p = np.pad(b, reach, mode="edge")
    for dy, dx in shifts:
        cost = np.abs(a - p[reach + dy : reach + dy + a.shape[0], reach + dx : reach + dx + a.shape[1]])[:h, :w].reshape(h // block, block, w // block, block).sum((1, 3))
        if best is None:
            best, size = cost, np.zeros(cost.shape)
        better = cost < best
        size = np.where(better, np.hypot(dy, dx), size)
        best = np.where(better, cost, best)
    return float(np.median(size))


# --- expressions over a square grey array ------------------------------------------


def mean_of(gray: Column) -> Column:
    return F.aggregate(gray, F.lit(0.0), lambda a, x: a + x) / F.size(gray)


def spread_of(gray: Column) -> Column:
    """Population standard deviation, two passes."""
    return let(gray, lambda g: let(mean_of(g), lambda m: F.sqrt(F.aggregate(g, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / F.size(g))))


def blur_of(gray: Column, side: int) -> Column:
    """Population variance of the 4-neighbour Laplacian with mirrored borders."""
    mirror = lambda i: -i if i < 0 else 2 * (side - 1) - i if i >= side else i
    at = lambda y, x: F.element_at(gray, mirror(y) * side + mirror(x) + 1)
    lap = F.array(*[at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for y in range(side) for x in range(side)])
    return let(spread_of(lap), lambda s: s * s)


def box_area_ratio(boxes: Column, frame_area: Column, least_conf: float) -> Column:
    """Summed areas of confident boxes (x_min, y_min, x_max, y_max, conf) over the frame, at most 1."""
    some = F.filter(boxes, lambda b: b["conf"] >= least_conf)
    area = F.aggregate(some, F.lit(0.0), lambda a, b: a + F.greatest(F.lit(0.0), b["x_max"] - b["x_min"]) * F.greatest(F.lit(0.0), b["y_max"] - b["y_min"]))
    return F.when(frame_area <= 0, 0.0).otherwise(F.least(F.lit(1.0), area / frame_area))


def evenly_spaced(n: Column, k: int) -> Column:
    """Indices of k evenly spaced items of n, all of them when n <= k."""
    if k < 1:
        raise ValueError("at least one item must be chosen")
    last = n - 1
    step = F.lit(0.0) if k == 1 else last / F.lit(float(k - 1))
    some = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when((i == k - 1) & (F.lit(k) > 1), last).otherwise(F.floor(i * step)).cast("int"))
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= k, F.sequence(F.lit(0), last.cast("int"))).otherwise(some)
