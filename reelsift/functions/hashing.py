"""Median hashes of thumbnails and distances between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def median(values: Column) -> Column:
    """Median of an array, the mean of the middle two for even sizes."""
    n = F.size(values)
    return let(F.array_sort(values), lambda s: (F.element_at(s, F.floor((n + 1) / 2).cast("int")) + F.element_at(s, F.floor(n / 2).cast("int") + 1)) / 2)


def bits(pixels: Column) -> Column:
    """'1' where a pixel is at least the median, first pixel first."""
    return let(pixels, lambda p: let(median(p), lambda m: F.array_join(F.transform(p, lambda x: F.when(x >= m, "1").otherwise("0")), "")))


def hex_of(bit_text: Column, size: int = 8) -> Column:
    if size < 2:
        raise ValueError("hash size must be at least 2")
    return F.lpad(F.lower(F.conv(bit_text, 2, 16)), size * size // 4, "0")


def as_long(hex_text: Column) -> Column:
    """64-bit pattern of 16 hex digits."""
    return F.conv(hex_text, 16, -10).cast("long")


def distance(a: Column, b: Column) -> Column:
    """Differing bits of two hashes; hex texts of unequal length are an error."""
    same = F.length(a) == F.length(b)
    return F.when(same, F.bit_count(as_long(a).bitwiseXOR(as_long(b)))).otherwise(F.raise_error("hash lengths differ").cast("int"))
