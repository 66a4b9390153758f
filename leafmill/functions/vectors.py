"""Expressions over vectors and bit strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalise(a: Column, eps: float = 1e-8) -> Column:
    """a / (|a| + eps); the zero vector stays zero."""
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / (n + eps))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def softmax(a: Column) -> Column:
    top = F.array_max(a)
    parts = F.transform(a, lambda x: F.exp(x - top))
    return F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda s, y: s + y))


def argmax(a: Column) -> Column:
    """Place of the first greatest element, from 0."""
    return F.array_position(a, F.array_max(a)).cast("int") - 1


def valid_hex(h: Column, digits: int) -> Column:
    return h.rlike(f"^[0-9a-fA-F]{{{digits}}}$")


def bands(h: Column, digits: int = 36, band_digits: int = 6) -> Column:
    """Array of (band, value): runs of hex digits, from the least significant."""
    return F.array(*[
        F.struct(F.lit(i).alias("band"), F.conv(F.substring(h, digits - band_digits * (i + 1) + 1, band_digits), 16, 10).cast("bigint").alias("value"))
        for i in range(digits // band_digits)])


def hamming(a: Column, b: Column, digits: int = 36) -> Column:
    """Differing bits of two hex strings of equal length, 64 bits at a time."""
    words = [(i + 1, min(16, digits - i)) for i in range(0, digits, 16)]
    word = lambda h, at, n: F.conv(F.substring(h, at, n), 16, -10).cast("bigint")
    total = F.lit(0)
    for at, n in words:
        total = total + F.bit_count(word(a, at, n).bitwiseXOR(word(b, at, n)))
    return total
