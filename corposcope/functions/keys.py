"""Seeded hash keys that do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(*parts: Column | str, seed: int = 42) -> Column:
    """Hexadecimal digest of the parts and the seed; sorting by it is a seeded shuffle."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def uniform(*parts: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) with 52 random bits, so every value is exact in a double."""
    return unit_interval(hash_key(*parts, seed=seed))


def unit_interval(digest: Column) -> Column:
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return bits / F.lit(float(2**52))


def bucket_of(digest: Column, digits: int) -> Column:
    """Leading hex digits of a digest: equal-sized, order-preserving buckets."""
    return F.substring(digest, 1, digits)
