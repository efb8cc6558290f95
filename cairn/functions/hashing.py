"""Stable hashing for bucket ids and experiment assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(col: Column, n: int) -> Column:
    """The bucket Spark's writer uses for ``bucketBy(n, col)``: pmod(hash(col), n)."""
    return F.pmod(F.hash(col), F.lit(n))


def md5_bucket(col: Column, modulus: int = 100, salt: str = "") -> Column:
    """Engine-independent hash bucket: first 8 hex digits of md5(salt || value) mod ``modulus``."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), col.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(modulus))
