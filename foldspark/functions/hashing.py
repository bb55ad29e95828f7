"""Randomness as a pure function of (seed, row key).

``rand(seed)`` depends on how rows are partitioned, so a split made with it
changes when the data is repartitioned and when a lost task is run again.
Hashing the key gives the same answer on any layout, and SQL can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 52  # 13 hex digits: an exact integer in a double
_HEX_DIGITS = HASH_BITS // 4


def hash_bits(seed: int | str, *keys: Column | str) -> Column:
    """A uniform integer in [0, 2^52) from the seed and the key columns."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    digits = F.substring(F.md5(text), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def hash01(seed: int | str, *keys: Column | str) -> Column:
    """A uniform double in [0, 1) from the seed and the key columns."""
    return hash_bits(seed, *keys) / F.lit(float(2**HASH_BITS))


def hash_index(n: int | Column, seed: int | str, *keys: Column | str) -> Column:
    """A uniform integer in [0, n)."""
    size = F.lit(n) if isinstance(n, int) else n
    return F.floor(hash01(seed, *keys) * size).cast("long")
