"""Repeatable randomness from row keys.

``md5(seed ':' key)`` gives the same hex text in Spark and in any SQL engine
with ``md5``, and does not depend on partitioning, so samples, splits and
shuffles are stable across cluster sizes and task retries (unlike
``df.sample`` / ``randomSplit``, whose rows change with the partition layout).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296  # 2^32: range of the first 8 hex digits


def _cols(keys: str | Sequence[str] | Column) -> list[Column]:
    if isinstance(keys, Column):
        return [keys]
    if isinstance(keys, str):
        keys = [keys]
    return [(k if isinstance(k, Column) else F.col(k)).cast("string") for k in keys]


def seeded_hash(seed: int | str, keys: str | Sequence[str] | Column) -> Column:
    """Lower-case hex md5 of ``'<seed>:<key1>:<key2>...'``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *_cols(keys)))


def hash_u32(h: Column) -> Column:
    """Integer in [0, 2^32) from the first 8 hex digits of a hash."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def seeded_u32(seed: int | str, keys: str | Sequence[str] | Column) -> Column:
    return hash_u32(seeded_hash(seed, keys))


def seeded_uniform(seed: int | str, keys: str | Sequence[str] | Column) -> Column:
    """Uniform double in [0, 1)."""
    return seeded_u32(seed, keys) / F.lit(float(TWO_32))


def keep_bound(fraction: float | Column) -> Column:
    """Integer bound b with P(u32 < b) = fraction (rounded up to 2^-32)."""
    f = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return F.ceil(f * F.lit(float(TWO_32))).cast("long")


def bernoulli_keep(seed: int | str, keys: str | Sequence[str] | Column,
                   fraction: float | Column) -> Column:
    """True for a repeatable ``fraction`` of keys; all keys when fraction >= 1."""
    f = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return (f >= 1) | (seeded_u32(seed, keys) < keep_bound(f))
