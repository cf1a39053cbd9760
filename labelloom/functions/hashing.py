"""Randomness as a hash of a seed and stable keys: the same on any partitioning, and in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(seed: int | str, *keys: str | Column) -> Column:
    """md5 of "seed:key:key..." as 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def unit(h: Column) -> Column:
    """A double in [0, 1) from the first 12 digits of a hex hash."""
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
