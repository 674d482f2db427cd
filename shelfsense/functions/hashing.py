"""Row hashes that depend on key values only, so a split is the same under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32


def key_hash(keys: Sequence[str], seed: int | None = None) -> Column:
    """First 32 bits of the MD5 of the keys joined by ``|`` (then the seed), as a long."""
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, HASH_BITS // 4), 16, 10).cast("long")


def key_fraction(keys: Sequence[str], seed: int | None = None) -> Column:
    """The hash as a number in [0, 1)."""
    return key_hash(keys, seed) / F.lit(float(1 << HASH_BITS))
