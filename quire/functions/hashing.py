"""Deterministic order keys.

``rand(seed)`` depends on partitioning, so shuffles are expressed as an order by
an md5 key instead. md5 hex is identical in Spark and DuckDB, so every shuffled
order can be checked by SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int | str, *parts: str | Column) -> Column:
    """``md5('<seed>:<part1>:<part2>…')`` as a 32-char lower-case hex string."""
    cols = [F.lit(str(seed))] + [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def hex_bucket(key: Column, digits: int) -> Column:
    """Leading ``digits`` hex digits of an md5 key as an integer in [0, 16**digits)."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")


def unit_interval(key: Column) -> Column:
    """Map an md5 key to a double in [0, 1) using its leading 13 hex digits (52 bits)."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
