"""Bucketed exclusive prefix sums.

A running sum as a plain window puts a whole partition key (a source, or the whole
stream) into one task. Instead rows carry a *bucket* that is monotone in the order:

1. ``groupBy(keys, bucket).sum(values)`` — a small table (keys x buckets rows),
   with map-side partial aggregation;
2. a window over that small table gives each bucket's starting offset;
3. the offsets are joined back (AQE broadcasts them when the measured size is small,
   otherwise it is a shuffle join) and a window *inside* ``(keys, bucket)`` adds the
   in-bucket running sum.

Nulls are values like any other: rows with a null key form a key of their own, and a
null bucket comes before all others, as a null does in ``order``. No row is dropped.

No task ever holds more than one bucket of one key, so a key that holds a third of
all rows is spread over ``buckets`` tasks. The result does not depend on the number
of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which a null equals a null; ``on`` is kept once."""
    renamed = right.select(*[F.col(c).alias(f"__on_{i}") for i, c in enumerate(on)], *[c for c in right.columns if c not in on])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__on_{i}")) for i, c in enumerate(on)])
    return left.join(renamed, same, how).drop(*[f"__on_{i}" for i in range(len(on))])


def exclusive_prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[str | Column],
    values: dict[str, str | Column],
) -> DataFrame:
    """Add, for every ``out -> value`` in ``values``, the sum of ``value`` over all
    earlier rows of the same ``keys`` in ``order``. ``bucket`` must be non-decreasing
    in ``order``."""
    keys = list(keys)
    tmp = {out: f"__v_{i}" for i, out in enumerate(values)}
    staged = df
    for out, expr in values.items():
        staged = staged.withColumn(tmp[out], F.col(expr) if isinstance(expr, str) else expr)

    totals = staged.groupBy(*keys, bucket).agg(*[F.sum(tmp[o]).alias(f"{tmp[o]}_b") for o in values])
    over_buckets = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if not keys:
        # The bucket table of a global sum is small (buckets rows); one task is fine.
        over_buckets = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        bucket,
        *[F.coalesce(F.sum(f"{tmp[o]}_b").over(over_buckets), F.lit(0)).alias(f"{tmp[o]}_off") for o in values],
    )

    joined = join_null_safe(staged, offsets, [*keys, bucket])
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = joined
    for o in values:
        out = out.withColumn(o, F.col(f"{tmp[o]}_off") + F.coalesce(F.sum(tmp[o]).over(within), F.lit(0)))
    return out.drop(*tmp.values(), *[f"{t}_off" for t in tmp.values()])


def bucketed_rank(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str | Column], out: str = "rank") -> DataFrame:
    """1-based ``row_number()`` over ``keys`` in ``order``, computed bucket-wise."""
    ranked = exclusive_prefix_sums(df, keys, bucket, order, {out: F.lit(1).cast("long")})
    return ranked.withColumn(out, F.col(out) + F.lit(1))
