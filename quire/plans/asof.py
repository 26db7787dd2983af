"""Bucketed "last value before" (as-of lookup / lag) per key.

``lag`` or ``last(ignorenulls)`` over a window partitioned by a key puts every row of
that key into one task. Here rows also carry a *bucket* that is monotone in the
order (e.g. a time bucket):

1. per ``(keys, bucket)`` the last non-null value (``max_by`` on the order) — a small
   table of keys x buckets rows, partially aggregated before the shuffle;
2. a window over that small table carries the last value of earlier buckets;
3. joined back, a window inside ``(keys, bucket)`` finds the last earlier value in
   the same bucket, falling back to the carried one.

A key holding a third of all rows is thus processed by as many tasks as it has
buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.prefix import join_null_safe


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[str],
    value: str | Column,
    out: str,
) -> DataFrame:
    """Add ``out`` = the last non-null ``value`` of an earlier row of the same ``keys``
    in ``order`` (strictly before; ties in ``order`` are broken by the listed columns,
    which must make the order total)."""
    return last_before_many(df, keys, bucket, order, {out: value})


def last_before_many(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[str],
    values: dict[str, str | Column],
) -> DataFrame:
    """``last_before`` for several values in one pass (one bucket table, one join,
    one window)."""
    keys = list(keys)
    tmp = {o: f"__v{i}" for i, o in enumerate(values)}
    staged = df
    for o, v in values.items():
        staged = staged.withColumn(tmp[o], F.col(v) if isinstance(v, str) else v)
    ord_struct = F.struct(*[F.col(o) for o in order])
    per_bucket = staged.groupBy(*keys, bucket).agg(
        *[F.max_by(tmp[o], F.when(F.col(tmp[o]).isNotNull(), ord_struct)).alias(f"{tmp[o]}_bl") for o in values]
    )
    # Every bucket present in the data gets the last value of earlier buckets.
    w_all = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        *keys, bucket, *[F.last(f"{tmp[o]}_bl", ignorenulls=True).over(w_all).alias(f"{tmp[o]}_c") for o in values]
    )
    joined = join_null_safe(staged, carry, [*keys, bucket], "left")
    w_in = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    res = joined
    for o in values:
        res = res.withColumn(o, F.coalesce(F.last(tmp[o], ignorenulls=True).over(w_in), F.col(f"{tmp[o]}_c")))
    return res.drop(*tmp.values(), *[f"{t}_c" for t in tmp.values()])


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp (no session time zone
    involved)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), t.cast("timestamp_ntz"))


def time_bucket(ts: str | Column, seconds: int) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(seconds * 1_000_000)).cast("long")
