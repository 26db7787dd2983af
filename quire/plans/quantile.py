"""Exact quantiles per key without holding a group in one task.

``percentile`` buffers every value of a group in one aggregation buffer. Here the
rank of each value inside its key comes from the bucketed prefix count (buckets are
a monotone function of the value), and the two order statistics around the
quantile position are picked by a filter — the same linear interpolation as
``percentile``/``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.prefix import exclusive_prefix_sums


def value_bucket(value: str, resolution: int = 64):
    """A bucket monotone in a positive value with ``resolution`` buckets per octave."""
    v = F.col(value)
    return F.when(v > 0, F.floor(F.log2(v) * F.lit(resolution))).otherwise(F.lit(-(1 << 30))).cast("long")


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, p: float, out: str, tiebreak: str | None = None) -> DataFrame:
    """Per key: the ``p`` quantile of ``value`` (nulls ignored), linear interpolation
    between the order statistics at ``floor``/``ceil`` of ``p x (n - 1)``. Equal values are
    counted first and stand as one row with their number, so ties fill no bucket.
    (``tiebreak`` is no longer needed.)"""
    keys = list(keys)
    once = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__w"))
    rows = once.withColumn("__b", value_bucket(value))
    ranked = exclusive_prefix_sums(rows, keys, "__b", [value], {"__r": F.col("__w")})
    n = once.groupBy(*keys).agg(F.sum("__w").alias("__n"))
    pos = (F.col("__n") - 1).cast("double") * F.lit(p)
    j = ranked.join(n, keys).withColumn("__pos", pos)
    holds = lambda at: (F.col("__r") <= at) & (at < F.col("__r") + F.col("__w"))
    lo_hi = j.where(holds(F.floor("__pos")) | holds(F.ceil("__pos")))
    agg = lo_hi.groupBy(*keys).agg(
        F.min_by(value, "__r").alias("__lo"), F.max_by(value, "__r").alias("__hi"), F.first("__pos").alias("__pos")
    )
    frac = F.col("__pos") - F.floor("__pos")
    return agg.select(*keys, (F.col("__lo") + frac * (F.col("__hi") - F.col("__lo"))).alias(out))
