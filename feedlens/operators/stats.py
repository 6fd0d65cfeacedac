"""Exact median for groups of any size (distributed rank selection).

Spark's exact ``percentile`` keeps, per group, one entry per distinct value
in a single task. A group that holds a third of a 100 TB table does not fit
there. Instead, the two middle ranks are located by narrowing:

1. (group, value) -> count: a shuffle on (group, value), so a hot group is
   spread over every reducer and duplicates collapse map-side.
2. For each group: n, min, max. The targets are ranks (n-1) div 2 and n div 2.
3. Twice: bucket the candidate values of each target into B equal-width
   buckets of its current [lo, hi] (the bucket index is monotonic in the
   value), count per bucket (a table of at most B rows per target), walk the
   cumulative counts, and keep the bucket holding the rank.
4. Sort only the values left in the final bucket (a range B^2 times narrower
   than the group's) and pick the ranked values.

The steps are lazy: no action, no collect, no loop over data on the driver.
Each reads the counts again, so callers pass them as a written table.
The result equals the interpolated median: lo if both middles are equal,
else 0.5*lo + 0.5*hi (the form Spark's percentile uses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 16
LEVELS = 2
# groups with at most this many distinct values take the single-aggregate
# exact median (its state is one entry per distinct value, so it is bounded)
SMALL_GROUP_DISTINCT = 1 << 20


def _join_targets(vc: DataFrame, targets: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Candidate values of each target: same group (null-safe), inside [lo, hi]."""
    t = targets.select(*[F.col(k).alias(f"_t_{k}") for k in keys],
                       "_which", "_rank", "_lo", "_hi", "_below")
    cond = [vc[k].eqNullSafe(t[f"_t_{k}"]) for k in keys]
    return (vc.join(t, cond)
            .where(F.col(value).between(F.col("_lo"), F.col("_hi")))
            .drop(*[f"_t_{k}" for k in keys]))


def _narrow(vc: DataFrame, targets: DataFrame, keys: list[str], value: str, count: str,
            buckets: int) -> DataFrame:
    cand = _join_targets(vc, targets, keys, value)
    width = F.col("_hi") - F.col("_lo")
    bucket = F.when(width > 0, F.least(F.lit(buckets - 1),
                                       F.floor((F.col(value) - F.col("_lo")) / width * F.lit(float(buckets)))))\
        .otherwise(F.lit(0))
    hist = (cand.groupBy(*keys, "_which", "_rank", "_below", bucket.alias("_b"))
            .agg(F.sum(count).alias("_c"), F.min(value).alias("_blo"), F.max(value).alias("_bhi")))
    w = Window.partitionBy(*keys, "_which").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_start", F.col("_below") + F.sum("_c").over(w) - F.col("_c"))
    return (hist.where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_c")))
            .select(*keys, "_which", "_rank", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"),
                    F.col("_start").alias("_below")))


def median_from_counts(vc: DataFrame, keys: list[str], value: str, count: str,
                       buckets: int = BUCKETS, levels: int = LEVELS,
                       small_group_distinct: int = SMALL_GROUP_DISTINCT) -> DataFrame:
    """keys + ``median`` from a frame of (keys, value, count) with distinct
    (keys, value) and non-null values.

    Groups of at most ``small_group_distinct`` distinct values are finished by
    one exact ``percentile`` aggregate with bounded state, which is cheaper for
    many small groups; with 0 all groups go through rank selection."""
    stats = vc.groupBy(*keys).agg(F.sum(count).alias("_n"), F.min(value).alias("_lo"),
                                  F.max(value).alias("_hi"), F.count(F.lit(1)).alias("_d"))
    if small_group_distinct <= 0:
        return _select_median(vc, stats, keys, value, count, buckets, levels)
    tagged = _join_stats(vc, stats.select(*keys, "_d"), keys)
    small = (tagged.where(F.col("_d") <= small_group_distinct).groupBy(*keys)
             .agg(F.percentile(F.col(value), F.lit(0.5), F.col(count)).alias("median")))
    large_vc = tagged.where(F.col("_d") > small_group_distinct).drop("_d")
    large = _select_median(large_vc, stats.where(F.col("_d") > small_group_distinct), keys, value, count,
                           buckets, levels)
    return small.unionByName(large)


def _join_stats(vc: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    s = stats.select(*[F.col(k).alias(f"_s_{k}") for k in keys], "_d")
    cond = [vc[k].eqNullSafe(s[f"_s_{k}"]) for k in keys]
    return vc.join(s, cond).drop(*[f"_s_{k}" for k in keys])


def _select_median(vc: DataFrame, stats: DataFrame, keys: list[str], value: str, count: str,
                   buckets: int, levels: int) -> DataFrame:
    targets = stats.select(
        *keys, "_lo", "_hi", F.lit(0).cast("bigint").alias("_below"),
        F.explode(F.array(F.struct(F.lit(0).alias("w"), F.expr("(_n - 1) div 2").alias("r")),
                          F.struct(F.lit(1).alias("w"), F.expr("_n div 2").alias("r")))).alias("_t"))
    targets = targets.select(*keys, F.col("_t.w").alias("_which"), F.col("_t.r").alias("_rank"),
                             "_lo", "_hi", "_below")
    for _ in range(levels):
        targets = _narrow(vc, targets, keys, value, count, buckets)
    cand = _join_targets(vc, targets, keys, value)
    w = Window.partitionBy(*keys, "_which").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cand = cand.withColumn("_end", F.col("_below") + F.sum(count).over(w))
    picked = cand.where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col(count)))
    res = picked.groupBy(*keys).agg(F.max(F.when(F.col("_which") == 0, F.col(value))).alias("_mlo"),
                                    F.max(F.when(F.col("_which") == 1, F.col(value))).alias("_mhi"))
    med = F.when(F.col("_mlo") == F.col("_mhi"), F.col("_mlo")) \
        .otherwise(F.lit(0.5) * F.col("_mlo") + F.lit(0.5) * F.col("_mhi"))
    return res.select(*keys, med.alias("median"))


def median_by(df: DataFrame, keys: list[str], value: str, **kw) -> DataFrame:
    """Exact median of ``value`` per ``keys`` (see module doc)."""
    vc = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
          .agg(F.count(F.lit(1)).alias("_cnt")))
    return median_from_counts(vc, keys, value, "_cnt", **kw)
