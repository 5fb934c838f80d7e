"""Exact medians and quantiles that survive hot groups.

The route is a histogram: rows are first counted per (group, value), which
combines map-side and spreads one hot group over many tasks because the value is
part of the key. Only then are the distinct values of a group brought together
and ranked by a running count, in a spilling window and not in an in-memory list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.session import dealt

#: The statistics of the short and of the long metric pack.
SHORT_PACK = ("count", "median", "q25", "q75")
LONG_PACK = ("count", "median", "mean", "max", "min", "std", "q25", "q75")


def stack_values(df: DataFrame, keep: Sequence[str], values: Mapping[int, str | Column]) -> DataFrame:
    """Rows ``(keep..., metric, value)``, one for each code in ``values``."""
    pairs = [
        F.struct(F.lit(code).cast("tinyint").alias("metric"), (F.col(c) if isinstance(c, str) else c).alias("value"))
        for code, c in values.items()
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))


def histogram(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """``(keys..., value, n)``; a NULL value keeps its group alive with n = 0."""
    return df.groupBy(*keys, value).agg(F.count(value).alias("n"))


def _at(cum: str, n: str, index: Column) -> Column:
    return (F.col(cum) - F.col(n) <= index) & (index < F.col(cum))


def ranked_pack(
    hist: DataFrame, keys: Sequence[str], metric: str = "metric", stats: Sequence[str] = SHORT_PACK
) -> DataFrame:
    """From a histogram to ``(keys..., metric, <stats>)``.

    q25 and q75 are nearest-rank: the element at ``round(q * (n - 1))`` with
    halves rounded up. The median is the mean of the two middle elements.
    """
    # One exchange on the keys serves the window, this aggregate and a later pivot.
    by_key = dealt(hist, *keys).withColumn("__group", F.xxhash64(*keys, metric))
    # A number in front, so that rows of different groups are told apart by one comparison when they are sorted.
    group = W.partitionBy("__group", *keys, metric)
    ranked = by_key.select(
        *keys, metric, "value", "n",
        F.sum("n").over(group.orderBy("value").rowsBetween(W.unboundedPreceding, 0)).alias("__cum"),
        F.sum("n").over(group).alias("__total"),
    )
    last = F.col("__total") - 1
    pick = lambda i: F.max(F.when(_at("__cum", "n", i), F.col("value")))
    nearest = lambda q100: F.floor((last * q100 + 50) / 100)
    value, n = F.col("value").cast("double"), F.col("n")
    total = F.sum("n")
    mean = F.try_divide(F.sum(value * n), total)
    squares = F.sum(value * value * n) - F.pow(F.sum(value * n), 2) / F.nullif(total, F.lit(0))
    exprs = {
        "count": total,
        "median": (pick(F.floor(last / 2)) + pick(F.floor((last + 1) / 2))) / 2,
        "q25": pick(nearest(25)).cast("double"),
        "q75": pick(nearest(75)).cast("double"),
        "mean": mean,
        "max": F.max(F.when(n > 0, value)),
        "min": F.min(F.when(n > 0, value)),
        "std": F.when(total > 1, F.sqrt(F.greatest(F.lit(0.0), squares) / F.nullif(total - 1, F.lit(0)))),
    }
    return ranked.groupBy(*keys, metric).agg(*[exprs[s].alias(s) for s in stats])


def pivot_pack(
    packs: DataFrame,
    keys: Sequence[str],
    names: Mapping[int, str],
    stats: Sequence[str] = SHORT_PACK,
) -> DataFrame:
    """One row per key with ``<stat>_<name>`` columns."""
    cols = [
        F.max(F.when(F.col("metric") == code, F.col(s))).alias(f"{s}_{name}")
        for code, name in names.items()
        for s in stats
    ]
    return packs.groupBy(*keys).agg(*cols)


def group_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact median of several columns per group, NULLs ignored."""
    codes = dict(enumerate(columns))
    stacked = stack_values(df, keys, {i: F.col(c).cast("double") for i, c in codes.items()})
    hist = histogram(stacked, [*keys, "metric"])
    packs = ranked_pack(hist, keys, stats=("median",))
    return packs.groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric") == i, F.col("median"))).alias(c) for i, c in codes.items()]
    )


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str) -> DataFrame:
    """Smallest value at which the running weight reaches half of the group's.

    Weights are counts, so the test ``2 * running >= total`` is exact.
    """
    sums = df.filter(F.col(weight) > 0).groupBy(*keys, value).agg(F.sum(weight).alias("__w"))
    group = W.partitionBy(*keys)
    ranked = sums.select(
        *keys, value,
        F.sum("__w").over(group.orderBy(value).rowsBetween(W.unboundedPreceding, 0)).alias("__cum"),
        F.sum("__w").over(group).alias("__total"),
    )
    half = F.col("__cum") * 2 >= F.col("__total")
    return ranked.filter(half).groupBy(*keys).agg(F.min(value).alias(out))


def with_weights(df: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Share of each row in its group's total weight (the figures behind the weighted median).

    The totals come from a mergeable aggregate joined back, not from a window
    that would hold the whole group.
    """
    totals = df.groupBy(*keys).agg(F.sum(weight).alias("total_weight"))
    return df.join(totals, list(keys)).withColumn(
        "weight_share", F.try_divide(F.col(weight), F.col("total_weight"))
    )
