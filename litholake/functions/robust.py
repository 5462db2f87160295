"""Robust statistics (A1-A6, A8): medians, MAD, robust z, trimmed medians, modes, gaps.

``exact=True`` uses Spark's exact interpolated percentile, which keeps one counter per distinct value of a group; it is
the right choice while groups have at most some millions of distinct values. ``quantiles_by_bisection`` and
``medians_by_bisection`` have no such limit: they narrow the value range of every group with histograms of fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litholake.session import materialise

MAD_TO_SIGMA = 1.4826


def finite(c: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def center_spread(df: DataFrame, keys: Sequence[str], value: str, floor: float = 0.0) -> DataFrame:
    """Per group: ``n``, ``center`` (median, 0 for no finite value), ``spread`` (1.4826 MAD, at least ``floor``). A1, A2.

    Nulls, NaN and infinities are left out; null keys form a group; empty input gives no group."""
    v = df.select(*keys, finite(F.col(value)).alias("v"))
    mid = v.groupBy(*keys).agg(F.count("v").alias("n"), F.coalesce(F.median("v"), F.lit(0.0)).alias("center"))
    renamed = mid.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "n", "center")
    dev = v.join(renamed, _same_keys(keys)).select(*keys, "n", "center", F.abs(F.col("v") - F.col("center")).alias("d"))
    return dev.groupBy(*keys, "n", "center").agg(F.greatest(F.coalesce(F.median("d"), F.lit(0.0)) * MAD_TO_SIGMA, F.lit(float(floor))).alias("spread"))


def _same_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys with columns ``__k0, __k1, ..``."""
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return cond


def robust_z(df: DataFrame, keys: Sequence[str], value: str, floor: float = 1e-9, out: str = "z", stats: DataFrame | None = None) -> DataFrame:
    """Adds ``(value - median) / max(1.4826 MAD, floor)`` of the row's group; null where the value is not finite. A2.
    ``stats``: the result of ``center_spread`` where it is known already."""
    stats = (center_spread(df, keys, value, floor) if stats is None else stats).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("center").alias("__c"), F.col("spread").alias("__s"))
    joined = df.join(stats, _same_keys(keys), "left")
    return joined.withColumn(out, F.try_divide(finite(F.col(value)) - F.col("__c"), F.col("__s"))).drop("__c", "__s", *[f"__k{i}" for i in range(len(keys))])


def trimmed_median(df: DataFrame, keys: Sequence[str], value: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Median of the values between two interpolated percentiles, both included. A3."""
    v = df.select(*keys, finite(F.col(value)).alias("v")).filter("v is not null")
    ends = v.groupBy(*keys).agg(F.percentile("v", F.array(F.lit(low), F.lit(high))).alias("p"))
    e = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "p")
    kept = v.join(e, _same_keys(keys)).filter((F.col("v") >= F.col("p")[0]) & (F.col("v") <= F.col("p")[1]))
    return kept.groupBy(*keys).agg(F.median("v").alias("trimmed_median"), F.count("*").alias("kept"))


def mode_first(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Most frequent non-null value per group; ties go to the one seen first in ``order``. A4."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("n"), -F.col("seen").cast("double"), F.lit(0))).alias("mode"), F.max("n").alias("mode_count"))


def gap_pitch(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median of the positive gaps between neighbouring distinct values. A5. One value alone has no pitch (null)."""
    d = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    w = Window.partitionBy(*keys).orderBy(value)
    gaps = d.withColumn("gap", F.col(value) - F.lag(value).over(w))
    return gaps.groupBy(*keys).agg(F.median(F.when(F.col("gap") > 0, F.col("gap"))).alias("pitch"), F.count("*").alias("distinct_values"))


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Counts of each combination, most common first, then by value. A6."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), *[F.col(c).asc_nulls_last() for c in cols])


def quantiles_by_bisection(df: DataFrame, key: str, value: str, q: float, bins: int = 512, small: int = 4096, max_rounds: int = 12) -> DataFrame:
    """The value of rank ``ceil(q n)`` of every group, for groups of any size: ``key, n, value``.

    Each round counts the values of a group's remaining range in ``bins`` bins (pre-aggregated before the shuffle) and
    keeps only the bin that holds the rank, until at most ``small`` values are left, among which it is picked exactly.
    Nothing of a group's size ever meets in one task. Null keys and values that are not finite are left out."""
    v = materialise(df.select(F.col(key).alias("k"), finite(F.col(value)).alias("v")).filter("k is not null and v is not null"), "bisect")
    state = v.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = state.select("k", "n", "lo", "hi", F.greatest(F.ceil(F.col("n") * q), F.lit(1)).alias("rank"), F.col("n").alias("left"))
    state = materialise(state, "bisect-state")
    for _ in range(max_rounds):
        if state.filter((F.col("left") > small) & (F.col("lo") < F.col("hi"))).isEmpty():
            break
        open_ = state.filter((F.col("left") > small) & (F.col("lo") < F.col("hi")))
        width = (F.col("hi") - F.col("lo")) / bins
        at = F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))
        hist = v.join(open_, "k").filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).groupBy("k", "n", "rank", at.alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("blo"), F.max("v").alias("bhi"))
        w = Window.partitionBy("k").orderBy("bin")
        placed = hist.withColumn("upto", F.sum("c").over(w)).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
        step = placed.select("k", "n", F.col("blo").alias("lo"), F.col("bhi").alias("hi"), (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), F.col("c").alias("left"))
        state = materialise(step.unionByName(state.join(open_.select("k"), "k", "left_anti")), "bisect-state")
    few = v.join(state, "k").filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).groupBy("k", "n", "rank", "v").agg(F.count("*").alias("c"))
    w = Window.partitionBy("k").orderBy("v")
    hit = few.withColumn("upto", F.sum("c").over(w)).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
    return hit.select(F.col("k").alias(key), "n", F.col("v").alias("value"))


def medians_by_bisection(df: DataFrame, keys: Sequence[str], value: str, ends: DataFrame, bins: int = 4096, small: int = 262144) -> DataFrame:
    """The interpolated median of every group, as ``F.median`` has it, for groups of any size: ``keys, median``.

    ``ends`` has a row for each group: the keys, the number ``n`` of its values, and ``lo`` and ``hi``, between which about
    all of them lie (they only place the first bins). Each round counts the values of a group's remaining range in ``bins``
    bins, or one by one when at most ``small`` are left, pre-aggregated before the shuffle, and keeps the bin that holds the
    lower middle rank. Nothing of a group's size ever meets in one task. Every round narrows the range to values that occur,
    so it ends. NaN counts as the largest value. Null keys and values are left out; ``n`` must not count them."""
    on = list(keys)
    v = df.select(*on, F.col(value).cast("double").alias("v")).filter("v is not null")
    inf, n = float("inf"), F.col("n").cast("long")
    left = ends.select(*on, F.lit(-inf).alias("lo"), F.lit(float("nan")).alias("hi"), F.col("lo").cast("double").alias("from"), F.col("hi").cast("double").alias("to"), F.floor((n + 1) / 2).alias("rank"), (n % 2 == 0).alias("even"), n.alias("left"))
    found = []
    while True:
        wide = F.col("to") - F.col("from")
        singly = (F.col("left") <= small) | ~F.coalesce(wide < inf, F.lit(False))
        place = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("from"), wide) * bins), F.lit(0)).cast("double")
        at = F.when(singly, F.col("v")).when(F.col("v") > F.col("to"), float(bins)).when(F.col("v") < F.col("from"), -1.0).otherwise(place)
        inside = v.join(left, on).filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        hist = inside.groupBy(*on, at.alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("blo"), F.max("v").alias("bhi"))
        w = Window.partitionBy(*on).orderBy("bin")
        placed = hist.withColumn("upto", F.sum("c").over(w)).withColumn("next", F.lead("blo").over(w)).join(left.select(*on, "rank", "even"), on)
        placed = placed.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
        middle = F.when(F.col("even") & (F.col("upto") == F.col("rank")), F.col("bhi") * 0.5 + F.col("next") * 0.5).when(F.col("blo") == F.col("bhi"), F.col("blo"))
        step = placed.select(*on, middle.alias("median"), F.col("blo").alias("lo"), F.col("bhi").alias("hi"), (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), "even", F.col("c").alias("left"))
        step = materialise(step, "bisect-state")  # a row for each group
        found.append(step.filter("median is not null").select(*on, "median"))
        left = step.filter("median is null").select(*on, "lo", "hi", F.col("lo").alias("from"), F.col("hi").alias("to"), "rank", "even", "left")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, found)
