"""Aggregations over hierarchies and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hierarchical_loss(df: DataFrame, levels: Sequence[str], original: str, removed: str) -> DataFrame:
    """Totals and loss for every prefix of ``levels``: original, removed (at most the original), remaining, the weighted
    percentage, and the unweighted mean of the percentages of the finest rows. A7.

    A row whose original is at most 1e-12 has no percentage. One Expand and one shuffle of partial sums. A level is null
    in the rows above it; ``depth`` tells how many levels a row has, so null keys and totals don't mix."""
    orig = F.coalesce(F.col(original).cast("double"), F.lit(0.0))
    gone = F.least(orig, F.coalesce(F.col(removed).cast("double"), F.lit(0.0)))
    fine = df.groupBy(*levels).agg(F.sum(orig).alias("o"), F.sum(gone).alias("r")).withColumn("p", F.when(F.col("o") > 1e-12, 100 * F.col("r") / F.when(F.col("o") > 1e-12, F.col("o"))))
    sets = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), *[(F.col(c) if i < d else F.lit(None).cast(fine.schema[c].dataType)).alias(c) for i, c in enumerate(levels)]) for d in range(len(levels) + 1)]))
    up = fine.select("o", "r", "p", sets.alias("k")).select("o", "r", "p", "k.*")
    out = up.groupBy("depth", *levels).agg(F.sum("o").alias("original"), F.sum("r").alias("removed"), F.avg("p").alias("mean_pct"))
    return out.select("depth", *levels, "original", "removed", (F.col("original") - F.col("removed")).alias("remaining"), F.when(F.col("original") > 1e-12, 100 * F.col("removed") / F.when(F.col("original") > 1e-12, F.col("original"))).alias("weighted_pct"), "mean_pct")


def otsu_threshold(df: DataFrame, keys: Sequence[str], value: str, lo: float, hi: float, bins: int = 256) -> DataFrame:
    """Threshold with the greatest between-class variance of each group's histogram: ``keys, threshold_bin``. A22.

    The histogram is pre-aggregated before the shuffle; the window runs over ``bins`` rows of a group. First bin wins."""
    b = F.least(F.greatest(F.floor((F.col(value) - lo) / F.lit((hi - lo) / bins)), F.lit(0)), F.lit(bins - 1)).cast("int")
    h = df.filter(F.col(value).isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    run = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    c = h.withColumn("w0", F.sum("n").over(run)).withColumn("s0", F.sum(F.col("n") * F.col("bin")).over(run)).withColumn("wt", F.sum("n").over(w)).withColumn("st", F.sum(F.col("n") * F.col("bin")).over(w))
    diff = F.try_divide(F.col("s0"), F.col("w0")) - F.try_divide(F.col("st") - F.col("s0"), F.col("wt") - F.col("w0"))
    var = F.col("w0") * (F.col("wt") - F.col("w0")) * diff * diff
    return c.withColumn("v", F.bround(F.coalesce(var, F.lit(-1.0)), 6)).groupBy(*keys).agg(F.max_by("bin", F.struct(F.col("v"), -F.col("bin"))).alias("threshold_bin"))


def reasons(*rules: tuple[str, Column]) -> Column:
    """Names of all rules that hold, in order; an empty array means valid. P13."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]))


def first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that holds, in order: the early-out cascade of filters as a testable column. P3."""
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in rules], F.lit(None).cast("string"))


def device_grid(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per device: crops, defects, wafers with a defect; and the header totals. A26."""
    n = F.when(F.col("defects").isNotNull(), F.size("defects")).otherwise(0)
    per = entries.groupBy("cell_row", "cell_col").agg(F.count("*").alias("crops"), F.sum(n).alias("defects"), F.countDistinct(F.when(n > 0, F.col("wafer_id"))).alias("wafers_with_defects"))
    head = entries.agg(F.countDistinct("wafer_id").alias("wafers"), F.countDistinct("cell_row", "cell_col").alias("devices"), F.countDistinct(F.when(n > 0, F.struct("cell_row", "cell_col"))).alias("flagged_devices"), F.sum(n).alias("defect_regions"))
    return per, head


def best_by(df: DataFrame, keys: Sequence[str], score: str, order: str) -> DataFrame:
    """Row with the greatest score per group, the first in ``order`` among equals. O6."""
    w = F.struct(F.col(score), -F.col(order).cast("double"))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), w).alias("r")).select(*keys, "r.*")


def capped(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """At most ``k`` rows of each group by ``order``, which must be total: a stated limit of the detector. O4, O5.

    Spark prunes to k rows per group in each task before the shuffle (WindowGroupLimit)."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= k).drop("__n")
