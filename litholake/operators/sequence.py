"""Window and sequence operators (W1-W21). Every window has a total order; ``order`` columns must provide it.

A window runs one group in one task. Groups here are profiles, rows or users; where one group may hold a large share of
the table, bucket it first (``keys`` plus a coarse time or position bucket)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: Sequence[str], position: str, limit: Column | float, out: str = "island", ties: Sequence[str] = ()) -> DataFrame:
    """Numbers the runs of rows whose gap to the predecessor is at most ``limit``; the first run is 0. W2, W17.

    Null positions come first and never open a run."""
    w = Window.partitionBy(*keys).orderBy(position, *ties)
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    gap = F.col(position) - F.lag(position).over(w)
    return df.withColumn("__new", F.coalesce((gap > limit).cast("int"), F.lit(0))).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def running_mean_clusters(df: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """1-D clustering of sorted values: a value joins the current cluster if it lies within ``tolerance`` of its running
    mean. ``keys, cluster_no, n, center``. W1.

    The fold is order-dependent, so a group is folded in one task, but as a stream: rows arrive sorted from Spark's
    external sort and only the running cluster is held. Nulls and NaN are left out."""
    kept = [df.schema[k] for k in keys]
    from pyspark.sql import types as T

    schema = T.StructType([*kept, T.StructField("cluster_no", T.LongType()), T.StructField("n", T.LongType()), T.StructField("center", T.DoubleType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, no, n, total, out = None, 0, 0, 0.0, []
        for b in batches:
            for *k, v in b.itertuples(index=False, name=None):
                if k != key:
                    if n:
                        out.append((*key, no, n, total / n))
                    key, no, n, total = k, 0, 0, 0.0
                if n and abs(v - total / n) > tolerance:
                    out.append((*key, no, n, total / n))
                    no, n, total = no + 1, 0, 0.0
                n, total = n + 1, total + v
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        if n:
            yield pd.DataFrame([(*key, no, n, total / n)], columns=names)

    v = df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v is not null and not isnan(__v)")
    v = v.repartition(*keys) if keys else v.coalesce(1)
    return v.sortWithinPartitions(*keys, "__v").mapInPandas(run, schema)


def moving_mean_same(df: DataFrame, keys: Sequence[str], order: str, value: str, radius: int, out: str = "smooth") -> DataFrame:
    """Zero-padded moving mean: the divisor is always 2 radius + 1, so the ends shrink towards 0. W4."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-radius, radius)
    return df.withColumn(out, F.sum(F.coalesce(F.col(value), F.lit(0))).over(w) / F.lit(float(2 * radius + 1)))


def directional_transition(df: DataFrame, keys: Sequence[str], order: str, value: str, radius: int, inside_positive: bool = True, out: str = "step") -> DataFrame:
    """Mean of the next ``radius`` values less that of the previous ones, not below 0; 0 where a side is empty. W5."""
    w = Window.partitionBy(*keys).orderBy(order)
    ahead, behind = F.avg(value).over(w.rowsBetween(1, radius)), F.avg(value).over(w.rowsBetween(-radius, -1))
    return df.withColumn(out, F.coalesce(F.greatest(ahead - behind if inside_positive else behind - ahead, F.lit(0.0)), F.lit(0.0)))


def gaussian_smooth(df: DataFrame, keys: Sequence[str], order: str, value: str, sigma: float, out: str = "smooth") -> DataFrame:
    """Gaussian weights over 3 sigma, renormalised at the ends. W6."""
    r = max(1, int(np.ceil(3 * sigma)))
    w = Window.partitionBy(*keys).orderBy(order)
    num = den = F.lit(0.0)
    for k in range(-r, r + 1):
        g = float(np.exp(-0.5 * (k / sigma) ** 2))
        v = F.lag(value, -k).over(w) if k else F.col(value)
        num, den = num + F.coalesce(v * g, F.lit(0.0)), den + F.when(v.isNotNull(), F.lit(g)).otherwise(F.lit(0.0))
    return df.withColumn(out, F.try_divide(num, den))


def local_maxima(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Rows above their predecessor and not below their successor; the ends count as lower. W8."""
    w = Window.partitionBy(*keys).orderBy(order)
    low = F.lit(float("-inf"))
    return df.withColumn("__p", F.coalesce(F.lag(value).over(w).cast("double"), low)).withColumn("__n", F.coalesce(F.lead(value).over(w).cast("double"), low)).filter((F.col(value) > F.col("__p")) & (F.col(value) >= F.col("__n"))).drop("__p", "__n")


def peak_confidence(z: Column) -> Column:
    """clip((z - 0.5) / 5, 0, 1). W8."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (z - 0.5) / 5))


def autocorrelation(df: DataFrame, keys: Sequence[str], order: str, value: str, low: int, high: int) -> DataFrame:
    """Sums of x(t) x(t + lag) about the mean for lags [low, high), and the first lag of the greatest: W13."""
    on = list(keys)
    mean = Window.partitionBy(*on)
    w = mean.orderBy(order)
    c = df.select(*on, order, (F.col(value) - F.avg(value).over(mean)).alias("x"))
    c = c.select(*on, "x", *[F.lead("x", k).over(w).alias(f"l{k}") for k in range(low, high)])
    s = c.groupBy(*on).agg(*[F.sum(F.col("x") * F.col(f"l{k}")).alias(f"l{k}") for k in range(low, high)])
    best = F.array_max(F.array(*[F.struct(F.coalesce(F.col(f"l{k}"), F.lit(float("-inf"))).alias("s"), F.lit(-k).alias("k")) for k in range(low, high)]))
    return s.select(*on, (-best["k"]).alias("lag"), best["s"].alias("strength"))


def periodic_neighbours(df: DataFrame, keys: Sequence[str], order: str, value: str, pitch: int, reach: int = 3, out: str = "expected") -> DataFrame:
    """Median of the values 1..reach pitches before and after; null where none exists. W11."""
    w = Window.partitionBy(*keys).orderBy(order)
    around = F.array_sort(F.array_compact(F.array(*[F.lag(value, s * k * pitch).over(w).cast("double") for k in range(1, reach + 1) for s in (1, -1)])))
    n = F.size(around)
    mid = F.col("__a")
    df = df.withColumn("__a", around).withColumn("__n", F.size("__a"))
    del n
    lower, upper = F.get(mid, F.floor((F.col("__n") - 1) / 2).cast("int")), F.get(mid, F.floor(F.col("__n") / 2).cast("int"))
    return df.withColumn(out, F.when(F.col("__n") > 0, (lower + upper) / 2)).drop("__a", "__n")


def multiscale_context(df: DataFrame, keys: Sequence[str], order: str, value: str, sizes: Sequence[int] = (9, 17, 31, 57, 97), level: float = 0.0) -> DataFrame:
    """Value less its centred mean at several scales: the greatest difference, and how many exceed ``level``. W12."""
    w = Window.partitionBy(*keys).orderBy(order)
    diffs = [F.col(value) - F.avg(value).over(w.rowsBetween(-(k // 2), k // 2)) for k in sizes]
    return df.withColumn("contrast", F.greatest(*diffs)).withColumn("support", sum([(d > level).cast("int") for d in diffs], F.lit(0)))


def column_row_expected(df: DataFrame, image: Sequence[str], col: str, row: str, value: str, least: Column | int = 8, out: str = "expected") -> DataFrame:
    """Column median plus row median of what the columns leave, column medians of fewer than ``least`` values falling
    back to the global median. W9. Grouped medians and joins, so no image is gathered in one task by a window."""
    on = list(image)
    v = df.filter(F.col(value).isNotNull())
    least = least if isinstance(least, Column) else F.lit(least)
    glob = v.groupBy(*on).agg(F.median(value).alias("__g"))
    cols = v.groupBy(*on, col).agg(F.median(value).alias("__cm"), F.count("*").alias("__cn")).join(glob, on).select(*on, col, F.when(F.col("__cn") >= least, F.col("__cm")).otherwise(F.col("__g")).alias("__c"))
    rest = v.join(cols, [*on, col])
    rows = rest.groupBy(*on, row).agg(F.median(F.col(value) - F.col("__c")).alias("__r"))
    return df.join(cols, [*on, col], "left").join(rows, [*on, row], "left").withColumn(out, F.col("__c") + F.col("__r")).drop("__c", "__r")


def guarded_z(df: DataFrame, keys: Sequence[str], value: str, least: int, floor: float = 1e-9, out: str = "z") -> DataFrame:
    """Robust z within each group, 0 in groups of fewer than ``least`` values. W10."""
    from litholake.functions.robust import center_spread

    s = center_spread(df, keys, value, floor)
    return df.join(s, list(keys), "left").withColumn(out, F.when(F.col("n") >= least, (F.col(value) - F.col("center")) / F.col("spread")).otherwise(F.lit(0.0))).drop("n", "center", "spread")


def suppress_crowded_rows(df: DataFrame, image: Sequence[str], row: str, score: str, radius: int, crowd: float, strong: float) -> DataFrame:
    """Where the smoothed count of a row's candidates exceeds ``crowd``, only those of at least ``strong`` stay. W16."""
    on = list(image)
    counts = df.groupBy(*on, row).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*on).orderBy(row).rangeBetween(-radius, radius)
    smooth = counts.select(*on, row, (F.sum("__n").over(w) / (2 * radius + 1)).alias("__s"))
    return df.join(smooth, [*on, row]).filter((F.col("__s") <= crowd) | (F.col(score) >= strong)).drop("__s")


def drop_consecutive_duplicates(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Rows that differ from their predecessor in one of ``cols``. W18."""
    w = Window.partitionBy(*keys).orderBy(order)
    now = F.struct(*cols)
    return df.withColumn("__p", F.lag(now).over(w)).filter(F.col("__p").isNull() | ~now.eqNullSafe(F.col("__p"))).drop("__p")


def even_sample(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """``n`` rows spread evenly over each group's order, first and last included (positions rounded half to even); the
    whole group where it has no more. W19."""
    w = Window.partitionBy(*keys)
    d = df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__m", F.count("*").over(w))
    if n == 1:
        return d.filter("__i = 0").drop("__i", "__m")
    k = F.bround(F.col("__i") * F.lit(float(n - 1)) / F.greatest(F.col("__m") - 1, F.lit(1)))
    hit = lambda j: F.bround(j * (F.col("__m") - 1) / F.lit(float(n - 1))) == F.col("__i")
    return d.filter((F.col("__m") <= n) | hit(k - 1) | hit(k) | hit(k + 1)).drop("__i", "__m")


def grid_order(df: DataFrame, keys: Sequence[str], x: str, y: str, per_row: int) -> DataFrame:
    """Points sorted by y, cut into rows of ``per_row``, each sorted by x: ``grid_row``, ``grid_col`` from 0. W20."""
    w = Window.partitionBy(*keys).orderBy(y, x)
    d = df.withColumn("grid_row", F.floor((F.row_number().over(w) - 1) / per_row).cast("int"))
    return d.withColumn("grid_col", F.row_number().over(Window.partitionBy(*keys, "grid_row").orderBy(x, y)) - 1)


def number_cells(df: DataFrame, keys: Sequence[str], row_key: str, x: str) -> DataFrame:
    """Rows numbered from 1 by descending ``row_key``, columns from 1 by ascending x. W3."""
    r = df.withColumn("cell_row", F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(row_key).desc())))
    return r.withColumn("cell_col", F.row_number().over(Window.partitionBy(*keys, "cell_row").orderBy(x)))


def circular_step(df: DataFrame, scope: Sequence[str], order: Sequence[str], item: str, step: int) -> DataFrame:
    """For every item the one ``step`` places on in its scope, around the end: ``item, target``. W21."""
    w = Window.partitionBy(*scope)
    d = df.select(*scope, item, *[c for c in order if c not in (*scope, item)]).withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    to = d.select(*scope, F.col("__i").alias("__t"), F.col(item).alias("target"))
    return d.withColumn("__t", F.pmod(F.col("__i") + step, F.col("__n"))).join(to, [*scope, "__t"]).select(*scope, item, "target")


def sample_path(df: DataFrame, order: Sequence[str], stride: int) -> DataFrame:
    """Every ``stride``-th row of a total order over a small listing (one window without partition). W19."""
    return df.withColumn("__i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) - 1).filter(F.col("__i") % stride == 0).drop("__i")
