"""Joins of the reference (J1-J9, J12, J14-J18, J21, S12-S13, S16, G7, G9), as equi-joins with residual conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def select_by_alias(df: DataFrame, aliases: Sequence[Column], wanted: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows one of whose aliases is wanted (any letter case), and the wanted names that match nothing. J1, G9.

    Rows come out once however many aliases match; null aliases match nothing; nothing wanted selects nothing."""
    names = sorted({w.strip().lower() for w in wanted})
    key = F.array_compact(F.array(*[F.lower(F.trim(a)) for a in aliases]))
    hit = df.filter(F.arrays_overlap(key, F.array(*[F.lit(n) for n in names]).cast("array<string>")))
    spark = df.sparkSession
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    missing = asked.join(df.select(F.explode(key).alias("name")).distinct(), "name", "left_anti")
    return hit, missing


def join_on_aliases(left: DataFrame, left_id: str, aliases: Sequence[Column], right: DataFrame, right_id: str, right_key: Column) -> DataFrame:
    """Inner join where any alias of the left row is the right row's key; each pair once. J3."""
    l_ = left.withColumn("__a", F.explode(F.array_distinct(F.array_compact(F.array(*aliases)))))
    r_ = right.withColumn("__a", right_key)
    return l_.join(r_, "__a").drop("__a").dropDuplicates([left_id, right_id])


def join_by_precedence(left: DataFrame, left_id: str, keys: Sequence[Column], right: DataFrame, right_key: str, right_cols: Sequence[str], order: str) -> DataFrame:
    """Left row with the right row of its first key that finds one; among equals the smallest ``order``. J5, J6, S13.

    The right side is reduced to its best row per key first; the keys of the left are exploded with their priority and
    joined once, instead of one join per key. Left rows without a partner stay, with nulls and ``priority`` null."""
    best = right.groupBy(F.col(right_key).alias("__k")).agg(F.min_by(F.struct(*right_cols), F.struct(order, *right_cols)).alias("__r"))
    tries = left.select(left_id, F.posexplode(F.array(*[k.cast("string") for k in keys])).alias("priority", "__k")).filter("__k is not null")
    found = tries.join(best, "__k").groupBy(left_id).agg(F.min_by(F.struct("priority", "__r"), "priority").alias("__f"))
    return left.join(found, left_id, "left").select(*left.columns, F.col("__f.priority").alias("priority"), *[F.col(f"__f.__r.{c}").alias(c) for c in right_cols])


def union_first(parts: Sequence[DataFrame], key: Column, order: Sequence[str] = ()) -> DataFrame:
    """Union in which the first part that has a key keeps it; within a part the smallest ``order``. J17."""
    tagged = None
    for i, p in enumerate(parts):
        t = p.withColumn("__part", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("__part", *order)
    return tagged.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__part")


def exactly_one_window(points: DataFrame, point_id: str, x: str, windows: DataFrame, window_id: str, lo: str, hi: str, bucket: float) -> DataFrame:
    """Points with the one half-open window [lo, hi) that holds them; points in none or in several come out with a null
    window and the number of matches. J7. ``bucket``: width of the join buckets, about that of a window."""
    w = windows.select(F.col(window_id).alias("__w"), F.col(lo).alias("__lo"), F.col(hi).alias("__hi")).filter("__lo < __hi")
    w = w.withColumn("__b", F.explode(F.sequence(F.floor(F.col("__lo") / bucket), F.floor(F.col("__hi") / bucket))))
    p = points.select(F.col(point_id).alias("__p"), F.col(x).alias("__x")).withColumn("__b", F.floor(F.col("__x") / bucket))
    m = p.join(w, "__b").filter("__x >= __lo and __x < __hi").groupBy("__p").agg(F.count("*").alias("matches"), F.min("__w").alias("__w"))
    j = points.join(m, F.col(point_id) == F.col("__p"), "left")
    return j.withColumn("matches", F.coalesce("matches", F.lit(0))).withColumn(window_id, F.when(F.col("matches") == 1, F.col("__w"))).drop("__p", "__w")


def overlapping(left: DataFrame, llo: str, lhi: str, right: DataFrame, rlo: str, rhi: str, bucket: float, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of intervals that overlap strictly (max of starts < min of ends), on equal ``keys``. J8.

    Each side is repeated for the buckets it touches; a pair is kept in the bucket where its overlap begins, so it comes
    out once and no distinct is needed."""
    l_ = left.withColumn("__b", F.explode(F.sequence(F.floor(F.col(llo) / bucket), F.floor(F.col(lhi) / bucket))))
    r_ = right.withColumn("__b", F.explode(F.sequence(F.floor(F.col(rlo) / bucket), F.floor(F.col(rhi) / bucket))))
    start, end = F.greatest(F.col(llo), F.col(rlo)), F.least(F.col(lhi), F.col(rhi))
    return l_.join(r_, [*keys, "__b"]).filter((start < end) & (F.floor(start / bucket) == F.col("__b"))).drop("__b")


def nearest(left: DataFrame, left_id: str, lx: str, right: DataFrame, right_id: str, rx: str, reach: float, keys: Sequence[str] = (), extra: Column | None = None) -> DataFrame:
    """For each left row the right row with the smallest |difference| up to ``reach`` (and ``extra``, if given); ties to
    the smallest id: ``left_id, right_id, distance``. Rows without a partner are left out. J9, J14, J15, J21."""
    l_ = left.withColumn("__b", F.explode(F.sequence(F.floor(F.col(lx) / reach) - 1, F.floor(F.col(lx) / reach) + 1)))
    r_ = right.withColumn("__b", F.floor(F.col(rx) / reach))
    d = F.abs(F.col(lx) - F.col(rx))
    m = l_.join(r_, [*keys, "__b"]).filter(d <= reach)
    if extra is not None:
        m = m.filter(extra)
    return m.groupBy(left_id).agg(F.min(F.struct(d.alias("distance"), F.col(right_id).alias("r"))).alias("m")).select(left_id, F.col("m.r").alias(right_id), F.col("m.distance").alias("distance"))


def neighbour_flags(df: DataFrame, keys: Sequence[str], col: str, row: str) -> DataFrame:
    """has_left, has_right, has_top, has_bottom: whether the neighbouring tile exists. J16.

    One aggregation and four lookups by exact position, no window, so gaps in the grid are no neighbours."""
    base = df.select(*keys, col, row).distinct()
    out = df
    for name, dc, dr in (("has_left", -1, 0), ("has_right", 1, 0), ("has_top", 0, -1), ("has_bottom", 0, 1)):
        there = base.select(*keys, (F.col(col) - dc).alias(col), (F.col(row) - dr).alias(row), F.lit(True).alias(name))
        out = out.join(there, [*keys, col, row], "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def latest_upsert(base: DataFrame, fresh: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``fresh`` replaces rows of ``base`` with equal keys and appends the rest; within a side the first by ``order``
    wins. S16."""
    both = base.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col("__new").desc(), *order)
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__new")


def dedupe_rounded(df: DataFrame, cols: Sequence[str], digits: int, order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per rounded key: the first or last by ``order``. G7. Aggregation with map-side combine, no window."""
    pick = F.min_by if keep == "first" else F.max_by
    key = [F.bround(F.col(c).cast("double"), digits).alias(f"__k{i}") for i, c in enumerate(cols)]
    return df.groupBy(*key).agg(pick(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def consistent_pairs(left: DataFrame, right: DataFrame, lkey: Column, rkey: Column, condition: Column, score: Column, by: str) -> DataFrame:
    """Best-scoring consistent pair for each ``by``: candidates of either side meet on a common key, never as a cross
    product. J12."""
    m = left.withColumn("__k", lkey).join(right.withColumn("__k", rkey), "__k").filter(condition).drop("__k")
    return m.groupBy(by).agg(F.max_by(F.struct(*m.columns), score).alias("r")).select("r.*")
