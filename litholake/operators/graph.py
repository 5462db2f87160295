"""Connected components and what depends on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litholake.session import materialise


def connected_components(nodes: DataFrame, edges: DataFrame, id_col: str, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``id_col, component`` (the smallest id of the component). I1.

    Alternating large-star and small-star: after each round every node points to a smaller neighbour, so the number of
    rounds grows with the logarithm of the longest path, and a node of very high degree is spread by the map-side
    minimum. Each round is written to the shared folder, which cuts the lineage. Raises if it has not converged."""
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    e = materialise(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u")
        e = materialise(small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(small_low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not converge")
    return nodes.select(F.col(id_col).cast("long").alias(id_col)).distinct().join(e.select(F.col("u").alias(id_col), F.col("v").alias("component")), id_col, "left").select(id_col, F.coalesce("component", F.col(id_col)).alias("component"))


def touching_boxes(boxes: DataFrame, id_col: str, bucket: float, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs ``a < b`` of boxes (x0, y0, x1, y1) that touch or overlap, on equal ``keys``. J13.

    Boxes are repeated for the x buckets they touch; a pair counts in the bucket where its overlap begins."""
    cols = [id_col, "x0", "y0", "x1", "y1"]
    l_ = boxes.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols]).withColumn("__b", F.explode(F.sequence(F.floor(F.col("a_x0") / bucket), F.floor(F.col("a_x1") / bucket))))
    r_ = boxes.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols]).withColumn("__b", F.explode(F.sequence(F.floor(F.col("b_x0") / bucket), F.floor(F.col("b_x1") / bucket))))
    start = F.greatest("a_x0", "b_x0")
    hit = (F.col(f"a_{id_col}") < F.col(f"b_{id_col}")) & (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("a_y1")) & (F.floor(start / bucket) == F.col("__b"))
    return l_.join(r_, [*keys, "__b"]).filter(hit).select(*keys, F.col(f"a_{id_col}").alias("a"), F.col(f"b_{id_col}").alias("b"))


def spanning(members: DataFrame, component: str, window: Sequence[str], x0: str, x1: str, left: str, right: str, span: float = 0.6) -> DataFrame:
    """Components with ``keep``: whether they reach from the left to the right part of their window; where none does, the
    widest is kept instead. I2. ``span`` in (0.5, 1] is the part of the window's width to be spanned."""
    if not 0.5 < span <= 1:
        raise ValueError("span must be in (0.5, 1]")
    m = (1 - span) / 2
    c = members.groupBy(*window, component).agg(F.min(x0).alias("lo"), F.max(x1).alias("hi"), F.first(left).alias("wl"), F.first(right).alias("wr"), F.count("*").alias("parts"))
    width = F.col("wr") - F.col("wl")
    c = c.withColumn("spans", (F.col("lo") <= F.col("wl") + m * width) & (F.col("hi") >= F.col("wr") - m * width))
    w = Window.partitionBy(*window)
    first = F.row_number().over(w.orderBy((F.col("hi") - F.col("lo")).desc(), component)) == 1
    return c.withColumn("keep", F.col("spans") | (~F.max("spans").over(w) & first)).drop("wl", "wr")
