"""Points near other points, and points in regions (problem 3).

near    Grid cells of twice the distance as join keys: every point is kept once on one side and sent on the other to its
        own cell and to those cells ahead whose border is within the distance, so that each pair of points meets exactly
        once. Cells that hold more than a fair share of the points are split: one side is dealt out, the other repeated.

inside  Polygons are triangulated by ear clipping. The triangles are put in Morton order and cut into runs of a few, the
        leaves of a bounding-volume hierarchy; runs of boxes form the next level, and so on until a level has few enough
        boxes to be broadcast. A task descends the top level for a whole batch of points at once; each lower level is one
        equi-join on the node, so the hierarchy may have any number of leaves of the same size. A point meets the triangles
        of its leaves and is tested exactly. Points on an edge that two triangles share belong to both, so the assignments
        are made distinct. Outlines that cross themselves come as fans, of which the even-odd rule is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litholake.kernels.triangles import BoxTree, ear_clip, morton
from litholake.operators.skew import with_salts
from litholake.session import materialise


def near_pairs(points: DataFrame, within: Sequence[str], id_col: str, x: str, y: str, distance: float) -> DataFrame:
    """``(left_id, right_id)`` of the points of one group (equal, non-null ``within`` columns) at most ``distance`` apart,
    the smaller id left; each pair once.

    Points with a null id, group column or coordinate, or a NaN coordinate, have no neighbour. Points of equal location
    are neighbours. Ids must be unique. The result holds every pair, so its size is that of the answer; ``neighbour_counts``
    gives one row for each point. The groups' columns travel as a 64-bit hash and as themselves on one side only, where
    they settle chance agreements."""
    cell, gs = 2.0 * distance, [f"g{i}" for i in range(len(within))]
    p = points.select(*[F.col(c).alias(g) for c, g in zip(within, gs, strict=True)], F.col(id_col).alias("id"), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"))
    p = p.dropna().withColumns({"cx": F.floor(F.col("px") / cell), "cy": F.floor(F.col("py") / cell)})
    p = with_salts(p.withColumn("key", F.xxhash64(*gs, "cx", "cy")), ["key"]).withColumnRenamed("__lit_salts", "parts")
    east, west = F.col("px") >= (F.col("cx") + 1) * cell - distance, F.col("px") <= F.col("cx") * cell + distance
    north = F.col("py") >= (F.col("cy") + 1) * cell - distance
    to = lambda dx, dy, own: F.struct(F.xxhash64(*gs, (F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy")).alias("key"), F.lit(own).alias("own"))
    ahead = F.array_compact(F.array(to(0, 0, True), F.when(east, to(1, 0, False)), F.when(west & north, to(-1, 1, False)), F.when(north, to(0, 1, False)), F.when(east & north, to(1, 1, False))))
    a = p.select(F.explode(ahead).alias("n"), *[F.col(g).alias(f"a{g}") for g in gs], F.col("id").alias("aid"), F.col("px").alias("ax"), F.col("py").alias("ay"))
    a = a.select("n.key", "n.own", *[f"a{g}" for g in gs], "aid", "ax", "ay")
    # the cell that is looked into decides how often a visitor is repeated; its own points are dealt out
    hot = p.filter("parts > 1").select("key", "parts").distinct()
    a = a.join(F.broadcast(hot), "key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    b = p.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).select("key", "salt", "id", "px", "py", *gs)
    same = F.lit(True)
    for g in gs:
        same = same & (F.col(g) == F.col(f"a{g}"))
    dx, dy = F.col("ax") - F.col("px"), F.col("ay") - F.col("py")
    pairs = a.join(b, ["key", "salt"]).filter((dx * dx + dy * dy <= float(distance) ** 2) & same & (~F.col("own") | (F.col("aid") < F.col("id"))))
    return pairs.select(F.least("aid", "id").alias("left_id"), F.greatest("aid", "id").alias("right_id"))


def neighbour_counts(points: DataFrame, within: Sequence[str], id_col: str, x: str, y: str, distance: float) -> DataFrame:
    """``(id, neighbours)`` of the points that have any; nulls and ties as in ``near_pairs``. Pairs are counted where they
    are found (one partial sum for each point and task), so crowds cost no more rows than points."""
    pairs = near_pairs(points, within, id_col, x, y, distance)
    ends = pairs.select(F.explode(F.array("left_id", "right_id")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("neighbours"))


TRIANGLE_SCHEMA = "region long, ax double, ay double, bx double, by double, cx double, cy double, fan boolean, opens boolean, closes boolean, x0 double, y0 double, x1 double, y1 double, zkey long"


def triangulate(regions: DataFrame, id_col: str, points_col: str) -> DataFrame:
    """Triangles of each polygon (array of structs x, y). Null, empty and arealess outlines give none; null vertices are
    skipped; a repeated id counts once. Integers below 2**25 give exact results, fractions and larger ones those of double
    arithmetic. ``fan``: the outline crosses itself (see ``ear_clip``)."""
    once = regions.filter(F.col(id_col).isNotNull() & (F.size(points_col) >= 3)).dropDuplicates([id_col]).select(F.col(id_col).cast("long").alias("region"), F.transform(points_col, lambda p: p["x"]).alias("xs"), F.transform(points_col, lambda p: p["y"]).alias("ys"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, rows, fans = [], [], []
            for region, xs, ys in zip(b["region"], b["xs"], b["ys"], strict=True):
                ring = [(_exact(u), _exact(v)) for u, v in zip(xs, ys, strict=True) if u is not None and v is not None and u == u and v == v]
                triangles, fan = ear_clip(ring)
                ids += [region] * len(triangles)
                fans += [(fan, fan and k == 0, fan and k == len(triangles) - 1) for k in range(len(triangles))]
                rows += [[c for p in t for c in p] for t in triangles]
            c = np.array(rows, float).reshape(len(rows), 6)
            box = np.column_stack([c[:, 0::2].min(1), c[:, 1::2].min(1), c[:, 0::2].max(1), c[:, 1::2].max(1)]) if len(rows) else np.zeros((0, 4))
            z = morton(np.clip(box[:, 0] + box[:, 2] + 2**30, 0, 2**31 - 1).astype(np.int64), np.clip(box[:, 1] + box[:, 3] + 2**30, 0, 2**31 - 1).astype(np.int64))
            yield pd.DataFrame({"region": np.array(ids, np.int64)} | {k: v for k, v in zip(("ax", "ay", "bx", "by", "cx", "cy"), c.T, strict=True)} | {k: v for k, v in zip(("fan", "opens", "closes"), np.array(fans, bool).reshape(len(rows), 3).T, strict=True)} | {k: v for k, v in zip(("x0", "y0", "x1", "y1"), box.T, strict=True)} | {"zkey": z})

    return once.mapInPandas(run, TRIANGLE_SCHEMA)


def _exact(v: float) -> float:
    return int(v) if v == int(v) else float(v)


#: Boxes of a level that may be broadcast: 16,384 are 0.7 MB. Longer levels get one above them, of FANOUT boxes each.
TOP, FANOUT = 16384, 64


def box_leaves(triangles: DataFrame, leaf_size: int = 16, top: int = TOP, fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame], np.ndarray, np.ndarray]:
    """Triangles with the number of their leaf; the levels of boxes below the top one, from above (``node, parent`` and
    box); and the top level's numbers and boxes in Morton order.

    Leaves have always the same size; a node is numbered by its partition of the Morton order and its place there, so a
    level's parents follow from its numbers. The top level has at most ``top`` boxes, or one for each partition. Triangles
    and numbers are written to the shared folder, so a recomputed task sees the same ones."""
    stored = materialise(triangles, "triangles")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            at = (seen + np.arange(b.num_rows)) // leaf_size
            seen += b.num_rows
            yield b.append_column("leaf", pa.array((np.int64(part) << 40) + at))

    ordered = stored.repartitionByRange("zkey").sortWithinPartitions("zkey", "region")
    placed = materialise(ordered.mapInArrow(number, TRIANGLE_SCHEMA + ", leaf long"), "leaves")
    corners = lambda df, node: df.groupBy(node.alias("node")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    parent = F.shiftleft(F.shiftright("node", 40), 40) + F.floor(F.col("node").bitwiseAND(F.lit((1 << 40) - 1)) / fanout)
    level, lower = materialise(corners(placed, F.col("leaf")), "boxes"), []
    while level.count() > top and level.filter(F.col("node").bitwiseAND(F.lit((1 << 40) - 1)) > 0).limit(1).count():
        lower.insert(0, level.withColumn("parent", parent))
        level = materialise(corners(level, parent), "boxes")
    boxes = level.toPandas().sort_values("node")
    return placed, lower, boxes["node"].to_numpy(np.int64), boxes.iloc[:, 1:].to_numpy(float)


def _side(px: Column, py: Column, a: str, b: str) -> Column:
    return (F.col(f"{b}x") - F.col(f"{a}x")) * (py - F.col(f"{a}y")) - (F.col(f"{b}y") - F.col(f"{a}y")) * (px - F.col(f"{a}x"))


def inside_regions(points: DataFrame, id_col: str, x: str, y: str, regions: DataFrame, region_col: str, points_col: str, leaf_size: int = 16, top: int = TOP, fanout: int = FANOUT) -> DataFrame:
    """``(id, region)`` for every point in or on the outline of a region, each pair once.

    Points without id or coordinates lie in no region; with no points or no regions the result is empty. Where a leaf
    holds more than a fair share of the points, they are dealt out and the leaf's few triangles repeated. Whether the
    triangles are broadcast is left to Spark's size check. Ids must be unique where outlines cross themselves."""
    spark = points.sparkSession
    placed, lower, nodes, boxes = box_leaves(triangulate(regions, region_col, points_col), leaf_size, top, fanout)
    tree = spark.sparkContext.broadcast((nodes, boxes))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, boxes = tree.value
        hierarchy = BoxTree(boxes)
        for b in batches:
            px, py = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            p, node = hierarchy.stab(px, py)
            hit = b.take(pa.array(p))
            yield pa.RecordBatch.from_arrays([*hit.columns, pa.array(nodes[node] if len(node) else np.zeros(0, np.int64))], names=["id", "px", "py", "leaf"])

    px, py = F.col("px"), F.col("py")
    in_box = (px >= F.col("x0")) & (px <= F.col("x1")) & (py >= F.col("y0")) & (py <= F.col("y1"))
    p = points.select(F.col(id_col).cast("long").alias("id"), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")).dropna()
    routed = p.mapInArrow(route, "id long, px double, py double, leaf long")
    for level in lower:
        routed = routed.join(level, routed["leaf"] == level["parent"]).filter(in_box).select("id", "px", "py", F.col("node").alias("leaf"))
    routed = materialise(routed, "routed")
    salted = with_salts(routed, ["leaf"])
    hot = salted.filter("__lit_salts > 1").select("leaf", F.col("__lit_salts").alias("parts")).distinct()
    tri = placed.join(F.broadcast(hot), "leaf", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts", "zkey")
    routed = salted.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("__lit_salts")).cast("int")).drop("__lit_salts")
    s = [_side(px, py, *ab) for ab in (("a", "b"), ("b", "c"), ("c", "a"))]
    inside = ((s[0] >= 0) & (s[1] >= 0) & (s[2] >= 0)) | ((s[0] <= 0) & (s[1] <= 0) & (s[2] <= 0))
    met = routed.join(tri, ["leaf", "salt"]).filter(in_box & inside)
    plain = met.filter("not fan").select("id", "region").distinct()
    # a fan's triangle counts where a ray from the point crosses its outline an odd number of times; shared diagonals cancel
    crosses = lambda a, b: ((F.col(f"{a}y") > py) != (F.col(f"{b}y") > py)) & (px < F.col(f"{a}x") + (F.col(f"{b}x") - F.col(f"{a}x")) * (py - F.col(f"{a}y")) / F.nullif(F.col(f"{b}y") - F.col(f"{a}y"), F.lit(0.0)))
    odd = F.lit(0)
    for a, b in (("a", "b"), ("b", "c"), ("c", "a")):
        odd = odd + F.coalesce(crosses(a, b).cast("int"), F.lit(0))
    on_edge = lambda a, b: (_side(px, py, a, b) == 0) & px.between(F.least(f"{a}x", f"{b}x"), F.greatest(f"{a}x", f"{b}x")) & py.between(F.least(f"{a}y", f"{b}y"), F.greatest(f"{a}y", f"{b}y"))
    fans = met.filter("fan").groupBy("id", "region").agg((F.sum(odd % 2) % 2).alias("odd"), F.max(on_edge("b", "c") | (F.col("opens") & on_edge("a", "b")) | (F.col("closes") & on_edge("c", "a"))).alias("edge"))
    return plain.unionByName(fans.filter("odd = 1 or edge").select("id", "region"))


def bbox_center(polygon: Column, bbox: Column) -> tuple[Column, Column]:
    """Centre of the bounding box of an outline's points (array of [x, y]), or else of a box [x, y, width, height].

    Points that are null, short or hold a null are skipped; without any usable point the box counts, and without a
    complete box the centre is null."""
    usable = F.filter(polygon, lambda p: F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())
    out = []
    for i in (0, 1):
        place = F.lit(i)
        vals = F.transform(usable, lambda p: F.get(p, place).cast("double"))  # noqa: B023
        mid = (F.array_min(vals) + F.array_max(vals)) / 2
        whole = F.when(F.size(bbox) >= 4, bbox)
        out.append(F.when(F.size(usable) > 0, mid).otherwise(F.get(whole, F.lit(i)).cast("double") + F.get(whole, F.lit(i + 2)) / 2))
    return out[0], out[1]
