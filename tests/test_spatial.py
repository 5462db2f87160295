import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litholake.kernels.triangles import BoxTree, ear_clip
from litholake.operators.spatial import bbox_center, inside_regions, near_pairs


def area2(t):
    (ax, ay), (bx, by), (cx, cy) = t
    return abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def inside(p, ring):
    x, y = p
    n, hit = len(ring), False
    for i in range(n):
        (ax, ay), (bx, by) = ring[i - 1], ring[i]
        if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
            hit = not hit
    return hit


SHAPES = {
    1: [(0, 0), (10, 0), (10, 10), (0, 10)],
    2: [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)],
    3: [(20, 0), (40, 0), (40, 20), (30, 5), (20, 20)],
    4: [(50, 0), (60, 0), (70, 0), (70, 10), (50, 10), (50, 10)],
    5: [(0, 30), (5, 30), (10, 30)],
    6: [(80, 0), (90, 0), (90, 10), (85, 10), (85, 20), (85, 10), (80, 10)],  # with a spike
}


def test_ear_clip_keeps_the_area():
    for ring in SHAPES.values():
        want = abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)))
        assert sum(area2(t) for t in ear_clip(ring)[0]) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(3, 12))
def test_ear_clip_of_random_star_shapes(seed, n):
    r = random.Random(seed)
    angles = sorted(r.random() * 6.283 for _ in range(n))
    ring = [(int(r.uniform(20, 100) * np.cos(a)), int(r.uniform(20, 100) * np.sin(a))) for a in angles]
    ring = list(dict.fromkeys(ring))
    if len(ring) < 3 or max(b - a for a, b in zip(angles, angles[1:] + [angles[0] + 6.283], strict=True)) > 3.1:
        return  # the centre must lie inside, else the shape is no star
    tri, fan = ear_clip(ring)
    if fan:
        return
    for _ in range(40):
        p = (r.randint(-110, 110), r.randint(-110, 110))
        got = any(inside(p, list(t)) for t in tri)
        crossing = area2(ring[:3]) >= 0 and inside(p, ring)
        if sum(area2(t) for t in tri) == abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))):
            assert got == crossing


def test_box_tree():
    r = np.random.default_rng(1)
    lo = r.integers(0, 100, (37, 2))
    boxes = np.hstack([lo, lo + r.integers(0, 20, (37, 2))]).astype(float)
    x, y = r.integers(0, 120, 200).astype(float), r.integers(0, 120, 200).astype(float)
    p, b = BoxTree(boxes).stab(x, y)
    want = {(i, j) for i in range(200) for j in range(37) if boxes[j, 0] <= x[i] <= boxes[j, 2] and boxes[j, 1] <= y[i] <= boxes[j, 3]}
    assert set(zip(p.tolist(), b.tolist(), strict=True)) == want and len(p) == len(want)
    assert len(BoxTree(np.zeros((0, 4))).stab(x, y)[0]) == 0


def test_inside_regions(spark):
    regions = spark.createDataFrame([(i, 4, [{"x": x, "y": y} for x, y in s]) for i, s in SHAPES.items()] + [(1, 4, [{"x": x, "y": y} for x, y in SHAPES[1]]), (7, 4, None), (8, 4, [])], "region_id long, id int, pts array<struct<x:int,y:int>>")
    pts = [(x / 2, y / 2) for x in range(-2, 190, 3) for y in range(-2, 64, 3)] + [(85.0, 15.0), (0.0, 0.0), (30.0, 5.0)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)] + [(None, 1.0, 1.0), (9999, None, 1.0)], "id long, x double, y double")
    got = {tuple(r) for r in inside_regions(points, "id", "x", "y", regions, "region_id", "pts", leaf_size=2).collect()}
    want = {(i, k) for i, p in enumerate(pts) for k, s in SHAPES.items() if k != 5 and inside(p, s)}
    assert got == want
    deep = {tuple(r) for r in inside_regions(points, "id", "x", "y", regions, "region_id", "pts", leaf_size=1, top=1, fanout=2).collect()}
    assert deep == want
    assert inside_regions(points.limit(0), "id", "x", "y", regions, "region_id", "pts").count() == 0
    assert inside_regions(points, "id", "x", "y", regions.limit(0), "region_id", "pts").count() == 0


def test_near_pairs(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["a", "b", None]), r.choice([1, 2]), float(r.randint(-60, 60)), float(r.randint(-60, 60))) for i in range(400)]
    rows += [(1000, "a", 1, float("nan"), 0.0), (1001, "a", None, 0.0, 0.0), (1002, "a", 1, 6.0, 8.0), (1003, "a", 1, 0.0, 0.0), (1004, "a", 1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, g string, s int, x double, y double").withColumn("cx", F.lit("clash"))
    got = sorted(tuple(t) for t in near_pairs(df, ["g", "s"], "id", "x", "y", 10.0).collect())
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[2] == b[2] and None not in (*a, *b) and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= 100)
    assert got == want and (1002, 1003) in got
    assert near_pairs(df.limit(0), ["g", "s"], "id", "x", "y", 10.0).count() == 0


def test_bbox_center(spark):
    df = spark.createDataFrame([([[0, 0], [10, 4]], [1, 1, 1, 1]), ([], [2, 2, 3, 4]), ([None, [1], [None, 2]], [0, 0, 2, 2]), (None, None), (None, [1, 2]), (None, [1, None, 2, 2])], "p array<array<int>>, b array<int>")
    x, y = bbox_center(F.col("p"), F.col("b"))
    assert [tuple(r) for r in df.select(x, y).collect()] == [(5.0, 2.0), (3.5, 4.0), (1.0, 1.0), (None, None), (None, None), (2.0, None)]


def test_outlines_that_cross_themselves_follow_the_even_odd_rule(spark):
    shapes = {1: [(0, 0), (6, 4), (6, 0), (0, 3)], 2: [(10, 0), (16, 10), (20, 0), (9, 7), (21, 7)], 3: [(0, 20), (4, 24), (4, 20), (0, 24)]}
    regions = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in s]) for k, s in shapes.items()], "region_id long, pts array<struct<x:int,y:int>>")
    pts = [(x / 2, y / 2) for x in range(-2, 46) for y in range(-2, 50)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    got = {tuple(r) for r in inside_regions(points, "id", "x", "y", regions, "region_id", "pts").collect()}
    assert got == {(i, k) for i, p in enumerate(pts) for k, s in shapes.items() if k != 3 and inside(p, s)}  # the third one's signed area is 0
    assert not any(pts[i] == (3.0, 3.0) for i, _ in got)


def test_large_stars_are_clipped_quickly():
    import time

    n = 3200
    ring = [(int(1e6 * (2 if i % 2 else 1) * np.cos(6.283185 * i / n)), int(1e6 * (2 if i % 2 else 1) * np.sin(6.283185 * i / n))) for i in range(n)]
    began = time.time()
    triangles, fan = ear_clip(ring)
    assert time.time() - began < 3 and not fan
    assert sum(area2(t) for t in triangles) == abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)))


def test_crowds_are_split(spark):
    from litholake.operators.spatial import neighbour_counts

    df = spark.range(1500).selectExpr("id", "'w' g", "if(id < 600, 5.0, id * 100.0) x", "0.0 y")
    assert near_pairs(df, ["g"], "id", "x", "y", 10.0).count() == 600 * 599 // 2
    assert {r.neighbours for r in neighbour_counts(df, ["g"], "id", "x", "y", 10.0).collect()} == {599}
