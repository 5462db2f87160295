import math
import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from litholake.functions import fits, geometry, robust, strings
from litholake.operators import graph, greedy, joins, rollup, sequence


def test_center_spread_ignores_what_is_not_finite(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 10.0), ("a", float("nan")), ("a", None), ("a", float("inf")), (None, 5.0), ("c", None)], "k string, v double")
    got = {r.k: (r.n, r.center, round(r.spread, 4)) for r in robust.center_spread(df, ["k"], "v", 0.5).collect()}
    assert got == {"a": (3, 2.0, 1.4826), None: (1, 5.0, 0.5), "c": (0, 0.0, 0.5)}
    assert robust.center_spread(df.limit(0), ["k"], "v").count() == 0


def test_quantiles_by_bisection(spark):
    r = random.Random(1)
    rows = [("a", r.gauss(0, 1e6)) for _ in range(3000)] + [("b", 7.0)] * 900 + [("c", float(i % 3)) for i in range(50)] + [(None, 1.0), ("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    for q in (0.0, 0.5, 0.93, 1.0):
        got = {x.k: x.value for x in robust.quantiles_by_bisection(df, "k", "v", q, bins=8, small=20).collect()}
        for k in "abc":
            v = sorted(x for g, x in rows if g == k and x is not None and x == x)
            assert got[k] == v[max(math.ceil(q * len(v)), 1) - 1]


def test_islands_clusters_and_profiles(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (0, 1, 2, 20, 21, 50)] + [("b", None)], "k string, x double")
    assert sorted(r.island for r in sequence.islands(df, ["k"], "x", 5.0).collect()) == [0, 0, 0, 0, 1, 1, 2]
    got = [tuple(r) for r in sequence.running_mean_clusters(df, ["k"], "x", 3.0).orderBy("cluster_no").collect()]
    assert got == [("a", 0, 3, 1.0), ("a", 1, 2, 20.5), ("a", 2, 1, 50.0)]
    p = spark.createDataFrame([(0, i, v) for i, v in enumerate([0.0, 0.0, 9.0, 9.0, 9.0])], "g int, i int, v double")
    smooth = [round(r.smooth, 6) for r in sequence.moving_mean_same(p, ["g"], "i", "v", 1).orderBy("i").collect()]
    assert smooth == [round(v, 6) for v in np.convolve([0, 0, 9, 9, 9], np.ones(3) / 3, "same")]
    assert [r.step for r in sequence.directional_transition(p, ["g"], "i", "v", 2).orderBy("i").collect()] == [0.0, 9.0, 9.0, 4.5, 0.0]
    assert [r.i for r in sequence.local_maxima(p, ["g"], "i", "v").collect()] == [0, 2]
    assert sequence.running_mean_clusters(df.limit(0), ["k"], "x", 3.0).count() == 0


def test_even_sample_matches_linspace(spark):
    df = spark.createDataFrame([(0, i) for i in range(57)], "g int, i int")
    got = sorted(r.i for r in sequence.even_sample(df, ["g"], ["i"], 13).collect())
    assert got == sorted(set(np.rint(np.linspace(0, 56, 13)).astype(int).tolist()))


def test_window_joins_are_half_open_and_exactly_one(spark):
    w = spark.createDataFrame([(1, 0.0, 10.0), (2, 10.0, 20.0), (3, 15.0, 25.0), (4, 5.0, 5.0)], "w int, lo double, hi double")
    p = spark.createDataFrame([(i, float(x)) for i, x in enumerate([0, 10, 16, 25, -1])] + [(9, None)], "p int, x double")
    got = {r.p: (r.matches, r.w) for r in joins.exactly_one_window(p, "p", "x", w, "w", "lo", "hi", 7.0).collect()}
    assert got == {0: (1, 1), 1: (1, 2), 2: (2, None), 3: (0, None), 4: (0, None), 9: (0, None)}


def test_overlapping_intervals_once(spark):
    r = random.Random(3)
    a = [(i, float(x := r.randint(0, 100)), float(x + r.randint(0, 40))) for i in range(60)]
    b = [(i, float(x := r.randint(0, 100)), float(x + r.randint(0, 40))) for i in range(60)]
    got = sorted((x.i, x.j) for x in joins.overlapping(spark.createDataFrame(a, "i int, l double, h double"), "l", "h", spark.createDataFrame(b, "j int, m double, n double"), "m", "n", 9.0).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if max(x[1], y[1]) < min(x[2], y[2]))


def test_precedence_and_alias_joins(spark):
    left = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, "zz", None)], "id int, k1 string, k2 string")
    right = spark.createDataFrame([("b", 7, "r"), ("b", 5, "q"), ("a", 9, "s"), (None, 1, "t")], "k string, v int, id string")
    got = {r.id: (r.priority, r.v) for r in joins.join_by_precedence(left, "id", [F.col("k1"), F.col("k2")], right.drop("id"), "k", ["v"], "v").collect()}
    assert got == {1: (0, 9), 2: (1, 5), 3: (None, None)}
    hit, missing = joins.select_by_alias(spark.createDataFrame([("Wafer_A", "g"), ("wafer_b", None)], "w string, g string"), [strings.wafer_key(F.col("w")), F.col("w"), F.col("g")], ["A", "nope"])
    assert [r.w for r in hit.collect()] == ["Wafer_A"] and [r.name for r in missing.collect()] == ["nope"]


def test_components_of_random_graphs(spark):
    r = random.Random(5)
    for n, m in ((60, 40), (80, 200), (30, 0)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + ([(i, i + 1) for i in range(20, 29)] if m else [])
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
        got = {x.id: x.component for x in graph.connected_components(nodes, spark.createDataFrame(edges or [(0, 0)], "a long, b long"), "id", "a", "b").collect()}
        assert got == {i: find(i) for i in range(n)}


def test_spanning_rule_with_safety_valve(spark):
    df = spark.createDataFrame([("w1", 1, 0.0, 9.0), ("w1", 2, 4.0, 6.0), ("w2", 3, 0.0, 3.0), ("w2", 4, 5.0, 6.0)], "w string, c int, x0 double, x1 double").withColumns({"l": F.lit(0.0), "r": F.lit(10.0)})
    got = {x.c: (x.spans, x.keep) for x in graph.spanning(df, "c", ["w"], "x0", "x1", "l", "r").collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (False, True), 4: (False, False)}
    with pytest.raises(ValueError):
        graph.spanning(df, "c", ["w"], "x0", "x1", "l", "r", 0.4)


def test_greedy_kernels():
    assert greedy.nms_keep(np.array([0.0, 1, 5]), np.array([0.0, 0, 0]), 2.0).tolist() == [0, 2]
    assert greedy.greedy_pairs(np.array([2.0, 1, 1]), np.array([0, 0, 1]), np.array([0, 1, 1])).tolist() == [1]
    assert greedy.suppress_overlaps(np.array([[0, 0, 10, 10], [1, 1, 5, 5], [20, 20, 30, 30.0]]), 0.7).tolist() == [0, 2]


def test_nms_groups(spark):
    rows = [(g, i, float(x), 0.0, float(s)) for g in (1, None) for i, (x, s) in enumerate([(0, 5), (1, 9), (10, 1), (11, 1)])]
    df = spark.createDataFrame(rows, "g int, i int, x double, y double, s double")
    assert sorted((r.g or 0, r.i) for r in greedy.nms_peaks(df, ["g"], "x", "y", "s", "i", 3.0).collect()) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert greedy.nms_peaks(df.limit(0), ["g"], "x", "y", "s", "i", 3.0).count() == 0


def test_fits_recover_parameters(spark):
    r = random.Random(7)
    s, a, tx, ty = 1.01, math.radians(1.2), 30.0, -7.0
    pts = [(r.uniform(-100, 100), r.uniform(-100, 100)) for _ in range(12)]
    rows = [("g", x, y, s * (math.cos(a) * x - math.sin(a) * y) + tx, s * (math.sin(a) * x + math.cos(a) * y) + ty) for x, y in pts] + [("one", 1.0, 1.0, 2.0, 2.0), ("g", None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double, u double, v double")
    f = {x.k: x for x in fits.similarity_fit(df, ["k"], "x", "y", "u", "v").collect()}
    assert abs(f["g"].scale - s) < 1e-9 and abs(f["g"].angle - a) < 1e-9 and abs(f["g"].tx - tx) < 1e-6 and f["g"].rmsd < 1e-5 and f["one"].scale is None
    m = {x.k: x for x in fits.affine_fit(df, ["k"], "x", "y", "u", "v").collect()}
    assert abs(m["g"].a - s * math.cos(a)) < 1e-9 and abs(m["g"].c - tx) < 1e-6 and m["one"].a is None
    circle = spark.createDataFrame([("c", 1e6 + 5 * math.cos(t), 3 + 5 * math.sin(t)) for t in range(9)] + [("l", float(i), float(i)) for i in range(4)], "k string, x double, y double")
    c = {x.k: x for x in fits.circle_fit(circle, ["k"], "x", "y").collect()}
    assert abs(c["c"].xc - 1e6) < 1e-6 and abs(c["c"].radius - 5) < 1e-6 and c["l"].radius is None


def test_geometry_scalars(spark):
    sq = [{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 2.0}, {"x": 0.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]
    df = spark.createDataFrame([(sq,), (None,), ([],)], "p array<struct<x:double,y:double>>")
    p = F.col("p")
    got = df.select(geometry.signed_area(p).alias("a"), geometry.contains(p, F.lit(4.0), F.lit(1.0)).alias("edge"), geometry.contains(p, F.lit(1.0), F.lit(1.0)).alias("mid"), geometry.contains(p, F.lit(5.0), F.lit(1.0)).alias("out"), F.size(geometry.open_ring(p)).alias("n")).collect()
    assert (got[0].a, got[0].edge, got[0].mid, got[0].out, got[0].n) == (8.0, True, True, False, 4)
    assert got[1].a is None and got[2].a == 0.0 and not got[2].mid
    frame = geometry.WaferFrame(5.0, 7.0, 0.3, 2.0, 2.1, 0.01, 1.0, -1.0)
    d = spark.createDataFrame([(1.5, -2.5)], "x double, y double")
    r = d.select(*[c.alias(n) for c, n in zip(frame.to_canvas(*frame.to_gds(F.col("x"), F.col("y"))), "xy", strict=True)]).first()
    assert abs(r.x - 1.5) < 1e-9 and abs(r.y + 2.5) < 1e-9


def test_loss_rollup_keeps_null_keys_apart_from_totals(spark):
    df = spark.createDataFrame([("a", 1, 100.0, 10.0), ("a", 2, 0.0, 5.0), (None, 1, 50.0, 80.0)], "w string, l int, o double, r double")
    got = {(r.depth, r.w, r.l): (r.original, r.removed, r.weighted_pct, r.mean_pct) for r in rollup.hierarchical_loss(df, ["w", "l"], "o", "r").collect()}
    assert got[0, None, None] == (150.0, 60.0, 40.0, 55.0)
    assert got[1, None, None] == (50.0, 50.0, 100.0, 100.0) and got[1, "a", None] == (100.0, 10.0, 10.0, 10.0) and got[2, "a", 2][2] is None


def test_medians_agree_with_python(spark):
    v = [3.0, 1.0, 2.0, 10.0]
    df = spark.createDataFrame([("k", x) for x in v], "k string, v double")
    assert robust.center_spread(df, ["k"], "v").first().center == median(v)
    assert robust.mode_first(spark.createDataFrame([("k", x, i) for i, x in enumerate([5, 3, 3, 5])], "k string, v int, i int"), ["k"], "v", "i").first()["mode"] == 5


def test_medians_by_bisection(spark):
    r = random.Random(3)
    inf, nan = float("inf"), float("nan")
    rows = [("a", r.gauss(0, 1) * 10 ** r.uniform(-3, 3)) for _ in range(2000)] + [("b", 7.0)] * 901 + [("c", float(i % 2)) for i in range(100)] + [("d", 5.0)] + [("e", v) for v in (-inf, -1.0, 2.0, inf, nan, nan)]
    df = spark.createDataFrame(rows + [(None, 1.0), ("a", None), ("z", None)], "k string, v double")
    want = {x.k: x.m for x in df.filter("k is not null and v is not null").groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert want["a"] == median(v for k, v in rows if k == "a") and want["c"] == 0.5
    ends = df.groupBy("k").agg(F.count("v").alias("n"), F.min(robust.finite(F.col("v"))).alias("lo"), F.max(robust.finite(F.col("v"))).alias("hi"))
    wrong = ends.withColumns({"lo": F.lit(-1.0), "hi": F.lit(1.0)})  # the ends need not be right
    for bins, small, e in ((64, 1, ends), (8, 20, wrong), (4096, 262144, wrong)):
        assert {x.k: x.median for x in robust.medians_by_bisection(df, ["k"], "v", e, bins, small).collect()} == want


def trimmed(pts, rounds, least=8):
    """Trimmed line of one group in plain Python: (n, slope)."""

    def line():
        n, sx, sy = len(pts), sum(x for x, _ in pts), sum(y for _, y in pts)
        s = (n * sum(x * y for x, y in pts) - sx * sy) / (n * sum(x * x for x, _ in pts) - sx * sx)
        return s, (sy - s * sx) / n

    for _ in range(rounds):
        s, i = line()
        m = median(y - s * x - i for x, y in pts)
        off = [abs(y - s * x - i - m) for x, y in pts]
        ok = [p for p, a in zip(pts, off, strict=True) if a <= max(1.5, 2.8 * 1.4826 * median(off))]
        pts = ok if len(ok) >= least else pts
    return len(pts), line()[0]


def test_trimmed_line_without_a_group_in_one_task(spark, monkeypatch):
    r = random.Random(11)
    groups = {g: [(x := r.uniform(0, 50), 3 * x + r.gauss(0, 4) + (r.random() < share) * r.uniform(0, 10 ** r.uniform(1, 4))) for _ in range(n)] for g, n, share in (("a", 700, 0.2), ("b", 41, 0.1), ("few", 9, 0.5), ("clean", 200, 0.0))}
    rows = [(g, 1, x, y) for g, pts in groups.items() for x, y in pts] + [("flat", 1, 2.0, float(i)) for i in range(20)] + [(None, 1, 1.0, 1.0), ("a", 1, None, 1.0), ("a", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, j int, u double, v double")
    plans, write = [], fits.materialise
    for module in (fits, robust):
        monkeypatch.setattr(module, "materialise", lambda d, label: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or write(d, label))
    for rounds in (0, 1, 3):
        got = {x.k: x for x in fits.trimmed_line_fit(df, ["k", "j"], "u", "v", rounds=rounds).collect()}
        assert got.keys() == {*groups, "flat"} and (got["flat"].n, got["flat"].slope) == (20, None)
        for g, pts in groups.items():
            n, slope = trimmed(pts, rounds)
            assert got[g].n == n and abs(got[g].slope - slope) < 1e-9
    assert plans and not [p for p in plans if "median(" in p or "percentile(" in p]  # these hold all values of a group in one task
