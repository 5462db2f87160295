import random

import pytest
from pyspark.sql import functions as F

from litholake.kernels.clip import area, boolean, offset_convex
from litholake.operators import fingers, subtract
from litholake.sources import gds

RECTS = [(2, 0, [(0, 0), (10, 0), (10, 200), (0, 200)]), (3, 0, [(0, 0), (5, 0), (5, 5)]), (7, 1, [(-5, -5), (5, -5), (5, 5), (-5, 5)])]


@pytest.fixture
def stream(tmp_path):
    path = str(tmp_path / "a.gds")
    assert gds.write_flat(iter(RECTS), path) == 3
    return path


def test_scan_filter_and_lossless_rewrite(spark, stream, tmp_path):
    df = gds.read_gds(spark, stream)
    b = df.filter("kind = 'boundary'").orderBy("seq").collect()
    assert [(r.layer, r.datatype) for r in b] == [(2, 0), (3, 0), (7, 1)] and [(p.x, p.y) for p in b[1].points] == [(0, 0), (5, 0), (5, 5), (0, 0)]
    assert [r.element_index for r in gds.read_gds(spark, stream, [3, 7]).collect()] == [1, 2] == [r.element_index for r in df.filter(F.col("layer").isin(3, 7)).collect()]
    out = str(tmp_path / "b.gds")
    gds.rewrite(df, None, out)
    data = open(stream, "rb").read()
    assert open(out, "rb").read() == data
    gds.rewrite(df, df.filter("layer = 3"), out)
    assert [c[3] for c in gds.chunks(open(out, "rb").read()) if c[1] == "boundary"] == [2, 7]


def test_truncated_streams_raise(stream):
    data = open(stream, "rb").read()
    for cut in (data[:-2], data[:91]):
        with pytest.raises(ValueError):
            list(gds.chunks(cut))
    broken = gds.record(gds.BOUNDARY, 0) + gds.record(gds.LAYER, 2, b"\0\1") + gds.record(gds.ENDEL, 0)
    with pytest.raises(ValueError):
        list(gds.chunks(broken))


def test_hierarchy():
    import struct

    name = lambda s: s.encode() + b"\0" * (len(s) % 2)
    xy = lambda *p: gds.record(gds.XY, 3, struct.pack(f">{len(p)}i", *p))
    leaf = gds.record(gds.BGNSTR, 2, bytes(24)) + gds.record(gds.STRNAME, 6, name("L")) + gds.boundary_record(4, 0, [(0, 0), (2, 0), (2, 1)]) + gds.record(gds.ENDSTR, 0)
    sref = gds.record(gds.SREF, 0) + gds.record(gds.SNAME, 6, name("L")) + gds.record(gds.STRANS, 1, b"\0\0") + gds.record(gds.ANGLE, 5, gds.to_real8(90.0)) + xy(10, 0) + gds.record(gds.ENDEL, 0)
    aref = gds.record(gds.AREF, 0) + gds.record(gds.SNAME, 6, name("L")) + gds.record(gds.COLROW, 2, struct.pack(">2h", 2, 3)) + xy(0, 0, 20, 0, 0, 30) + gds.record(gds.ENDEL, 0)
    top = gds.record(gds.BGNSTR, 2, bytes(24)) + gds.record(gds.STRNAME, 6, name("T")) + sref + aref + gds.record(gds.ENDSTR, 0)
    flat = list(gds.flatten_stream(leaf + top))
    assert len(flat) == 7 and flat[0][2][:3] == [(10, 0), (10, 2), (9, 2)] and flat[-1][2][0] == (10, 20)
    for v in (1e-9, 1e-3, 0.5, 90.0, -270.25):
        assert abs(gds.real8(gds.to_real8(v)) - v) <= 1e-15 * abs(v)


def grid(spark):
    rows, k = [], 0
    for r, y in enumerate((0, 1000)):
        for c in range(3):
            for i in range(5):
                x = c * 500 + i * 40
                rows.append((k, 7, x, y, x + 10, y + 200))
                k += 1
    rows += [(k + 1, 7, 3000, 0, 3050, 20), (k + 2, 2, 0, 0, 9, 9)]
    pieces = [(100, 3, -100, 50, 120, 60), (101, 3, 110, 40, 300, 50), (102, 3, 60, 150, 80, 160), (103, 3, 480, 50, 520, 60), (104, 3, 640, 50, 660, 60), (105, 3, 0, 0, 5000, 10), (106, 3, 9000, 0, 9010, 10)]
    return spark.createDataFrame(rows + pieces, "element_index long, layer int, x0 int, y0 int, x1 int, y1 int")


def test_cells_from_fingers_and_hanging_pieces(spark):
    b = grid(spark)
    cells = fingers.infer_cells(b, 7)
    got = [(r.cell_row, r.cell_col, r.cx, r.cy, r.lines, r.x_pitch, r.y_pitch) for r in cells.orderBy("cell_row", "cell_col").collect()]
    assert got == [(r + 1, c + 1, c * 500 + 85.0, r * 1000 + 100.0, 5, 500.0, 1000.0) for r in range(2) for c in range(3)]
    removed, report = fingers.hanging_pieces(b, cells, 3)
    assert sorted(r.element_index for r in removed.collect()) == [102, 104]
    rep = {(r.cell_row, r.cell_col): (r.target_boundaries, r.components, r.removed, r.fallback_used) for r in report.collect()}
    assert rep == {(1, 1): (3, 2, 1, False), (1, 2): (2, 2, 1, True)}
    with pytest.raises(ValueError):
        fingers.infer_cells(b.filter("layer = 2"), 2)


def test_booleans_by_sampling():
    r = random.Random(2)
    for _ in range(25):
        a = [[(r.randint(0, 40), r.randint(0, 40)) for _ in range(r.randint(3, 6))] for _ in range(2)]
        b = [[(r.randint(0, 40), r.randint(0, 40)) for _ in range(r.randint(3, 6))]]

        def inside(p, ring):
            x, y = p
            n = 0
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
                n += (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay)
            return n % 2 == 1

        for op, f in (("not", lambda u, v: u and not v), ("and", lambda u, v: u and v), ("or", lambda u, v: u or v)):
            out = boolean(a, b, op)
            for _ in range(40):
                p = (r.random() * 40, r.random() * 40)
                assert any(inside(p, t) for t in out) == f(any(inside(p, t) for t in a), any(inside(p, t) for t in b))
        assert abs(area(boolean(a, b, "and")) + area(boolean(a, b, "not")) - area(boolean(a, [], "or"))) < 1e-6
    assert abs(area([offset_convex([(0, 0), (10, 0), (10, 10), (0, 10)], 1.0)]) - 144) < 1e-9


def test_subtraction_and_report(spark):
    sq = lambda x, y, w, h: [{"x": float(u), "y": float(v)} for u, v in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]
    design = spark.createDataFrame([(4, 1, sq(0, 0, 100, 100)), (4, 2, sq(200, 0, 100, 100)), (2, 3, sq(0, 0, 100, 100)), (None, 4, sq(0, 0, 1, 1))], f"layer int, id long, points {subtract._PTS}")
    defects = spark.createDataFrame([(1, sq(10, 10, 10, 10)), (2, sq(15, 15, 5, 5)), (3, sq(90, 90, 30, 30))], f"id long, points {subtract._PTS}")
    out = subtract.subtract_layers(design, defects, [4], bucket=64.0)
    by = {(r.layer, r.id): 0.0 for r in out.collect()}
    for r in out.collect():
        by[r.layer, r.id] += area([[(p.x, p.y) for p in r.points]])
    assert by == {(4, 1): 10000 - 200, (4, 2): 10000.0, (2, 3): 10000.0, (None, 4): 1.0}
    devices = spark.createDataFrame([("1-1", sq(0, 0, 100, 100)), ("1-2", sq(200, 0, 100, 100)), ("9-9", sq(900, 900, 10, 10))], f"device string, points {subtract._PTS}")
    rep = {(r.depth, r.device, r.layer): (r.original, r.removed, r.weighted_pct) for r in subtract.removal_report(design.filter("layer = 4"), out.filter("layer = 4"), devices, 64.0).collect()}
    assert rep[2, "1-1", 4] == (10000.0, 200.0, 2.0) and rep[1, "9-9", None] == (0.0, 0.0, None) and rep[0, None, None][2] == 1.0
    same = subtract.subtract_layers(design, defects.limit(0), [4])
    assert same.count() == 4


def test_shunts(spark):
    seg = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 50.0), (2, 10.0, 0.0, 12.0, 100.0), (3, 20.0, 60.0, 22.0, 100.0), (4, 0.0, 200.0, 50.0, 210.0)], "id long, x0 double, y0 double, x1 double, y1 double")
    got = {(r.id, r.end): (r.sx0, r.sx1) for r in subtract.shunts(seg, 10.0, 2.0).collect()}
    assert got == {(1, "low"): (1.0, 11.0), (1, "high"): (1.0, 11.0), (2, "low"): (1.0, 11.0), (2, "high"): (11.0, 21.0), (3, "low"): (11.0, 21.0), (3, "high"): (11.0, 21.0)}


def test_each_group_of_defects_has_its_own_result(spark):
    sq = lambda x, y, w, h: [{"x": float(u), "y": float(v)} for u, v in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]
    design = spark.createDataFrame([(4, 1, sq(0, 0, 100, 100)), (4, 2, sq(50, 0, 100, 100)), (4, 5, sq(200, 0, 100, 100)), (2, 3, sq(0, 0, 100, 100)), (None, 4, sq(0, 0, 1, 1))], f"layer int, id long, points {subtract._PTS}")
    rows = [("a", 1, 1, sq(10, 10, 10, 10)), ("a", 1, 2, sq(15, 15, 10, 10)), ("a", 2, 3, sq(60, 20, 60, 5)), ("b", 1, 4, sq(190, -10, 200, 200)), (None, 1, 5, sq(0, 0, 7, 7)), ("c", 1, 6, sq(900, 900, 5, 5))]
    defects = spark.createDataFrame(rows, f"wafer string, scan int, id long, points {subtract._PTS}")
    groups = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), ("c", 1), ("d", 1)], "wafer string, scan int")
    devices = spark.createDataFrame([("1-1", sq(0, 0, 120, 100)), ("1-2", sq(200, 0, 100, 100)), ("9-9", sq(900, 900, 10, 10))], f"device string, points {subtract._PTS}")
    totals = subtract.subtract_totals(design, defects, [4], groups, 64.0).collect()
    report = subtract.removal_by_group(design.filter("layer = 4"), defects, devices, groups, 64.0).collect()
    assert len(totals) == 6 * 3 and len(report) == 6 * (3 + 3 + 1)
    for wafer, scan in [tuple(r) for r in groups.collect()]:
        out = subtract.subtract_layers(design, spark.createDataFrame([r[2:] for r in rows if r[:2] == (wafer, scan)], f"id long, points {subtract._PTS}"), [4], 64.0)
        want: dict = {}
        for r in out.collect():
            n, a = want.get(r.layer, (0, 0.0))
            want[r.layer] = n + 1, a + area([[(p.x, p.y) for p in r.points]])
        assert {r.layer: (r.pieces, round(r.area, 6)) for r in totals if (r.wafer, r.scan) == (wafer, scan)} == {k: (v[0], round(v[1], 6)) for k, v in want.items()}
        rep = subtract.removal_report(design.filter("layer = 4"), out.filter("layer = 4"), devices, 64.0).collect()
        figures = lambda r: (r.depth, r.device, r.layer, *[None if v is None else round(v, 6) for v in (r.original, r.removed, r.remaining, r.weighted_pct, r.mean_pct)])
        assert sorted(map(repr, (figures(r) for r in report if (r.wafer, r.scan) == (wafer, scan)))) == sorted(map(repr, map(figures, rep)))


def test_all_wafers_and_outlines_are_cut(spark, data):
    from litholake.plans import design_queries as q

    scans = {tuple(r) for r in q._scans(spark, data).collect()}
    assert len(scans) > 1
    whole = {r.layer: r.a for r in q._design(spark, data).groupBy("layer").agg({"points": "count"}).withColumnRenamed("count(points)", "a").collect()}
    got = q.q53_subtracted_layers(spark, data).collect()
    assert {(r.wafer_id, r.scan_no) for r in got} == scans and len(got) == len(scans) * len(whole)
    cutters = q._cutters(spark, data).collect()
    comps = {r.component_id: r for r in spark.read.parquet(f"{data}/defect_components.parquet").dropDuplicates(["component_id"]).collect()}
    cells = {(r.cell_row, r.cell_col): r for r in spark.read.parquet(f"{data}/cells.parquet").collect()}
    assert len({c.id for c in cutters}) == len(cutters) > 0.9 * len(comps) and {(c.wafer_id, c.scan_no) for c in cutters} == scans
    for c in cutters:
        r = comps[c.id]
        k, (sx, sy) = cells[r.cell_row, r.cell_col], r.scale_to_original_px or (1.0, 1.0)
        ring = [p for p in r.polygon_px or [] if p is not None and len(p) >= 2 and None not in p[:2]]
        if abs(sum(p[0] * s[1] - p[1] * s[0] for p, s in zip(ring, ring[1:] + ring[:1], strict=True))) < 1e-9:
            x, y, w, h = r.bbox_px[:4]
            ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        assert [(p.x, p.y) for p in c.points] == [(k.crop_x0_dbu + k.dbu_per_px * p[0] * sx, k.crop_y1_dbu - k.dbu_per_px * p[1] * sy) for p in ring]
    lost = {(r.wafer_id, r.scan_no): r.removed for r in q.q54_removal_report(spark, data).filter("depth = 0").collect()}
    assert set(lost) == scans and sum(v > 0 for v in lost.values()) > 1


def test_protected_layer_keeps_borders_and_bridges_fingers(spark):
    box = lambda x0, y0, x1, y1: [{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    shapes = [(k, 3, box(10 * k, 0, 10 * k + 2, 100)) for k in range(5)] + [(9, 3, box(-5, -20, 60, -5)), (8, 1, box(0, 0, 5, 5))]
    design = spark.createDataFrame(shapes, "id long, layer int, points array<struct<x:double,y:double>>")
    defects = spark.createDataFrame([(1, box(18, 40, 24, 60)), (2, box(-3, -12, 3, -8))], "id long, points array<struct<x:double,y:double>>")
    got = subtract.subtract_protected(design, defects, 3, 10.0, 2.0).collect()
    area = lambda rows: sum(abs(sum(a.x * b.y - a.y * b.x for a, b in zip(r.points, r.points[1:] + r.points[:1], strict=True))) / 2 for r in rows)
    kinds = {k: [r for r in got if r.kind == k] for k in ("border", "finger", "shunt")}
    assert [r.id for r in kinds["border"]] == [9] and area(kinds["border"]) == 65 * 15
    assert abs(area(kinds["finger"]) - (5 * 200 - 40)) < 1e-6
    assert kinds["shunt"] and all(p.y <= 40 or p.y >= 60 or not 18 < p.x < 24 for r in kinds["shunt"] for p in r.points)
    whole = subtract.subtract_protected(design, defects.limit(0), 3, 10.0, 2.0).collect()
    assert len(whole) == 6 and not [r for r in whole if r.kind == "shunt"]
