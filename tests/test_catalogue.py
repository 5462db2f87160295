import math

import pytest
from pyspark.sql import functions as F

from litholake.functions import geometry, strings
from litholake.kernels import clip
from litholake.operators import catalogue, fingers, markers


def test_catalogue_and_orders(spark):
    images = spark.createDataFrame([("A_1", 1, None), ("b_2", 2, 1), (None, 1, 1), ("A_1", 1, 2)], "stem string, cell_row int, cell_col int")
    notes = spark.createDataFrame([("a_1 ", [1], 1), ("A_1", [2, 3], 2), (None, [9], 3)], "stem string, defects array<int>, no int")
    got = catalogue.with_annotations(images, "stem", notes, "defects", "no").orderBy(*catalogue.device_order(key="stem")).collect()
    assert [(r.stem, r.defects) for r in got] == [(None, []), ("A_1", [2, 3]), ("A_1", [2, 3]), ("b_2", [])]
    order = catalogue.in_declared_order(images, "stem", ["B_2", "x", "b_2"]).collect()
    assert {(r.stem, r.position) for r in order} == {("A_1", None), ("b_2", 0), (None, None)}


def test_selector_lists_all_unknown_cells(spark):
    cells = spark.createDataFrame([(1, 2), (3, 4), (3, 4)], "cell_row int, cell_col int")
    assert catalogue.select_cells(cells, [" 3-4"]).count() == 2 and catalogue.select_cells(cells, []).count() == 3
    with pytest.raises(ValueError, match="unknown cells: 9-9, x"):
        catalogue.select_cells(cells, ["1-2", "9-9", "x"])


def test_general_offset_and_repair():
    ell = [(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)]
    grown = clip.offset(ell, 1.0)
    assert abs(clip.area(grown) - (12 * 6 + 6 * 6)) < 1e-6
    assert abs(clip.area(clip.offset(ell[::-1], 1.0)) - clip.area(grown)) < 1e-6
    assert abs(clip.area(clip.offset([(0, 0), (10, 0), (10, 10), (0, 10)], 2.0)) - 196) < 1e-6
    needle = clip.offset([(0, 0), (100, 1), (100, -1)], 1.0)
    assert max(x for p in needle for x, _ in p) <= 101 + 1e-6 and min(x for p in needle for x, _ in p) >= -1.1
    assert clip.offset([(0, 0), (1, 0), (2, 0)], 1.0) == [[(0, 0), (1, 0), (2, 0)]]
    assert abs(clip.area(clip.repaired([(0, 0), (4, 4), (4, 0), (0, 4)])) - 8) < 1e-9 and clip.repaired([(0, 0), (1, 1)]) == []


def test_small_rules(spark):
    t = spark.createDataFrame([(0.0, "m"), (59.6, "a b"), (3599.0, ""), (3661.0, "x"), (None, None), (-3.0, "-")], "s double, w string")
    got = [tuple(r) for r in t.select(strings.minutes_text(F.col("s")), strings.quoted(F.col("w"))).collect()]
    assert got == [("0:00", "m"), ("1:00", '"a b"'), ("59:59", '""'), ("1:01:01", "x"), ("--:--", None), ("--:--", "-")]
    tiles = spark.createDataFrame([(0.0, 0.0), (60.0, 60.0), (None, 0.0)], "x double, y double")
    inside = geometry.tile_inside(F.col("x"), F.col("y"), F.lit(10.0), F.lit(10.0), F.lit(0.0), F.lit(0.0), F.lit(100.0))
    assert [r[0] for r in tiles.select(inside).collect()] == [True, False, None]
    boxes = spark.createDataFrame([(1, 0, 0, 2, 50), (1, 5, 0, 7, 50), (1, 9, 0, 40, 50), (1, 50, 0, 52, 1), (1, None, 0, 1, 1)], "g int, x0 int, y0 int, x1 int, y1 int")
    assert sorted(str(r.kind) for r in fingers.finger_or_border(boxes, ["g"]).collect()) == ["None", "border", "border", "finger", "finger"]
    report = fingers.cleanup_json(spark.createDataFrame([(1, 1, 7), (1, 1, 3)], "cell_row int, cell_col int, element_index long"), spark.createDataFrame([(1, 1, 5), (1, 2, 4)], "cell_row int, cell_col int, parts int"))
    assert sorted(r.report for r in report.collect()) == ['{"cell_row":1,"cell_col":1,"parts":5,"removed_elements":[3,7]}', '{"cell_row":1,"cell_col":2,"parts":4,"removed_elements":[]}']


def test_lattice_metrics_and_rail(spark):
    fits = spark.createDataFrame([("m", 10.0, math.pi * 0.75, 0.5, 12), ("e", 10.0, 0.0, 0.1, 3)], "k string, scale double, angle double, rmsd double, matches int")
    squares = spark.createDataFrame([("m", 5.0, 0.1), ("m", 5.0, 0.2), ("m", 5.0, 0.6)], "k string, side double, error double")
    r = {x.k: x for x in markers.candidate_metrics(fits, squares, ["k"]).collect()}
    assert abs(r["m"].size_ratio - 0.5) < 1e-9 and r["m"].size_cv == 0 and abs(r["m"].error_ratio - 0.05) < 1e-9 and abs(r["m"].asymmetry - 3) < 1e-9 and abs(r["m"].turn + 45) < 1e-9
    assert r["e"].size_ratio is None
    valid = markers.candidate_metrics(fits, squares, ["k"]).select("k", markers.rejection(10.0).alias("why")).filter("k = 'm'").first()
    assert not valid.why
    pixels = spark.createDataFrame([("a", float(x), float(y)) for x in (-30, -20, 0, 25) for y in range(5)], "k string, x double, y double")
    anchors = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 10.0), ("b", 0.0, 0.0, 0.0, 10.0)], "k string, ax double, ay double, angle double, pitch double")
    assert {x.k: x.side for x in markers.side_of_rail(pixels, anchors, "k").collect()} == {"a": "left", "b": None}
    turned = anchors.withColumn("angle", F.lit(math.pi))
    assert markers.side_of_rail(pixels, turned, "k").filter("k = 'a'").first().side == "right"
