import math
import random

import pytest
from pyspark.sql import functions as F

from litholake.operators import markers
from litholake.sources import annotations, batch
from litholake.streaming import sessions


def test_batch_files(spark, tmp_path):
    text = "\ufeff# comment\nname: mesa\npath: C:\\x:y\n\nNAME: Wafer_b\nPath: /p\nfolder_name: LORs\npath: /g\nname: MESA\npath: /again\nwhat: 1\npath: 2\nname:\npath: /v\nname: odd\n"
    good, errors = batch.parse_batch(spark, text)
    assert [tuple(r) for r in good.orderBy("after_folder").collect()] == [("LORs", "/g", "folder_name", "LORs"), ("Wafer_b", "/p", "name", None), ("Wafer_mesa", "C:\\x:y", "name", None)]
    assert [(r.line_no, r.problem) for r in errors.collect()] == [(9, "repeated wafer id"), (11, "expected name or folder_name"), (13, "empty value"), (15, "declaration without path")]
    assert batch.parse_batch(spark, "# only\n")[1].count() == 1
    for d in ("g/b", "g/A", "n"):
        (tmp_path / d).mkdir(parents=True)
    df = spark.createDataFrame([("G", str(tmp_path / "g"), "folder_name", "G"), ("Wafer_n", str(tmp_path / "n"), "name", None)], batch.WAFERS)
    assert [r.wafer_id for r in batch.expand_groups(df).collect()] == ["G_A", "G_b", "Wafer_n"]
    (tmp_path / "g" / "loose.txt").write_text("x")
    with pytest.raises(ValueError):
        batch.expand_groups(df)


def test_tiles_runs_and_exclusions(spark):
    f = spark.createDataFrame([("/r/tile_x001_y002.jpg",), ("/r/tile_x001_y002 (1).jpg",), ("/r/tile_x002_y001.jpg",), ("/r/other.jpg",), ("/w/analysis_png/a.PNG",), ("/w/metadata/a.json",), ("/v/analysis_png/a.txt",)], "path string")
    t = batch.scan_tiles(f)
    assert sorted((r["col"], r["row"], r["path"]) for r in t.collect()) == [(1, 2, "/r/tile_x001_y002.jpg"), (2, 1, "/r/tile_x002_y001.jpg")]
    assert tuple(batch.grid_size(t).first()) == (2, 2, 2)
    assert {r.run: (r.images, r.complete) for r in batch.image_inventory(f).collect()} == {"/w": (1, True), "/v": (0, False)}
    names = spark.createDataFrame([("a.png", "A"), ("b.png", None)], "image string, stem string")
    assert [r.image for r in batch.exclude(names, ["A.jpg"], "image", "stem").collect()] == ["b.png"] and batch.exclude(names, [], "image").count() == 2


def test_config_and_removal_guard(tmp_path):
    (tmp_path / "d.gds").write_bytes(b"")
    assert batch.design_path({"gds_path": "d.gds"}, str(tmp_path / "config.json")).endswith("d.gds")
    with pytest.raises(ValueError):
        batch.design_path({"gds_path": "d.txt"}, str(tmp_path / "config.json"))
    assert batch.option({"a": "x", "b": "2"}, ("a", "b"), 1.0) == 2.0
    (tmp_path / "out").mkdir()
    assert batch.safe_remove_tree(str(tmp_path / "out"), str(tmp_path))
    for bad in (str(tmp_path), "/", "."):
        with pytest.raises(ValueError):
            batch.safe_remove_tree(bad, str(tmp_path))


def test_annotations_and_geometry(spark):
    t = '{"A.jpg": [{"polygon_gds": [[0,0],[4,0],[4,4]], "score": 9}, 3, {"corners_gds": [[0,0],[2,0],[2,2],[0,2]]}], "a.png": [{"center_x_um": 1, "center_y_um": 1, "width_um": 2, "height_um": 4}, {"score": 1}], "version": 2}'
    df = spark.createDataFrame([(1, t), (2, "broken"), (3, None)], "id long, body string")
    rows = annotations.annotation_rows(df, "body", "id")
    assert {r.kind: r.n for r in annotations.load_totals(rows).collect()} == {"exact": 1, "bbox": 1, "legacy": 1, "none": 1}
    assert {r.image for r in annotations.last_by_stem(rows, "id").collect()} == {"a.png"}
    m, warnings = annotations.metadata_rows(spark.createDataFrame([(1, '{"gds_bbox_um": [0, 0, 10, 20], "crop_size_px": [100, 200]}'), (2, "{broken"), (3, None)], "id int, t string"), "t", "id")
    x, y = annotations.bbox_to_gds(F.lit(10.0), F.lit(20.0))
    assert [tuple(r) for r in m.select("id", annotations.transform_kind(), x, y).collect()] == [(1, "bbox", 1.0, 18.0)]
    assert sorted(r.id for r in warnings.collect()) == [2, 3]


def test_marker_lattice_is_recovered(spark):
    r = random.Random(5)
    a, pitch = math.radians(1.2), 40.0
    pts = [(1000 + pitch * 1.01 * (math.cos(a) * x - math.sin(a) * y), 700 + pitch * 1.01 * (math.sin(a) * x + math.cos(a) * y)) for _, x, y in markers.template()]
    rows = [("i", k, x + r.uniform(-0.5, 0.5), y + r.uniform(-0.5, 0.5), 20.0, 21.0, 400.0) for k, (x, y) in enumerate(pts[:11])] + [("i", 100 + k, r.uniform(0, 2000), r.uniform(0, 1500), 20.0, 20.0, 390.0) for k in range(15)] + [("i", 999, 5.0, 5.0, 200.0, 10.0, 2000.0)]
    shapes = spark.createDataFrame(rows, "image string, shape_id int, x double, y double, w double, h double, area double")
    sq = markers.square_candidates(shapes, 20.0)
    assert sq.count() == 26
    best = markers.match_lattice(sq, markers.lattice_hypotheses(sq, pitch), 6.0).first()
    assert best.matches >= 10 and abs(best.tx - 1000) < 1.5 and abs(best.ty - 700) < 1.5 and abs(best.scale - 40.4) < 0.5
    assert min(abs(best.angle - a), abs(abs(best.angle - a) - math.pi)) < 0.02
    ok = spark.createDataFrame([(11, 40.0, 0.5, 0.5, 0.1), (7, 40.0, 9.0, 0.9, 0.5)], "matches int, scale double, rmsd double, size_ratio double, size_cv double")
    assert [len(x[0]) for x in ok.select(markers.rejection(40.0)).collect()] == [0, 4]


def test_cell_layout(spark):
    cells = spark.createDataFrame([(i, k) for i, n in enumerate(markers.ROW_SHAPE, 1) for k in range(n)], "cell_row int, k int")
    assert tuple(markers.row_shape_is_valid(cells).first()) == (True, 76)
    assert tuple(markers.row_shape_is_valid(cells.filter("not (cell_row = 3 and k = 0)")).first()) == (False, 75)


def test_streamed_sessions_equal_batch(spark, data, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    spark.read.parquet(f"{data}/events.parquet").coalesce(1).write.parquet(str(folder / "a"))
    events = sessions.read_events(spark, str(folder / "a"))
    q = sessions.sessions(events, late="1 hour").writeStream.format("memory").queryName("closed").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.event_type, r.user_id, r.start, r.last, r.n) for r in spark.table("closed").collect()}
    from litholake.plans.reference_queries import QUERIES

    whole = QUERIES["q42_sessions"](spark, data).select("event_type", "user_id", F.timestamp_micros("start_us").alias("start"), F.timestamp_micros("last_us").alias("last"), "n")
    want = {tuple(r) for r in whole.collect()}
    assert got <= want and len(got) > 0.9 * len(want)


def test_readme_claims_no_missing_method():
    import re
    from pathlib import Path

    root = Path(__file__).parent.parent
    claims = [line.split("|")[2] for line in (root / "README.md").read_text().split("## Reference operators")[1].split("Open or only partly there")[0].splitlines() if line.startswith("|")]
    claims += [re.search(r"\(([A-Z]\d[^)]*)\)", p.read_text().split('"""')[1]) for p in (root / "litholake").rglob("*.py") if '"""' in p.read_text()]
    ids = set()
    for text in (c if isinstance(c, str) else c[1] for c in claims if c):
        for a, n, m in re.findall(r"\b([A-Z])(\d+)(?:-[A-Z](\d+))?", text):
            ids |= {f"{a}{k}" for k in range(int(n), int(m or n) + 1)}
    assert {"L1", "S24", "A15"} <= ids
    assert ids.isdisjoint({"L2", "L6", "L7", "L9", "I7", "J20", "S22", "S23", "S25"})
