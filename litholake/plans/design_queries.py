"""Design clean-up, subtraction and annotation queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litholake.functions.geometry import bounds, signed_area
from litholake.operators import fingers, subtract
from litholake.plans import problems_core
from litholake.plans.reference_queries import bound
from litholake.session import table
from litholake.sources import annotations

GRID_LAYER, TARGET_LAYER = 3, 4


def design_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bounds(F.col("points"))
    d = bound(spark, sf_dir).filter("size(points) >= 3").withColumn("b", b)
    return d.select("element_index", "layer", *[F.col(f"b.{c}").cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")])


def nominal_fingers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of the metal layer with their width set to the nominal 600 DBU about their centre: in this design widths are
    varied on purpose, while the inference relies on a modal size."""
    c = F.floor((F.col("x0") + F.col("x1")) / 2).cast("int")
    d = design_boxes(spark, sf_dir).filter(F.col("layer") == TARGET_LAYER)
    return d.select("element_index", "layer", (c - 300).alias("x0"), "y0", (c + 300).alias("x1"), "y1")


def q51_inferred_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that the fingers of the metal layer imply."""
    return fingers.infer_cells(nominal_fingers(spark, sf_dir), TARGET_LAYER).select("cell_row", "cell_col", "cx", "cy", "lines")


def q52_grid_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the grid layer per cell of the design, and what would be removed."""
    x = lambda c: F.col(f"bbox_um.{c}") * 10
    cells = table(spark, sf_dir, "cells").select("cell_row", "cell_col", x("x0").alias("wx0"), x("y0").alias("wy0"), x("x1").alias("wx1"), x("y1").alias("wy1"), F.lit(90000.0).alias("x_pitch"), F.lit(90000.0).alias("y_pitch"))
    return fingers.hanging_pieces(design_boxes(spark, sf_dir), cells, GRID_LAYER)[1]


SCAN = ("wafer_id", "scan_no")


def _cutters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of all components in the design (DBU), each component once: ``wafer_id, scan_no, id, points``.

    The scaled points of ``polygon_px``; where fewer than three are usable or they span no area, the scaled box. A
    component with neither cuts nothing. Components of an unknown wafer stay under null."""
    c = table(spark, sf_dir, "defect_components", "component_id", *SCAN, "cell_row", "cell_col", "polygon_px", "bbox_px", "scale_to_original_px")
    cells = table(spark, sf_dir, "cells", "cell_row", "cell_col", "crop_x0_dbu", "crop_y1_dbu", "dbu_per_px")
    at = lambda a, i: F.get(a, F.lit(i)).cast("double")
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.transform(F.filter("polygon_px", lambda p: at(p, 0).isNotNull() & at(p, 1).isNotNull()), lambda p: pt(at(p, 0), at(p, 1)))
    x, y, w, h = (at(F.col("bbox_px"), i) for i in range(4))
    box = F.when((w > 0) & (h > 0) & x.isNotNull() & y.isNotNull(), F.array(pt(x, y), pt(x + w, y), pt(x + w, y + h), pt(x, y + h)))
    px = c.withColumn("ring", ring).withColumn("px", F.when(F.abs(signed_area(F.col("ring"))) >= 1e-9, F.col("ring")).otherwise(box)).filter("px is not null").dropDuplicates(["component_id"])
    sx, sy = (F.coalesce(at(F.col("scale_to_original_px"), i), F.lit(1.0)) for i in (0, 1))
    placed = px.withColumns({"sx": sx, "sy": sy}).join(cells, ["cell_row", "cell_col"])
    return placed.select(*SCAN, F.col("component_id").alias("id"), F.transform("px", lambda p: pt(F.col("crop_x0_dbu") + F.col("dbu_per_px") * p["x"] * F.col("sx"), F.col("crop_y1_dbu") - F.col("dbu_per_px") * p["y"] * F.col("sy"))).alias("points"))


def _scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "defect_components", *SCAN).distinct()


def _design(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir).filter("size(points) >= 3").select("layer", F.col("element_index").alias("id"), "points")


def q53_subtracted_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: pieces and area of each layer after the defects of a wafer and scan have been cut from the metal layer."""
    out = subtract.subtract_totals(_design(spark, sf_dir), _cutters(spark, sf_dir), [TARGET_LAYER], _scans(spark, sf_dir), 4000.0)
    return out.withColumn("area", F.bround("area", 3))


def q54_removal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area lost per wafer and scan, device and layer."""
    before = _design(spark, sf_dir).filter(F.col("layer") == TARGET_LAYER)
    pt = lambda x, y: F.struct((F.col(x) * 10).alias("x"), (F.col(y) * 10).alias("y"))
    devices = table(spark, sf_dir, "cells").select(F.concat_ws("-", "cell_row", "cell_col").alias("device"), F.array(pt("bbox_um.x0", "bbox_um.y0"), pt("bbox_um.x1", "bbox_um.y0"), pt("bbox_um.x1", "bbox_um.y1"), pt("bbox_um.x0", "bbox_um.y1")).alias("points"))
    rep = subtract.removal_by_group(before, _cutters(spark, sf_dir), devices, _scans(spark, sf_dir), 4000.0)
    return rep.select(*SCAN, "depth", "device", "layer", *[F.bround(c, 3).alias(c) for c in ("original", "removed", "remaining", "weighted_pct", "mean_pct")])


def q55_metadata_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which frame the metadata of each crop source carries, and how many corners agree with the design."""
    c = table(spark, sf_dir, "cell_records", "record_id", "metadata").filter("metadata is not null").dropDuplicates(["record_id"])
    rows, _ = annotations.metadata_rows(c, "metadata", "record_id")
    return rows.groupBy("crop_source", annotations.transform_kind().alias("kind")).agg(F.count("*").alias("n"), F.count_if(F.size("gds_corners_um") == 4).alias("with_corners"))


def q56_annotation_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects of the detector's texts by the geometry they bring."""
    r = table(spark, sf_dir, "detector_results", "result_id", "body").filter("body is not null").dropDuplicates(["result_id"])
    return annotations.load_totals(annotations.annotation_rows(r, "body", "result_id"))


def q57_reviewed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S20, A9"""
    e = table(spark, sf_dir, "device_entries", "entry_id", "wafer_id", "cell_row", "cell_col", "defects").filter("wafer_id is not null")
    e = e.withColumn("defects", F.transform("defects", lambda d: F.when(d.isNotNull(), F.struct(d["source"].alias("source"), d["center_x_um"].alias("center_x_um"), d["center_y_um"].alias("center_y_um"))))).dropDuplicates(["entry_id"])
    return annotations.reviewed_summary(e)


QUERIES = {f.__name__: f for f in (q51_inferred_cells, q52_grid_pieces, q53_subtracted_layers, q54_removal_report, q55_metadata_frames, q56_annotation_kinds, q57_reviewed_summary)}
ORACLES = {
    "q57_reviewed_summary": """
with e as (select distinct on (entry_id) entry_id, wafer_id, cell_row, cell_col, defects from device_entries where wafer_id is not null),
x as (select wafer_id, cell_row, cell_col, unnest(case when len(defects) > 0 then defects else [null] end) d from e),
k as (select *, case when d is null then null when contains(lower(coalesce(d.source, '')), 'manual') then 'manual' when contains(lower(coalesce(d.source, '')), 'algorithmic') or contains(lower(coalesce(d.source, '')), 'automatic') or contains(lower(coalesce(d.source, '')), 'detector') then 'automatic' else 'manual' end kind from x)
select wafer_id, count(distinct (cell_row, cell_col)) as cells, count(*) filter (where kind = 'automatic') as automatic, count(*) filter (where kind = 'manual') as manual, min(d.center_x_um) as x0, min(d.center_y_um) as y0, max(d.center_x_um) as x1, max(d.center_y_um) as y1 from k group by 1""",
}
ORACLES["q56_annotation_kinds"] = f"""{problems_core._P2},
k as (select e, e->'polygon_gds' pg, e->'corners_gds' cg, e->'center_x_um' a, e->'center_y_um' b, e->'width_um' c, e->'height_um' d from sl)
select case when json_array_length(pg) >= 3 then 'exact' when json_array_length(cg) >= 3 then 'bbox' when a is not null and b is not null and c::double > 0 and d::double > 0 then 'legacy' else 'none' end as kind, count(*) as n from k group by 1"""

_CELL = "c as (select cell_row, cell_col, bbox_um.x0 * 10 wx0, bbox_um.y0 * 10 wy0, bbox_um.x1 * 10 wx1, bbox_um.y1 * 10 wy1 from cells)"
ORACLES["q52_grid_pieces"] = f"""
with recursive o as (select distinct on (element_index) element_index, layer, points p from boundaries order by element_index),
g as (select element_index id, list_min(list_transform(p, lambda q: q.x)) x0, list_min(list_transform(p, lambda q: q.y)) y0, list_max(list_transform(p, lambda q: q.x)) x1, list_max(list_transform(p, lambda q: q.y)) y1 from o where layer = {GRID_LAYER} and len(p) >= 3),
{_CELL},
i as (select g.*, cell_row r, cell_col k, wx0, wx1 from g join c on (x0 + x1) / 2.0 >= wx0 and (x0 + x1) / 2.0 < wx1 and (y0 + y1) / 2.0 >= wy0 and (y0 + y1) / 2.0 < wy1 where x1 - x0 <= 108000 and y1 - y0 <= 108000),
m as (select * from i where id in (select id from i group by 1 having count(*) = 1)),
t as (select a.id a, b.id b from m a join m b on a.r = b.r and a.k = b.k and a.id <> b.id and a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1),
reach as (select id, id root from m union select t.b, reach.root from reach join t on t.a = reach.id),
comp as (select id, min(root) z from reach group by 1),
s as (select r, k, z, min(x0) lo, max(x1) hi, any_value(wx0) wl, any_value(wx1) wr, count(*) parts from m join comp using (id) group by 1, 2, 3),
v as (select *, lo <= wl + 0.2 * (wr - wl) and hi >= wr - 0.2 * (wr - wl) spans from s),
w as (select *, spans or (not bool_or(spans) over (partition by r, k) and row_number() over (partition by r, k order by hi - lo desc, z) = 1) keep from v)
select r as cell_row, k as cell_col, sum(parts)::bigint as target_boundaries, count(*) as components, coalesce(sum(case when not keep then parts end), 0)::bigint as removed, count(*) filter (where keep) as kept_components, not bool_or(spans) as fallback_used from w group by 1, 2"""
