"""Queries of the general problems 1-3 over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litholake.operators import nested, references, spatial
from litholake.session import materialise, table

REFERENCES = (("cell_records", "image_path", "record_id"), ("cell_records", "metadata_path", "record_id"), ("device_entries", "image_path", "entry_id"))
NEAR_DBU = 280.0
METAL_LAYERS = (4, 8)


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference: table, field, record, moment and path; no references left out by repeated deliveries."""
    cells = table(spark, sf_dir, "cell_records", "record_id", "recorded_at", "image_path", "metadata_path")
    cells = cells.select(F.lit("cell_records").alias("src_table"), "record_id", "recorded_at", F.explode(F.array(F.struct(F.lit("image_path").alias("ref_field"), F.col("image_path").alias("path")), F.struct(F.lit("metadata_path").alias("ref_field"), F.col("metadata_path").alias("path")))).alias("r")).select("src_table", "r.ref_field", "record_id", "recorded_at", "r.path")
    entries = table(spark, sf_dir, "device_entries", "entry_id", "recorded_at", "image_path").select(F.lit("device_entries").alias("src_table"), F.lit("image_path").alias("ref_field"), F.col("entry_id").alias("record_id"), "recorded_at", F.col("image_path").alias("path"))
    return cells.unionByName(entries).filter(references.is_reference(F.col("path")))


def _orphans(spark: SparkSession, sf_dir: str, reasons: bool = False) -> DataFrame:
    refs = references.with_path_keys(_references(spark, sf_dir), "path").drop("path")
    files = table(spark, sf_dir, "crop_files", "file_path", "arrived_at", "deleted_at").filter(F.col("arrived_at").isNotNull() & references.is_reference(F.col("file_path")))
    lives = references.with_path_keys(files, "file_path").drop("file_path")
    gone = references.orphan_references(refs, lives, references.PATH_KEYS, "identical", "recorded_at", "arrived_at", "deleted_at")
    if reasons:
        gone = references.why_orphaned(gone, lives, references.PATH_KEYS, "identical", "recorded_at", "arrived_at")
    return gone.select("src_table", "ref_field", "record_id", F.date_format("recorded_at", "yyyy-MM").alias("ref_month"), *(["reason"] if reasons else [])).distinct()


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir)


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, field and month."""
    return _orphans(spark, sf_dir).groupBy("src_table", "ref_field", "ref_month").agg(F.count("*").alias("orphans"))


def p1_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, field and month, told apart by what became of the file: missing, late or deleted."""
    return _orphans(spark, sf_dir, reasons=True).groupBy("src_table", "ref_field", "ref_month", "reason").agg(F.count("*").alias("orphans"))


def p1_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device entries whose cell of a scan has no cell record; a null part of the key matches any (MATCH PARTIAL)."""
    keys = ["wafer_id", "scan_no", "cell_row", "cell_col"]
    entries = table(spark, sf_dir, "device_entries", "entry_id", *keys).dropDuplicates(["entry_id"])
    return references.orphan_references(entries, table(spark, sf_dir, "cell_records", *keys), keys, "partial").select("entry_id")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = nested.metadata_points(table(spark, sf_dir, "cell_records", "record_id", "metadata"))
    entries = nested.defect_points(table(spark, sf_dir, "device_entries", "entry_id", "defects"))
    results = nested.body_points(table(spark, sf_dir, "detector_results", "result_id", "body"))
    return cells.unionByName(entries).unionByName(results)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("parent_table", "parent_id", "child", "item_no", "point_no")


def p2_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat rows with their coordinates."""
    return _points(spark, sf_dir)


def p2_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defects of the device entries as a table of their own, linked by entry and place."""
    entries = table(spark, sf_dir, "device_entries", "entry_id", "defects")
    return nested.child_rows(entries, "entry_id", "defects", ["defect_type", "center_x_um", "center_y_um", "width_um", "height_um", "score", "area_px", "source", "seam_overlap_frac"]).withColumnRenamed("parent_id", "entry_id")


def p2_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images of the detector bodies, with the number of their defects."""
    return nested.body_images(table(spark, sf_dir, "detector_results", "result_id", "body"))


def p2_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar members of the extraction metadata, one row each."""
    cells = table(spark, sf_dir, "cell_records", "record_id", "metadata")
    return nested.metadata_members(cells, "record_id", "metadata", ("cell_stem", "crop_source", "analysis_png", "flat_angle_deg", "downscale_factor", "local_stitch_scale"))


def located_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each component once, with its place in the design (DBU); components without a location are left out."""
    c = table(spark, sf_dir, "defect_components", "component_id", "wafer_id", "scan_no", "cell_row", "cell_col", "polygon_px", "bbox_px", "scale_to_original_px")
    cells = table(spark, sf_dir, "cells", "cell_row", "cell_col", "crop_x0_dbu", "crop_y1_dbu", "dbu_per_px")
    mx, my = spatial.bbox_center(F.col("polygon_px"), F.col("bbox_px"))
    scale = lambda i: F.coalesce(F.get("scale_to_original_px", F.lit(i)), F.lit(1.0))
    px = c.select("component_id", "wafer_id", "scan_no", "cell_row", "cell_col", (mx * scale(0)).alias("mx"), (my * scale(1)).alias("my")).filter("mx is not null and my is not null").distinct()
    return px.join(cells, ["cell_row", "cell_col"]).select("component_id", "wafer_id", "scan_no", (F.col("crop_x0_dbu") + F.col("dbu_per_px") * F.col("mx")).alias("x"), (F.col("crop_y1_dbu") - F.col("dbu_per_px") * F.col("my")).alias("y"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = materialise(located_components(spark, sf_dir), "located")  # narrow rows, read by both branches
    near = spatial.near_pairs(located, ["wafer_id", "scan_no"], "component_id", "x", "y", NEAR_DBU)
    metal = table(spark, sf_dir, "boundaries", "element_index", "layer", "points").filter(F.col("layer").isin(*METAL_LAYERS))
    inside = spatial.inside_regions(located, "component_id", "x", "y", metal, "element_index", "points")
    return near.select(F.lit("near").alias("relation"), F.col("left_id").alias("component_id"), F.col("right_id").alias("target_id")).unionByName(inside.select(F.lit("inside").alias("relation"), F.col("id").alias("component_id"), F.col("region").alias("target_id")))


def p3_crowding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many components of the same wafer scan lie close to each component, as far as there are any."""
    located = materialise(located_components(spark, sf_dir), "located")
    return spatial.neighbour_counts(located, ["wafer_id", "scan_no"], "component_id", "x", "y", NEAR_DBU).withColumnRenamed("id", "component_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p1_reasons, p1_partial, p2_found, p2_points, p2_defects, p2_images, p2_metadata, p3_found, p3_crowding)}

_SEGMENTS = r"""list_reduce(list_prepend([]::varchar[], list_transform(string_split(replace(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '\', '/'), '/'), lambda s: [s])),
 lambda acc, x: case when x[1] in ('', '.') then acc when x[1] = '..' then acc[:greatest(len(acc) - 1, 0)] else list_concat(acc, x) end)"""
_REFS = f"""
seg as (select src_table, ref_field, id, recorded_at, {_SEGMENTS.format("path")} s from (
  select 'cell_records' src_table, 'image_path' ref_field, record_id id, recorded_at, image_path path from cell_records
  union all select 'cell_records', 'metadata_path', record_id, recorded_at, metadata_path from cell_records
  union all select 'device_entries', 'image_path', entry_id, recorded_at, image_path from device_entries)
  where path is not null and lower(regexp_replace(path, '^\\s+|\\s+$', '', 'g')) not in ('', 'none')),
ref as (select distinct src_table, ref_field, id, recorded_at, array_to_string(s[greatest(coalesce(list_position(s, 'aligned_cells'), 1), 1):], '/') p from seg),
fseg as (select {_SEGMENTS.format("file_path")} s, arrived_at, deleted_at from crop_files where file_path is not null),
life as (select distinct array_to_string(s[greatest(coalesce(list_position(s, 'aligned_cells'), 1), 1):], '/') p, arrived_at, deleted_at from fseg),
gone as (select distinct src_table, ref_field, id as record_id, strftime(recorded_at, '%Y-%m') ref_month from ref
  where not exists (select 1 from life where life.p = ref.p and arrived_at <= recorded_at and (deleted_at is null or deleted_at > recorded_at)))
"""
ORACLES: dict[str, str] = {
    "p1_found": f"with {_REFS} select src_table, ref_field, record_id, ref_month from gone",
    "p1_report": f"with {_REFS} select src_table, ref_field, ref_month, count(*) as orphans from gone group by 1, 2, 3",
    "p1_reasons": f"""with {_REFS}, began as (select p, min(arrived_at) a from life where p is not null and arrived_at is not null group by 1),
 told as (select distinct src_table, ref_field, id, strftime(recorded_at, '%Y-%m') ref_month, case when a is null then 'missing' when recorded_at is null then 'undated' when a > recorded_at then 'late' else 'deleted' end reason from ref left join began using (p)
  where not exists (select 1 from life where life.p = ref.p and arrived_at <= recorded_at and (deleted_at is null or deleted_at > recorded_at)))
 select src_table, ref_field, ref_month, reason, count(*) as orphans from told group by 1, 2, 3, 4""",
    "p1_partial": """select entry_id from (select distinct on (entry_id) * from device_entries where entry_id is not null order by entry_id) e
 where not (wafer_id is null and scan_no is null and cell_row is null and cell_col is null) and not exists (select 1 from cell_records c
  where (e.wafer_id is null or e.wafer_id = c.wafer_id) and (e.scan_no is null or e.scan_no = c.scan_no) and (e.cell_row is null or e.cell_row = c.cell_row) and (e.cell_col is null or e.cell_col = c.cell_col))""",
}

ORACLES["p2_defects"] = """select entry_id, (i - 1)::int as item_no, d.defect_type, d.center_x_um, d.center_y_um, d.width_um, d.height_um, d.score, d.area_px, d.source, d.seam_overlap_frac
 from (select entry_id, i, defects[i] d from (select entry_id, defects, unnest(range(1, len(defects) + 1)) i from (select distinct on (entry_id) * from device_entries where entry_id is not null order by entry_id))) where d is not null"""

# the object of a JSON text, and a member that may be text itself, as the statement of problem 2 has them
_BARE = "ltrim({0}, chr(65279))"
_JSON = "(case when json_valid({0}) then {0}::json end)"
_UNWRAP = "case when json_type({0}) = 'VARCHAR' and json_valid(ltrim({0}->>'$', chr(65279))) then ltrim({0}->>'$', chr(65279))::json when json_type({0}) = 'VARCHAR' then null else {0} end"
_LONE = "case when json_type({0}) = 'ARRAY' and json_array_length({0}) = 1 and json_type({0}, '$[0]') = 'OBJECT' then {0}->0 when json_type({0}) = 'OBJECT' then {0} end"


def _objects(name: str, key: str, text: str) -> str:
    bare, one, lone = _BARE.format(text), _UNWRAP.format("j"), _LONE.format("j")
    return f"""(select id, {lone} j from (select id, {one} j from (select id, {_JSON.format("t")} j from (select distinct on ({key}) {key} id, {bare} t from {name} where {key} is not null order by {key}))))"""


_NUM = "in ('BIGINT', 'UBIGINT', 'HUGEINT', 'UHUGEINT', 'DOUBLE')"
_XY = f"""case when json_type(e) = 'ARRAY' and json_type(e, '$[0]') {_NUM} and json_type(e, '$[1]') {_NUM} then [(e->0)::double, (e->1)::double]
 when json_type(e) = 'OBJECT' and json_type(e, '$.x') {_NUM} and json_type(e, '$.y') {_NUM} then [(e->'x')::double, (e->'y')::double] end"""
_P2 = f"""with o as (select * from {_objects("cell_records", "record_id", "metadata")} where j is not null),
m as (select id, child, {_UNWRAP.format("a")} a from (select id, unnest(['gds_corners_um', 'overlapping_tiles']) child, unnest([j->'gds_corners_um', j->'overlapping_tiles']) a from o)),
cp as (select id, child, i, {_XY} p from (select id, child, i, a->i e from (select id, child, a, unnest(range(json_array_length(a)::bigint)) i from m where json_type(a) = 'ARRAY'))),
de as (select entry_id id, i - 1 i, defects[i] d from (select entry_id, defects, unnest(range(1, len(defects) + 1)) i from (select distinct on (entry_id) * from device_entries where entry_id is not null order by entry_id))),
dq as (select id, i, k - 1 k, [g[k][1], g[k][2]] p from (select id, i, d.polygon_px g, unnest(range(1, len(d.polygon_px) + 1)) k from de where d is not null) where len(g[k]) >= 2 and g[k][1] is not null and g[k][2] is not null),
b as (select * from {_objects("detector_results", "result_id", "body")} where j is not null),
li as (select id, n, im->>'image' child, case when json_type(im->'image') = 'VARCHAR' then true else false end named, im->'defects' d from (select id, n, (j->'images')->n im from (select id, j, unnest(range(json_array_length(j->'images')::bigint)) n from b where json_type(j->'images') = 'ARRAY')) where json_type(im) = 'OBJECT'),
ob as (select id, case when json_type(j, '$.annotations') is not null then case when json_type(j, '$.annotations') = 'OBJECT' then j->'annotations' end else j end j from b where json_type(j, '$.images') is null),
kk as (select id, j, k, json_keys(j)[k] child from (select id, j, unnest(range(1, len(json_keys(j)) + 1)) k from ob where j is not null)),
im as (select id, n, case when named then child end child, d from li union all select id, row_number() over (partition by id order by k) - 1, child, d from (select id, k, child, json_extract(j, '$."' || child || '"') d from kk) where json_type(d) = 'ARRAY'),
nu as (select row_number() over () u, id, n, child, d from im),
sl as (select u, id, child, s, d->s e from (select u, id, child, d, unnest(range(json_array_length(d)::bigint)) s from nu where json_type(d) = 'ARRAY') where json_type(d, '$[' || s || ']') = 'OBJECT' union all select u, id, child, 0, d from nu where json_type(d) = 'OBJECT'),
sp as (select u, id, child, s, {_UNWRAP.format("g")} g from (select u, id, child, s, e->'polygon_px' g from sl)),
bp as (select u, id, child, s, k, {_XY} p from (select u, id, child, s, k, g->k e from (select u, id, child, s, g, unnest(range(json_array_length(g)::bigint)) k from sp where json_type(g) = 'ARRAY'))),
f as (select 'cell_records' parent_table, id, child, i item, -1 point, p from cp where p is not null
 union all select 'device_entries', id, 'defects', i, k, p from dq union all select 'device_entries', id, 'defects', i, -1, null from de where d is not null and not exists (select 1 from dq where dq.id = de.id and dq.i = de.i)
 union all select 'detector_results', id, child, s, k, p from bp where p is not null
 union all select 'detector_results', id, child, s, -1, null from sp where not exists (select 1 from bp where bp.u = sp.u and bp.s = sp.s and p is not null)
 union all select 'detector_results', id, child, -1, -1, null from nu where not exists (select 1 from sl where sl.u = nu.u))"""
ORACLES["p2_found"] = f"{_P2} select parent_table, id as parent_id, child, item::int as item_no, point::int as point_no from f"
ORACLES["p2_points"] = f"{_P2} select parent_table, id as parent_id, child, item::int as item_no, point::int as point_no, p[1] as x, p[2] as y from f"

ORACLES["p2_images"] = f"{_P2} select nu.id as parent_id, n::int as image_no, nu.child as image, count(sl.u)::int as defects from nu left join sl using (u) group by u, 1, 2, 3"
ORACLES["p2_metadata"] = f"""{_P2} select id as parent_id, member, case when json_type(v) = 'VARCHAR' then v->>'$' end as text, case when json_type(v) {_NUM} then v::double end as number
 from (select id, member, json_extract(j, '$.' || member) v from (select id, j, unnest(['cell_stem', 'crop_source', 'analysis_png', 'flat_angle_deg', 'downscale_factor', 'local_stitch_scale']) member from o)) where json_type(v) = 'VARCHAR' or json_type(v) {_NUM}"""

_LOCATED = """
c as (select distinct on (component_id) * from defect_components order by component_id, ingested_at),
u as (select component_id, wafer_id, scan_no, cell_row, cell_col, bbox_px b, scale_to_original_px s, list_filter(polygon_px, lambda p: p is not null and len(p) >= 2 and p[1] is not null and p[2] is not null) g from c),
m as (select *, case when len(g) > 0 then (list_min(list_transform(g, lambda p: p[1])) + list_max(list_transform(g, lambda p: p[1]))) / 2.0::double when len(b) >= 4 then b[1] + b[3] / 2.0::double end x,
 case when len(g) > 0 then (list_min(list_transform(g, lambda p: p[2])) + list_max(list_transform(g, lambda p: p[2]))) / 2.0::double when len(b) >= 4 then b[2] + b[4] / 2.0::double end y from u),
loc as (select component_id, wafer_id, scan_no, crop_x0_dbu + dbu_per_px * (x * coalesce(s[1], 1)) x, crop_y1_dbu - dbu_per_px * (y * coalesce(s[2], 1)) y from m join cells using (cell_row, cell_col) where x is not null and y is not null)
"""
_NEAR = """
cellk as (select *, floor(x / 280)::bigint gx, floor(y / 280)::bigint gy from loc),
near as (select a.component_id, b.component_id t from cellk a cross join (select unnest([-1, 0, 1]) dx) cross join (select unnest([-1, 0, 1]) dy) join cellk b on a.wafer_id = b.wafer_id and a.scan_no = b.scan_no and b.gx = a.gx + dx and b.gy = a.gy + dy
 where a.component_id < b.component_id and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 280 * 280)
"""
ORACLES["p3_crowding"] = f"with {_LOCATED}, {_NEAR} select component_id, count(*) as neighbours from (select component_id from near union all select t from near) group by 1"
ORACLES["p3_found"] = f"""with {_LOCATED}, {_NEAR},
r0 as (select distinct on (element_index) element_index, list_filter(points, lambda p: p is not null) p from boundaries where layer in (4, 8) and len(points) >= 3 order by element_index),
r1 as (select element_index, p, len(p) n, list_min(list_transform(p, lambda q: q.x)) x0, list_max(list_transform(p, lambda q: q.x)) x1, list_min(list_transform(p, lambda q: q.y)) y0, list_max(list_transform(p, lambda q: q.y)) y1 from r0),
r2 as (select * from r1 where list_sum(list_transform(range(1, n + 1), lambda i: p[i].x::double * p[i % n + 1].y - p[i].y::double * p[i % n + 1].x)) <> 0),
box as (select component_id, element_index, x, y, p, n from loc join r2 on x between x0 and x1 and y between y0 and y1),
e as (select component_id, element_index, x, y, p[i].x::double ax, p[i].y::double ay, p[i % n + 1].x::double bx, p[i % n + 1].y::double by_ from (select *, unnest(range(1, n + 1)) i from box)),
k as (select component_id, element_index, bool_or((bx - ax) * (y - ay) - (by_ - ay) * (x - ax) = 0 and x between least(ax, bx) and greatest(ax, bx) and y between least(ay, by_) and greatest(ay, by_)) onl,
 sum(case when (ay > y) <> (by_ > y) and x < ax + (bx - ax) * (y - ay) / nullif(by_ - ay, 0) then 1 else 0 end) c from e group by 1, 2)
select 'near' as relation, component_id, t as target_id from near union all select 'inside', component_id, element_index from k where onl or c % 2 = 1"""
