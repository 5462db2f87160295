"""Metadata and annotation texts, the records' frames, and the sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litholake.functions import geometry
from litholake.kernels.jsonindex import objects_of
from litholake.operators.nested import Images, by_bytes

_M = "array<array<double>>"
#: Superset of the three metadata shapes; every field may be missing.
METADATA = f"wafer_id string, cell_row int, cell_col int, cell_stem string, crop_source string, downscale_factor double, canvas_to_downscaled_scale_used double, output_resize_scale double, gds_bbox_um array<double>, gds_corners_um {_M}, canvas_corners_px {_M}, canvas_corners_px_fullres {_M}, canvas_corners_px_downscaled {_M}, local_origin_px array<double>, local_origin_px_downscaled array<double>, local_origin_px_fullres array<double>, rotation_matrix_2x3 {_M}, rotation_matrix_2x3_downscaled {_M}, crop_bounds_local_px array<double>, crop_bounds_local_px_downscaled_before_resize array<double>, crop_size_px array<int>, overlapping_tiles array<array<int>>, boundary_alignment struct<homography_local_to_crop_3x3:{_M}>, analysis_png string, legacy_jpg string, seam_mask string"
DEFECT = "struct<type:string,box_px:array<int>,bbox_px:array<int>,center_x_um:double,center_y_um:double,width_um:double,height_um:double,corners_gds:array<array<double>>,polygon_gds:array<array<double>>,polygon_px:array<array<double>>,score:double,area_px:int,source:string,seam_overlap_frac:double>"


def metadata_rows(df: DataFrame, text_col: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """(rows, warnings): texts parsed with the superset schema. S11. A text that is no JSON object is a warning and no
    row; a field of the wrong type is null, and its row comes with a warning."""
    options = {"allowNonNumericNumbers": "true", "columnNameOfCorruptRecord": "__bad"}
    text = F.regexp_replace(text_col, "^\ufeff", "")
    parsed = df.select(*keep, F.from_json(text, METADATA + ", __bad string", options).alias("m"))
    fields = [F.col(f"m.{f.name}") for f in parsed.schema["m"].dataType.fields if f.name != "__bad"]
    bad = F.col("m").isNull() | F.col("m.__bad").isNotNull()
    lost = bad & F.forall(F.array(*[f.isNull() for f in fields]), lambda x: x)
    return parsed.filter(~lost).select(*keep, "m.*").drop("__bad"), parsed.filter(bad).select(*keep, F.when(lost, "unreadable metadata").otherwise("fields of the wrong type").alias("warning"))


def transform_kind() -> Column:
    """Which frame a metadata row carries: homography, rotation, downscaled rotation, or only the bounding box. B3."""
    return F.when(F.col("boundary_alignment.homography_local_to_crop_3x3").isNotNull(), "homography").when(F.col("rotation_matrix_2x3").isNotNull() & F.col("local_origin_px").isNotNull(), "rotation").when(F.col("rotation_matrix_2x3_downscaled").isNotNull() & F.col("local_origin_px_downscaled").isNotNull(), "rotation_downscaled").when(F.col("gds_bbox_um").isNotNull(), "bbox").otherwise("none")


def bbox_to_gds(px: Column, py: Column) -> tuple[Column, Column]:
    """The last resort: pixels mapped linearly into the design box (y up). Null without box or size."""
    b, s = lambda i: F.get("gds_bbox_um", F.lit(i)), lambda i: F.get("crop_size_px", F.lit(i))
    return b(0) + F.try_divide(px * (b(2) - b(0)), s(0)), b(3) - F.try_divide(py * (b(3) - b(1)), s(1))


def annotation_rows(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """One row per defect object of the three accepted shapes: ``keep, image, place, defect``; other entries are left
    out, a text that isn't an object gives no row. S12. The last of several images with one stem is not chosen here;
    see ``last_by_stem``."""
    kept = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in by_bytes(b.column(len(keep))):
                for ix, row, token in objects_of(b.column(len(keep)).slice(i, j - i)):
                    im = Images(ix, row, token)
                    owner = pa.array(i + im.row[im.image])
                    named = im.name.take(pa.array(im.image))
                    numbers = [pa.array(v.astype(np.int32)) for v in (im.no[im.image], im.place)]
                    yield pa.RecordBatch.from_arrays([*(b.column(k).take(owner) for k in range(len(keep))), named, *numbers, ix.text(im.slot).cast(pa.string())], names=[*keep, "image", "image_no", "place", "text"])

    out = df.select(*keep, text_col).mapInArrow(run, f"{kept + ', ' if kept else ''}image string, image_no int, place int, text string")
    return out.select(*keep, "image", "image_no", "place", F.from_json("text", DEFECT, {"allowNonNumericNumbers": "true"}).alias("defect"))


def last_by_stem(rows: DataFrame, *keep: str) -> DataFrame:
    """Of images with equal stems (any case) within a record, the last one's defects. S12."""
    from litholake.functions.strings import device_key

    k = rows.withColumn("stem", device_key(F.col("image")))
    last = k.groupBy(*keep, "stem").agg(F.max("image_no").alias("image_no"))
    return k.join(last, [*keep, "stem", "image_no"], "left_semi")


def annotation_choice(reviewed: Column, automatic: Column, forced: str | None = None) -> tuple[Column, Column]:
    """(path, kind) of the annotation to use: reviewed, else automatic, else none; or one of them forced. S13."""
    if forced == "reviewed":
        return reviewed, F.when(reviewed.isNotNull(), "reviewed").otherwise("none")
    if forced == "automatic":
        return automatic, F.when(automatic.isNotNull(), "automatic").otherwise("none")
    return F.coalesce(reviewed, automatic), F.when(reviewed.isNotNull(), "reviewed").when(automatic.isNotNull(), "automatic").otherwise("none")


def _points(pairs: Column) -> Column:
    return F.transform(F.filter(pairs, lambda p: F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull()), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))


def defect_geometry(d: str = "defect") -> tuple[Column, Column]:
    """(points, kind) of a defect in microns: exact polygon, else box corners, else centre and size; ``none`` where there
    are fewer than three points or no area. S18, P8, P18, A23."""
    exact, corners = _points(F.col(f"{d}.polygon_gds")), _points(F.col(f"{d}.corners_gds"))
    c = [F.col(f"{d}.{n}") for n in ("center_x_um", "center_y_um", "width_um", "height_um")]
    legacy = F.when(c[0].isNotNull() & c[1].isNotNull() & c[2].isNotNull() & c[3].isNotNull(), geometry.centred_box(*c))
    ok = lambda p: p.isNotNull() & ~geometry.is_degenerate(p)
    pts = F.when(ok(exact), exact).when(ok(corners), corners).when(ok(legacy), legacy)
    return pts, F.when(ok(exact), "exact").when(ok(corners), "bbox").when(ok(legacy), "legacy").otherwise("none")


def load_totals(rows: DataFrame) -> DataFrame:
    """How many defects have which geometry. A23."""
    return rows.select(defect_geometry()[1].alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def to_gds_json(defects: DataFrame, key: str = "image") -> DataFrame:
    """One JSON text per image with its defects, best score first: the GDS-ready form. S14.

    One image's defects are a bounded list (the detector's own limit)."""
    cols = [c for c in defects.columns if c != key]
    d = defects.groupBy(key).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), F.struct(*cols).alias("d")))).alias("l"))
    return d.select(key, F.to_json(F.transform("l", lambda e: e["d"])).alias("json"))


def detector_json(defects: DataFrame, run: str) -> DataFrame:
    """One JSON text per run with summary and images. S14."""
    per = defects.groupBy(run, "image").agg(F.collect_list(F.struct("bbox_px", "polygon_px", "area_px", "score", "mean_score", "seam_overlap_frac", "reason")).alias("defects"))
    return per.groupBy(run).agg(F.to_json(F.struct(F.struct(F.count("*").alias("images"), F.sum(F.size("defects")).alias("defects")).alias("summary"), F.collect_list(F.struct("image", "defects")).alias("images"))).alias("json"))


def removal_text(report: DataFrame) -> DataFrame:
    """The removal report as fixed-width lines in order: ``ord, line``; undefined percentages read N/A. S18.

    ``report`` has depth, device, layer, original, remaining, removed, weighted_pct, mean_pct."""
    pct = F.coalesce(F.format_string("%.6f", F.col("weighted_pct")), F.lit("N/A"))
    row = F.when(F.col("depth") == 1, F.format_string("%-34s %15.3f %16.3f %14.3f %11s", F.substring(F.coalesce("device", F.lit("?")), 1, 34), "original", "remaining", "removed", pct))
    row = row.when(F.col("depth") == 2, F.format_string("    layer %-4s: original=%.3f um^2, final=%.3f um^2, removed=%.3f um^2 (%s)", F.col("layer").cast("string"), "original", "remaining", "removed", pct))
    row = row.otherwise(F.concat(F.lit("overall (area weighted): "), pct, F.lit(" %, mean of devices: "), F.coalesce(F.format_string("%.6f", F.col("mean_pct")), F.lit("N/A")), F.lit(" %")))
    return report.select((F.col("depth") == 0).cast("int").alias("last"), F.coalesce("device", F.lit("")).alias("device"), "depth", F.coalesce(F.col("layer").cast("int"), F.lit(-1)).alias("layer"), row.alias("line")).orderBy("last", "device", "depth", "layer")


def reviewed_summary(entries: DataFrame) -> DataFrame:
    """Counts and bounds of a reviewed wafer: cells, automatic and manual defects, design bounds. S20, A9."""
    from litholake.functions.strings import source_kind

    d = entries.select("wafer_id", "cell_row", "cell_col", F.explode_outer("defects").alias("d"))
    kind = F.when(F.col("d").isNotNull(), source_kind(F.col("d.source")))
    return d.groupBy("wafer_id").agg(F.countDistinct("cell_row", "cell_col").alias("cells"), F.count_if(kind == "automatic").alias("automatic"), F.count_if(kind == "manual").alias("manual"), F.min("d.center_x_um").alias("x0"), F.min("d.center_y_um").alias("y0"), F.max("d.center_x_um").alias("x1"), F.max("d.center_y_um").alias("y1"))


def model_cache(spark: SparkSession, folder: str, key_parts: list, build) -> DataFrame:
    """A stored model, reused only for the same inputs: the key is a hash of paths, times and parameters. S21, B8."""
    import hashlib

    jvm = spark.sparkContext._jvm
    path = f"{folder.rstrip('/')}/{hashlib.sha256(json.dumps(key_parts, sort_keys=True, default=str).encode()).hexdigest()}"
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
