"""Cell inference from regular fingers, and the clean-up of hanging grid pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litholake.functions.robust import gap_pitch
from litholake.operators.graph import connected_components, spanning, touching_boxes
from litholake.session import materialise


def infer_cells(boxes: DataFrame, reference_layer: int) -> DataFrame:
    """``cell_row, cell_col, cx, cy, lines, wx0, wy0, wx1, wy1`` from boxes (element_index, layer, x0, y0, x1, y1).

    Fingers are the boxes of the reference layer with its modal width and modal height (the one seen first among equals)
    if higher than wide. They are grouped to rows by their exact y extent, split into cells where the distance of centres
    exceeds three times the row's modal distance, and each cell's window is centred with the median pitches. Raises where
    the layer has fewer than four fingers. Null boxes are left out."""
    ref = materialise(boxes.filter(F.col("layer") == reference_layer).dropna(subset=["x0", "y0", "x1", "y1"]).select("element_index", "x0", "y0", "x1", "y1", (F.col("x1") - F.col("x0")).alias("w"), (F.col("y1") - F.col("y0")).alias("h")), "reference-layer")

    def mode(c: str):
        return ref.groupBy(c).agg(F.count("*").alias("n"), F.min("element_index").alias("seen")).agg(F.max_by(c, F.struct("n", -F.col("seen"))).alias(c))

    f = ref.join(F.broadcast(mode("w")), "w").join(F.broadcast(mode("h")), "h").filter("h > w")  # one row each
    if f.limit(4).count() < 4:
        raise ValueError(f"layer {reference_layer} has too few regular vertical fingers")
    f = f.withColumn("c", (F.col("x0") + F.col("x1")) / 2)
    row = Window.partitionBy("y0", "y1").orderBy("c", "element_index")
    g = f.withColumn("gap", F.col("c") - F.lag("c").over(row)).withColumn("k", F.row_number().over(row))
    pitch = g.filter("gap > 0").groupBy("y0", "y1", F.bround("gap").alias("p")).agg(F.count("*").alias("n"), F.min("k").alias("seen")).groupBy("y0", "y1").agg(F.max_by("p", F.struct("n", -F.col("seen"))).alias("finger_pitch"))
    g = g.join(pitch, ["y0", "y1"], "left").withColumn("new", F.coalesce((F.col("gap") > 3 * F.col("finger_pitch")).cast("int"), F.lit(0)))
    g = g.withColumn("cell_col", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    cells = g.groupBy("y0", "y1", "cell_col").agg(((F.min("c") + F.max("c")) / 2).alias("cx"), F.count("*").alias("lines")).withColumn("cy", (F.col("y0") + F.col("y1")) / 2)
    cells = cells.withColumn("cell_row", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("y0", "y1")))  # a few rows of cells
    cells = materialise(cells, "cells")
    pitches = gap_pitch(cells.select(F.lit("x").alias("axis"), F.col("cx").alias("v")).unionByName(cells.select(F.lit("y").alias("axis"), F.col("cy").alias("v"))), ["axis"], "v").groupBy().pivot("axis", ["x", "y"]).agg(F.first("pitch"))
    w = cells.join(F.broadcast(pitches))  # one row
    return w.select("cell_row", "cell_col", "cx", "cy", "lines", F.col("x").alias("x_pitch"), F.col("y").alias("y_pitch"), (F.col("cx") - F.col("x") / 2).alias("wx0"), (F.col("cy") - F.col("y") / 2).alias("wy0"), (F.col("cx") + F.col("x") / 2).alias("wx1"), (F.col("cy") + F.col("y") / 2).alias("wy1"))


def assign_to_cells(boxes: DataFrame, cells: DataFrame) -> DataFrame:
    """Boxes with the one cell whose half-open window holds their centre; larger than 1.2 pitches, in none or in several:
    ``outside``. J7, P11. The window's grid cell is the join key."""
    p = cells.agg(F.max("x_pitch").alias("x_pitch"), F.max("y_pitch").alias("y_pitch"))
    b = boxes.withColumns({"mx": (F.col("x0") + F.col("x1")) / 2, "my": (F.col("y0") + F.col("y1")) / 2}).join(F.broadcast(p))  # one row
    big = (F.col("x1") - F.col("x0") > 1.2 * F.col("x_pitch")) | (F.col("y1") - F.col("y0") > 1.2 * F.col("y_pitch"))
    b = b.withColumns({"big": big, "gx": F.floor(F.col("mx") / F.col("x_pitch")), "gy": F.floor(F.col("my") / F.col("y_pitch"))})
    c = cells.select("cell_row", "cell_col", "wx0", "wy0", "wx1", "wy1", F.explode(F.sequence(F.floor(F.col("wx0") / F.col("x_pitch")), F.floor(F.col("wx1") / F.col("x_pitch")))).alias("gx"), F.col("y_pitch").alias("yp"))
    c = c.withColumn("gy", F.explode(F.sequence(F.floor(F.col("wy0") / F.col("yp")), F.floor(F.col("wy1") / F.col("yp"))))).drop("yp")
    m = b.filter("not big").join(c, ["gx", "gy"]).filter("mx >= wx0 and mx < wx1 and my >= wy0 and my < wy1")
    one = m.groupBy("element_index").agg(F.count("*").alias("matches"), F.first(F.struct("cell_row", "cell_col", "wx0", "wx1")).alias("c")).filter("matches = 1")
    return boxes.join(one, "element_index", "left").select(*boxes.columns, F.col("c.cell_row").alias("cell_row"), F.col("c.cell_col").alias("cell_col"), F.col("c.wx0").alias("wx0"), F.col("c.wx1").alias("wx1"), F.col("c").isNull().alias("outside"))


def hanging_pieces(boxes: DataFrame, cells: DataFrame, target_layer: int, span: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """Elements of the target layer to be removed, and the report per cell. I1, I2.

    Within each cell touching boxes form components; those that don't span the window are removed, unless none does, in
    which case the widest stays. Touching is decided on bounding boxes, exact for the axis-parallel pieces of a grid."""
    target = materialise(assign_to_cells(boxes.filter(F.col("layer") == target_layer), cells), "assigned")
    inside = target.filter("not outside")
    width = cells.agg(F.max("x_pitch")).first()[0] or 1.0
    comp = connected_components(inside, touching_boxes(inside, "element_index", float(width) / 8, ["cell_row", "cell_col"]), "element_index", "a", "b")
    members = materialise(inside.join(comp, "element_index"), "members")
    verdict = spanning(members, "component", ["cell_row", "cell_col"], "x0", "x1", "wx0", "wx1", span)
    removed = members.join(verdict.filter("not keep").select("cell_row", "cell_col", "component"), ["cell_row", "cell_col", "component"]).select("element_index")
    report = verdict.groupBy("cell_row", "cell_col").agg(F.sum("parts").alias("target_boundaries"), F.count("*").alias("components"), F.sum(F.when(~F.col("keep"), F.col("parts")).otherwise(0)).alias("removed"), F.count_if("keep").alias("kept_components"), (~F.max("spans")).alias("fallback_used"))
    return removed, report


def finger_or_border(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """``boxes`` (x0, y0, x1, y1) with ``kind``: ``finger`` where narrower than 1.5 times the group's median width and higher
    than wide, else ``border``; null boxes get null. P9."""
    w = F.col("x1") - F.col("x0")
    usual = boxes.groupBy(*keys).agg(F.median(w).alias("__usual"))
    kind = F.when(w.isNull() | (F.col("y1") - F.col("y0")).isNull(), None).when((w < 1.5 * F.col("__usual")) & (F.col("y1") - F.col("y0") > w), "finger").otherwise("border")
    return boxes.join(usual, keys, "left").withColumn("kind", kind).drop("__usual")


def cleanup_json(removed: DataFrame, report: DataFrame) -> DataFrame:
    """The clean-up report as one JSON text for each cell: its counts, and the removed elements in order. S19. A row per
    cell, so nothing grows beyond what one cell holds; null cells are reported under null."""
    gone = removed.groupBy("cell_row", "cell_col").agg(F.sort_array(F.collect_list("element_index")).alias("removed_elements"))
    on = ["cell_row", "cell_col"]
    j = report.join(gone, on, "left").withColumn("removed_elements", F.coalesce("removed_elements", F.array().cast("array<long>")))
    return j.select(*on, F.to_json(F.struct(*[c for c in j.columns])).alias("report"))
