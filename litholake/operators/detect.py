"""Detection on crops (D0-D15, P3, R14): one grouped kernel per image, the filter cascade as column expressions.

The kernel turns an image into candidate components with the peaks of their evidence planes. Every rule that accepts,
rejects or merges them afterwards is relational, so the cascade's order can be read, tested and changed without touching
pixels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litholake.kernels import passes as kernel_passes
from litholake.kernels import evidence, raster
from litholake.operators.greedy import suppress_duplicates
from litholake.operators.rollup import first_reason
from litholake.session import materialise


@dataclass(frozen=True)
class Params:
    """Defaults of the detector's command line."""

    threshold: float = 8.8
    min_score: float = 8.8
    min_area: int = 18
    max_area_frac: float = 0.22
    border_px: int = 42
    border_frac: float = 0.015
    open_radius: int = 1
    close_radius: int = 5
    max_width: int = 3000
    seam_reject: float = 0.55
    seam_aspect: float = 7.0
    seam_margin: float = 1.25
    duplicate_share: float = 0.7


PEAKS = ("large", "compact", "chroma_large", "dark_local", "dark", "chroma", "forced")
SCHEMA = "image string, height int, width int, x int, y int, w int, h int, area_px int, angle double, score double, mean_score double, seam_frac double, design_frac double, polygon_px array<array<int>>, reason string, error string, " + ", ".join(f"{p} double" for p in PEAKS)


def candidates(images: DataFrame, params: Params = Params(), passes: tuple = (), image_col: str = "image", content_col: str = "content", seam_col: str | None = None, design_col: str | None = None, template: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Components above the threshold of each image (PNG bytes), with their evidence. Optional masks (PNG, any grey above
    0) mark seams and the design: candidates outside the design score nothing, weak ones on its outlines less. ``template``
    (of ``template_of``: one image's size) adds differences from the usual image, for images of its size. An image that can't be read gives one row
    with ``error``; an image without candidates gives none; null images are skipped."""

    known = images.sparkSession.sparkContext.broadcast(template) if template is not None else None

    def one(name: str, data: bytes, seam: bytes | None, design: bytes | None) -> list[tuple]:
        img = raster.decode_png(bytes(data))
        full_h, full_w = img.shape[:2]
        img = raster.resize_max_width(img, params.max_width)
        h, w = img.shape[:2]
        mask = evidence.interior_mask(h, w, params.border_px, params.border_frac, img)
        masks = [raster.resize(raster.decode_png(bytes(m), grey=True), h, w) > 0 if m is not None else None for m in (seam, design)]
        usual = known.value if known is not None else None
        fits = usual is not None and usual[0].shape[:2] == (h, w)
        score, planes = evidence.defect_score(img, mask, usual if fits else None, masks[1])
        labels, n = raster.label(raster.open_close(score >= params.threshold, params.open_radius, params.close_radius))
        reasons = ["kept"] * n
        if passes:  # later passes see what the base has taken; touching masks become one, with their reasons joined
            found = [("kept", labels == k) for k in range(1, n + 1)]
            found += kernel_passes.run(passes, planes, labels > 0, mask if masks[1] is None else mask & masks[1])
            found = kernel_passes.merge_adjacent([(r, kernel_passes.tidy(m) & mask) for r, m in found])
            labels, reasons = np.zeros((h, w), np.int32), [r for r, _ in found]
            for k, (_, m) in enumerate(found, 1):
                labels[m & (labels == 0)] = k
            n = len(found)
        if not n:
            return []
        t = raster.component_table(labels, n, {"score": score, "seam": np.zeros((h, w)) if masks[0] is None else masks[0].astype(float), "design": np.ones((h, w)) if masks[1] is None else masks[1].astype(float), **planes})
        sx, sy = full_w / w, full_h / h
        out = []
        for k in np.flatnonzero(t["area"] >= params.min_area):
            x, y, cw, ch = (int(t[c][k]) for c in ("x0", "y0", "w", "h"))
            poly = [[int(round(px * sx)), int(round(py * sy))] for px, py in raster.component_polygon(labels, k + 1, x, y, cw, ch)]
            out.append((name, full_h, full_w, int(round(x * sx)), int(round(y * sy)), max(1, int(round(cw * sx))), max(1, int(round(ch * sy))), int(round(t["area"][k] * sx * sy)), None if np.isnan(t["angle"][k]) else float(t["angle"][k]), round(float(t["score_max"][k]), 3), round(float(t["score_mean"][k]), 3), round(float(t["seam_mean"][k]), 3), float(t["design_mean"][k]), poly, reasons[k], None, *(float(t[f"{p}_{'mean' if p == 'forced' else 'max'}"][k]) for p in PEAKS)))
        return out

    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False, name=None):
                try:
                    rows = one(*r)
                except ValueError as e:
                    rows = [(r[0], *[None] * 14, str(e), *[None] * len(PEAKS))]
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    none = F.lit(None).cast("binary")
    picked = images.filter(F.col(content_col).isNotNull()).select(F.col(image_col), F.col(content_col), F.col(seam_col) if seam_col else none.alias("seam"), F.col(design_col) if design_col else none.alias("design"))
    return picked.mapInPandas(run, SCHEMA)


def template_of(images: DataFrame, most: int = 15, max_width: int = 3000, image_col: str = "image", content_col: str = "content") -> tuple[np.ndarray, np.ndarray] | None:
    """Median and spread (Lab) of the ``most`` images with the smallest names, those of the first one's size; a documented
    sample, since a median of images needs no more. None without images. A18."""
    rows = images.filter(F.col(content_col).isNotNull()).orderBy(image_col).select(content_col).limit(most).collect()
    labs = [raster.to_lab(raster.resize_max_width(raster.decode_png(bytes(r[0])), max_width)) for r in rows]
    return raster.median_template([x for x in labs if x.shape == labs[0].shape]) if labs else None


def reject_reason(p: Params = Params()) -> Column:
    """Name of the first rule that rejects a candidate, null for a kept one. P3, D1, D11, D13.

    Skinny near-vertical pieces are rests of the regular lines; small pieces on the frame are crop artefacts; long pieces
    on a seam are stitching artefacts. Strong evidence that lines don't produce overrides the first group."""
    side = F.least("height", "width")
    margin = F.greatest(F.lit(60.0), F.round(0.08 * side))
    pixels = F.col("height").cast("double") * F.col("width")
    aspect = F.greatest(F.col("w") / F.col("h"), F.col("h") / F.col("w"))
    fill = F.col("area_px") / (F.col("w") * F.col("h"))
    forced = F.col("forced") >= 0.04
    thin = (F.col("w") <= F.greatest(F.lit(5.0), 0.0065 * F.col("width"))) & (F.col("h") >= F.greatest(F.lit(14.0), 2.2 * F.col("w")))
    line = thin | ((aspect > 8) & (fill < 0.65))
    vertical = thin | (F.abs(F.coalesce(F.col("angle"), F.lit(0.0)) - 90) <= 18)
    strong = forced | (F.col("chroma_large") >= p.min_score + 1.2) | (F.col("dark_local") >= p.min_score + 2) | (F.col("dark") >= p.min_score + 4) | (F.col("large") >= p.min_score + 2.5)
    at_x = (F.col("x") <= margin) | (F.col("x") + F.col("w") >= F.col("width") - margin)
    at_y = (F.col("y") <= margin) | (F.col("y") + F.col("h") >= F.col("height") - margin)
    corner_y = (F.col("y") <= F.floor(1.6 * margin)) | (F.col("y") + F.col("h") >= F.col("height") - F.floor(1.6 * margin))
    low = F.col("score")
    # the registration target of every crop: small, at the bottom centre, neither dark nor reaching the edge
    at_bottom_centre = ((F.col("x") + F.col("w") / 2) / F.col("width")).between(0.425, 0.575) & (F.col("y") + F.col("h") / 2 >= 0.865 * F.col("height")) & (F.col("w") * F.col("h") < 0.014 * pixels)
    return first_reason(
        ("unreadable", F.col("error").isNotNull()),
        ("small", F.col("area_px") < p.min_area),
        ("large", (F.col("area_px") > p.max_area_frac * pixels) & ~forced),
        ("weak", low < p.min_score),
        ("line", vertical & line & ~strong),
        ("tick", thin & (F.col("area_px") < F.greatest(F.lit(180.0), 0.0001 * pixels)) & (F.col("chroma") < p.min_score + 2) & (F.col("dark_local") < p.min_score + 2.5)),
        ("sparse", (fill < 0.22) & (low < p.min_score + 1) & (F.col("compact") < p.min_score + 1) & ~forced),
        ("frame", (at_x | at_y) & (line | (F.col("area_px") < F.greatest(F.lit(260.0), 0.00045 * pixels)) | ((aspect > 5) & (fill < 0.55))) & ~forced & (low < p.min_score + 14)),
        ("frame_small", at_y & (F.col("area_px") < F.greatest(F.lit(1500.0), 0.003 * pixels))),
        ("corner", (at_x & corner_y) & (F.col("area_px") < F.greatest(F.lit(650.0), 0.0012 * pixels))),
        ("target", at_bottom_centre & ~forced & (F.col("dark_local") < p.min_score + 2) & (F.col("y") + F.col("h") < F.col("height") - 3)),
        ("seam", (F.col("seam_frac") >= p.seam_reject) & ((aspect >= p.seam_aspect) | ((F.col("h") > 0.45 * F.col("height")) & (F.col("w") < 0.08 * F.col("width")))) & (low < p.min_score + p.seam_margin)),
    )


def detect(images: DataFrame, params: Params = Params(), passes: tuple = kernel_passes.USUAL, clusters: bool = True, **columns) -> DataFrame:
    """Kept components of each image: box, polygon, area, scores, ``reason``. Duplicates of better boxes are dropped.
    ``passes``: what follows the base components; an empty tuple leaves those alone. ``clusters`` adds the regions in which
    components crowd (D12), for which the components are written to the shared folder once."""
    c = candidates(images, params, passes, **columns)
    kept = c.withColumn("reject", reject_reason(params)).filter("reject is null").drop("reject")
    b = kept.withColumns({"x0": F.col("x"), "y0": F.col("y"), "x1": F.col("x") + F.col("w"), "y1": F.col("y") + F.col("h"), "ord": F.xxhash64("x", "y", "w", "h")})
    best = suppress_duplicates(b, ["image"], "score", "area_px", "ord", params.duplicate_share)
    found = best.select("image", F.array("x", "y", "w", "h").alias("bbox_px"), "polygon_px", "area_px", "score", "mean_score", F.col("seam_frac").alias("seam_overlap_frac"), "reason")
    if not clusters:
        return found
    found = materialise(found, "components")
    c = lambda i: F.get("corners", F.lit(i))
    outline = F.array(F.array(c(0), c(1)), F.array(c(2), c(1)), F.array(c(2), c(3)), F.array(c(0), c(3)))
    w, h = c(2) - c(0), c(3) - c(1)
    regions = cluster_regions(found).select("image", F.array(c(0), c(1), w, h).alias("bbox_px"), outline.alias("polygon_px"), (w * h).alias("area_px"), "score", F.col("score").alias("mean_score"), F.lit(0.0).alias("seam_overlap_frac"), F.lit("cluster_region").alias("reason"))
    return found.unionByName(regions)


def cluster_regions(defects: DataFrame, reach: float = 120.0, least: int = 7, others: int = 5, core: int = 2) -> DataFrame:
    """Regions of at least ``least`` components whose boxes lie within ``reach`` of each other: box and score
    min(65, 22 + 2 n). D12. Components of boxes grown by half the reach, through the graph operator.

    Where the components bring a ``reason``, at least ``others`` of them must come from other passes than that of sparse
    particles, and at least ``core`` from the base, the material or the salient passes: a field of dust is no region."""
    from litholake.operators.graph import connected_components, touching_boxes

    if "reason" not in defects.columns:
        defects, others, core = defects.withColumn("reason", F.lit("kept")), 0, 0
    b = lambda i: F.get("bbox_px", F.lit(i))
    d = defects.withColumn("id", F.pmod(F.xxhash64("image", "bbox_px"), F.lit(1 << 62)))
    parts = F.split(F.coalesce("reason", F.lit("")), r"\+")
    d = d.withColumns({"sparse": F.array_contains(parts, "kept_sparse_particle"), "solid": F.exists(parts, lambda r: (r == "kept") | r.rlike("material|salient"))})
    g = d.select("image", "id", "sparse", "solid", (b(0) - reach / 2).alias("x0"), (b(1) - reach / 2).alias("y0"), (b(0) + b(2) + reach / 2).alias("x1"), (b(1) + b(3) + reach / 2).alias("y1"))
    comp = connected_components(g, touching_boxes(g, "id", 4 * reach, ["image"]), "id", "a", "b")
    m = g.join(comp, "id").groupBy("image", "component").agg(F.count("*").alias("n"), F.count_if(~F.col("sparse")).alias("dense"), F.count_if("solid").alias("solid"), *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    return m.filter((F.col("n") >= least) & (F.col("dense") >= others) & (F.col("solid") >= core)).select("image", "n", F.array(*[F.round(F.col(c) + s * reach / 2).cast("int") for c, s in (("x0", 1), ("y0", 1), ("x1", -1), ("y1", -1))]).alias("corners"), F.least(F.lit(65.0), 22 + 2.0 * F.col("n")).alias("score"))


def roi_to_full(defects: DataFrame, rois: DataFrame) -> DataFrame:
    """Results of a cropped analysis region in the pixels of the whole crop: offset and scale per image
    (image, ox, oy, sx, sy), boxes at least one pixel wide. R14. Images without a region stay as they are."""
    j = defects.join(rois, "image", "left")
    ox, oy, sx, sy = (F.coalesce(F.col(c), F.lit(v)) for c, v in (("ox", 0.0), ("oy", 0.0), ("sx", 1.0), ("sy", 1.0)))
    b = lambda i: F.get("bbox_px", F.lit(i))
    box = F.array(F.bround(ox + b(0) * sx).cast("int"), F.bround(oy + b(1) * sy).cast("int"), F.greatest(F.lit(1), F.bround(b(2) * sx).cast("int")), F.greatest(F.lit(1), F.bround(b(3) * sy).cast("int")))
    poly = F.transform("polygon_px", lambda p: F.array(F.bround(ox + F.get(p, F.lit(0)) * sx).cast("int"), F.bround(oy + F.get(p, F.lit(1)) * sy).cast("int")))
    return j.withColumn("bbox_px", box).withColumn("polygon_px", poly).withColumn("area_px", F.bround(F.col("area_px") * sx * sy).cast("int")).select(*defects.columns)
