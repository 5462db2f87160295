"""From tiles to cell crops (L11, R3-R7, S6, S15): the plan finds the tiles of each cell by grid arithmetic, one grouped
kernel stitches and straightens a cell, and a writer stores the results.

A cell is covered by few tiles, whatever the size of the wafer, so the group of one cell is bounded by its size; cells are
independent of each other, and no wafer is ever stitched as a whole."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litholake.kernels import raster

JPEG = b"\xff\xd8\xff"


@dataclass(frozen=True)
class Grid:
    """Tiles of one size on a grid; neighbours overlap by a share of their size."""

    width: int
    height: int
    overlap: float = 0.1

    @property
    def step(self) -> tuple[float, float]:
        return self.width * (1 - self.overlap), self.height * (1 - self.overlap)


def decode_reduced(data: bytes, target_width: int) -> np.ndarray:
    """A PNG at about the wanted width: a quarter of the size where the target is at most 0.30 of it, half where at most
    0.60, else whole. S6. JPEG raises: there is no decoder for it here."""
    if data[:3] == JPEG:
        raise ValueError("JPEG images can't be decoded here")
    img = raster.decode_png(data)
    share = target_width / img.shape[1]
    k = 4 if share <= 0.30 else 2 if share <= 0.60 else 1
    h, w = img.shape[0] // k * k, img.shape[1] // k * k
    if k == 1 or not h or not w:
        return img
    return np.rint(img[:h, :w].reshape(h // k, k, w // k, k, 3).mean((1, 3))).astype(np.uint8)


def cell_tiles(cells: DataFrame, grid: Grid, pad: float = 0.0) -> DataFrame:
    """``cells`` (with ``corners``, the canvas pixels of the cell's four corners as structs x, y) with each tile position
    (``tile_col, tile_row``, from 0) that a cell's bounding box, widened by ``pad``, touches. No tiles are read. Cells
    without four corners get none."""
    sx, sy = grid.step
    lo = lambda c: F.array_min(F.transform("corners", lambda p: p[c])) - pad
    hi = lambda c: F.array_max(F.transform("corners", lambda p: p[c])) + pad
    whole = cells.filter((F.size("corners") == 4) & F.forall("corners", lambda p: p["x"].isNotNull() & p["y"].isNotNull()))
    first = lambda c, size, step: F.greatest(F.floor((lo(c) - size) / step) + 1, F.lit(0))
    span = lambda c, size, step: F.when(F.floor(hi(c) / step) >= first(c, size, step), F.sequence(first(c, size, step), F.floor(hi(c) / step)))
    return whole.withColumn("tile_col", F.explode(span("x", grid.width, sx))).withColumn("tile_row", F.explode(span("y", grid.height, sy)))


CROP = "wafer_id string, cell_row int, cell_col int, crop_png binary, seam_png binary, overlapping_tiles array<array<int>>, local_origin_px array<int>, canvas_corners_px array<array<double>>, crop_size_px array<int>, covered double, error string"


def extract_cells(cells: DataFrame, tiles: DataFrame, grid: Grid, width: int, height: int, pad: int = 8, level: float = 0.85, seam_share: float = 0.2) -> DataFrame:
    """One crop of ``width`` x ``height`` pixels for each cell (wafer_id, cell_row, cell_col, corners: top left, top right,
    bottom right, bottom left on the canvas) from tiles (wafer_id, tile_col, tile_row, content: PNG): ``CROP``.

    Tiles are levelled against each other, blended with ramps over their overlaps and straightened by the homography of
    the corners. ``seam_png`` marks where tiles overlap, widened by ``seam_share`` of the overlap; ``covered`` is the share of
    the crop that tiles cover. Positions without a tile stay black; a cell without any tile gives no row; of several tiles
    for one position the one with the largest content hash counts; a tile that can't be read is left out and named in
    ``error``. Extra columns play no part."""
    sx, sy = grid.step
    ox, oy = int(round(grid.width * grid.overlap)), int(round(grid.height * grid.overlap))
    once = tiles.filter(F.col("content").isNotNull()).groupBy("wafer_id", "tile_col", "tile_row").agg(F.max_by("content", F.xxhash64("content")).alias("content"))
    want = cell_tiles(cells.select("wafer_id", "cell_row", "cell_col", "corners"), grid, pad)
    flat = F.transform("corners", lambda p: F.array(p["x"].cast("double"), p["y"].cast("double")))
    rows = want.join(once, ["wafer_id", "tile_col", "tile_row"]).select("wafer_id", "cell_row", "cell_col", flat.alias("corners"), "tile_col", "tile_row", "content")

    def one(g: pd.DataFrame) -> pd.DataFrame:
        corners = np.array([list(p) for p in g["corners"].iloc[0]], float)
        x0, y0 = (np.floor(corners.min(0)) - pad).astype(int)
        w, h = (np.ceil(corners.max(0)) + pad + 1 - (x0, y0)).astype(int)
        placed, used, errors = [], [], []
        for col, row, data in sorted(zip(g["tile_col"], g["tile_row"], g["content"], strict=True), key=lambda t: (t[1], t[0])):
            try:
                if bytes(data[:3]) == JPEG:
                    raise ValueError("JPEG images can't be decoded here")
                img = raster.decode_png(bytes(data))
            except ValueError as e:
                errors.append(f"{col}-{row}: {e}")
                continue
            weight = raster.feather_weight(*img.shape[:2], ox, oy, col > 0, True, row > 0, True)
            placed.append((int(round(col * sx)) - x0, int(round(row * sy)) - y0, img, weight))
            used.append([int(col), int(row)])
        local, cover = raster.stitch(placed, int(h), int(w), level)
        target = np.array([[0, 0], [width - 1, 0], [width - 1, height - 1], [0, height - 1]], float)
        m = raster.homography(target, corners - (x0, y0))
        crop = raster.warp(local, m, height, width)
        seam = raster.warp((raster.seam_mask(cover, int(round(seam_share * min(ox, oy)))) * 255).astype(np.uint8), m, height, width)
        there = raster.warp((cover > 0).astype(np.uint8), m, height, width)
        key = g.iloc[0]
        return pd.DataFrame([(key["wafer_id"], key["cell_row"], key["cell_col"], raster.encode_png(crop), raster.encode_png(np.repeat(seam[:, :, None], 3, 2)), used, [int(x0), int(y0)], corners.tolist(), [width, height], float(there.mean()), "; ".join(errors) or None)], columns=[c.split()[0] for c in CROP.split(", ")])

    return rows.groupBy("wafer_id", "cell_row", "cell_col").applyInPandas(one, CROP)


def with_metadata(crops: DataFrame, cells: DataFrame, source: str = "native_physical_boundary") -> DataFrame:
    """Crops with ``cell_stem`` and ``metadata``, the JSON text that goes with the image; ``cells`` bring
    ``gds_corners_um`` (array of [x, y]). S15."""
    j = crops.join(cells.select("wafer_id", "cell_row", "cell_col", "gds_corners_um"), ["wafer_id", "cell_row", "cell_col"], "left")
    stem = F.concat(F.col("wafer_id"), F.lit("_cell_"), F.col("cell_row"), F.lit("-"), F.col("cell_col"))
    j = j.withColumns({"cell_stem": stem, "crop_source": F.lit(source), "analysis_png": F.concat(F.lit("analysis_png/"), stem, F.lit(".png"))})
    fields = ["wafer_id", "cell_row", "cell_col", "cell_stem", "crop_source", "gds_corners_um", "canvas_corners_px", "local_origin_px", "overlapping_tiles", "crop_size_px", "analysis_png"]
    return j.withColumn("metadata", F.to_json(F.struct(*fields)))


def write_crops(crops: DataFrame, folder: str, preview_width: int = 800) -> DataFrame:
    """Writes image, seam mask, preview and metadata of each crop (of ``with_metadata``) below ``folder``, a path that all
    executors share, in ``<wafer>/analysis_png``, ``seam_masks``, ``previews`` and ``metadata``: ``cell_stem, file_kind,
    path, size_bytes``. S15. Files are replaced whole, so a repeated task leaves the same files. Lazy: read the result."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                preview = raster.encode_png(raster.resize_max_width(raster.decode_png(bytes(r.crop_png)), preview_width))
                for kind, sub, end, data in (("analysis_png", "analysis_png", ".png", bytes(r.crop_png)), ("seam_mask", "seam_masks", "_seam.png", bytes(r.seam_png)), ("preview", "previews", ".png", preview), ("metadata", "metadata", ".json", json.dumps(json.loads(r.metadata), indent=2).encode())):
                    at = f"{root}/{r.wafer_id}/{sub}"
                    fs.create_dir(at, recursive=True)
                    with fs.open_output_stream(f"{at}/{r.cell_stem}{end}") as f:
                        f.write(data)
                    rows.append((r.cell_stem, kind, f"{at}/{r.cell_stem}{end}", len(data)))
            yield pd.DataFrame(rows, columns=["cell_stem", "file_kind", "path", "size_bytes"])

    return crops.select("wafer_id", "cell_stem", "crop_png", "seam_png", "metadata").mapInPandas(run, "cell_stem string, file_kind string, path string, size_bytes long")
