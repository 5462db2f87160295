import json

import numpy as np
import pytest

from litholake.kernels import raster
from litholake.operators import extract

GRID = extract.Grid(60, 40, 0.1)


def canvas():
    y, x = np.mgrid[0:150, 0:230]
    return np.stack([100 + 60 * np.sin(x / 9), 110 + 50 * np.cos(y / 7), 90 + 0.3 * x + 0.2 * y], 2).clip(0, 255).astype(np.uint8)


def tiles(spark, skip=()):
    img, rows = canvas(), []
    for r in range(4):
        for c in range(4):
            x, y = round(c * 54), round(r * 36)
            part = img[y : y + 40, x : x + 60]
            if part.shape[:2] == (40, 60) and (c, r) not in skip:
                rows.append(("W", c, r, bytearray(raster.encode_png(part)), "extra"))
    return spark.createDataFrame(rows, "wafer_id string, tile_col int, tile_row int, content binary, corners string")


def corner(*p):
    return [{"x": float(x), "y": float(y)} for x, y in p]


CELLS = [("W", 1, 1, corner((20, 15), (99, 15), (99, 74), (20, 74))), ("W", 1, 2, corner((150, 90), (90, 130), (30, 60), (100, 20))), ("W", 9, 9, corner((900, 900), (950, 900), (950, 950), (900, 950))), ("W", 5, 5, None)]
SCHEMA = "wafer_id string, cell_row int, cell_col int, corners array<struct<x:double,y:double>>"


def test_tiles_of_cells(spark):
    got = extract.cell_tiles(spark.createDataFrame(CELLS[:1] + CELLS[3:], SCHEMA), GRID).select("tile_col", "tile_row").collect()
    assert sorted(map(tuple, got)) == [(c, r) for c in (0, 1) for r in (0, 1, 2)]


def test_crops_show_the_canvas(spark):
    cells = spark.createDataFrame(CELLS, SCHEMA)
    got = {(r.cell_row, r.cell_col): r for r in extract.extract_cells(cells, tiles(spark).unionByName(tiles(spark)), GRID, 80, 60).collect()}
    assert set(got) == {(1, 1), (1, 2)}
    plain = got[1, 1]
    assert np.abs(raster.decode_png(bytes(plain.crop_png)).astype(int) - canvas()[15:75, 20:100]).max() <= 2 and plain.covered == 1.0
    assert plain.crop_size_px == [80, 60] and [0, 0] in plain.overlapping_tiles and plain.error is None
    seam = raster.decode_png(bytes(plain.seam_png))[:, :, 0] > 0
    assert seam[30, 54 + 3 - 20] and not seam[10, 5]
    turned = raster.decode_png(bytes(got[1, 2].crop_png))
    assert np.abs(turned[0, 0].astype(int) - canvas()[90, 150]).max() <= 3 and np.abs(turned[59, 79].astype(int) - canvas()[60, 30]).max() <= 3


def test_missing_and_broken_tiles(spark):
    bad = spark.createDataFrame([("W", 0, 0, bytearray(b"\xff\xd8\xff\xe0"), "x")], "wafer_id string, tile_col int, tile_row int, content binary, corners string")
    got = extract.extract_cells(spark.createDataFrame(CELLS[:1], SCHEMA), tiles(spark, skip=((0, 0), (1, 1))).unionByName(bad), GRID, 80, 60).collect()
    assert len(got) == 1 and 0.2 < got[0].covered < 1 and got[0].error.startswith("0-0: JPEG")
    assert extract.extract_cells(spark.createDataFrame(CELLS[:1], SCHEMA), tiles(spark).limit(0), GRID, 80, 60).count() == 0


def test_artefacts_are_written(spark, tmp_path):
    cells = spark.createDataFrame([c[:3] + (c[3], [[0.0, 1.0]]) for c in CELLS[:1]], SCHEMA + ", gds_corners_um array<array<double>>")
    crops = extract.with_metadata(extract.extract_cells(cells, tiles(spark), GRID, 80, 60), cells)
    files = {r.file_kind: r for r in extract.write_crops(crops, str(tmp_path), 20).collect()}
    assert set(files) == {"analysis_png", "seam_mask", "preview", "metadata"}
    meta = json.load(open(files["metadata"].path))
    assert meta["cell_stem"] == "W_cell_1-1" and meta["crop_size_px"] == [80, 60] and meta["gds_corners_um"] == [[0.0, 1.0]]
    assert raster.decode_png(open(files["preview"].path, "rb").read()).shape[1] == 20 and files["analysis_png"].path.endswith("W/analysis_png/W_cell_1-1.png")


def test_reduced_decoding():
    png = raster.encode_png(canvas())
    assert extract.decode_reduced(png, 60).shape[:2] == (37, 57) and extract.decode_reduced(png, 120).shape[:2] == (75, 115) and extract.decode_reduced(png, 200).shape[:2] == (150, 230)
    with pytest.raises(ValueError, match="JPEG"):
        extract.decode_reduced(b"\xff\xd8\xff\xe0", 10)
