import numpy as np
import pytest

from litholake.kernels import borders, evidence, passes
from litholake.kernels import raster as r
from litholake.operators import detect


def stripes(h=240, w=260, pitch=8):
    rng = np.random.default_rng(0)
    base = 120 + 25 * np.sin(2 * np.pi * np.arange(w) / pitch)
    img = np.repeat((base[None, :] + rng.normal(0, 1.5, (h, w)))[:, :, None], 3, 2)
    return np.clip(img, 0, 255).astype(np.uint8)


def test_png_round_trip_and_errors():
    img = stripes(20, 31)
    assert (r.decode_png(r.encode_png(img)) == img).all()
    assert r.decode_png(r.encode_png(img[:, :, 0]), grey=True).shape == (20, 31)
    for bad in (b"", b"nothing", r.encode_png(img)[:60]):
        with pytest.raises(ValueError):
            r.decode_png(bad)


def test_lab_round_trip():
    img = np.random.default_rng(1).integers(0, 256, (16, 16, 3)).astype(np.uint8)
    assert np.abs(r.from_lab(r.to_lab(img)).astype(int) - img).max() <= 1


def test_labels_equal_flood_fill():
    m = np.random.default_rng(2).random((40, 50)) < 0.45
    labels, n = r.label(m)
    seen = np.zeros_like(m)
    count = 0
    for y, x in zip(*np.nonzero(m), strict=True):
        if seen[y, x]:
            continue
        count += 1
        stack, want = [(y, x)], labels[y, x]
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            assert labels[a, b] == want
            for u in range(max(a - 1, 0), min(a + 2, 40)):
                for v in range(max(b - 1, 0), min(b + 2, 50)):
                    if m[u, v] and not seen[u, v]:
                        seen[u, v] = True
                        stack.append((u, v))
    assert count == n == labels.max() and ((labels > 0) == m).all()
    assert r.label(np.zeros((3, 3), bool))[1] == 0


def test_morphology_and_growth():
    m = np.zeros((30, 30), bool)
    m[10:20, 10:20] = True
    m[5, 5] = True
    assert r.open_close(m, 1, 0).sum() >= 90 and not r.open_close(m, 1, 0)[5, 5]
    assert (r.geodesic(m & (np.indices(m.shape)[0] < 11), m, 50) == m).all()


def test_polygon_and_fill_agree():
    m = np.zeros((30, 40), bool)
    m[4:21, 6:31] = True
    labels, _ = r.label(m)
    poly = r.component_polygon(labels, 1, 6, 4, 25, 17)
    assert sorted(map(tuple, poly)) == [(6, 4), (6, 20), (30, 4), (30, 20)]
    assert np.abs(r.fill_polygon(np.array(poly, float), 30, 40).sum() - m.sum()) <= 25


def test_pitch_and_background():
    lab = r.to_lab(stripes(w=640, pitch=8))
    mask = evidence.interior_mask(240, 640, 10, 0.0)
    assert evidence.vertical_pitch(lab[:, :, 0], mask) == 8.0
    assert np.abs(evidence.residual_lab(lab, mask)[mask][:, 0]).mean() < 2.0


def test_stitch_weights_and_seams():
    tiles = [(0, 0, np.full((20, 30, 3), 100, np.uint8), r.feather_weight(20, 30, 6, 0, False, True, False, False)), (24, 0, np.full((20, 30, 3), 100, np.uint8), r.feather_weight(20, 30, 6, 0, True, False, False, False))]
    out, cover = r.stitch(tiles, 22, 54)
    assert (out[:20] == 100).all() and (out[20:] == 0).all() and (cover[0] == 2).sum() == 6
    assert r.seam_mask(cover, 1)[0].sum() == 8
    h = r.homography(np.array([[0, 0], [9, 0], [9, 9], [0, 9]]), np.array([[0, 0], [9, 0], [9, 9], [0, 9]]))
    img = np.arange(100, dtype=np.uint8).reshape(10, 10)
    assert (r.warp(img, h, 10, 10) == img).all()


def test_flat_field_and_template():
    ramp = np.linspace(0.7, 1.3, 60)[None, :] * np.full((60, 1), 100.0)
    f = r.flat_field([ramp, ramp * 0.8], 32)
    assert f[:, 2].mean() < 0.85 < 1.15 < f[:, -3].mean()
    lab = r.to_lab(stripes(80, 90))
    noisy = np.random.default_rng(3).normal(0, 20, (80, 90))
    assert r.shift_between(noisy, np.roll(noisy, (2, -3), (0, 1))) == (2, -3)
    med, mad = r.median_template([lab, lab, lab])
    assert np.allclose(med, lab) and np.allclose(mad, [1.8, 0.9, 0.9])


def test_detects_a_spot_and_nothing_on_clean_stripes(spark):
    clean = stripes()
    spot = clean.copy()
    y, x = np.ogrid[:240, :260]
    spot[(x - 130) ** 2 + (y - 120) ** 2 <= 81] = 25
    df = spark.createDataFrame([("clean", bytearray(r.encode_png(clean))), ("spot", bytearray(r.encode_png(spot))), ("bad", bytearray(b"xx")), ("null", None)], "image string, content binary")
    p = detect.Params(border_px=10)
    got = detect.detect(df, p).collect()
    assert [g.image for g in got] == ["spot"]
    bx, by, bw, bh = got[0].bbox_px
    assert abs(bx + bw / 2 - 130) <= 6 and abs(by + bh / 2 - 120) <= 6
    assert [c.image for c in detect.candidates(df, p).filter("error is not null").collect()] == ["bad"]


def test_cluster_regions_and_roi(spark):
    rows = [("i", [10 * k, 0, 5, 5], [[0, 0], [10, 10]], 25) for k in range(8)] + [("i", [900, 900, 5, 5], [], 25), ("j", [0, 0, 5, 5], None, 25)]
    d = spark.createDataFrame(rows, "image string, bbox_px array<int>, polygon_px array<array<int>>, area_px int")
    c = detect.cluster_regions(d).collect()
    assert [(x.image, x.n, x.corners, x.score) for x in c] == [("i", 8, [0, 0, 75, 5], 38.0)]
    full = detect.roi_to_full(d, spark.createDataFrame([("i", 100.0, 50.0, 2.0, 2.0)], "image string, ox double, oy double, sx double, sy double"))
    one = full.filter("image = 'i'").orderBy(full.bbox_px[0]).first()
    assert (one.bbox_px, one.polygon_px, one.area_px) == ([100, 50, 10, 10], [[100, 50], [120, 70]], 100)
    assert full.filter("image = 'j'").first().bbox_px == [0, 0, 5, 5]


def test_passes_add_spots_and_tidy():
    planes = {k: np.zeros((120, 140), np.float32) for k in ("large", "compact", "chroma_large", "dark_local", "dark", "chroma")}
    planes["dark_local"][50:53, 60:63] = 20
    planes["dark_local"][50, 80] = 15
    planes["chroma_large"][0:14, 30:60] = 9
    planes["chroma_large"][100:104, :] = 9
    found = passes.run(passes.USUAL[:3], planes, np.zeros((120, 140), bool), np.ones((120, 140), bool))
    spots = [int(m.sum()) for reason, m in found if reason == "kept_tiny_dark"]
    assert spots == [9, 1] and sum(m[5, 40] for _, m in found) == 1
    ring = np.zeros((20, 20), bool)
    ring[4:12, 4:12] = True
    ring[7, 7] = False
    assert passes.fill_holes(ring, 5)[7, 7] and not passes.fill_holes(ring, 0)[7, 7]
    a, b, c = (np.zeros((30, 30), bool) for _ in range(3))
    a[2:10, 2:10] = b[3:5, 3:5] = c[2:10, 12:15] = True
    merged = passes.merge_adjacent([("kept", a), ("spot", b), ("edge", c)])
    assert [x[0] for x in merged] == ["kept+edge"]


def test_border_is_found_and_rectified():
    rng = np.random.default_rng(4)
    img = np.full((300, 320, 3), 60.0)
    img[60:240, 70:250] = 130 + 40 * ((np.arange(180) // 4) % 2)[None, :, None]
    img = np.clip(img + rng.normal(0, 2, img.shape), 0, 255).astype(np.uint8)
    got = borders.rectify(img, np.array([[76, 66], [244, 64], [245, 234], [75, 236]], float))
    assert got["success"] and np.abs(got["corners"] - np.array([[70, 60], [249, 60], [249, 239], [70, 239]])).max() <= 4
    blank = borders.rectify(np.full((300, 320, 3), 90, np.uint8), np.array([[76, 66], [244, 64], [245, 234], [75, 236]], float))
    assert not blank["success"] and blank["image"].shape[2] == 3


def test_wafer_circle_squares_and_pose():
    y, x = np.ogrid[:200, :220]
    disc = np.where((x - 110) ** 2 + (y - 95) ** 2 <= 80**2, 200, 20).astype(np.uint8)
    cx, cy, rad = borders.wafer_circle(disc)
    assert abs(cx - 110) < 1 and abs(cy - 95) < 1 and abs(rad - 80) < 1.5
    grey = np.full((120, 120), 40, np.uint8)
    for k in range(3):
        grey[30:40, 20 + 30 * k : 30 + 30 * k] = 220
    t = borders.bright_squares(grey, 10)
    assert np.allclose(sorted(t["cx"]), [24.5, 54.5, 84.5], atol=1.0)
    square = np.zeros((101, 101), np.uint8)
    square[28:69, 34:75] = 200
    edge = np.array([(i, s) for i in range(-20, 21, 2) for s in (-20.5, 20.5)] + [(s, i) for i in range(-20, 21, 2) for s in (-20.5, 20.5)])
    pose = borders.best_pose(square, edge, np.radians(np.arange(-6, 7, 3)), np.array([0.8, 1.0, 1.2]))
    assert abs(pose["x"] - 54) <= 1.5 and abs(pose["y"] - 48) <= 1.5 and pose["scale"] == 1.0 and abs(pose["angle"]) < 0.06


def test_reject_reasons_in_order(spark):
    base = {"height": 1000, "width": 1000, "x": 300, "y": 400, "w": 40, "h": 40, "area_px": 1200, "angle": 10.0, "score": 12.0, "seam_frac": 0.0, "error": None, "large": 0.0, "compact": 12.0, "chroma_large": 0.0, "dark_local": 0.0, "dark": 0.0, "chroma": 0.0, "forced": 0.0}
    cases = {None: {}, "unreadable": {"error": "x"}, "small": {"area_px": 5}, "large": {"area_px": 300_000, "w": 600, "h": 600}, "weak": {"score": 8.0}, "line": {"w": 4, "h": 60, "area_px": 200, "angle": 90.0}, "sparse": {"w": 90, "h": 90, "score": 9.0, "compact": 9.0}, "frame": {"x": 10, "w": 20, "h": 20, "area_px": 300}, "frame_small": {"y": 20, "score": 30.0}, "corner": {"x": 20, "y": 100, "w": 30, "h": 30, "area_px": 500, "score": 30.0}, "target": {"x": 480, "y": 870}, "seam": {"seam_frac": 0.9, "w": 20, "h": 150, "score": 9.0, "angle": 0.0, "compact": 12.0}}
    schema = ", ".join(f"{k} {'string' if k in ('want', 'error') else 'int' if k in ('height', 'width', 'x', 'y', 'w', 'h', 'area_px') else 'double'}" for k in ("want", *base))
    df = spark.createDataFrame([(want, *(base | c).values()) for want, c in cases.items()], schema)
    assert [(r.want, r.got) for r in df.select("want", detect.reject_reason().alias("got")).collect()] == [(k, k) for k in cases]


def test_seam_rule_at_its_limits(spark):
    base = {"height": 1000, "width": 1000, "x": 300, "y": 400, "w": 20, "h": 140, "area_px": 2000, "angle": 0.0, "score": 10.0, "seam_frac": 0.55, "error": None, "large": 0.0, "compact": 12.0, "chroma_large": 0.0, "dark_local": 0.0, "dark": 0.0, "chroma": 0.0, "forced": 0.0}
    cases = [("seam", {}), (None, {"seam_frac": 0.54}), (None, {"h": 139}), (None, {"score": 10.05}), ("seam", {"score": 10.04})]
    schema = ", ".join(f"{k} {'string' if k in ('want', 'error') else 'int' if k in ('height', 'width', 'x', 'y', 'w', 'h', 'area_px') else 'double'}" for k in ("want", *base))
    df = spark.createDataFrame([(want, *(base | c).values()) for want, c in cases], schema)
    assert [r.got for r in df.select(detect.reject_reason().alias("got")).collect()] == [w for w, _ in cases]


def test_colours_force_scores_and_the_frame_is_left_out():
    base = np.zeros((300, 400, 3), np.uint8)
    base[:] = (150, 90, 80)
    blob, big, frame = base.copy(), base.copy(), base.copy()
    blob[140:160, 180:204] = (40, 160, 200)
    big[60:240, 80:330] = (40, 190, 220)
    frame[:20] = frame[:, :20] = (40, 190, 220)
    inner = evidence.interior_mask(300, 400, 10, 0.0)
    score = lambda img, **k: evidence.defect_score(img, inner, **k)[0]
    assert score(blob)[150, 190] >= 11.5 and evidence.blobs(blob).sum() > 300 and not evidence.stain(blob).any()
    assert evidence.stain(big)[150, 200] and score(big)[150, 200] >= 13.0
    assert not evidence.interior_mask(300, 400, 10, 0.0, frame)[24, 200] and evidence.interior_mask(300, 400, 10, 0.0, frame)[40, 200]
    line = base.copy()
    line[20:280, 200:204] = (40, 160, 200)
    assert not evidence.blobs(line).any()


def test_template_promotes_and_outlines_weaken(spark):
    img = stripes()
    lab = r.to_lab(img)
    odd = img.copy()
    odd[110:116, 120:126] = np.clip(odd[110:116, 120:126].astype(int) + 22, 0, 255)
    mask = evidence.interior_mask(*img.shape[:2], 10, 0.0)
    template = r.median_template([lab, lab, lab])
    plain, _ = evidence.defect_score(odd, mask)
    more, _ = evidence.defect_score(odd, mask, template)
    assert more[113, 123] >= plain[113, 123] and more.max() <= max(18.0, plain.max())
    design = np.ones(img.shape[:2], bool)
    design[:, 123:] = False
    cut, _ = evidence.defect_score(odd, mask, template, design)
    assert (cut[:, 123:] == 0).all() and (cut <= more + 1e-6).all() and cut[113, 122] < more[113, 122] + 1e-6
    frame = spark.createDataFrame([(f"i{k}", bytearray(r.encode_png(img))) for k in range(3)], "image string, content binary")
    got = detect.template_of(frame)
    assert np.allclose(got[0], template[0]) and detect.template_of(frame.limit(0)) is None
    assert detect.detect(frame, detect.Params(border_px=10), template=got).count() == 0


def test_a_field_of_dust_is_no_region(spark):
    schema = "image string, bbox_px array<int>, reason string"
    row = lambda image, k, reason: (image, [10 * k, 0, 5, 5], reason)
    dust = [row("dust", k, "kept_sparse_particle") for k in range(9)]
    smear = [row("smear", k, r) for k, r in enumerate(["kept", "kept_tiny_dark", "kept_tiny_dark", "kept_salient_spot+kept_tiny_dark", "kept_tiny_dark", "kept_sparse_particle", "kept_sparse_particle"])]
    thin = [row("thin", k, "kept" if k == 0 else "kept_tiny_dark") for k in range(8)]
    assert [(r.image, r.n) for r in detect.cluster_regions(spark.createDataFrame(dust + smear + thin, schema)).collect()] == [("smear", 7)]


def test_crowded_spots_bring_their_region(spark):
    img = stripes(340, 520)  # spots far enough apart not to be one component
    y, x = np.ogrid[:340, :520]
    for k in range(10):
        img[(x - (80 + 90 * (k % 5))) ** 2 + (y - (110 + 110 * (k // 5))) ** 2 <= 64] = 25
    df = spark.createDataFrame([("i", bytearray(r.encode_png(img)))], "image string, content binary")
    got = detect.detect(df, detect.Params(border_px=10), passes=()).collect()
    regions = [g for g in got if g.reason == "cluster_region"]
    assert len(got) - len(regions) >= 7 and len(regions) == 1
    assert regions[0].bbox_px[2] >= 180 and regions[0].score == min(65, 22 + 2.0 * (len(got) - 1))
