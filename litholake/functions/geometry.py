"""Geometry scalars on arrays of points (A16, A21, F4-F7, J11, P8, P10, P15, G4) and frame transforms.

Points are structs ``x, y``; polygons are arrays of them in order, open or closed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _next(pts: Column) -> Column:
    """The ring shifted by one: each point's successor."""
    return F.concat(F.slice(pts, F.lit(2), F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, F.lit(1), F.least(F.size(pts), F.lit(1))))


def _d(c: Column) -> Column:
    return c.cast("double")


def signed_area(pts: Column) -> Column:
    """Shoelace area, positive for counter-clockwise; null for null, 0 for fewer than three points. A16."""
    terms = F.zip_with(pts, _next(pts), lambda a, b: _d(a["x"]) * _d(b["y"]) - _d(a["y"]) * _d(b["x"]))
    return F.when(F.size(pts) >= 3, F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2).when(pts.isNotNull(), F.lit(0.0))


def is_degenerate(pts: Column) -> Column:
    """Fewer than three points or no area to speak of. P8."""
    return (F.size(pts) < 3) | (F.abs(signed_area(pts)) < 1e-9)


def bounds(pts: Column) -> Column:
    """Struct x0, y0, x1, y1; null for no point. A9."""
    xs, ys = F.transform(pts, lambda p: _d(p["x"])), F.transform(pts, lambda p: _d(p["y"]))
    return F.when(F.size(pts) > 0, F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")))


def rectangularity(pts: Column) -> Column:
    """Area over bounding box area; null where the box has none. P10."""
    b = bounds(pts)
    return F.try_divide(F.abs(signed_area(pts)), (b["x1"] - b["x0"]) * (b["y1"] - b["y0"]))


def centroid(pts: Column) -> Column:
    """Mean of the vertices."""
    n = F.size(pts)
    sx = F.aggregate(pts, F.lit(0.0), lambda s, p: s + _d(p["x"]))
    sy = F.aggregate(pts, F.lit(0.0), lambda s, p: s + _d(p["y"]))
    return F.when(n > 0, F.struct((sx / F.when(n > 0, n)).alias("x"), (sy / F.when(n > 0, n)).alias("y")))


def scale_about_centroid(pts: Column, margin: Column) -> Column:
    """Pushes the vertices out so that the farthest moves by ``margin``: the fallback of a true offset. G4."""
    c = centroid(pts)
    far = F.array_max(F.transform(pts, lambda p: F.hypot(_d(p["x"]) - c["x"], _d(p["y"]) - c["y"])))
    k = F.when(far > 0, (far + margin) / F.when(far > 0, far)).otherwise(F.lit(1.0))
    return F.transform(pts, lambda p: F.struct((c["x"] + (_d(p["x"]) - c["x"]) * k).alias("x"), (c["y"] + (_d(p["y"]) - c["y"]) * k).alias("y")))


def contains(pts: Column, x: Column, y: Column, eps: float = 1e-9) -> Column:
    """Point in polygon by crossing number; on the outline (within ``eps`` of the cross product) counts as inside. J11."""
    pairs = F.zip_with(pts, _next(pts), lambda a, b: F.struct(_d(a["x"]).alias("ax"), _d(a["y"]).alias("ay"), _d(b["x"]).alias("bx"), _d(b["y"]).alias("by")))

    def cross(e: Column) -> Column:
        return (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])

    def on_edge(e: Column) -> Column:
        return (F.abs(cross(e)) <= eps) & (x >= F.least(e["ax"], e["bx"]) - eps) & (x <= F.greatest(e["ax"], e["bx"]) + eps) & (y >= F.least(e["ay"], e["by"]) - eps) & (y <= F.greatest(e["ay"], e["by"]) + eps)

    def crosses(e: Column) -> Column:  # to the right of the point, half-open in y
        up = (e["ay"] <= y) & (e["by"] > y) & (cross(e) > 0)
        down = (e["by"] <= y) & (e["ay"] > y) & (cross(e) < 0)
        return up | down

    inside = F.size(F.filter(pairs, crosses)) % 2 == 1
    return F.when(F.size(pts) >= 3, F.exists(pairs, on_edge) | inside).otherwise(F.lit(False))


def open_ring(pts: Column) -> Column:
    """Without consecutive duplicates and without the closing point. W18."""
    kept = F.filter(pts, lambda p, i: (i == 0) | (p != F.get(pts, i - 1)))
    return F.when((F.size(kept) > 1) & (F.get(kept, F.lit(0)) == F.get(kept, F.size(kept) - 1)), F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))).otherwise(kept)


def is_convex_enclosing(quad: Column, seed: Column, least_area: float = 0.75, slack: float = 5.0) -> Column:
    """Convex quad of at least ``least_area`` of the seed's area whose edges leave no seed corner more than ``slack``
    outside. P15."""
    nxt, nxt2 = _next(quad), _next(_next(quad))
    turns = F.zip_with(F.zip_with(quad, nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), nxt2, lambda e, c: (_d(e["b"]["x"]) - _d(e["a"]["x"])) * (_d(c["y"]) - _d(e["b"]["y"])) - (_d(e["b"]["y"]) - _d(e["a"]["y"])) * (_d(c["x"]) - _d(e["b"]["x"])))
    convex = F.forall(turns, lambda t: t > 0) | F.forall(turns, lambda t: t < 0)
    sign = F.when(signed_area(quad) >= 0, 1.0).otherwise(-1.0)
    edges = F.zip_with(quad, nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    near = F.forall(seed, lambda p: F.forall(edges, lambda e: sign * ((_d(e["b"]["x"]) - _d(e["a"]["x"])) * (_d(p["y"]) - _d(e["a"]["y"])) - (_d(e["b"]["y"]) - _d(e["a"]["y"])) * (_d(p["x"]) - _d(e["a"]["x"]))) >= -slack * F.hypot(_d(e["b"]["x"]) - _d(e["a"]["x"]), _d(e["b"]["y"]) - _d(e["a"]["y"]))))
    return (F.size(quad) == 4) & convex & (F.abs(signed_area(quad)) >= least_area * F.abs(signed_area(seed))) & near


def order_quad(pts: Column) -> Column:
    """Four points as top-left, top-right, bottom-right, bottom-left (y down), by their sums and differences. F7."""
    by = lambda f: F.array_sort(F.transform(pts, lambda p: F.struct(f(p).alias("k"), _d(p["x"]).alias("x"), _d(p["y"]).alias("y"))))
    s, d = by(lambda p: _d(p["x"]) + _d(p["y"])), by(lambda p: _d(p["y"]) - _d(p["x"]))
    point = lambda e: F.struct(e["x"].alias("x"), e["y"].alias("y"))
    return F.when(F.size(pts) == 4, F.array(point(F.get(s, F.lit(0))), point(F.get(d, F.lit(0))), point(F.get(s, F.lit(3))), point(F.get(d, F.lit(3)))))


def box_corners(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Corners of a box given by its top-left corner and size. P18."""
    pt = lambda a, b: F.struct(_d(a).alias("x"), _d(b).alias("y"))
    return F.array(pt(x, y), pt(x + w, y), pt(x + w, y + h), pt(x, y + h))


def centred_box(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """Corners of a box given by centre and size: the legacy record shape. P18."""
    return box_corners(cx - w / 2, cy - h / 2, w, h)


def scale_points(pts: Column, sx: Column, sy: Column) -> Column:
    """Detection pixels to original pixels, rounded half to even. P18."""
    return F.transform(pts, lambda p: F.struct(F.bround(_d(p["x"]) * sx).cast("int").alias("x"), F.bround(_d(p["y"]) * sy).cast("int").alias("y")))


def alignment_margin(ex: Column, ey: Column, sx: Column, sy: Column, radius: Column, angle_deg: Column, extra: Column) -> Column:
    """hypot(|ex| sx, |ey| sy) + radius sin|angle| + max(0, extra). A21."""
    return F.hypot(F.abs(ex) * sx, F.abs(ey) * sy) + radius * F.sin(F.radians(F.abs(angle_deg))) + F.greatest(F.lit(0.0), extra)


def um_per_px(width_um: Column, height_um: Column, width_px: Column, height_px: Column) -> tuple[Column, Column]:
    """Microns per pixel along both axes; 1 where unknown. A21."""
    return tuple(F.coalesce(F.when((px > 0) & (um > 0), um / F.when(px > 0, px)), F.lit(1.0)) for um, px in ((width_um, width_px), (height_um, height_px)))


def odd_at_least(k: Column, least: int = 3) -> Column:
    """The next odd integer at or above ``k`` and ``least``. F4."""
    v = F.greatest(F.ceil(k).cast("int"), F.lit(least))
    return v + F.when(v % 2 == 0, F.lit(1)).otherwise(F.lit(0))


def affine(x: Column, y: Column, m: tuple) -> tuple[Column, Column]:
    a, b, c, d, e, f = m
    return a * x + b * y + c, d * x + e * y + f


@dataclass(frozen=True)
class WaferFrame:
    """Canvas pixels (y down) to design microns (y up) of one wafer. F6."""

    xc: float
    yc: float
    angle: float
    sx: float
    sy: float
    shear: float = 0.0
    ox: float = 0.0
    oy: float = 0.0
    gds_xc: float = 0.0
    gds_yc: float = 0.0

    def to_gds(self, x: Column, y: Column) -> tuple[Column, Column]:
        dx, dy = x - self.xc, F.lit(self.yc) - y
        c, s = F.cos(F.lit(self.angle)), F.sin(F.lit(self.angle))
        rx, ry = dx * c - dy * s, dx * s + dy * c
        gy = ry * self.sy
        return rx * self.sx + self.shear * gy + self.ox + self.gds_xc, gy + self.oy + self.gds_yc

    def to_canvas(self, gx: Column, gy: Column) -> tuple[Column, Column]:
        v = gy - self.gds_yc - self.oy
        rx, ry = (gx - self.gds_xc - self.ox - self.shear * v) / self.sx, v / self.sy
        c, s = F.cos(F.lit(self.angle)), F.sin(F.lit(self.angle))
        return self.xc + rx * c + ry * s, self.yc - (-rx * s + ry * c)


def tile_to_canvas(col: Column, row: Column, x: Column, y: Column, tile_w: float, tile_h: float, overlap_pct: float) -> tuple[Column, Column]:
    """Tiles are numbered from 1; the step is the size less the overlap. F6."""
    k = 1 - overlap_pct / 100
    return (col - 1) * (tile_w * k) + x, (row - 1) * (tile_h * k) + y


def crop_px_to_canvas(px: Column, py: Column, resize: Column, crop_x: Column, crop_y: Column, rot: tuple, origin_x: Column, origin_y: Column) -> tuple[Column, Column]:
    """Undo the resize, add the crop's origin, invert the 2 x 3 rotation, add the local origin. F6."""
    x, y = px / resize + crop_x, py / resize + crop_y
    a, b, c, d, e, f = rot
    det = a * e - b * d
    u, v = x - c, y - f
    return (e * u - b * v) / det + origin_x, (a * v - d * u) / det + origin_y


def report_canvas(x: Column, y: Column, min_x: Column, max_y: Column, scale: Column, padding: Column) -> tuple[Column, Column]:
    """Design microns to the pixels of a report image. F6."""
    return padding + (x - min_x) * scale, padding + (max_y - y) * scale


def intersect_lines(a1: Column, b1: Column, a2: Column, b2: Column) -> tuple[Column, Column]:
    """Of y = a1 x + b1 and x = a2 y + b2; null for parallels. F7."""
    det = F.lit(1.0) - a1 * a2
    x = F.when(F.abs(det) > 1e-12, (a2 * b1 + b2) / det)
    return x, a1 * x + b1


def tile_inside(x: Column, y: Column, w: Column, h: Column, cx: Column, cy: Column, radius: Column, share: float = 0.98) -> Column:
    """Whether all corners of a tile (top left corner and size) lie within ``share`` of the wafer's radius. P6. Null where
    anything is unknown."""
    far = F.greatest(*[F.hypot(x + i * w - cx, y + j * h - cy) for i in (0, 1) for j in (0, 1)])
    known = x.isNotNull() & y.isNotNull() & w.isNotNull() & h.isNotNull()
    return F.when(known, far <= share * radius)
