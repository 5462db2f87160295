"""Evidence of defects in one image: planes declared as a table, read by one evaluator.

A *view* is the image's Lab channels, prepared in one way and standardised over the interior. A *row* of evidence reads one
quantity from a view and weighs it. A score is the largest weighted row. Shapes of colour are selected likewise: by a table
of bounds on the measures of their regions."""

from __future__ import annotations

import numpy as np

from litholake.kernels.raster import component_table, dilate, erode, gaussian, label, laplacian, median_filter, open_close, robust_z_image, shift_between, smooth, sobel_y, to_lab

# Fixed values of the detector -----------------------------------------------------------------------------------------

#: Least spread of L, a, b in a view.
FLOORS = {"calm": (1.4, 0.9, 0.9), "local": (1.1, 0.8, 0.8), "plain": (1.4, 0.9, 0.9), "texture": (1.0,), "across": (1.0,)}
#: Evidence of large and of compact defects, and of differences from a template: view, quantity, weight.
LARGE = (("calm", "abs", 0.95), ("calm", "chroma", 1.10), ("calm", "dark", 1.00), ("calm", "bright", 0.90))
COMPACT = (("local", "dark", 1.05), ("local", "bright", 0.80), ("local", "chroma", 0.95), ("texture", "abs", 0.45), ("across", "bright", 0.58))
TEMPLATE = (("template", "dark", 1.00), ("template", "bright", 0.72), ("template", "chroma", 1.00))
#: What supports a transverse response, and its weight.
SUPPORT, TRANSVERSE = {"large": 1.45, "compact": 2.80, "chroma_local": 1.80}, 0.78
#: Scores that colours force: blobs of an odd colour, stains.
FORCED = {"blob": 11.5, "stain": 13.0}
#: Promotion of template differences: local excess and score, or support by a plane; the most they can score.
TEMPLATE_LOCAL, TEMPLATE_SCORE, TEMPLATE_CAP = 1.15, 4.8, 18.0
TEMPLATE_SUPPORT = {"compact": 2.6, "large": 1.9, "across": 3.2, "dark_local": 1.8, "chroma_local": 1.8}
#: Evidence strong enough to hold on the design's outlines, and the factor for what isn't.
OUTLINE_STRONG, OUTLINE_FACTOR = {"compact": 6.2, "large": 5.0, "dark_local": 4.0, "chroma_local": 4.2}, 0.32
#: Colours as ranges of hue (0 to 179), saturation and value.
COLOURS = {"frame": ((14, 45), (46, 255), (111, 255)), "stain": ((12, 48), (43, 255), (116, 255)), "gold": ((8, 52), (31, 255), (46, 255)), "black": ((0, 179), (26, 255), (0, 89))}
#: Gold by Lab: least L, most a, least b.
GOLD_LAB = (96, 141, 146)
#: Bounds (from, to) on the measures of a region: all of a row must hold, one row of a table suffices. ``height``, ``width``
#: and ``area`` are shares of the image; ``_px`` are pixels; ``side`` and ``end`` are 1 for regions at the left or right,
#: and at the upper or lower border.
STAIN = ({"area_px": (1200, None), "area": (0.006, None), "height": (0.18, None), "width": (0.14, None), "width_px": (31, None), "fill": (0.10, None)},)
BLOB = (
    {"width_px": (5, None), "height_px": (5, None), "aspect": (None, 10.0)},
    {"area_px": (350, None), "area": (0.00065, None), "width_px": (10, None), "height_px": (10, None)},
)
NO_BLOB = (
    {"area_px": (None, 19)},
    {"area": (None, 0.000035)},
    {"height": (0.22, None), "width_px": (None, 8)},
    {"height": (0.22, None), "width": (None, 0.012)},
    {"aspect": (14.0, None), "fill": (None, 0.45), "area": (None, 0.006)},
    {"aspect": (25.0, None), "width": (None, 0.025)},
    {"side": (1, None), "height": (0.35, None), "width": (None, 0.07)},
    {"end": (1, None), "width": (0.35, None), "height": (None, 0.07)},
    {"end": (1, None), "width": (0.50, None), "area": (0.01, None)},
)
FRAME = tuple({"area_px": (65, None), "area": (0.0005, None), place: (1, None)} for place in ("side", "end"))

# Colours and shapes ---------------------------------------------------------------------------------------------------


def to_hsv(bgr: np.ndarray) -> np.ndarray:
    """Hue in half degrees, saturation and value from 0 to 255."""
    v = bgr.astype(np.float32)
    top, low = v.max(2), v.min(2)
    spread = np.where(top > low, top - low, 1.0)
    b, g, r = v[:, :, 0], v[:, :, 1], v[:, :, 2]
    hue = np.select([top == low, top == r, top == g], [0.0, (g - b) / spread, 2 + (b - r) / spread], 4 + (r - g) / spread)
    return np.stack([np.round(hue * 30) % 180, np.round(255 * (top - low) / np.maximum(top, 1)), top], 2)


def coloured(hsv: np.ndarray, name: str) -> np.ndarray:
    return np.logical_and.reduce([(hsv[:, :, c] >= lo) & (hsv[:, :, c] <= hi) for c, (lo, hi) in enumerate(COLOURS[name])])


def inset(h: int, w: int, pad: int) -> np.ndarray:
    m = np.zeros((h, w), bool)
    pad = min(pad, (min(h, w) - 1) // 2)
    m[pad : h - pad, pad : w - pad] = True
    return m


def regions_where(mask: np.ndarray, any_of: tuple[dict, ...], none_of: tuple[dict, ...] = (), border: int = 0) -> np.ndarray:
    """The connected regions of a mask whose measures satisfy a row of ``any_of`` and no row of ``none_of``."""
    labels, n = label(mask)
    if not n:
        return np.zeros_like(mask)
    h, w = mask.shape
    t = component_table(labels, n, {})
    measures = {
        "area_px": t["area"], "area": t["area"] / mask.size, "width_px": t["w"], "width": t["w"] / w, "height_px": t["h"], "height": t["h"] / h,
        "aspect": np.maximum(t["w"] / t["h"], t["h"] / t["w"]), "fill": t["area"] / (t["w"] * t["h"]),
        "side": ((t["x0"] <= border) | (t["x1"] + 1 >= w - border)).astype(int), "end": ((t["y0"] <= border) | (t["y1"] + 1 >= h - border)).astype(int),
    }

    def holds(rows: tuple[dict, ...]) -> np.ndarray:
        found = np.zeros(n, bool)
        for row in rows:
            fits = np.ones(n, bool)
            for name, (lo, hi) in row.items():
                fits &= (lo is None or measures[name] >= lo) & (hi is None or measures[name] <= hi)
            found |= fits
        return found

    return np.concatenate([[False], holds(any_of) & ~holds(none_of)])[labels]


def interior_mask(h: int, w: int, border_px: int = 42, border_frac: float = 0.015, bgr: np.ndarray | None = None) -> np.ndarray:
    """Everything but a border of the larger of both widths and, with an image, its yellow frame: regions of that colour
    that touch the border, with 6 pixels around them. P5."""
    pad = max(border_px, int(border_frac * min(h, w)))
    m = inset(h, w, pad)
    if bgr is not None:
        frame = regions_where(coloured(to_hsv(bgr), "frame"), FRAME, border=min(pad, (min(h, w) - 1) // 2))
        if frame.any():
            m &= ~dilate(frame, 6)
    return m


def stain(bgr: np.ndarray, border_px: int = 18) -> np.ndarray:
    """Huge yellow stains that reach deep into the cell, also where they touch its frame. P4."""
    h, w = bgr.shape[:2]
    inner = inset(h, w, max(border_px, round(0.012 * min(h, w))))
    return open_close(regions_where(open_close(coloured(to_hsv(bgr), "stain") & inner, 1, 0), STAIN), 0, 2)


def blobs(bgr: np.ndarray, border_px: int = 18) -> np.ndarray:
    """Compact or broad patches of gold, brown or black; neither lines of the layout nor rests of the frame. P4."""
    h, w = bgr.shape[:2]
    pad = max(border_px, round(0.018 * min(h, w)))
    hsv, lab = to_hsv(bgr), to_lab(bgr)
    gold = (lab[:, :, 0] >= GOLD_LAB[0]) & (lab[:, :, 1] <= GOLD_LAB[1]) & (lab[:, :, 2] >= GOLD_LAB[2])
    odd = (coloured(hsv, "gold") | coloured(hsv, "black") | gold) & inset(h, w, pad)
    return open_close(regions_where(open_close(odd, 1, 0), BLOB, NO_BLOB, pad + 4), 0, 1)


# Background and lines -------------------------------------------------------------------------------------------------


def _masked_median(a: np.ndarray, mask: np.ndarray, axis: int, least: float, default: float) -> np.ndarray:
    """Medians along an axis; ``default`` where at most ``least`` values count."""
    order = np.sort(np.where(mask, a, np.inf), axis=axis)
    n = mask.sum(axis)
    at = lambda k: np.take_along_axis(order, np.expand_dims(np.clip(k, 0, a.shape[axis] - 1), axis), axis).squeeze(axis)
    mid = np.where(n > 0, (at((n - 1) // 2) + at(n // 2)) / 2, default)
    return np.where(n > least, mid, default)


def expected_background(ch: np.ndarray, mask: np.ndarray, col_sigma: float, row_sigma: float) -> np.ndarray:
    """Column medians plus smoothed medians of the rows' rest. W9."""
    h, w = ch.shape
    center = float(np.median(ch[mask])) if mask.any() else 0.0
    col = smooth(_masked_median(ch, mask, 0, max(8, 0.1 * h), center), col_sigma)
    row = smooth(_masked_median(ch - col[None, :] + center, mask, 1, max(8, 0.1 * w), center), row_sigma)
    return (col[None, :] + row[:, None] - center).astype(np.float32)


def residual_lab(lab: np.ndarray, mask: np.ndarray) -> np.ndarray:
    h = lab.shape[0]
    plan = ((0.0, max(12.0, 0.025 * h)), (2.0, max(18.0, 0.035 * h)), (2.0, max(18.0, 0.035 * h)))
    return np.stack([lab[:, :, c] - expected_background(lab[:, :, c], mask, *s) for c, s in enumerate(plan)], 2)


def vertical_pitch(lightness: np.ndarray, mask: np.ndarray) -> float:
    """Pitch of vertical lines: the lag at which the columns' profile agrees best with itself, by its power spectrum; a
    guess from the width where the profile is too short or flat. W13."""
    h, w = lightness.shape
    lags = np.arange(max(4, round(w / 220)), min(round(w / 55), 28))
    seen = np.flatnonzero(mask.sum(0) > max(12, 0.2 * h))
    if len(seen) >= max(40, 0.25 * w) and len(lags) > 1:
        medians = _masked_median(lightness, mask, 0, 0, 0.0)
        profile = np.interp(np.arange(w), seen, medians[seen])
        profile = profile - smooth(profile, max(10.0, w / 40))
        spectrum = np.abs(np.fft.rfft(profile - profile.mean(), 2 * w)) ** 2
        agreement = np.fft.irfft(spectrum, 2 * w)
        if agreement[0] > 1e-6:
            return float(np.clip(lags[np.argmax(np.round(agreement[lags], 6))], 4.5, 22.0))
    return float(np.clip(w / 115.0, 5.0, 18.0))


def transverse_texture(lightness: np.ndarray, mask: np.ndarray, pitch: float) -> np.ndarray:
    """Structure along lines that should be uniform: edges across the lines, less what whole rows have in common. R9."""
    h, w = lightness.shape
    rows = expected_background(lightness, mask, 0.0, max(16.0, 0.03 * h))
    edges = gaussian(np.abs(sobel_y(lightness - rows)), max(1.5, 0.55 * pitch), 1.1)
    found = np.clip(robust_z_image(edges, mask, 0.65), 0, None)
    common = gaussian(found, max(16.0, 0.065 * w), 0.6)
    return (np.clip(found - 0.72 * common, 0, None) * mask).astype(np.float32)


# Score ----------------------------------------------------------------------------------------------------------------

_READ = {
    "abs": lambda v: np.abs(v[0]),
    "dark": lambda v: np.clip(-v[0], 0, None),
    "bright": lambda v: np.clip(v[0], 0, None),
    "chroma": lambda v: np.hypot(v[1], v[2]),
}


def strongest(views: dict[str, list[np.ndarray]], rows: tuple[tuple[str, str, float], ...]) -> np.ndarray:
    """The largest weighted quantity of the rows, at each pixel."""
    out = None
    for view, quantity, weight in rows:
        plane = weight * _READ[quantity](views[view])
        out = plane if out is None else np.maximum(out, plane)
    return out


def any_above(planes: dict[str, np.ndarray], levels: dict[str, float]) -> np.ndarray:
    return np.logical_or.reduce([planes[name] >= level for name, level in levels.items()])


def views_of(lab: np.ndarray, mask: np.ndarray, pitch: float) -> dict[str, list[np.ndarray]]:
    """The views of an image: calmed along the lines, against its local median, as it is, and its textures."""
    rest = residual_lab(lab, mask)
    size = int(round(max(13.0, 5 * pitch))) | 1
    calm = [gaussian(rest[:, :, c], max(2.0, 1.35 * pitch), max(1.2, 0.35 * pitch)) for c in range(3)]
    raw = {"calm": calm, "local": [lab[:, :, c] - median_filter(lab[:, :, c], size) for c in range(3)], "plain": [rest[:, :, c] for c in range(3)], "texture": [laplacian(calm[0])]}
    views = {name: [robust_z_image(a, mask, f) for a, f in zip(arrays, FLOORS[name], strict=True)] for name, arrays in raw.items()}
    return views | {"across": [transverse_texture(lab[:, :, 0], mask, pitch)]}


def defect_score(bgr: np.ndarray, mask: np.ndarray, template: tuple[np.ndarray, np.ndarray] | None = None, design: np.ndarray | None = None) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Score of each pixel and its evidence planes. R10, D0.

    The larger of large and compact evidence, and of transverse texture where another plane supports it; nothing outside
    the interior; colours force a score. A template (median and spread of aligned images in Lab) adds local differences,
    a design mask takes what lies outside the design and weakens what lies on its outlines."""
    lab = to_lab(bgr)
    pitch = vertical_pitch(lab[:, :, 0], mask)
    views = views_of(lab, mask, pitch)
    planes = {"large": strongest(views, LARGE), "compact": strongest(views, COMPACT), "across": views["across"][0]}
    planes |= {"chroma_large": _READ["chroma"](views["calm"]), "dark_local": _READ["dark"](views["local"]), "chroma_local": _READ["chroma"](views["local"])}
    planes |= {"dark": _READ["dark"](views["plain"]), "chroma": _READ["chroma"](views["plain"])}
    backed = np.where(any_above(planes, SUPPORT), TRANSVERSE * planes["across"], 0)
    score = np.maximum.reduce([planes["large"], planes["compact"], backed]) * mask
    forced = {"blob": blobs(bgr) & mask, "stain": stain(bgr)}
    for name, where in forced.items():
        score = np.where(where, np.maximum(score, FORCED[name]), score)
    planes["forced"] = (forced["blob"] | forced["stain"]).astype(np.float32)
    if template is not None:
        score = np.maximum(score, promoted(lab, mask, template, planes))
    if design is not None:
        reach = max(1, round(0.85 * pitch) // 2)
        outlines = dilate(design, reach) & ~erode(design, reach)
        weak = outlines & ~(any_above(planes, OUTLINE_STRONG) | (planes["forced"] > 0))
        score = np.where(design, np.where(weak, OUTLINE_FACTOR * score, score), 0)
    return score.astype(np.float32), planes


def promoted(lab: np.ndarray, mask: np.ndarray, template: tuple[np.ndarray, np.ndarray], planes: dict[str, np.ndarray]) -> np.ndarray:
    """Differences from a template that are local, or that the image itself supports. A18, R8, D0."""
    median, spread = template
    dy, dx = shift_between(median[:, :, 0], lab[:, :, 0])
    z = (np.roll(lab, (-dy, -dx), (0, 1)) - median) / spread
    z = np.roll(z, (dy, dx), (0, 1))
    score = strongest({"template": [z[:, :, c] for c in range(3)]}, TEMPLATE) * mask
    local = np.clip(score - 0.78 * gaussian(score, 7.0, 7.0), 0, None)
    believed = ((local >= TEMPLATE_LOCAL) & (score >= TEMPLATE_SCORE)) | any_above(planes, TEMPLATE_SUPPORT)
    return np.where(believed, np.minimum(score, TEMPLATE_CAP), 0.0)
