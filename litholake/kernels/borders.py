"""Border rectification, bright squares and pose search."""

from __future__ import annotations

import numpy as np

from litholake.functions.robust import MAD_TO_SIGMA
from litholake.kernels import raster


def z1(v: np.ndarray) -> np.ndarray:
    m = np.median(v)
    return (v - m) / max(MAD_TO_SIGMA * float(np.median(np.abs(v - m))), 1e-6)


def transition(v: np.ndarray, r: int, inside_positive: bool) -> np.ndarray:
    """Mean of the next ``r`` values less the previous ``r``, shrinking at the ends, not below 0. W5."""
    c = np.concatenate([[0.0], np.cumsum(v)])
    n, i = len(v), np.arange(len(v))
    hi, lo = np.minimum(i + 1 + r, n), np.maximum(i - r, 0)
    ahead = np.divide(c[hi] - c[i + 1], hi - i - 1, out=np.zeros(n), where=hi > i + 1)
    behind = np.divide(c[i] - c[lo], i - lo, out=np.zeros(n), where=i > lo)
    return np.where((hi > i + 1) & (i > lo), np.maximum(ahead - behind if inside_positive else behind - ahead, 0), 0)


def side_profile(grey: np.ndarray, chroma: np.ndarray, axis: int, inside_positive: bool, r: int = 12) -> np.ndarray:
    """Evidence of a border at each position along ``axis``: edges, and the rise of energy, texture and colour. W7."""
    g = np.abs(np.gradient(grey.astype(float), axis=axis))
    across = 1 - axis
    edge = np.percentile(g, 70, axis=across)
    energy, texture, colour = g.mean(across), grey.astype(float).std(across), chroma.mean(across)
    return 0.65 * z1(edge) + 1.65 * z1(transition(energy, r, inside_positive)) + 1.05 * z1(transition(texture, r, inside_positive)) + 0.80 * z1(transition(colour, r, inside_positive))


def choose(score: np.ndarray, lo: int, hi: int, seed: float, reach: float) -> tuple[int, float]:
    """Best local maximum in [lo, hi) with a penalty for the distance to the expected place, and its confidence. W8."""
    i = np.arange(max(lo, 1), min(hi, len(score) - 1))
    peaks = i[(score[i] > score[i - 1]) & (score[i] >= score[i + 1])]
    if not len(peaks):
        return int(round(seed)), 0.0
    k = int(peaks[np.argmax(score[peaks] - 0.5 * np.abs(peaks - seed) / max(reach, 1.0))])
    return k, float(np.clip((score[k] - 0.5) / 5, 0, 1))


def trimmed_line(t: np.ndarray, v: np.ndarray, rounds: int = 5) -> tuple[float, float, float]:
    """(slope, intercept, rms) of v over t with outliers trimmed by their MAD. A11."""
    keep = np.ones(len(t), bool)
    a = b = 0.0
    for _ in range(rounds):
        a, b = np.polyfit(t[keep], v[keep], 1) if np.ptp(t[keep]) > 0 else (0.0, float(np.median(v[keep])))
        r = v - a * t - b
        d = np.abs(r - np.median(r[keep]))
        nxt = d <= max(1.5, 2.8 * MAD_TO_SIGMA * float(np.median(d[keep])))
        if nxt.sum() < 8 or (nxt == keep).all():
            break
        keep = nxt
    return float(a), float(b), float(np.sqrt(np.mean((v - a * t - b)[keep] ** 2)))


def rectify(bgr: np.ndarray, quad: np.ndarray, margin: float = 0.18, least: float = 0.22, out: tuple[int, int] | None = None) -> dict:
    """Finds the four physical borders near an expected quad (corners from the top left, clockwise) and maps them to a
    rectangle by one perspective warp. R7.

    The expected quad is first rectified with ``margin`` around it; each side is located in its profile, refined along
    its length and fitted by a trimmed line; corners are intersections. Confidence is 0.82 mean(side) + 0.18 exp(-rms).
    Below ``least``, or for a quad that isn't convex, the expected quad itself is warped and ``success`` is false."""
    side = [float(np.hypot(*(quad[(k + 1) % 4] - quad[k]))) for k in range(4)]
    w, h = int(round(max(side[0], side[2]))), int(round(max(side[1], side[3])))
    out = out or (h, w)
    px, py = int(margin * w), int(margin * h)
    inner = np.array([[px, py], [px + w - 1, py], [px + w - 1, py + h - 1], [px, py + h - 1]], float)
    to_source = raster.homography(inner, quad)
    flat = raster.warp(bgr, to_source, h + 2 * py, w + 2 * px)
    lab = raster.to_lab(flat)
    grey, chroma = lab[:, :, 0], np.hypot(lab[:, :, 1] - 128, lab[:, :, 2] - 128)
    lines, conf, rms = [], [], []
    for axis, seed, positive in ((0, py, True), (1, px + w - 1, False), (0, py + h - 1, False), (1, px, True)):
        n, pad = grey.shape[axis], py if axis == 0 else px
        k, c = choose(side_profile(grey, chroma, axis, positive), max(0, int(seed - pad)), min(n, int(seed + pad)), seed, pad)
        length, strips = grey.shape[1 - axis], 24
        at = np.linspace(0.12 * length, 0.88 * length, strips + 1).astype(int)
        g = np.abs(np.gradient(grey, axis=axis))
        lo, hi = max(0, k - 10), min(n, k + 11)
        found = [lo + int(np.argmax(np.take(g[:, a:b].mean(1) if axis == 0 else g[a:b].mean(0), np.arange(lo, hi)))) for a, b in zip(at[:-1], at[1:], strict=True)]
        s, b0, e = trimmed_line((at[:-1] + at[1:]) / 2, np.array(found, float))
        lines.append((axis, s, b0))
        conf.append(c)
        rms.append(e)

    def meet(horizontal: tuple, vertical: tuple) -> tuple[float, float]:
        _, a1, b1 = horizontal  # y = a1 x + b1
        _, a2, b2 = vertical  # x = a2 y + b2
        x = (a2 * b1 + b2) / (1 - a1 * a2)
        return x, a1 * x + b1

    corners = np.array([meet(lines[0], lines[3]), meet(lines[0], lines[1]), meet(lines[2], lines[1]), meet(lines[2], lines[3])])
    p = np.column_stack([corners, np.ones(4)]) @ to_source.T
    found_quad = p[:, :2] / p[:, 2:]
    d = np.roll(found_quad, -1, 0) - found_quad
    turns = d[:, 0] * np.roll(d, -1, 0)[:, 1] - d[:, 1] * np.roll(d, -1, 0)[:, 0]
    confidence = float(np.clip(0.82 * np.mean(conf) + 0.18 * np.exp(-np.mean(rms) / max(2.0, 0.015 * min(w, h))), 0, 1))
    ok = bool(confidence >= least and ((turns > 0).all() or (turns < 0).all()))
    use = found_quad if ok else quad
    rect = np.array([[0, 0], [out[1] - 1, 0], [out[1] - 1, out[0] - 1], [0, out[0] - 1]], float)
    return {"success": ok, "corners": use, "confidence": confidence, "image": raster.warp(bgr, raster.homography(rect, use), *out), "reason": "" if ok else "low confidence" if confidence < least else "not convex"}


def otsu(grey: np.ndarray) -> int:
    """Threshold with the greatest variance between both classes. A22."""
    h = np.bincount(grey.ravel(), minlength=256).astype(float)
    w0, s0 = np.cumsum(h), np.cumsum(h * np.arange(256))
    w1 = w0[-1] - w0
    with np.errstate(divide="ignore", invalid="ignore"):
        v = w0 * w1 * (s0 / w0 - (s0[-1] - s0) / w1) ** 2
    return int(np.nanargmax(np.where((w0 > 0) & (w1 > 0), v, -1)))


def bright_squares(grey: np.ndarray, side: float) -> dict[str, np.ndarray]:
    """Components of the white-square response: bright at the scale of a square against its surroundings. L3."""
    g = grey.astype(np.float32)
    response = raster.gaussian(g, side / 6) - raster.gaussian(g, side * 1.2)
    top = float(response.max(initial=0.0))
    labels, n = raster.label(response > max(0.35 * top, 4.0))
    t = raster.component_table(labels, n, {"response": response})
    return t | {"cx": (t["x0"] + t["x1"]) / 2, "cy": (t["y0"] + t["y1"]) / 2}


def wafer_circle(grey: np.ndarray) -> tuple[float, float, float] | None:
    """(x, y, radius) of the wafer on a canvas: largest bright component, outline fitted by a trimmed circle. A10, A22."""
    labels, n = raster.label(grey > otsu(grey))
    if not n:
        return None
    k = int(np.argmax(np.bincount(labels.ravel())[1:])) + 1
    pts = np.array(raster.outline(labels == k), float)
    for _ in range(6):
        if len(pts) < 8:
            return None
        m = pts.mean(0)
        q = pts - m
        sol, *_ = np.linalg.lstsq(np.column_stack([2 * q, np.ones(len(q))]), (q**2).sum(1), rcond=None)
        r = float(np.sqrt(max(sol[2] + sol[0] ** 2 + sol[1] ** 2, 0)))
        off = np.abs(np.hypot(q[:, 0] - sol[0], q[:, 1] - sol[1]) - r)
        if (off < 0.012 * r).all() or (off < 0.012 * r).sum() < 8:
            break
        pts = pts[off < 0.012 * r]
    return float(m[0] + sol[0]), float(m[1] + sol[1]), r


def best_pose(grey: np.ndarray, points: np.ndarray, angles: np.ndarray, scales: np.ndarray, reach: int = 12) -> dict:
    """Pose of template points (about their centre) with the greatest mean edge proximity: a coarse grid of angle, scale
    and shift, refined around the best. L10; ties go to the first pose."""
    g = np.hypot(*np.gradient(grey.astype(float)))
    edge = g > max(0.25 * g.max(), 1e-6)
    near = np.zeros(grey.shape)
    grown = edge
    for k in range(reach):
        near += grown / reach
        grown = raster.dilate(grown, 1)
    h, w = grey.shape
    best = {"score": -1.0}

    def tries(a_s, s_s, centre, step):
        for a in a_s:
            for s in s_s:
                rot = s * np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
                p = points @ rot.T
                for dy in range(-reach, reach + 1, step):
                    for dx in range(-reach, reach + 1, step):
                        q = np.rint(p + centre + (dx, dy)).astype(int)
                        ok = (q[:, 0] >= 0) & (q[:, 1] >= 0) & (q[:, 0] < w) & (q[:, 1] < h)
                        v = float(near[q[ok, 1], q[ok, 0]].sum() / len(q))
                        if v > best["score"] + 1e-12:
                            best.update(score=v, angle=float(a), scale=float(s), x=float(centre[0] + dx), y=float(centre[1] + dy))

    tries(angles, scales, np.array([(w - 1) / 2, (h - 1) / 2]), max(1, reach // 4))
    da = (angles[1] - angles[0]) / 2 if len(angles) > 1 else 0.0
    tries([best["angle"] + k * da for k in (-1, 0, 1)], [best["scale"]], np.array([best["x"], best["y"]]), 1)
    return best
