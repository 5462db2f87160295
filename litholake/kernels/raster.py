"""Raster kernels on NumPy arrays (R1-R15, A17-A19, I3-I4, P4-P5, W9, W13). Images are H x W x 3 in BGR order, 8 bit.

They run inside grouped or mapped Arrow functions, one image at a time, with everything around them relational. Colour
conversion, blur widths and contours behave like the usual image libraries but not bit for bit."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from litholake.functions.robust import MAD_TO_SIGMA

# --- codecs (S5, S6) ------------------------------------------------------------------------------------------------


def encode_png(img: np.ndarray) -> bytes:
    """Grey (H x W) or BGR (H x W x 3), 8 bit."""
    a = img if img.ndim == 2 else img[:, :, ::-1]
    h, w = a.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(a, np.uint8).reshape(h, -1)], 1).tobytes()
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if img.ndim == 2 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes, grey: bool = False) -> np.ndarray:
    """8-bit, not interlaced PNG as BGR or grey; raises ValueError for anything else, truncated data included."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, idat, head = 8, [], None
    while at + 8 <= len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            idat.append(body)
        at += 12 + n
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
        raise ValueError("unsupported PNG")
    w, h, c = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    try:
        rows = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8).reshape(h, 1 + w * c)
    except (zlib.error, ValueError) as e:
        raise ValueError("broken PNG") from e
    out = np.zeros((h, w * c), np.int64)
    for y in range(h):
        f, line = int(rows[y, 0]), rows[y, 1:].astype(np.int64)
        up = out[y - 1] if y else np.zeros(w * c, np.int64)
        if f == 2:
            line = line + up
        elif f == 1:
            line = np.cumsum(line.reshape(w, c), 0).reshape(-1)
        elif f in (3, 4):
            line = line.copy()
            for i in range(w * c):
                a, b, d = (line[i - c] if i >= c else 0), up[i], (up[i - c] if i >= c else 0)
                if f == 3:
                    p = (a + b) // 2
                else:
                    q = a + b - d
                    p = min((abs(q - a), 0, a), (abs(q - b), 1, b), (abs(q - d), 2, d))[2]
                line[i] = (line[i] + p) & 255
        out[y] = line & 255
    px = out.astype(np.uint8).reshape(h, w, c)
    colour = px[:, :, :3][:, :, ::-1] if c >= 3 else np.repeat(px[:, :, :1], 3, 2)
    return to_grey(colour) if grey else np.ascontiguousarray(colour)


def resize(img: np.ndarray, h: int, w: int) -> np.ndarray:
    """Area mean when shrinking, bilinear when growing."""
    src_h, src_w = img.shape[:2]
    if (h, w) == (src_h, src_w):
        return img
    return _resample(_resample(img.astype(np.float64), h, 0), w, 1).astype(img.dtype) if img.dtype != np.uint8 else np.clip(np.rint(_resample(_resample(img.astype(np.float64), h, 0), w, 1)), 0, 255).astype(np.uint8)


def _resample(a: np.ndarray, n: int, axis: int) -> np.ndarray:
    m = a.shape[axis]
    a = np.moveaxis(a, axis, 0)
    if n < m:
        c = np.concatenate([np.zeros((1, *a.shape[1:])), np.cumsum(a, 0)])
        edges = np.linspace(0, m, n + 1)
        k = np.minimum(edges.astype(int), m - 1)
        part = (edges - k).reshape(-1, *[1] * (a.ndim - 1))
        at = c[k] + part * a[k]
        out = (at[1:] - at[:-1]) * (n / m)
    else:
        x = np.clip((np.arange(n) + 0.5) * m / n - 0.5, 0, m - 1)
        k = np.minimum(x.astype(int), max(m - 2, 0))
        t = (x - k).reshape(-1, *[1] * (a.ndim - 1))
        out = a[k] * (1 - t) + a[np.minimum(k + 1, m - 1)] * t
    return np.moveaxis(out, 0, axis)


def resize_max_width(img: np.ndarray, max_width: int) -> np.ndarray:
    h, w = img.shape[:2]
    return img if w <= max_width else resize(img, max(1, round(h * max_width / w)), max_width)


# --- colour and filters ---------------------------------------------------------------------------------------------


def to_grey(bgr: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(bgr.astype(np.float64) @ np.array([0.114, 0.587, 0.299])), 0, 255).astype(np.uint8)


#: Linear sRGB to CIE XYZ, and the D65 white point.
RGB_TO_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
WHITE = np.array([0.950456, 1.0, 1.088754])


def to_lab(bgr: np.ndarray) -> np.ndarray:
    """CIE LAB scaled to 0..255 (L times 2.55, a and b plus 128), as float."""
    c = bgr[:, :, ::-1].astype(np.float64) / 255
    lin = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    xyz = lin @ RGB_TO_XYZ.T / WHITE
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    lightness = np.where(xyz[:, :, 1] > 0.008856, 116 * f[:, :, 1] - 16, 903.3 * xyz[:, :, 1])
    return np.stack([lightness * 2.55, 500 * (f[:, :, 0] - f[:, :, 1]) + 128, 200 * (f[:, :, 1] - f[:, :, 2]) + 128], 2).astype(np.float32)


def from_lab(lab: np.ndarray) -> np.ndarray:
    lightness, a, b = lab[:, :, 0] / 2.55, lab[:, :, 1] - 128.0, lab[:, :, 2] - 128.0
    fy = (lightness + 16) / 116
    f = np.stack([fy + a / 500, fy, fy - b / 200], 2)
    xyz = np.where(f**3 > 0.008856, f**3, (f - 16 / 116) / 7.787) * WHITE
    lin = np.clip(xyz @ np.linalg.inv(RGB_TO_XYZ).T, 0, 1)
    c = np.where(lin <= 0.0031308, 12.92 * lin, 1.055 * lin ** (1 / 2.4) - 0.055)
    return np.clip(np.rint(c[:, :, ::-1] * 255), 0, 255).astype(np.uint8)


def _kernel(sigma: float) -> np.ndarray:
    r = max(1, int(np.ceil(3 * sigma)))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return k / k.sum()


def _convolve(a: np.ndarray, k: np.ndarray, axis: int) -> np.ndarray:
    r, n = len(k) // 2, a.shape[axis]
    if n == 1:
        return a.astype(np.float64)
    pad = [(0, 0)] * a.ndim
    pad[axis] = (min(r, n - 1), min(r, n - 1))
    p = np.pad(a.astype(np.float64), pad, mode="reflect")
    extra = r - min(r, n - 1)
    if extra:
        pad[axis] = (extra, extra)
        p = np.pad(p, pad, mode="edge")
    out = np.zeros(a.shape)
    for i, w in enumerate(k):
        out += w * np.take(p, np.arange(i, i + n), axis)
    return out


def gaussian(a: np.ndarray, sigma_x: float, sigma_y: float | None = None) -> np.ndarray:
    """Gaussian blur with mirrored borders."""
    sigma_y = sigma_x if sigma_y is None else sigma_y
    out = _convolve(a, _kernel(sigma_x), 1) if sigma_x > 0 else a
    return (_convolve(out, _kernel(sigma_y), 0) if sigma_y > 0 else out).astype(np.float32)


def smooth(v: np.ndarray, sigma: float) -> np.ndarray:
    return _convolve(v[None, :], _kernel(sigma), 1)[0] if sigma > 0 else v


def median_filter(a: np.ndarray, size: int) -> np.ndarray:
    """Median along rows, then along columns: a separable stand-in for the square median, robust to compact objects."""
    r = size // 2
    for axis in (1, 0):
        rr = min(r, a.shape[axis] - 1)
        pad = [(0, 0)] * 2
        pad[axis] = (rr, rr)
        a = np.median(np.lib.stride_tricks.sliding_window_view(np.pad(a, pad, mode="reflect"), 2 * rr + 1, axis=axis), axis=-1)
    return a.astype(np.float32)


def robust_z_image(a: np.ndarray, mask: np.ndarray, floor: float) -> np.ndarray:
    v = a[mask & np.isfinite(a)]
    if not len(v):
        return np.zeros(a.shape, np.float32)
    m = np.median(v)
    return ((a - m) / max(MAD_TO_SIGMA * float(np.median(np.abs(v - m))), floor)).astype(np.float32)


def sobel_y(a: np.ndarray) -> np.ndarray:
    p = np.pad(a, 1, mode="reflect")
    row = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return row[2:] - row[:-2]


def laplacian(a: np.ndarray) -> np.ndarray:
    p = np.pad(a, 1, mode="reflect")
    return 2 * (p[:-2, :-2] + p[:-2, 2:] + p[2:, :-2] + p[2:, 2:]) - 8 * a


def disk(radius: int) -> np.ndarray:
    y, x = np.ogrid[-radius : radius + 1, -radius : radius + 1]
    return x * x + y * y <= radius * radius + radius * 0.5


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    if radius <= 0:
        return mask.copy()
    h, w = mask.shape
    p = np.pad(mask, radius)
    out = np.zeros_like(mask)
    for dy, dx in np.argwhere(disk(radius)):
        out |= p[dy : dy + h, dx : dx + w]
    return out


def erode(mask: np.ndarray, radius: int) -> np.ndarray:
    return ~dilate(~np.pad(mask, radius, mode="edge"), radius)[radius : radius + mask.shape[0], radius : radius + mask.shape[1]] if radius > 0 else mask.copy()


def open_close(mask: np.ndarray, open_radius: int, close_radius: int) -> np.ndarray:
    """Threshold masks are opened, then closed. R11."""
    m = dilate(erode(mask, open_radius), open_radius)
    return erode(dilate(m, close_radius), close_radius)


def geodesic(seed: np.ndarray, allowed: np.ndarray, steps: int) -> np.ndarray:
    """Growth of a seed within a mask, a bounded number of steps. I4."""
    grown = seed & allowed
    for _ in range(steps):
        nxt = dilate(grown, 1) & allowed
        if (nxt == grown).all():
            break
        grown = nxt
    return grown


# --- components -----------------------------------------------------------------------------------------------------


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components, numbered from 1 in reading order of their first pixel; union-find over runs. I3."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    ry, rs = np.nonzero(edge == 1)
    _, re_ = np.nonzero(edge == -1)
    n = len(ry)
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(ry, np.arange(h + 1))
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if rs[j] <= re_[i] and rs[i] <= re_[j]:
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if re_[i] < re_[j]:
                i += 1
            else:
                j += 1
    roots = np.array([find(i) for i in range(n)], np.int64)
    _, number = np.unique(roots, return_inverse=True)
    out = np.zeros((h, w), np.int32)
    for y, s, e, k in zip(ry, rs, re_, number, strict=True):
        out[y, s:e] = k + 1
    return out, int(number.max(initial=-1)) + 1


def component_table(labels: np.ndarray, n: int, planes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Box, area, orientation, and peak and mean of every evidence plane, for all components at once. A15, A17."""
    ys, xs = np.nonzero(labels)
    k = labels[ys, xs] - 1
    area = np.bincount(k, minlength=n)
    t = {"area": area}
    for name, v, f, start in (("x0", xs, np.minimum, 1 << 30), ("y0", ys, np.minimum, 1 << 30), ("x1", xs, np.maximum, -1), ("y1", ys, np.maximum, -1)):
        t[name] = np.full(n, start, np.int64)
        f.at(t[name], k, v)
    t["w"], t["h"] = t["x1"] - t["x0"] + 1, t["y1"] - t["y0"] + 1
    div = np.maximum(area, 1)
    mx, my = np.bincount(k, xs, n) / div, np.bincount(k, ys, n) / div
    cxx, cyy, cxy = (np.bincount(k, p * q, n) for p, q in ((xs - mx[k], xs - mx[k]), (ys - my[k], ys - my[k]), (xs - mx[k], ys - my[k])))
    t["angle"] = np.where(area >= 6, np.degrees(0.5 * np.arctan2(2 * cxy, cxx - cyy)) % 180, np.nan)
    for name, plane in planes.items():
        v = plane[ys, xs]
        t[f"{name}_max"] = np.full(n, -np.inf)
        np.maximum.at(t[f"{name}_max"], k, v)
        t[f"{name}_mean"] = np.bincount(k, v, n) / div
    return t


def outline(mask: np.ndarray) -> list[tuple[int, int]]:
    """Outer border of the component that holds the mask's first pixel, as a ring of pixels (Moore tracing)."""
    p = np.pad(mask, 1)
    ys, xs = np.nonzero(p)
    if not len(ys):
        return []
    start = (int(ys[0]), int(xs[0]))
    turn = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]
    ring, at, d = [start], start, 0
    for _ in range(4 * p.size):
        for k in range(8):
            e = (d + 6 + k) % 8
            q = (at[0] + turn[e][0], at[1] + turn[e][1])
            if p[q]:
                at, d = q, e
                break
        else:
            break
        if at == start:
            break
        ring.append(at)
    return [(x - 1, y - 1) for y, x in ring]


def simplify(ring: list[tuple[int, int]], eps: float) -> list[tuple[int, int]]:
    """Ring with vertices closer than ``eps`` to the chord dropped (farthest-point splitting). R12."""
    if len(ring) < 4:
        return ring
    pts = np.array(ring, float)
    far = int(np.argmax(((pts - pts[0]) ** 2).sum(1)))
    keep, stack = {0, far}, [(0, far), (far, len(ring))]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        p, q = pts[a], pts[b % len(ring)]
        v = pts[a + 1 : b] - p
        u = q - p
        n = np.hypot(*u)
        d = np.abs(u[0] * v[:, 1] - u[1] * v[:, 0]) / n if n else np.hypot(v[:, 0], v[:, 1])
        i = int(np.argmax(d))
        if d[i] > eps:
            keep.add(a + 1 + i)
            stack += [(a, a + 1 + i), (a + 1 + i, b)]
    return [ring[i] for i in sorted(keep)]


def component_polygon(labels: np.ndarray, k: int, x: int, y: int, w: int, h: int, share: float = 0.006, least: float = 1.0) -> list[list[int]]:
    ring = outline(labels[y : y + h, x : x + w] == k)
    length = sum(np.hypot(a[0] - b[0], a[1] - b[1]) for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
    return [[int(px + x), int(py + y)] for px, py in simplify(ring, max(least, share * length))] or [[x, y]]


def fill_polygon(points: np.ndarray, h: int, w: int) -> np.ndarray:
    """Pixels whose centre lies in the polygon (even-odd). R13."""
    out = np.zeros((h, w), bool)
    p, q = points, np.roll(points, -1, 0)
    for y in range(max(0, int(points[:, 1].min())), min(h, int(points[:, 1].max()) + 1)):
        hit = (p[:, 1] > y) != (q[:, 1] > y)
        if hit.any():
            xs = np.sort(p[hit, 0] + (y - p[hit, 1]) * (q[hit, 0] - p[hit, 0]) / (q[hit, 1] - p[hit, 1]))
            for a, b in zip(xs[::2], xs[1::2], strict=False):
                out[y, max(0, int(np.ceil(a))) : max(0, min(w, int(np.floor(b)) + 1))] = True
    return out


# --- template (A18, R8) ---------------------------------------------------------------------------------------------


def shift_between(ref: np.ndarray, img: np.ndarray, limit: int = 6) -> tuple[int, int]:
    """Whole-pixel shift (dy, dx) of ``img`` against ``ref`` by phase correlation of high-passed planes, clamped."""
    a, b = (p - gaussian(p, 8.0) for p in (ref.astype(np.float32), img.astype(np.float32)))
    f = np.fft.rfft2(a) * np.conj(np.fft.rfft2(b))
    r = np.fft.irfft2(f / np.maximum(np.abs(f), 1e-9), a.shape)
    y, x = np.unravel_index(int(np.argmax(r)), r.shape)
    h, w = r.shape
    dy, dx = (y - h if y > h // 2 else y), (x - w if x > w // 2 else x)
    return (-dy, -dx) if max(abs(dy), abs(dx)) <= limit else (0, 0)


def median_template(labs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Median and MAD planes of aligned images, with floors 1.8, 0.9, 0.9. A18."""
    aligned = [labs[0]]
    for lab in labs[1:]:
        dy, dx = shift_between(labs[0][:, :, 0], lab[:, :, 0])
        aligned.append(np.roll(lab, (-dy, -dx), (0, 1)))
    s = np.stack(aligned)
    m = np.median(s, 0)
    return m.astype(np.float32), np.maximum(MAD_TO_SIGMA * np.median(np.abs(s - m), 0), np.array([1.8, 0.9, 0.9])).astype(np.float32)


# --- stitching (R1-R6, A3, A19) -------------------------------------------------------------------------------------


def feather_weight(h: int, w: int, overlap_x: int, overlap_y: int, left: bool, right: bool, top: bool, bottom: bool) -> np.ndarray:
    """Separable linear ramps on the sides that have a neighbour. R2."""

    def ramp(n: int, o: int, low: bool, high: bool) -> np.ndarray:
        v, o = np.ones(n), min(o, n)
        up = (np.arange(o) + 1) / (o + 1)
        if low and o:
            v[:o] = np.minimum(v[:o], up)
        if high and o:
            v[n - o :] = np.minimum(v[n - o :], up[::-1])
        return v

    return (ramp(h, overlap_y, top, bottom)[:, None] * ramp(w, overlap_x, left, right)[None, :]).astype(np.float32)


def overlap_delta(tile_l: np.ndarray, placed_l: np.ndarray, weight: np.ndarray, least: int = 2500, limit: float = 18.0) -> float:
    """Median lightness difference where both exist, trimmed to its 10th to 90th percentile; 0 for too few pixels. A3, R3."""
    d = (placed_l - tile_l)[weight > 1e-6]
    if len(d) < least:
        return 0.0
    lo, hi = np.percentile(d, [10, 90])
    v = float(np.clip(np.median(d[(d >= lo) & (d <= hi)]), -limit, limit))
    return v if abs(v) >= 0.05 else 0.0


def add_lightness(bgr: np.ndarray, delta: float) -> np.ndarray:
    lab = to_lab(bgr)
    lab[:, :, 0] = np.clip(lab[:, :, 0] + delta, 0, 255)
    return from_lab(lab)


def flat_field(lightness: list[np.ndarray], side: int = 64) -> np.ndarray:
    """Median of the tiles' normalised smooth lightness, re-smoothed, with median 1, clipped to 0.55..1.65. A19."""
    small = []
    for a in lightness:
        s = gaussian(resize(a.astype(np.float32), side, side), side / 8)
        m = float(np.median(s))
        if m > 1e-6:
            small.append(s / m)
    if not small:
        return np.ones((side, side), np.float32)
    f = gaussian(np.median(np.stack(small), 0), side / 16)
    return np.clip(f / np.median(f), 0.55, 1.65).astype(np.float32)


def flatten_illumination(bgr: np.ndarray, field: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Lightness divided by the field, its median kept, blended by ``strength``. R1."""
    lab = to_lab(bgr)
    lightness = lab[:, :, 0]
    even = lightness / np.maximum(resize(field, *lightness.shape), 1e-3)
    even *= np.median(lightness) / max(float(np.median(even)), 1e-6)
    lab[:, :, 0] = np.clip(lightness + strength * (even - lightness), 0, 255)
    return from_lab(lab)


def match_lightness(bgr: np.ndarray, target: float, strength: float = 0.65) -> np.ndarray:
    """Moves the median lightness towards a target. R1, A20."""
    return add_lightness(bgr, strength * (target - float(np.median(to_lab(bgr)[:, :, 0]))))


def stitch(tiles: list[tuple[int, int, np.ndarray, np.ndarray]], h: int, w: int, level: float = 0.85, least: int = 2500) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean of tiles (x, y, image, weight) in the given order, each first levelled against what lies below; and
    the number of tiles under each pixel. Uncovered pixels are 0. R3, R4."""
    acc, total, cover = np.zeros((h, w, 3)), np.zeros((h, w)), np.zeros((h, w), np.int32)
    for x, y, img, weight in tiles:
        x0, y0, x1, y1 = max(x, 0), max(y, 0), min(x + img.shape[1], w), min(y + img.shape[0], h)
        if x1 <= x0 or y1 <= y0:
            continue
        part, wt = img[y0 - y : y1 - y, x0 - x : x1 - x], weight[y0 - y : y1 - y, x0 - x : x1 - x]
        under = total[y0:y1, x0:x1]
        if level > 0 and (under > 1e-6).any():
            below = np.clip(acc[y0:y1, x0:x1] / np.maximum(under, 1e-6)[:, :, None], 0, 255).astype(np.uint8)
            delta = overlap_delta(to_lab(part)[:, :, 0], to_lab(below)[:, :, 0], under, least)
            part = add_lightness(part, level * delta) if delta else part
        acc[y0:y1, x0:x1] += part * wt[:, :, None]
        total[y0:y1, x0:x1] += wt
        cover[y0:y1, x0:x1] += 1
    out = np.where(total[:, :, None] > 1e-6, acc / np.maximum(total, 1e-6)[:, :, None], 0)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8), cover


def seam_mask(cover: np.ndarray, widen: int) -> np.ndarray:
    """Pixels covered by more than one tile, widened. R5."""
    return dilate(cover > 1, widen)


def warp(img: np.ndarray, m: np.ndarray, h: int, w: int) -> np.ndarray:
    """Output pixel (x, y) taken from ``m @ (x, y, 1)`` (2 x 3 affine or 3 x 3 homography), bilinear, 0 outside. R6, R7."""
    m = np.vstack([m, [0, 0, 1]]) if m.shape == (2, 3) else m
    y, x = np.mgrid[0:h, 0:w]
    u, v, k = (m[i, 0] * x + m[i, 1] * y + m[i, 2] for i in range(3))
    u, v = u / k, v / k
    ok = (u >= 0) & (v >= 0) & (u <= img.shape[1] - 1) & (v <= img.shape[0] - 1)
    u0, v0 = np.clip(u.astype(int), 0, max(img.shape[1] - 2, 0)), np.clip(v.astype(int), 0, max(img.shape[0] - 2, 0))
    a, b = np.clip(u - u0, 0, 1), np.clip(v - v0, 0, 1)
    if img.ndim == 3:
        a, b, ok = a[..., None], b[..., None], ok[..., None]
    f = img.astype(np.float64)
    u1, v1 = np.minimum(u0 + 1, img.shape[1] - 1), np.minimum(v0 + 1, img.shape[0] - 1)
    out = (f[v0, u0] * (1 - a) + f[v0, u1] * a) * (1 - b) + (f[v1, u0] * (1 - a) + f[v1, u1] * a) * b
    return np.where(ok, np.rint(out), 0).astype(img.dtype)


def homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """3 x 3 map of four point pairs."""
    rows = []
    for (x, y), (u, v) in zip(src, dst, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y, u], [0, 0, 0, x, y, 1, -v * x, -v * y, v]]
    a = np.array(rows, float)
    return np.append(np.linalg.solve(a[:, :8], a[:, 8]), 1.0).reshape(3, 3)


def heat(score: np.ndarray, clip: float = 20.0) -> np.ndarray:
    """Score as a blue-to-red map. R15."""
    t = np.clip(score / clip, 0, 1)
    return np.rint(np.stack([255 * np.clip(1.5 - np.abs(4 * t - c), 0, 1) for c in (1, 2, 3)], 2)).astype(np.uint8)


def overlay(bgr: np.ndarray, polygons: list[np.ndarray], colour: tuple[int, int, int] = (0, 0, 255), alpha: float = 0.3) -> np.ndarray:
    """Polygons painted over the image. R15."""
    out = bgr.astype(np.float64)
    for p in polygons:
        m = fill_polygon(np.asarray(p, float), *bgr.shape[:2])
        out[m] = (1 - alpha) * out[m] + alpha * np.array(colour)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)
