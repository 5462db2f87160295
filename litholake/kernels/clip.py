"""Polygon booleans by horizontal slabs: exact for any simple or crossing outlines under the even-odd rule of each set.

All vertices and edge crossings cut the plane into slabs; within a slab every edge is a straight side, so each set is a
row of trapezoids, and the boolean is a merge of intervals. The result is a list of trapezoids (disjoint but for edges)."""

from __future__ import annotations

import numpy as np

Poly = list[tuple[float, float]]


def _edges(polys: list[Poly]) -> np.ndarray:
    out = [(*(a if a[1] < b[1] else b), *(b if a[1] < b[1] else a), k) for k, p in enumerate(polys) for a, b in zip(p, p[1:] + p[:1], strict=True) if a[1] != b[1]]
    return np.array(out, float).reshape(len(out), 5)


def _crossing_ys(e: np.ndarray) -> list[float]:
    ys: list[float] = []
    for i in range(len(e)):
        x1, y1, x2, y2 = e[i, :4]
        o = e[i + 1 :]
        o = o[(o[:, 1] < y2) & (o[:, 3] > y1)]
        if not len(o):
            continue
        s1, s2 = (x2 - x1) / (y2 - y1), (o[:, 2] - o[:, 0]) / (o[:, 3] - o[:, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            y = (o[:, 0] - x1 + s1 * y1 - s2 * o[:, 1]) / (s1 - s2)
        ok = np.isfinite(y) & (y > np.maximum(y1, o[:, 1])) & (y < np.minimum(y2, o[:, 3]))
        ys += y[ok].tolist()
    return ys


def _inside(crossings: list[tuple[float, float, float, int, int]], op: str, n: tuple[int, int]) -> list[tuple]:
    """Intervals of a slab where the boolean holds; crossings sorted by x at mid-height: (mid, lower x, upper x, set, polygon)."""
    inside = ([False] * n[0], [False] * n[1])
    count, out, open_at = [0, 0], [], None
    test = {"not": lambda a, b: a and not b, "and": lambda a, b: a and b, "or": lambda a, b: a or b, "xor": lambda a, b: a != b}[op]
    for c in crossings:
        s, p = c[3], c[4]
        inside[s][p] = not inside[s][p]
        count[s] += 1 if inside[s][p] else -1
        now = test(count[0] > 0, count[1] > 0)
        if now and open_at is None:
            open_at = c
        elif not now and open_at is not None:
            out.append((open_at, c))
            open_at = None
    return out


def boolean(a: list[Poly], b: list[Poly], op: str = "not", precision: float = 1e-9) -> list[Poly]:
    """``a op b`` (not, and, or, xor) as trapezoids; each set is the union of its polygons, each even-odd. Slabs thinner
    than ``precision`` are dropped."""
    ea, eb = _edges(a), _edges(b)
    e = np.vstack([np.column_stack([ea, np.zeros(len(ea))]), np.column_stack([eb, np.ones(len(eb))])])
    if not len(e):
        return []
    ys = np.unique(np.concatenate([e[:, 1], e[:, 3], _crossing_ys(e)]))
    out: list[Poly] = []
    for lo, hi in zip(ys[:-1], ys[1:], strict=True):
        if hi - lo <= precision:
            continue
        act = e[(e[:, 1] <= lo) & (e[:, 3] >= hi)]
        if not len(act):
            continue
        slope = (act[:, 2] - act[:, 0]) / (act[:, 3] - act[:, 1])
        xl, xh = act[:, 0] + slope * (lo - act[:, 1]), act[:, 0] + slope * (hi - act[:, 1])
        rows = sorted(zip(((xl + xh) / 2).tolist(), xl.tolist(), xh.tolist(), act[:, 5].astype(int).tolist(), act[:, 4].astype(int).tolist(), strict=True))
        for left, right in _inside(rows, op, (len(a), len(b))):
            ring = [(left[1], lo), (right[1], lo), (right[2], hi), (left[2], hi)]
            ring = [p for i, p in enumerate(ring) if p != ring[i - 1]]
            if len(ring) >= 3 and right[0] > left[0]:
                out.append(ring)
    return out


def area(polys: list[Poly]) -> float:
    """Sum of the absolute areas."""
    return float(sum(abs(sum(p[0] * q[1] - p[1] * q[0] for p, q in zip(r, r[1:] + r[:1], strict=True))) / 2 for r in polys))


def offset_convex(p: Poly, margin: float) -> Poly:
    """A convex polygon pushed out by ``margin`` with mitred corners (limit 2, beyond which the corner is cut). G4."""
    s = sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(p, p[1:] + p[:1], strict=True))
    ring = p if s > 0 else p[::-1]
    out: Poly = []
    for i in range(len(ring)):
        a, b, c = ring[i - 1], ring[i], ring[(i + 1) % len(ring)]
        u, v = np.subtract(b, a), np.subtract(c, b)
        nu, nv = np.array([u[1], -u[0]]) / np.hypot(*u), np.array([v[1], -v[0]]) / np.hypot(*v)
        k = 1 + float(nu @ nv)
        if k > 0.5:  # mitre no longer than twice the margin
            out.append(tuple(np.add(b, margin * (nu + nv) / k)))
        else:
            out += [tuple(np.add(b, margin * nu)), tuple(np.add(b, margin * nv))]
    return out


def offset(p: Poly, margin: float, mitre: float = 2.0) -> list[Poly]:
    """Any simple polygon pushed out by ``margin``, as trapezoids: the union of the polygon, the strips along its edges and
    the mitres of its convex corners (cut where longer than ``mitre`` margins). Reflex corners need none, their strips
    overlap. A polygon without area, or no margin, comes out as it is. G4."""
    ring = [q for i, q in enumerate(p) if q != p[i - 1]]
    s = sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
    if s == 0 or margin <= 0 or len(ring) < 3:
        return [list(p)]
    ring = ring if s > 0 else ring[::-1]
    n = len(ring)
    normals = []
    for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
        d = np.subtract(b, a)
        normals.append(np.array([d[1], -d[0]]) / np.hypot(*d) * margin)
    parts: list[Poly] = [ring]
    for i in range(n):
        a, b, u, v = ring[i], ring[(i + 1) % n], normals[i], normals[(i + 1) % n]
        parts.append([a, tuple(np.add(a, u)), tuple(np.add(b, u)), b])
        if u[0] * v[1] - u[1] * v[0] > 1e-12 * margin**2:  # the outline turns left: an open wedge
            k = 1 + float(u @ v) / margin**2
            tip = [tuple(np.add(b, (u + v) / k))] if k > 2 / mitre**2 else []
            parts.append([b, tuple(np.add(b, u)), *tip, tuple(np.add(b, v))])
    return boolean(parts, [], "or")


def repaired(p: Poly) -> list[Poly]:
    """A polygon made valid: repeated vertices dropped, crossings resolved by the even-odd rule, as trapezoids; nothing for
    an outline without area. G5."""
    ring = [q for i, q in enumerate(p) if q != p[i - 1] and None not in q]
    return boolean([ring], [], "or") if len(ring) >= 3 else []
