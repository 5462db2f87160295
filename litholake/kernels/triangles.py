"""Ear clipping of simple polygons and box hierarchies over their triangles."""

from __future__ import annotations

import numpy as np


def _cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _crossings(ring: np.ndarray) -> bool:
    """Whether two edges of a ring cross properly (touching doesn't count). Edges are met in the order of their left end."""
    a, b = ring, np.roll(ring, -1, axis=0)
    left, right = np.minimum(a[:, 0], b[:, 0]), np.maximum(a[:, 0], b[:, 0])
    order = np.argsort(left, kind="stable")
    a, b, left, right = a[order], b[order], left[order], right[order]
    ends = np.searchsorted(left, right, "right")  # edge i may meet edges i + 1 .. ends[i] - 1
    side = lambda p, q, r: (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
    at, n = 0, len(a)
    while at < n:
        upto = at + 1
        many = int(ends[at] - at - 1)
        while upto < n and many + ends[upto] - upto - 1 < 1 << 18:
            many += int(ends[upto] - upto - 1)
            upto += 1
        lengths = ends[at:upto] - np.arange(at, upto) - 1
        i = np.repeat(np.arange(at, upto), lengths)
        j = np.arange(len(i)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + i + 1
        low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
        near = (low[i] < high[j]) & (low[j] < high[i])
        i, j = i[near], j[near]
        sign = lambda *p: np.sign(side(*p))
        if ((sign(a[i], b[i], a[j]) * sign(a[i], b[i], b[j]) < 0) & (sign(a[j], b[j], a[i]) * sign(a[j], b[j], b[i]) < 0)).any():
            return True
        at = upto
    return False


def ear_clip(points: list[tuple]) -> tuple[list[tuple], bool]:
    """Triangles that cover exactly the polygon with this outline; and whether they are a fan.

    Either orientation, open or closed rings, repeated and collinear vertices are fine. An outline that encloses no area
    gives no triangle. Where the outline doubles back on itself (a spike without width) a flat triangle keeps the spike,
    since it belongs to the outline. An outline that crosses itself has no triangulation on its own vertices: it gives a fan
    from its first vertex, of which the even-odd rule counts those that hold a point. Integers below 2**30 are exact.

    Ears wait in a queue: cutting one concerns only its two neighbours. Only reflex vertices can lie in an ear."""
    ring = [p for i, p in enumerate(points) if p != points[i - 1]] if len(points) > 1 else list(points)
    if len(ring) < 3:
        return [], False
    area = sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
    if area == 0:
        return [], False
    whole = all(isinstance(c, int) for p in ring for c in p)
    xy = np.array(ring, np.int64 if whole else float)
    if _crossings(xy):
        return [(ring[0], p, q) for p, q in zip(ring[1:], ring[2:], strict=False)], True
    if area < 0:
        ring, xy = ring[::-1], xy[::-1].copy()
    n = left = len(ring)
    prev, after, alive = [i - 1 for i in range(n)], [(i + 1) % n for i in range(n)], [True] * n
    prev[0] = n - 1
    turn = [_cross(ring[prev[i]], ring[i], ring[after[i]]) for i in range(n)]
    blocking = np.array([t <= 0 for t in turn])
    flat, ears = [i for i in range(n) if turn[i] == 0], [i for i in range(n) if turn[i] > 0]
    out: list[tuple] = []

    def is_ear(i: int) -> bool:
        a, b, c = ring[prev[i]], ring[i], ring[after[i]]
        at = np.flatnonzero(blocking)
        p = xy[at]
        inside = np.ones(len(at), bool)
        for o, q in ((a, b), (b, c), (c, a)):
            inside &= (q[0] - o[0]) * (p[:, 1] - o[1]) - (q[1] - o[1]) * (p[:, 0] - o[0]) >= 0
        return all(ring[k] in (a, b, c) for k in at[inside].tolist())

    def cut(i: int) -> None:
        nonlocal left
        alive[i], blocking[i] = False, False
        left -= 1
        p, q = prev[i], after[i]
        after[p], prev[q] = q, p
        if ring[p] == ring[q] and left > 2:  # the two ends of a cut-off spike are one vertex
            cut(q)
            return
        for k in (p, q):
            turn[k] = _cross(ring[prev[k]], ring[k], ring[after[k]])
            blocking[k] = turn[k] <= 0
            (flat if turn[k] == 0 else ears).append(k)

    waiting: list[int] = []
    while left > 3:
        i = None
        while flat and i is None:  # straight on, or a spike; first of all, since a spike's foot would pass for an ear
            k = flat.pop()
            i = k if alive[k] and turn[k] == 0 else None
        if i is not None:
            a, b, c = ring[prev[i]], ring[i], ring[after[i]]
            if (a[0] - b[0]) * (c[0] - b[0]) + (a[1] - b[1]) * (c[1] - b[1]) > 0:
                out.append((a, b, c))
            cut(i)
            ears, waiting = waiting + ears, []
            continue
        while ears and i is None:
            k = ears.pop()
            if alive[k] and turn[k] > 0:
                if is_ear(k):
                    i = k
                else:
                    waiting.append(k)
        if i is None:  # touching parts: cut the corner with the least area, so that the work ends
            i = min((k for k in range(n) if alive[k]), key=lambda k: abs(turn[k]))
        out.append((ring[prev[i]], ring[i], ring[after[i]]))
        cut(i)
        if not ears and not flat:
            ears, waiting = waiting, []
    rest = [ring[k] for k in range(n) if alive[k]]
    if len(rest) == 3:
        out.append(tuple(rest))
    return out, False


def morton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Interleaved bits of two arrays of non-negative integers below 2**31."""

    def spread(v: np.ndarray) -> np.ndarray:
        v = v.astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = (v | (v << np.uint64(shift))) & np.uint64(mask)
        return v

    return (spread(x) | (spread(y) << np.uint64(1))).astype(np.int64)


class BoxTree:
    """A bounding-volume hierarchy over boxes that come in a spatial order (Morton): an implicit binary tree."""

    def __init__(self, boxes: np.ndarray):
        self.n = len(boxes)
        size = 1
        while size < max(1, self.n):
            size *= 2
        self.size = size
        tree = np.full((2 * size, 4), np.inf)
        tree[:, 2:] = -np.inf
        tree[size : size + self.n] = boxes
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
        self.tree = tree

    def stab(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, box) pairs of every box that holds a point, edges included; all points descend together."""
        p, node = np.arange(len(x)), np.ones(len(x), np.int64)
        while len(p):
            box = self.tree[node]
            hit = (x[p] >= box[:, 0]) & (y[p] >= box[:, 1]) & (x[p] <= box[:, 2]) & (y[p] <= box[:, 3])
            p, node = p[hit], node[hit]
            if not len(p) or node[0] >= self.size:  # all nodes of a round lie on one level
                break
            p, node = np.repeat(p, 2), np.repeat(node * 2, 2)
            node[1::2] += 1
        return p, node - self.size
