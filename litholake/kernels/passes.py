"""Detector passes after the base components (D2-D5, D7-D10, D15): seeds, bounded growth, clean-up of masks.

Each pass adds or reshapes masks of one image; what is kept of them is decided relationally. A pass is a value, so a
pipeline is a list and a test can run one alone."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from litholake.kernels.raster import dilate, geodesic, label
from litholake.operators.greedy import nms_keep


@dataclass(frozen=True)
class Peaks:
    """Local maxima of an evidence plane as components: tiny dark spots, salient spots, sparse particles, fused micro
    evidence. Per tile the best ``per_tile``, none closer than ``radius``, at most ``limit`` (the detector's own caps)."""

    reason: str
    plane: str
    least: float
    radius: float
    limit: int
    tile: int = 512
    per_tile: int = 4
    grow: float = 0.5
    steps: int = 6


@dataclass(frozen=True)
class EdgeGrowth:
    """Material along the crop's edges: seeds within ``margin`` of an edge grow through weaker evidence, a bounded number
    of steps; growth that takes in more than ``strip`` of an edge band is no defect but the frame, and is dropped."""

    reason: str
    plane: str
    seed: float
    least: float
    margin: int
    steps: int = 11
    strip: float = 0.5


#: The usual order: edges, large material, then ever smaller spots.
USUAL = (
    EdgeGrowth("kept_edge_material", "chroma_large", 8.8, 5.0, 90),
    EdgeGrowth("kept_large_material", "large", 8.8, 6.0, 10**6, steps=7, strip=0.34),
    Peaks("kept_tiny_dark", "dark_local", 11.0, 12.0, 8),
    Peaks("kept_salient_spot", "compact", 12.0, 16.0, 10),
    Peaks("kept_sparse_particle", "dark", 14.0, 26.0, 18, per_tile=2),
    Peaks("kept_multiscale_micro", "micro", 3.5, 14.0, 42),
)


def fuse(planes: dict[str, np.ndarray]) -> np.ndarray:
    """Fused micro evidence: the three strongest of the normalised planes, 1 + 0.55 + 0.25. D10."""
    scale = {"dark_local": 5.0, "dark": 5.0, "compact": 5.0, "chroma": 6.0, "large": 4.5, "chroma_large": 5.5}
    stack = np.sort(np.stack([np.clip(planes[k] / s, 0, 8) for k, s in scale.items()]), 0)
    return stack[-1] + 0.55 * stack[-2] + 0.25 * stack[-3]


def peak_masks(p: Peaks, planes: dict[str, np.ndarray], allowed: np.ndarray) -> list[np.ndarray]:
    """Masks of the pass's spots, strongest first; each grown around its peak through ``grow`` of the peak's value."""
    v = np.where(allowed, planes[p.plane], -np.inf)
    ys, xs = np.nonzero(v >= p.least)
    if not len(ys):
        return []
    order = np.lexsort((xs, ys, -v[ys, xs]))
    ys, xs = ys[order], xs[order]
    near = nms_keep(xs.astype(float), ys.astype(float), p.radius)
    tiles = (ys[near] // p.tile) * (v.shape[1] // p.tile + 1) + xs[near] // p.tile
    rank = np.zeros(len(near), int)
    for t in np.unique(tiles):
        at = np.flatnonzero(tiles == t)
        rank[at] = np.arange(len(at))
    chosen = near[np.lexsort((np.arange(len(near)), rank))][: p.limit] if (rank < p.per_tile).all() else near[[i for i in np.lexsort((np.arange(len(near)), rank)) if rank[i] < p.per_tile]][: p.limit]
    out = []
    for i in chosen:
        seed = np.zeros(v.shape, bool)
        seed[ys[i], xs[i]] = True
        y0, y1, x0, x1 = max(ys[i] - 16, 0), ys[i] + 17, max(xs[i] - 16, 0), xs[i] + 17
        part = np.zeros(v.shape, bool)
        part[y0:y1, x0:x1] = geodesic(seed[y0:y1, x0:x1], v[y0:y1, x0:x1] >= p.grow * v[ys[i], xs[i]], p.steps)
        out.append(part)
    return out


def edge_masks(p: EdgeGrowth, planes: dict[str, np.ndarray], allowed: np.ndarray) -> list[np.ndarray]:
    v, (h, w) = planes[p.plane], allowed.shape
    y, x = np.ogrid[:h, :w]
    band = (np.minimum(np.minimum(y, h - 1 - y), np.minimum(x, w - 1 - x)) <= p.margin) & allowed
    grown = geodesic((v >= p.seed) & band, (v >= p.least) & allowed, p.steps)
    labels, n = label(grown)
    out = []
    for k in range(1, n + 1):
        m = labels == k
        ys, xs = np.nonzero(m)
        if (np.ptp(xs) + 1) <= p.strip * w or (np.ptp(ys) + 1) <= p.strip * h or m.sum() / ((np.ptp(xs) + 1) * (np.ptp(ys) + 1)) > p.strip:
            out.append(m)
    return out


def run(passes: tuple, planes: dict[str, np.ndarray], taken: np.ndarray, mask: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """(reason, mask) of all passes in order; later passes see what earlier ones have taken."""
    planes = planes | ({"micro": fuse(planes)} if "micro" not in planes else {})
    out = []
    for p in passes:
        found = (peak_masks if isinstance(p, Peaks) else edge_masks)(p, planes, mask & ~taken)
        for m in found:
            out.append((p.reason, m))
            taken = taken | dilate(m, 2)
    return out


def fill_holes(m: np.ndarray, largest: int) -> np.ndarray:
    """Holes of at most ``largest`` pixels closed; larger ones are real. D15."""
    labels, n = label(~np.pad(m, 1))
    if n < 2:
        return m
    size = np.bincount(labels.ravel(), minlength=n + 1)
    close = size <= largest
    close[[0, labels[0, 0]]] = False
    return m | close[labels][1:-1, 1:-1]


def tidy(m: np.ndarray) -> np.ndarray:
    """A halo of 1, 2 or 3 pixels by area, small holes closed. D15."""
    area = int(m.sum())
    return fill_holes(dilate(m, 1 if area < 40 else 2 if area < 1000 else 3), max(12, area // 50))


def merge_adjacent(masks: list[tuple[str, np.ndarray]], gap: int = 3, share: float = 0.7) -> list[tuple[str, np.ndarray]]:
    """To a fixpoint: masks that lie by ``share`` inside a larger one vanish in it, those within ``gap`` become one with
    their reasons joined by ``+``. I6, J19."""
    work = sorted(masks, key=lambda x: -int(x[1].sum()))
    changed = True
    while changed:
        changed = False
        for i in range(len(work)):
            for j in range(len(work) - 1, i, -1):
                (r, a), (s, b) = work[i], work[j]
                if (a & b).sum() >= share * max(1, b.sum()):
                    work[i] = (r, a | b)
                elif (dilate(a, gap) & b).any():
                    work[i] = ("+".join(dict.fromkeys((r + "+" + s).split("+"))), a | b)
                else:
                    continue
                del work[j]
                changed = True
    return work
