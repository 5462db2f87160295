"""Order-dependent choices within one image or hypothesis.

A group is one image, tile or hypothesis: bounded by the detector's own candidate limits, not by the table. The kernels
are NumPy functions over a sorted group; everything around them stays relational."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_group(df: DataFrame, keys: Sequence[str], order: Sequence, columns: Sequence[str], kernel: Callable[..., np.ndarray]) -> DataFrame:
    """The rows of each group whose positions ``kernel(*columns)`` returns, given the group's sorted column values.

    Sorted groups stream through a partition; all groups of a batch are cut out by one comparison of neighbouring keys
    and their survivors by one take, so many small groups cost little. Only a group that is still open is carried over."""
    k = list(keys)

    def choose(t: pa.Table, bounds: np.ndarray) -> pa.Table:
        values = [t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in columns]
        keep = [np.array([s]) if e - s == 1 else s + kernel(*(v[s:e] for v in values)) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        return t.take(pa.array(np.concatenate(keep))) if keep else t.slice(0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            new = np.zeros(t.num_rows, bool)
            new[0] = True
            for c in k:
                v = t[c].combine_chunks()
                left, right = v[:-1], v[1:]
                differs = pc.fill_null(pc.not_equal(left, right), False).to_numpy(zero_copy_only=False) | (pc.is_null(left).to_numpy(zero_copy_only=False) != pc.is_null(right).to_numpy(zero_copy_only=False))
                new[1:] |= differs
            starts = np.flatnonzero(new)
            if len(starts) > 1:
                yield from choose(t, starts).to_batches()
            held = t.slice(int(starts[-1]))
        if held is not None:
            yield from choose(held, np.array([0, held.num_rows])).to_batches()

    d = df.repartition(*k) if k else df.coalesce(1)
    return d.sortWithinPartitions(*[F.col(c) for c in k], *order).mapInArrow(run, df.schema)


def nms_keep(x: np.ndarray, y: np.ndarray, radius: float, limit: int | None = None) -> np.ndarray:
    """Positions kept when points, in the given order, suppress later ones closer than ``radius``; hashed by cells."""
    cells: dict[tuple[int, int], list[int]] = {}
    kept = []
    for i in range(len(x)):
        cx, cy = int(np.floor(x[i] / radius)), int(np.floor(y[i] / radius))
        clash = any((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 < radius * radius for dx in (-1, 0, 1) for dy in (-1, 0, 1) for j in cells.get((cx + dx, cy + dy), ()))
        if not clash:
            kept.append(i)
            cells.setdefault((cx, cy), []).append(i)
            if limit and len(kept) >= limit:
                break
    return np.array(kept, np.int64)


def nms_peaks(df: DataFrame, keys: Sequence[str], x: str, y: str, score: str, order: str, radius: float, limit: int | None = None) -> DataFrame:
    """Peaks by descending score (ties by ``order``), none closer than ``radius`` to a better one. W14, G8."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return _by_group(d, keys, [F.col(score).desc(), F.col(order)], [x, y], lambda gx, gy: nms_keep(gx.astype(float), gy.astype(float), radius, limit))


def stratified_peaks(df: DataFrame, image: Sequence[str], x: str, y: str, score: str, order: str, tile: float, per_tile: int, radius: float, limit: int) -> DataFrame:
    """Per tile the best ``per_tile`` peaks, then round-robin over the tiles by rank, global suppression and limit. W15.

    Tile ranks are native (Spark prunes to ``per_tile`` rows before the shuffle); only the few survivors of an image go
    through the sequential step."""
    t = df.withColumn("__tx", F.floor(F.col(x) / tile)).withColumn("__ty", F.floor(F.col(y) / tile))
    near = nms_peaks(t, [*image, "__tx", "__ty"], x, y, score, order, radius, per_tile)
    w = Window.partitionBy(*image, "__tx", "__ty").orderBy(F.col(score).desc(), order)
    ranked = near.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= per_tile)
    out = _by_group(ranked, image, [F.col("__rank"), F.col(score).desc(), F.col(order)], [x, y], lambda gx, gy: nms_keep(gx.astype(float), gy.astype(float), radius, limit))
    return out.drop("__tx", "__ty", "__rank")


def greedy_pairs(d: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """One-to-one matches: candidates in order of (distance, i, j), each taken if both ends are free."""
    taken_i, taken_j, keep = set(), set(), []
    for k in np.lexsort((j, i, d)):
        if i[k] not in taken_i and j[k] not in taken_j:
            taken_i.add(i[k])
            taken_j.add(j[k])
            keep.append(k)
    return np.array(keep, np.int64)


def greedy_match(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str, tolerance: float) -> DataFrame:
    """Greedy one-to-one matching of points (x, y) within ``tolerance``, per group: ``left_id, right_id, distance``. J10."""
    cell = lambda p, c: F.floor(F.col(f"{p}{c}") / tolerance)
    l_ = left.select(*keys, left_id, F.col("x").alias("lx"), F.col("y").alias("ly")).withColumn("n", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])))
    l_ = l_.select(*keys, left_id, "lx", "ly", (cell("l", "x") + F.col("n.a")).alias("cx"), (cell("l", "y") + F.col("n.b")).alias("cy"))
    r_ = right.select(*keys, right_id, F.col("x").alias("rx"), F.col("y").alias("ry")).withColumns({"cx": cell("r", "x"), "cy": cell("r", "y")})
    c = l_.join(r_, [*keys, "cx", "cy"]).withColumn("distance", F.hypot(F.col("lx") - F.col("rx"), F.col("ly") - F.col("ry"))).filter(F.col("distance") <= tolerance).select(*keys, left_id, right_id, "distance")
    return _by_group(c, keys, [F.col("distance"), F.col(left_id), F.col(right_id)], ["distance", left_id, right_id], greedy_pairs)


def suppress_overlaps(boxes: np.ndarray, share: float) -> np.ndarray:
    """Boxes (x0, y0, x1, y1) kept in order when later ones covering ``share`` of the smaller area are dropped."""
    kept: list[int] = []
    area = (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])
    for i in range(len(boxes)):
        b = boxes[i]
        k = np.array(kept, np.int64)
        w = np.minimum(b[2], boxes[k, 2]) - np.maximum(b[0], boxes[k, 0])
        h = np.minimum(b[3], boxes[k, 3]) - np.maximum(b[1], boxes[k, 1])
        inter = np.maximum(w, 0) * np.maximum(h, 0)
        if not (inter >= share * np.maximum(np.minimum(area[i], area[k]), 1e-12)).any():
            kept.append(i)
    return np.array(kept, np.int64)


def suppress_duplicates(df: DataFrame, keys: Sequence[str], score: str, area: str, order: str, share: float = 0.7) -> DataFrame:
    """Boxes (columns x0, y0, x1, y1) by descending score and area; one that overlaps a better one by ``share`` of the
    smaller area is dropped. J18."""
    return _by_group(df, keys, [F.col(score).desc(), F.col(area).desc(), F.col(order)], ["x0", "y0", "x1", "y1"], lambda *c: suppress_overlaps(np.column_stack(c).astype(float), share))
