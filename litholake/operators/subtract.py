"""Subtraction of defect polygons from design layers, shunts, and the removal report."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from litholake.functions.geometry import bounds
from litholake.kernels.clip import area, boolean
from litholake.operators.rollup import hierarchical_loss
from litholake.session import materialise

_PTS = "array<struct<x:double,y:double>>"


def _ring(pts) -> list[tuple[float, float]]:
    out = [(float(p["x"]), float(p["y"])) for p in pts if p is not None]
    return out[:-1] if len(out) > 1 and out[0] == out[-1] else out


def _doubles(c: str):
    return F.transform(c, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))


def candidates(polygons: DataFrame, cutters: DataFrame, bucket: float, keys: Sequence[str] = (), each: Sequence[str] = ()) -> DataFrame:
    """Each polygon (id, points) with the array of cutters whose boxes overlap its own. The boxes' grid cells are the
    join key; a pair counts in the cell where its overlap begins. ``each``: keys that only the cutters have; a polygon
    comes out once for each of their values, null included, that touches it."""
    def boxed(df: DataFrame, p: str, i: str, own: Sequence[str] = ()) -> DataFrame:
        d = df.select(*own, *keys, F.col(i).alias(f"{p}id"), _doubles("points").alias(f"{p}pts")).withColumn("b", bounds(F.col(f"{p}pts"))).filter("b is not null").select("*", *[F.col(f"b.{c}").alias(f"{p}{c}") for c in ("x0", "y0", "x1", "y1")]).drop("b")
        d = d.withColumn("gx", F.explode(F.sequence(F.floor(F.col(f"{p}x0") / bucket), F.floor(F.col(f"{p}x1") / bucket))))
        return d.withColumn("gy", F.explode(F.sequence(F.floor(F.col(f"{p}y0") / bucket), F.floor(F.col(f"{p}y1") / bucket))))

    a, c = boxed(polygons, "a", "id"), boxed(cutters, "c", "id", each)
    sx, sy = F.greatest("ax0", "cx0"), F.greatest("ay0", "cy0")
    hit = (F.col("ax0") < F.col("cx1")) & (F.col("cx0") < F.col("ax1")) & (F.col("ay0") < F.col("cy1")) & (F.col("cy0") < F.col("ay1")) & (F.floor(sx / bucket) == F.col("gx")) & (F.floor(sy / bucket) == F.col("gy"))
    m = a.join(c, [*keys, "gx", "gy"]).filter(hit)
    return m.groupBy(*each, *keys, "aid").agg(F.first("apts").alias("points"), F.collect_list("cpts").alias("cutters")).withColumnRenamed("aid", "id")


def cut(polygons: DataFrame, cutters: DataFrame, op: str = "not", bucket: float = 1000.0, keys: Sequence[str] = ()) -> DataFrame:
    """``polygons op cutters`` piece by piece: ``keys, id, piece_no, points, area``. G1, G3.

    Polygons that no cutter touches pass through whole (not) or vanish (and) without reaching the kernel. A polygon's
    pieces are trapezoids. The cutters gathered for one polygon are those that overlap it."""
    if op not in ("not", "and"):
        raise ValueError("op must be 'not' or 'and'")
    m = candidates(polygons, cutters, bucket, keys)
    kept = ", ".join(f"{k} {polygons.schema[k].dataType.simpleString()}" for k in keys)
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    target = pa.schema([*to_arrow_schema(polygons.select(*keys).schema), pa.field("id", pa.int64()), pa.field("piece_no", pa.int32()), pa.field("points", pa.list_(point)), pa.field("area", pa.float64())])
    schema = f"{kept + ', ' if kept else ''}id long, piece_no int, points {_PTS}, area double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                for n, piece in enumerate(boolean([_ring(r["points"])], [_ring(c) for c in r["cutters"]], op)):
                    rows.append({k: r[k] for k in keys} | {"id": r["id"], "piece_no": n, "points": [{"x": x, "y": y} for x, y in piece], "area": area([piece])})
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    pieces = m.mapInArrow(run, schema)
    if op == "and":
        return pieces
    from litholake.functions.geometry import signed_area

    rest = polygons.select(*keys, F.col("id").cast("long").alias("id"), F.lit(0).alias("piece_no"), _doubles("points").alias("points")).withColumn("area", F.abs(signed_area(F.col("points"))))
    return rest.join(m.select(*keys, "id"), [*keys, "id"], "left_anti").unionByName(pieces)


def measured(polygons: DataFrame, cutters: DataFrame, op: str, bucket: float, keys: Sequence[str], each: Sequence[str]) -> DataFrame:
    """``polygons op cutters`` in figures, for each value of the cutters' keys ``each`` by itself: ``each, keys, id, before,
    pieces, after`` of the polygons that are touched, areas before and after. The polygons are not repeated for values
    that leave them whole."""
    m = candidates(polygons, cutters, bucket, keys, each)
    own = [*each, *keys]
    target = pa.schema([*to_arrow_schema(m.select(*own).schema), pa.field("id", pa.int64()), pa.field("before", pa.float64()), pa.field("pieces", pa.int64()), pa.field("after", pa.float64())])
    schema = "".join(f"{k} {m.schema[k].dataType.simpleString()}, " for k in own) + "id long, before double, pieces long, after double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                ring = _ring(r["points"])
                got = boolean([ring], [_ring(c) for c in r["cutters"]], op)
                rows.append({k: r[k] for k in own} | {"id": r["id"], "before": area([ring]), "pieces": len(got), "after": area(got)})
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    return m.mapInArrow(run, schema)


def _on_layers(defects: DataFrame, layers: DataFrame) -> DataFrame:
    return defects.join(F.broadcast(layers))  # a few layers


def _left_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which null keys equal each other."""
    b = b.select(*[F.col(k).alias(f"_{k}") if k in on else F.col(k) for k in b.columns])
    match = F.lit(True)
    for k in on:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return a.join(b, match, "left").drop(*[f"_{k}" for k in on])


def subtract_totals(design: DataFrame, defects: DataFrame, target_layers: Sequence[int], groups: DataFrame, bucket: float = 1000.0) -> DataFrame:
    """Pieces and area of each layer as ``subtract_layers`` leaves it, for each group of defects by itself: ``groups'
    columns, layer, pieces, area``. G1.

    ``defects`` (groups' columns, id, points) hold the columns of ``groups``; a group without defects leaves the design
    unchanged. The design is totalled once, each group adds only what its defects change."""
    from litholake.functions.geometry import signed_area

    each = groups.columns
    base = design.groupBy("layer").agg(F.count("*").alias("n"), F.sum(F.abs(signed_area(F.col("points")))).alias("whole"))
    layers = design.sparkSession.createDataFrame([(int(k),) for k in target_layers], "layer int")
    m = measured(design.filter(F.col("layer").isin(list(target_layers))), _on_layers(defects, layers), "not", bucket, ["layer"], each)
    diff = m.groupBy(*each, "layer").agg(F.sum(F.col("pieces") - 1).alias("more"), F.sum(F.col("before") - F.col("after")).alias("less"))
    out = _left_join(groups.crossJoin(F.broadcast(base)), diff, [*each, "layer"])
    return out.select(*each, "layer", (F.col("n") + F.coalesce("more", F.lit(0))).alias("pieces"), (F.col("whole") - F.coalesce("less", F.lit(0.0))).alias("area"))


def subtract_layers(design: DataFrame, defects: DataFrame, target_layers: Sequence[int], bucket: float = 1000.0) -> DataFrame:
    """Design (layer, id, points) with the defects (id, points) cut from the target layers; other layers pass through.
    G1. With no defects the design comes out unchanged."""
    hit = F.col("layer").isin(list(target_layers))
    through = design.filter(~F.coalesce(hit, F.lit(False))).select("layer", F.col("id").cast("long").alias("id"), F.lit(0).alias("piece_no"), _doubles("points").alias("points"))
    cutters = _on_layers(defects, design.sparkSession.createDataFrame([(int(k),) for k in target_layers], "layer int"))
    return through.unionByName(cut(design.filter(hit), cutters, "not", bucket, ["layer"]).drop("area"))


def shunts(segments: DataFrame, pitch: float, width: float, tolerance: float = 5.0) -> DataFrame:
    """Rectangles that connect the ends of cut vertical segments (id, x0, y0, x1, y1) with the nearest segment at that
    height: ``id, end, sx0, sy0, sx1, sy1``. G2, J15.

    Both ends look left and right up to 2.5 pitches for a segment that reaches within ``tolerance`` of the end; the
    smallest |dx| above 0.1 wins, then the smallest id."""
    reach = 2.5 * pitch
    v = segments.filter("y1 - y0 > x1 - x0").withColumn("mx", (F.col("x0") + F.col("x1")) / 2)
    ends = v.select("id", "mx", F.explode(F.array(F.struct(F.lit("low").alias("end"), F.col("y0").alias("y")), F.struct(F.lit("high").alias("end"), F.col("y1").alias("y")))).alias("e")).select("id", "mx", "e.end", "e.y")
    left = ends.withColumn("g", F.explode(F.sequence(F.floor(F.col("mx") / reach) - 1, F.floor(F.col("mx") / reach) + 1)))
    other = v.select(F.col("id").alias("oid"), F.col("mx").alias("ox"), F.col("y0").alias("oy0"), F.col("y1").alias("oy1")).withColumn("g", F.floor(F.col("ox") / reach))
    dx = F.col("ox") - F.col("mx")
    m = left.join(other, "g").filter((F.abs(dx) >= 0.1) & (F.abs(dx) <= reach) & (F.col("y") >= F.col("oy0") - tolerance) & (F.col("y") <= F.col("oy1") + tolerance))
    best = m.groupBy("id", "end", "mx", "y").agg(F.min(F.struct(F.abs(dx).alias("d"), "oid", "ox")).alias("b"))
    return best.select("id", "end", F.least("mx", "b.ox").alias("sx0"), (F.col("y") - width / 2).alias("sy0"), F.greatest("mx", "b.ox").alias("sx1"), (F.col("y") + width / 2).alias("sy1"))


def subtract_protected(design: DataFrame, defects: DataFrame, layer: int, pitch: float, width: float, tolerance: float = 5.0, bucket: float = 1000.0) -> DataFrame:
    """The layer (id, points) with its fingers cut by the defects (id, points) and bridged, its borders left whole: ``kind``
    (``border``, ``finger``, ``shunt``), ``id, piece_no, points``. G2, P9, J15.

    The cut pieces of a finger are put together along its height; each end that a cut has made is bridged to the nearest
    finger at that height, and what of the bridge lies within a defect is cut off. Fingers that no defect touches come
    out as they are; degenerate outlines count as borders. Empty defects leave the layer unchanged."""
    from litholake.functions.geometry import bounds
    from litholake.operators.fingers import finger_or_border

    mine = design.filter(F.col("layer") == layer).select("layer", F.col("id").cast("long").alias("id"), "points").withColumn("b", bounds(F.col("points")))
    sorted_out = finger_or_border(mine.select("*", "b.x0", "b.y0", "b.x1", "b.y1"), ["layer"])
    parts = materialise(sorted_out.withColumn("kind", F.coalesce("kind", F.lit("border"))).drop("b"), "kinds")
    cutters = defects.select(F.lit(layer).alias("layer"), "id", "points")
    fingers = parts.filter("kind = 'finger'")
    pieces = materialise(cut(fingers.select("layer", "id", "points"), cutters, "not", bucket, ["layer"]), "pieces")
    box = pieces.withColumn("b", bounds(F.col("points"))).select("id", "b.x0", "b.y0", "b.x1", "b.y1")
    along = Window.partitionBy("id").orderBy("y0", "y1")  # the pieces of one finger
    far = F.max("y1").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = box.withColumn("fresh", F.coalesce((F.col("y0") > far + 1e-6).cast("int"), F.lit(0))).withColumn("run", F.sum("fresh").over(along))
    segments = runs.groupBy("id", "run").agg(*[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    segments = materialise(segments.withColumn("seg", F.concat_ws("-", "id", "run")), "segments")
    whole = fingers.select("id", F.col("y0").alias("oy0"), F.col("y1").alias("oy1"))
    made = segments.join(whole, "id").select(F.col("seg").alias("id"), F.explode(F.array_compact(F.array(F.when(F.col("y0") > F.col("oy0") + 1e-6, "low"), F.when(F.col("y1") < F.col("oy1") - 1e-6, "high")))).alias("end"))
    bridges = shunts(segments.select(F.col("seg").alias("id"), "x0", "y0", "x1", "y1"), pitch, width, tolerance).join(made, ["id", "end"])
    pt = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    bridges = bridges.distinct().select(F.lit(layer).alias("layer"), F.xxhash64("id", "end").alias("id"), F.array(pt("sx0", "sy0"), pt("sx1", "sy0"), pt("sx1", "sy1"), pt("sx0", "sy1")).alias("points"))
    clipped = cut(bridges, cutters, "not", bucket, ["layer"])
    out = lambda df, kind: df.select(F.lit(kind).alias("kind"), "id", F.col("piece_no").cast("int").alias("piece_no"), "points")
    borders = parts.filter("kind = 'border'").select("id", F.lit(0).alias("piece_no"), _doubles("points").alias("points"))
    return out(borders, "border").unionByName(out(pieces, "finger")).unionByName(out(clipped, "shunt"))


def removal_report(original: DataFrame, final: DataFrame, devices: DataFrame, bucket: float = 1000.0) -> DataFrame:
    """Loss per layer, device and in all (A7): areas of the original and the final polygons (layer, id, points) within
    each device's window (device, points)."""
    win = materialise(devices.select(F.col("device"), F.monotonically_increasing_id().alias("id"), "points"), "windows")  # numbered once
    layers = original.select("layer").distinct()
    names = win.select("id", "device")
    w = win.drop("device").join(F.broadcast(layers))  # layers of a design are few

    def within(polys: DataFrame, out: str) -> DataFrame:
        numbered = polys.select("layer", F.monotonically_increasing_id().alias("pid"), "points")
        p = cut(w.select("layer", "id", "points"), numbered.select("layer", F.col("pid").alias("id"), "points"), "and", bucket, ["layer"])
        return p.groupBy("layer", "id").agg(F.sum("area").alias(out))

    both = w.select("layer", "id").join(within(original, "before"), ["layer", "id"], "left").join(within(final, "after"), ["layer", "id"], "left").join(names, "id")
    lost = both.withColumn("lost", F.greatest(F.coalesce("before", F.lit(0.0)) - F.coalesce("after", F.lit(0.0)), F.lit(0.0)))
    return hierarchical_loss(lost, ["device", "layer"], "before", "lost")


def removal_by_group(original: DataFrame, defects: DataFrame, devices: DataFrame, groups: DataFrame, bucket: float = 1000.0) -> DataFrame:
    """``removal_report`` of the design (layer, id, points) after all its layers were cut by the defects of one group, for
    each group by itself: ``groups' columns, depth, device, layer, ...``; depth 0 is a group as a whole. A7, G3.

    ``defects`` (groups' columns, id, points) hold the columns of ``groups``; a group without defects loses nothing. What
    lies within the devices is found once, as disjoint pieces; a group loses their overlap with its defects."""
    each = groups.columns
    win = materialise(devices.select("device", F.monotonically_increasing_id().alias("id"), "points"), "windows")
    layers = original.select("layer").distinct()
    w = win.drop("device").join(F.broadcast(layers))  # layers of a design are few
    inside = cut(w.select("layer", "id", "points"), original.select("layer", "id", "points"), "and", bucket, ["layer"])
    inside = materialise(inside.select("layer", F.col("id").alias("window"), F.monotonically_increasing_id().alias("id"), "points", "area"), "inside")
    before = w.select("layer", "id").join(inside.groupBy("layer", F.col("window").alias("id")).agg(F.sum("area").alias("before")), ["layer", "id"], "left").join(win.select("id", "device"), "id")
    m = measured(inside, _on_layers(defects, layers), "and", bucket, ["layer"], each).select(*each, "id", F.col("after").alias("gone"))
    lost = m.join(inside.select("id", "layer", "window"), "id").groupBy(*each, "layer", F.col("window").alias("id")).agg(F.sum("gone").alias("lost"))
    both = _left_join(groups.crossJoin(F.broadcast(before)), lost, [*each, "layer", "id"])  # as many rows as devices and layers
    out = hierarchical_loss(both, [*each, "device", "layer"], "before", "lost")
    return out.filter(F.col("depth") >= len(each)).withColumn("depth", F.col("depth") - len(each))
