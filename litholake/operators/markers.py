"""Marker lattices and registration.

Candidate squares, lattice hypotheses and their acceptance are relational; only the one-to-one matching of a hypothesis
is sequential (twelve points). Geometry of the marker: 3 columns x 4 rows of equal squares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litholake.functions.fits import similarity_fit
from litholake.operators.greedy import greedy_match
from litholake.operators.rollup import reasons

COLUMNS, ROWS = 3, 4
#: Devices in each of the ten rows of the design.
ROW_SHAPE = (4, 6, 8, 10, 10, 10, 10, 8, 6, 4)


def device_cells(boxes: DataFrame, radius: Column) -> DataFrame:
    """Boxes of device size (3,000 to 15,000 microns both ways) whose centre lies within 1.02 radii; of boxes with equal
    rounded centres the last one stays. P1, G7, L1."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    d = boxes.filter(w.between(3000, 15000) & h.between(3000, 15000) & (F.hypot(cx, cy) <= 1.02 * radius)).withColumns({"cx": cx, "cy": cy})
    return d.groupBy(F.bround("cx", 1).alias("__x"), F.bround("cy", 1).alias("__y")).agg(F.max_by(F.struct(*d.columns), "element_index").alias("r")).select("r.*")


def row_shape_is_valid(cells: DataFrame, shape: Sequence[int] = ROW_SHAPE) -> DataFrame:
    """One row: whether the numbered cells (cell_row) have the expected devices in each row. L1, W3."""
    want = cells.sparkSession.createDataFrame([(i, n) for i, n in enumerate(shape, 1)], "cell_row int, want int")
    got = cells.groupBy("cell_row").agg(F.count("*").alias("got"))
    return want.join(got, "cell_row", "full").agg(F.min(F.coalesce((F.col("want") == F.col("got")), F.lit(False))).alias("valid"), F.sum(F.coalesce("got", F.lit(0))).alias("cells"))


def square_candidates(shapes: DataFrame, expected: float, limit: int = 280) -> DataFrame:
    """Shapes (image, shape_id, w, h, area) that may be squares, per image the ``limit`` closest in size. P12, O5."""
    w, h = F.col("w"), F.col("h")
    side = F.sqrt(w * h)
    ok = (w / h).between(0.62, 1.60) & (F.col("area") / (w * h)).between(0.14, 1.0) & (side / expected).between(0.35, 3.0)
    d = shapes.filter((w > 0) & (h > 0)).filter(ok).withColumn("off", F.abs(F.log(side / expected)))
    n = F.row_number().over(Window.partitionBy("image").orderBy("off", "shape_id"))
    return d.withColumn("__n", n).filter(F.col("__n") <= limit).drop("__n", "off")


def template(pitch: float = 1.0) -> list[tuple[int, float, float]]:
    """Slots of the lattice around its centre."""
    return [(r * COLUMNS + c, (c - (COLUMNS - 1) / 2) * pitch, (r - (ROWS - 1) / 2) * pitch) for r in range(ROWS) for c in range(COLUMNS)]


def lattice_hypotheses(squares: DataFrame, pitch: float, spread: float = 0.35) -> DataFrame:
    """Similarity hypotheses from ordered pairs of squares (image, shape_id, x, y) about one pitch apart, placed on every
    horizontally neighbouring pair of slots: ``image, hypothesis, ax, ay, ux, uy, slot``. L4.

    Pairs meet through grid cells of the largest distance, not as a product of all squares."""
    reach = pitch * (1 + spread)
    a = squares.select("image", F.col("shape_id").alias("i"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    a = a.withColumn("gx", F.explode(F.sequence(F.floor(F.col("ax") / reach) - 1, F.floor(F.col("ax") / reach) + 1))).withColumn("gy", F.explode(F.sequence(F.floor(F.col("ay") / reach) - 1, F.floor(F.col("ay") / reach) + 1)))
    b = squares.select("image", F.col("shape_id").alias("j"), F.col("x").alias("bx"), F.col("y").alias("by"), F.floor(F.col("x") / reach).alias("gx"), F.floor(F.col("y") / reach).alias("gy"))
    d = F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    pairs = a.join(b, ["image", "gx", "gy"]).filter((F.col("i") != F.col("j")) & d.between(pitch * (1 - spread), reach))
    slots = [s for s, _, _ in template() if s % COLUMNS < COLUMNS - 1]
    return pairs.select("image", "i", "j", "ax", "ay", (F.col("bx") - F.col("ax")).alias("ux"), (F.col("by") - F.col("ay")).alias("uy"), F.explode(F.array(*[F.lit(s) for s in slots])).alias("slot")).withColumn("hypothesis", F.concat_ws("-", "i", "j", "slot"))


def match_lattice(squares: DataFrame, hypotheses: DataFrame, tolerance: float, least: int = 8) -> DataFrame:
    """The best hypothesis of each image: most matches, then smallest rms error: ``image, hypothesis, matches, scale,
    angle, tx, ty, rmsd``. J10, O6. Matching is greedy and one to one within a hypothesis."""
    slots = squares.sparkSession.createDataFrame(template(), "s int, px double, py double")
    h = hypotheses.withColumn("k", F.col("slot"))
    dx = (F.col("px") + (COLUMNS - 1) / 2 - F.pmod("k", F.lit(COLUMNS)), F.col("py") + (ROWS - 1) / 2 - F.floor(F.col("k") / COLUMNS))
    want = h.join(F.broadcast(slots))  # twelve slots
    want = want.select("image", "hypothesis", F.col("s"), "px", "py", (F.col("ax") + dx[0] * F.col("ux") - dx[1] * F.col("uy")).alias("x"), (F.col("ay") + dx[0] * F.col("uy") + dx[1] * F.col("ux")).alias("y"))
    have = hypotheses.select("image", "hypothesis").join(squares.select("image", "shape_id", "x", "y"), "image")
    m = greedy_match(want, have, ["image", "hypothesis"], "s", "shape_id", tolerance)
    pts = m.join(want.select("image", "hypothesis", "s", "px", "py"), ["image", "hypothesis", "s"]).join(squares.select("image", "shape_id", F.col("x").alias("qx"), F.col("y").alias("qy")), ["image", "shape_id"])
    fit = similarity_fit(pts, ["image", "hypothesis"], "px", "py", "qx", "qy").filter(F.col("n") >= least)
    return fit.groupBy("image").agg(F.max_by(F.struct("hypothesis", F.col("n").alias("matches"), "scale", "angle", "tx", "ty", "rmsd"), F.struct(F.col("n"), -F.bround("rmsd", 6), F.col("hypothesis"))).alias("r")).select("image", "r.*")


def rejection(expected_pitch: float) -> Column:
    """Why a fitted lattice (matches, scale, rmsd, size_ratio, size_cv) is not accepted; empty means valid. The
    columns are those of ``candidate_metrics``. P13."""
    return reasons(
        ("fewer than 10 of 12 squares", F.col("matches") < 10),
        ("error above 10 % of the pitch", F.col("rmsd") > 0.10 * F.col("scale")),
        ("square to pitch ratio", ~F.col("size_ratio").between(0.35, 0.75)),
        ("uneven sizes", F.col("size_cv") > 0.25),
        ("pitch", ~(F.col("scale") / expected_pitch).between(0.65, 1.45)),
    )


def consistent(radius: float, separation: float) -> Column:
    """Whether a left and a right lattice (l_*, r_*) may belong to one wafer. J12."""
    turn = F.abs(F.pmod(F.degrees(F.col("l_angle") - F.col("r_angle")) + 90, F.lit(180.0)) - 90)
    ratio = lambda c: F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) / F.greatest(F.col(f"l_{c}"), F.col(f"r_{c}"))
    apart = F.hypot(F.col("l_tx") - F.col("r_tx"), F.col("l_ty") - F.col("r_ty"))
    off = F.hypot(F.col("l_tx") + F.col("r_tx"), F.col("l_ty") + F.col("r_ty")) / 2
    return (turn <= 10) & (ratio("scale") <= 0.20) & (off <= F.greatest(15 * F.col("l_scale"), F.lit(0.055 * radius))) & (F.abs(apart - separation) <= 0.18 * separation)


def registration(points: DataFrame, key: str = "wafer_id", centre_weight: int = 6) -> DataFrame:
    """Final similarity from marker points (key, x, y, u, v, is_centre), centres counting ``centre_weight`` times. L8."""
    many = points.withColumn("__k", F.explode(F.sequence(F.lit(1), F.when(F.col("is_centre"), F.lit(centre_weight)).otherwise(F.lit(1)))))
    return similarity_fit(many, [key], "x", "y", "u", "v")


def first_source(*sources: tuple[str, Column]) -> tuple[Column, Column]:
    """The first result that is there, and its label: raw tiles, compact detector, prediction. L12, B14."""
    value = F.coalesce(*[c for _, c in sources])
    label = F.lit("none")
    for name, c in reversed(sources):
        label = F.when(c.isNotNull(), name).otherwise(label)
    return value, label


def candidate_metrics(fits: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fits (keys, scale, angle, rmsd) with the measures of their squares (keys, side, error): ``size_ratio`` (median side to
    pitch), ``size_cv`` (spread of sides to their mean), ``error_ratio`` (rms error to pitch), ``asymmetry`` (largest to median
    error) and ``turn`` (angle in degrees, modulo 180, from -90 on). A24. A fit without squares gets nulls."""
    m = members.groupBy(*keys).agg(F.median("side").alias("__s"), F.stddev_pop("side").alias("__sd"), F.avg("side").alias("__m"), F.max("error").alias("__e"), F.median("error").alias("__me"))
    turn = F.pmod(F.degrees("angle") + 90, F.lit(180.0)) - 90
    return fits.join(m, list(keys), "left").withColumns({"size_ratio": F.try_divide(F.col("__s"), F.col("scale")), "size_cv": F.try_divide(F.col("__sd"), F.col("__m")), "error_ratio": F.try_divide(F.col("rmsd"), F.col("scale")), "asymmetry": F.try_divide(F.col("__e"), F.col("__me")), "turn": turn}).drop("__s", "__sd", "__m", "__e", "__me")


def side_of_rail(pixels: DataFrame, anchors: DataFrame, key: str, pitch_share: float = 1.0) -> DataFrame:
    """``key, side``: on which side of a marker its rail lies, by the mask's pixels (key, x, y) about the anchor (key, ax, ay,
    angle, pitch) in the marker's own frame. L5.

    Pixels within ``pitch_share`` pitches of the marker's axis are no evidence. Left and right are told by the majority;
    equal counts, or none, give null."""
    j = pixels.join(anchors, key)
    u = (F.col("x") - F.col("ax")) * F.cos("angle") + (F.col("y") - F.col("ay")) * F.sin("angle")
    n = j.groupBy(key).agg(F.count_if(u < -pitch_share * F.col("pitch")).alias("l"), F.count_if(u > pitch_share * F.col("pitch")).alias("r"))
    side = F.when(F.col("l") > F.col("r"), "left").when(F.col("r") > F.col("l"), "right")
    return anchors.select(key).distinct().join(n, key, "left").select(key, side.alias("side"))
