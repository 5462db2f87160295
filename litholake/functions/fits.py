"""Closed-form fits as aggregates (A10-A15): one pass of sums per group, no iteration over rows, no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litholake.functions.robust import medians_by_bisection
from litholake.session import discard, materialise


def _det3(a: Sequence[Column], b: Sequence[Column], c: Sequence[Column]) -> Column:
    return a[0] * (b[1] * c[2] - b[2] * c[1]) - a[1] * (b[0] * c[2] - b[2] * c[0]) + a[2] * (b[0] * c[1] - b[1] * c[0])


def _solve3(m: Sequence[Sequence[Column]], r: Sequence[Column]) -> list[Column]:
    """Cramer's rule for a symmetric 3 x 3 system; null for a singular one."""
    det = _det3(*m)
    out = []
    for k in range(3):
        rows = [[r[i] if j == k else m[i][j] for j in range(3)] for i in range(3)]
        out.append(F.try_divide(_det3(*rows), det))
    return out


def _line_of(d: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Line of rows ``x, y, w`` per group: ``n, slope, intercept`` and the aggregates in ``more``, in one pass."""
    s = d.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("w").alias("sw"), F.sum(F.expr("w*x")).alias("sx"), F.sum(F.expr("w*y")).alias("sy"), F.sum(F.expr("w*x*x")).alias("sxx"), F.sum(F.expr("w*x*y")).alias("sxy"), *more)
    det = F.expr("sw*sxx - sx*sx")
    slope = F.when(F.abs(det) > 1e-12, F.expr("sw*sxy - sx*sy") / F.when(F.abs(det) > 1e-12, det))
    s = s.withColumns({"slope": slope, "intercept": (F.col("sy") - slope * F.col("sx")) / F.col("sw")})
    return s.drop("sw", "sx", "sy", "sxx", "sxy")


def line_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, weight: str | None = None) -> DataFrame:
    """Least-squares line per group: ``n, slope, intercept``; with ``weight`` each row counts accordingly. A11.

    Rows with a null are left out; fewer than two distinct x give a null line."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), w.alias("w")).dropna(subset=["x", "y", "w"])
    return _line_of(d, keys).select(*keys, "n", "slope", "intercept")


def trimmed_line_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, rounds: int = 5, least_rows: int = 8, floor: float = 1.5, factor: float = 2.8 * 1.4826) -> DataFrame:
    """Line fit with residuals beyond ``max(floor, factor * MAD)`` trimmed in each of a fixed number of rounds; a group
    stops losing rows when fewer than ``least_rows`` would stay. A11, I5.

    The rows are written once to the shared folder, with a number for their group; of each round only its line, middle and
    limit per group are kept, from which every pass tells the rows that are left. So nothing of a group's size meets in one
    task, and groups may have any size. A round in which no group loses a row would repeat itself, so the rounds end there.
    Null keys are left out."""
    on, g, nan = list(keys), ["group_no"], F.lit(float("nan"))
    groups = materialise(df.select(*on).distinct().withColumn("group_no", F.monotonically_increasing_id()), "groups")
    d = df.select(*on, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(subset=["x", "y"])
    d = materialise(d.join(groups, on).select("group_no", "x", "y"), "points")
    extremes = [f(c).alias(c + e) for c in "xy" for e, f in (("lo", F.min), ("hi", F.max))]
    line = ["n", "slope", "intercept", "xlo", "xhi", "ylo", "yhi"]
    s = materialise(_line_of(d.withColumn("w", F.lit(1.0)), g, *extremes), "lines")
    past: list[str] = []

    def off(k: int | str) -> Column:
        return F.abs(F.col("y") - F.col(f"slope{k}") * F.col("x") - F.col(f"intercept{k}") - F.col(f"middle{k}"))

    def left(s: DataFrame, rounds: int) -> DataFrame:
        rows = d.withColumn("w", F.lit(1.0)).join(s, g)
        for k in range(rounds):  # a limit of NaN keeps all
            rows = rows.filter(F.coalesce(off(k) <= F.col(f"limit{k}"), F.lit(True)))
        return rows

    for k in range(rounds):
        tilt = [F.col("slope") * F.col(c) for c in ("xlo", "xhi")]
        s = s.withColumns({"lo": F.col("ylo") - F.greatest(*tilt) - F.col("intercept"), "hi": F.col("yhi") - F.least(*tilt) - F.col("intercept")})
        middle = medians_by_bisection(left(s, k).withColumn("v", F.expr("y - slope * x - intercept")), g, "v", s)
        this = {f"slope{k}": F.col("slope"), f"intercept{k}": F.col("intercept"), f"middle{k}": F.col("median"), "top": F.greatest(F.abs(F.col("lo") - F.col("median")), F.abs(F.col("hi") - F.col("median")))}
        s = materialise(s.join(middle, g, "left").withColumns(this).drop("median", "lo", "hi"), "middles")
        ends = s.select(*g, "n", F.lit(0.0).alias("lo"), F.col("top").alias("hi"))
        mad = medians_by_bisection(left(s, k).withColumn("v", off(k)), g, "v", ends).select(*g, F.greatest(F.col("median") * factor, F.lit(floor)).alias(f"limit{k}"))
        s = materialise(s.join(mad, g, "left").drop("top"), "limits")
        new = _line_of(left(s.filter(F.col(f"limit{k}").isNotNull()), k + 1), g, *extremes).withColumnsRenamed({c: f"new_{c}" for c in line})
        loses = F.coalesce((F.col("new_n") >= least_rows) & (F.col("new_n") < F.col("n")), F.lit(False))
        past += [f"{c}{k}" for c in ("slope", "intercept", "middle")]
        after = [F.when(loses, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in line]
        limits = [f"limit{j}" for j in range(k)]
        s = materialise(s.join(new, g, "left").select(*g, *after, *past, *limits, F.when(loses, F.col(f"limit{k}")).otherwise(nan).alias(f"limit{k}"), loses.alias("lost")), "lines")
        if s.filter("lost").isEmpty():
            break
        s = s.drop("lost")
    discard(d)
    return s.join(groups, g).select(*on, "n", "slope", "intercept")


def circle_fit(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Algebraic least-squares circle: ``n, xc, yc, radius``; null for collinear points. A10.

    Sums are taken about each group's mean, which keeps them well-conditioned far from the origin."""
    d = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(subset=["x", "y"])
    on = list(keys)
    mean = d.groupBy(*on).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    c = d.join(mean, on).select(*on, "mx", "my", F.expr("x-mx").alias("u"), F.expr("y-my").alias("v"))
    c = c.withColumn("z", F.expr("u*u+v*v"))
    s = c.groupBy(*on, "mx", "my").agg(F.count("*").alias("n"), *[F.sum(F.expr(e)).alias(a) for a, e in {"suu": "u*u", "suv": "u*v", "svv": "v*v", "suz": "u*z", "svz": "v*z", "sz": "z"}.items()])
    det = F.expr("suu*svv - suv*suv")
    good = F.when(F.abs(det) > 1e-12, det)
    a = F.expr("suz*svv - svz*suv") / good / 2
    b = F.expr("suu*svz - suv*suz") / good / 2
    return s.select(*on, "n", (F.col("mx") + a).alias("xc"), (F.col("my") + b).alias("yc"), F.sqrt(a * a + b * b + F.col("sz") / F.col("n")).alias("radius"))


def robust_circle_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, tolerance: float = 0.012, rounds: int = 5) -> DataFrame:
    """Circle fit with points off the circle by more than ``tolerance * radius`` trimmed in a bounded number of rounds. A10."""
    d, on = df, list(keys)
    for _ in range(rounds):
        fit = circle_fit(d, on, x, y).select(*on, "xc", "yc", "radius")
        off = F.abs(F.hypot(F.col(x) - F.col("xc"), F.col(y) - F.col("yc")) - F.col("radius"))
        d = materialise(d.join(fit, on).filter((off <= tolerance * F.col("radius")) | F.col("radius").isNull()).drop("xc", "yc", "radius"), "kept")
    return circle_fit(d, on, x, y)


def affine_fit(df: DataFrame, keys: Sequence[str], sx: str, sy: str, tx: str, ty: str) -> DataFrame:
    """Least-squares affine map of point pairs per group: ``a, b, c`` (x' = a x + b y + c), ``d, e, f`` (y'). A12.

    Null for fewer than three points or collinear ones. The normal equations are shared by both rows and centred."""
    on = list(keys)
    d = df.select(*on, *[F.col(c).cast("double").alias(n) for c, n in ((sx, "x"), (sy, "y"), (tx, "u"), (ty, "v"))]).dropna(subset=["x", "y", "u", "v"])
    mean = d.groupBy(*on).agg(*[F.avg(n).alias(f"m{n}") for n in "xyuv"])
    c = d.join(mean, on).select(*on, "mx", "my", "mu", "mv", *[F.expr(f"{n}-m{n}").alias(n) for n in "xyuv"])
    s = c.groupBy(*on, "mx", "my", "mu", "mv").agg(F.count("*").alias("n"), *[F.sum(F.expr(f"{p}*{q}")).alias(p + q) for p, q in ("xx", "xy", "yy", "xu", "yu", "xv", "yv")])
    det = F.expr("xx*yy - xy*xy")
    good = F.when((F.col("n") >= 3) & (F.abs(det) > 1e-9), det)
    out = {}
    for k, (p, q, r, m) in {"u": ("a", "b", "c", "mu"), "v": ("d", "e", "f", "mv")}.items():
        out[p] = F.expr(f"x{k}*yy - y{k}*xy") / good
        out[q] = F.expr(f"xx*y{k} - xy*x{k}") / good
        out[r] = F.col(m) - out[p] * F.col("mx") - out[q] * F.col("my")
    return s.select(*on, "n", *[v.alias(k) for k, v in out.items()])


def similarity_fit(df: DataFrame, keys: Sequence[str], sx: str, sy: str, tx: str, ty: str) -> DataFrame:
    """Scale, rotation, translation and rms error of the best similarity (no reflection) per group. A13."""
    on = list(keys)
    d = df.select(*on, *[F.col(c).cast("double").alias(n) for c, n in ((sx, "x"), (sy, "y"), (tx, "u"), (ty, "v"))]).dropna(subset=["x", "y", "u", "v"])
    mean = d.groupBy(*on).agg(*[F.avg(n).alias(f"m{n}") for n in "xyuv"])
    c = d.join(mean, on).select(*on, "mx", "my", "mu", "mv", *[F.expr(f"{n}-m{n}").alias(n) for n in "xyuv"])
    s = c.groupBy(*on, "mx", "my", "mu", "mv").agg(F.count("*").alias("n"), F.sum(F.expr("x*u+y*v")).alias("dot"), F.sum(F.expr("x*v-y*u")).alias("cross"), F.sum(F.expr("x*x+y*y")).alias("ss"), F.sum(F.expr("u*u+v*v")).alias("tt"))
    scale = F.try_divide(F.hypot("dot", "cross"), F.col("ss"))
    angle = F.atan2("cross", "dot")
    left = F.greatest(F.col("tt") - scale * F.hypot("dot", "cross"), F.lit(0.0))
    return s.select(*on, "n", scale.alias("scale"), angle.alias("angle"), (F.col("mu") - scale * (F.cos(angle) * F.col("mx") - F.sin(angle) * F.col("my"))).alias("tx"), (F.col("mv") - scale * (F.sin(angle) * F.col("mx") + F.cos(angle) * F.col("my"))).alias("ty"), F.sqrt(left / F.col("n")).alias("rmsd"))


def two_point_similarity(ax: Column, ay: Column, bx: Column, by: Column, ux: Column, uy: Column, vx: Column, vy: Column) -> tuple[Column, Column, Column, Column]:
    """(scale, angle, tx, ty) of the similarity that takes a to u and b to v; null scale for a = b. A14."""
    dx, dy, du, dv = bx - ax, by - ay, vx - ux, vy - uy
    scale = F.try_divide(F.hypot(du, dv), F.hypot(dx, dy))
    angle = F.atan2(dx * dv - dy * du, dx * du + dy * dv)
    return scale, angle, ux - scale * (F.cos(angle) * ax - F.sin(angle) * ay), uy - scale * (F.sin(angle) * ax + F.cos(angle) * ay)


def pca_orientation(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 6) -> DataFrame:
    """Direction of the largest spread in degrees, folded to [0, 180); null for fewer than ``least`` points. A15."""
    d = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(subset=["x", "y"])
    s = d.groupBy(*keys).agg(F.count("*").alias("n"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("c"))
    deg = F.degrees(F.lit(0.5) * F.atan2(F.lit(2.0) * F.col("c"), F.col("vx") - F.col("vy")))
    return s.select(*keys, "n", F.when(F.col("n") >= least, F.pmod(deg + 180.0, F.lit(180.0))).alias("orientation_deg"))
