"""References to records that do not exist (problem 1).

Method: composite keys with partial nulls. Every reference key is a tuple of columns of which some may be null. The
references are grouped by their *null mask*; each mask is anti-joined on its non-null columns only. All masks travel
through one shuffle: the join key is (mask, packed non-null columns), so a mask never meets another one, and the number
of jobs does not grow with the number of masks.

``match`` declares what a partly null key means (after the SQL standard's MATCH clause):

=============  =====================================================================================================
``simple``     a key with any null is no reference at all: never reported
``full``       a key of nulls only is no reference; a mixed key can't match anything: always reported
``partial``    a key of nulls only is no reference; a mixed key matches any target that agrees on its non-null columns
``identical``  a null stands for "this part is absent": only a target with the same null mask can match
=============  =====================================================================================================

Targets may have a life span ``[valid_from, valid_to)``; a reference made at ``at`` is served only by a life that
covers it. Hot keys don't explode: lives are pre-aggregated before the shuffle (lives without an end need only the earliest
start, lives without a start only the latest end, one row per key each), and lives with both are put on the time grid
whose step is just as long as the life, a power of two, so a life of any length lies in at most two slices, and the slice
is part of the join key. A reference that is still open looks once into each grid in use, of which there are at most 32.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = ("simple", "full", "partial", "identical")
_SEP = "\u0001"


def null_mask(keys: Sequence[str], cols: Sequence[Column] | None = None) -> Column:
    """Bit i is set where key i is null."""
    cols = cols or [F.col(k) for k in keys]
    out = F.lit(0)
    for i, c in enumerate(cols):
        out = out + F.when(c.isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return out


def _pack(keys: Sequence[str], mask: int | None = None) -> Column:
    """The key columns as one string: length-prefixed, so that no two different keys agree."""
    use = [k for i, k in enumerate(keys) if mask is None or not mask >> i & 1]
    parts = [F.when(F.col(k).isNotNull(), F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string"))) for k in use]
    return F.concat_ws(_SEP, *parts) if parts else F.lit("")


def orphan_references(
    refs: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    match: str = "identical",
    at: str | None = None,
    valid_from: str | None = None,
    valid_to: str | None = None,
    step_seconds: int = 86400,
) -> DataFrame:
    """The rows of ``refs`` that no row of ``targets`` serves; columns and repeated rows of ``refs`` stay.

    Nulls: see ``match``; a null ``at`` lies in no life and is reported; a null ``valid_from`` means "since ever", a null
    ``valid_to`` "for ever". Empty ``targets`` make every reference an orphan, empty ``refs`` give no row. Other columns
    of ``targets`` are dropped before the join, so equal names can't clash; names beginning with ``__lit_`` are reserved.
    ``step_seconds`` is the finest time grid.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    r, t = _sides(refs, targets, list(keys), match, valid_from, valid_to)
    same = (F.col("__lit_mask") == F.col("__lit_tmask")) & (F.col("__lit_key") == F.col("__lit_tkey"))
    drop = ["__lit_mask", "__lit_key"]
    if valid_from is None and valid_to is None:
        return r.join(t.select("__lit_tmask", "__lit_tkey").distinct(), same, "left_anti").drop(*drop)
    moment, key = F.col(at), ["__lit_tmask", "__lit_tkey"]
    always = t.filter("__lit_from is null and __lit_to is null").select(*key).distinct()
    endless = t.filter("__lit_from is not null and __lit_to is null").groupBy(*key).agg(F.min("__lit_from").alias("__lit_from"))
    since_ever = t.filter("__lit_from is null and __lit_to is not null").groupBy(*key).agg(F.max("__lit_to").alias("__lit_to"))
    left = r.join(endless, same & (F.col("__lit_from") <= moment), "left_anti")
    left = left.join(always, same & moment.isNotNull(), "left_anti").join(since_ever, same & (F.col("__lit_to") > moment), "left_anti")
    ended = t.filter("__lit_from < __lit_to").groupBy(*key, "__lit_to").agg(F.min("__lit_from").alias("__lit_from"))
    length = F.greatest(F.unix_seconds("__lit_to") - F.unix_seconds("__lit_from"), F.lit(1)) / F.lit(float(step_seconds))
    ended = ended.withColumn("__lit_tgrid", F.greatest(F.ceil(F.log2(length)), F.lit(0)).cast("int"))
    grids = [g["__lit_tgrid"] for g in ended.select("__lit_tgrid").distinct().collect()]  # at most 32 powers of two
    if not grids:
        return left.drop(*drop)
    slice_of = lambda c, grid: F.floor(F.unix_seconds(c) / (F.lit(float(step_seconds)) * F.pow(F.lit(2.0), grid)))
    ended = ended.withColumn("__lit_tslice", F.explode(F.sequence(slice_of(F.col("__lit_from"), F.col("__lit_tgrid")), slice_of(F.col("__lit_to"), F.col("__lit_tgrid")))))
    looks = F.array(*[F.lit(g) for g in sorted(grids)])
    open_ = left.select(*drop, moment.alias("__lit_at")).distinct().withColumn("__lit_grid", F.explode(looks)).withColumn("__lit_slice", slice_of(F.col("__lit_at"), F.col("__lit_grid")))
    inside = same & (F.col("__lit_grid") == F.col("__lit_tgrid")) & (F.col("__lit_slice") == F.col("__lit_tslice")) & (F.col("__lit_from") <= F.col("__lit_at")) & (F.col("__lit_to") > F.col("__lit_at"))
    served = open_.join(ended, inside, "left_semi").select(F.col("__lit_mask").alias("__lit_tmask"), F.col("__lit_key").alias("__lit_tkey"), "__lit_at").distinct()
    return left.join(served, same & (moment == F.col("__lit_at")), "left_anti").drop(*drop)


def _sides(refs: DataFrame, targets: DataFrame, keys: list[str], match: str, valid_from: str | None, valid_to: str | None) -> tuple[DataFrame, DataFrame]:
    """References and targets with mask and packed key, by the rules of ``match``."""
    every = (1 << len(keys)) - 1
    r = refs.withColumn("__lit_mask", null_mask(keys))
    if match == "simple":
        r = r.filter("__lit_mask = 0")
    elif match != "identical":
        r = r.filter(F.col("__lit_mask") != every)
    start = F.col(valid_from) if valid_from else F.lit(None).cast("timestamp")
    end = F.col(valid_to) if valid_to else F.lit(None).cast("timestamp")
    t = targets.select(*keys, start.alias("__lit_from"), end.alias("__lit_to"))
    if match == "partial":  # a target answers under each of the masks that references can have
        variants = [F.struct(F.lit(m).alias("m"), _pack(keys, m).alias("k"), null_mask(keys).bitwiseAND(F.lit(every & ~m)).alias("n")) for m in range(every)]
        t = t.select(F.explode(F.array(*variants)).alias("v"), "__lit_from", "__lit_to").filter("v.n = 0").select(F.col("v.m").alias("__lit_tmask"), F.col("v.k").alias("__lit_tkey"), "__lit_from", "__lit_to")
    else:
        t = t.withColumn("__lit_tmask", null_mask(keys))
        if match != "identical":
            t = t.filter("__lit_tmask = 0")
        t = t.select("__lit_tmask", _pack(keys).alias("__lit_tkey"), "__lit_from", "__lit_to")
    return r.withColumn("__lit_key", _pack(keys)), t


def why_orphaned(
    orphans: DataFrame, targets: DataFrame, keys: Sequence[str], match: str = "identical", at: str | None = None, valid_from: str | None = None
) -> DataFrame:
    """``orphans`` (of ``orphan_references``) with ``reason``.

    ``late``: the first target begins after the reference; ``deleted``: a target began before, so it had ended (or never
    lived) by then; ``undated``: there is a target, but the reference has no moment; ``missing``: no target at all, as for
    keys that nothing can match."""
    r, t = _sides(orphans, targets, list(keys), match, valid_from, None)
    first = t.groupBy("__lit_tmask", "__lit_tkey").agg(F.min(F.coalesce("__lit_from", F.lit("0001-01-01").cast("timestamp"))).alias("__lit_from"))
    same = (F.col("__lit_mask") == F.col("__lit_tmask")) & (F.col("__lit_key") == F.col("__lit_tkey"))
    reason = F.when(F.col("__lit_tkey").isNull(), "missing").when(F.col(at).isNull(), "undated").when(F.col("__lit_from") > F.col(at), "late").otherwise("deleted")
    return r.join(first, same, "left").withColumn("reason", reason).drop("__lit_mask", "__lit_key", "__lit_tmask", "__lit_tkey", "__lit_from")


def canonical_segments(path: Column, root: str = "aligned_cells") -> Column:
    """The segments of a path: white space around it dropped, lower case, either slash, empty, ``.`` and ``..`` segments
    resolved (``..`` at the top is dropped), and everything before the first segment ``root`` left out."""
    plain = F.lower(F.translate(F.regexp_replace(path, r"(?U)^\s+|\s+$", ""), "\\", "/"))
    raw = F.split(plain, "/")
    folded = F.aggregate(
        raw,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x.isin("", "."), acc).when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))),
    )
    seg = F.when(plain.rlike(r"(^|/)\.{0,2}(/|$)"), folded).otherwise(raw)
    pos = F.array_position(seg, root)
    return F.when(pos > 1, F.slice(seg, pos.cast("int"), F.size(seg))).otherwise(seg)


PATH_KEYS = ["key_name", "key_kind", "key_scan", "key_wafer", "key_head"]


def with_path_keys(df: DataFrame, column: str, root: str = "aligned_cells") -> DataFrame:
    """Adds the composite key of a file path, from its end: name, kind, scan, wafer, and whatever stands before.

    A part that the path doesn't have is null; the five columns and the canonical path determine each other."""
    df = df.withColumn("__lit_seg", canonical_segments(F.col(column), root))
    n = F.size("__lit_seg")
    cols = {k: F.when(n > i, F.element_at("__lit_seg", -(i + 1))) for i, k in enumerate(PATH_KEYS[:4])}
    cols["key_head"] = F.when(n > 4, F.concat_ws("/", F.slice("__lit_seg", F.lit(1), F.greatest(n - 4, F.lit(1)))))
    return df.withColumns(cols).drop("__lit_seg")


def is_reference(path: Column) -> Column:
    """False for null, blank and the word none in any case."""
    word = F.lower(F.regexp_replace(path, r"(?U)^\s+|\s+$", ""))
    return path.isNotNull() & ~word.isin("", "none")
