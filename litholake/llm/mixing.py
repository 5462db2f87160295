"""Mixing sources to target weights (problem 7), by raking.

Token totals of the cells (source x language x topic) are raked by iterative proportional fitting: cell weights are
scaled in turn to the language, topic and source marginals until they stand still, never above a source's cap on repeats.
The weight of a cell is the calibrated number of times each of its documents is to be used: the whole part for certain,
the fraction as a probability. Sampling is by ordered hashes (sequential Poisson): within a source the documents with the
smallest ``uniform / fraction`` are used once more, up to the cutoff at which the source has its tokens. The cutoffs come
from two histograms, the second within the bin where the first one crosses, so no group is gathered or sorted in one place.

Everything is a table: cells, marginals, cutoffs. Each scaling is one grouped sum over the cells, so there may be any
number of sources, languages and topics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litholake.session import discard, materialise

#: Bins of either histogram: cutoffs are exact to 2^-32 of the range.
BINS = 1 << 16


def normal_name(c: Column) -> Column:
    """Letter case, surrounding white space and ``-`` for ``_`` don't distinguish names; null and blank become ``''``."""
    return F.translate(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")), "-", "_")


def _marginal(targets: DataFrame | None, name: str) -> DataFrame | None:
    """``name`` and its share ``want`` of all tokens; shares are scaled to 1, unusable ones dropped."""
    if targets is None:
        return None
    t = targets.select(normal_name(F.col(name)).alias(name), F.col("target_share").cast("double").alias("want")).filter("want > 0").groupBy(name).agg(F.max("want").alias("want"))
    return t.withColumn("want", F.col("want") / F.sum("want").over(Window.partitionBy(F.lit(0))))  # a hand-written table


def rake(cells: DataFrame, per_job: int = 2, tolerance: float = 1e-6, most: int = 60) -> DataFrame:
    """``cells`` with ``weight``, by bounded iterative proportional fitting.

    Columns: ``source, lang, topic, tokens``; ``cap`` of the source; ``want_source``, ``want_lang``, ``want_topic``, the
    tokens that the source, language and topic of the cell are to have in all (null: as it comes). The source marginal is
    fitted last and met where the caps allow it, the other two as nearly as these allow. Ends when no weight moves by more
    than ``tolerance`` in a round, or after ``most`` rounds: where the marginals contradict each other or the caps there is
    no fixed point, and the source marginal, fitted last, holds. ``per_job`` rounds are one plan; then the cells are
    written, so plans don't grow."""
    now = cells.withColumn("weight", F.least(F.lit(1.0), F.col("cap")))
    held = None
    for _ in range(0, most, per_job):
        step = now
        for k in range(per_job):
            if k == per_job - 1:
                step = step.withColumn("before", F.col("weight"))
            for name in ("lang", "topic", "source", "source"):  # what a cap cuts off is given to the source's other cells
                of = Window.partitionBy(name)
                mine = F.col("weight") * F.col("tokens")
                full = F.col("weight") >= F.col("cap")
                need = F.col(f"want_{name}") - F.coalesce(F.sum(F.when(full, mine)).over(of), F.lit(0.0))
                have = F.sum(F.when(~full, mine)).over(of)
                factor = F.when(F.col(f"want_{name}").isNull() | (F.coalesce(have, F.lit(0.0)) <= 0), F.lit(1.0)).otherwise(F.greatest(need, F.lit(0.0)) / have)
                if name != "source":  # a language or topic above its share is lowered as a whole
                    every = F.sum(mine).over(of)
                    factor = F.when(F.col(f"want_{name}").isNull() | (every <= 0), F.lit(1.0)).otherwise(F.col(f"want_{name}") / every)
                    step = step.withColumn("weight", F.least(F.col("weight") * factor, F.col("cap")))
                else:
                    step = step.withColumn("weight", F.when(full, F.col("weight")).otherwise(F.least(F.col("weight") * factor, F.col("cap"))))
        gone, held = held, materialise(step, "raked")
        discard(gone)
        now = held.drop("before")
        moved = held.agg(F.max(F.abs(F.col("weight") - F.col("before")))).first()[0] or 0.0
        if moved <= tolerance:
            break
    return now


@dataclass
class Mix:
    """``selection``: id, source, lang, topic, tokens, repeats. ``shares``: one row per listed source."""

    selection: DataFrame
    shares: DataFrame


def mix(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", total: float | None = None, lang_targets: DataFrame | None = None, topic_targets: DataFrame | None = None, seed: int = 7) -> Mix:
    """Documents (``id_col, source, lang, topic, tokens``) drawn so that each source of ``targets`` (``source,
    target_share, max_repeats``) has its share of all tokens, none being used more often than its source's
    ``max_repeats``.

    ``lang_targets`` (``lang, target_share``) and ``topic_targets`` (``topic, target_share``) give the shares wished for
    languages and topics, as far as sources and caps allow; without them they keep those of the eligible tokens, and what
    they don't list is left as it comes. ``total`` defaults to the most tokens that the caps allow. Names are compared by
    ``normal_name``; a target that is listed twice counts once, one with a null or non-positive share or cap not at all. A
    listed source without tokens can't have its share: the others keep their proportions, and it is reported with 0.
    Documents of no listed source, without tokens or without id take no part. Ids must be unique. Given the same rows and
    seed the choice is the same, whatever the partitioning."""
    t = targets.select(normal_name(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).filter("target_share > 0 and max_repeats > 0").dropDuplicates(["source"])
    clean = docs.filter((F.col("tokens") > 0) & F.col(id_col).isNotNull()).select(F.col(id_col), normal_name(F.col("source")).alias("source"), normal_name(F.col("lang")).alias("lang"), normal_name(F.col("topic")).alias("topic"), F.col("tokens").cast("long").alias("tokens"))
    eligible = materialise(clean.join(t.select("source"), "source", "left_semi"), "eligible")
    sums = materialise(eligible.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "cells")
    have = sums.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    served = t.join(have, "source")
    one = Window.partitionBy(F.lit(0))  # one row per listed source
    wanted = materialise(served.withColumn("share", F.col("target_share") / F.sum("target_share").over(one)).withColumn("most", F.min(F.col("max_repeats") * F.col("source_tokens") / F.col("share")).over(one)), "wanted")
    most = (wanted.agg(F.first("most")).first()[0]) or 0.0
    total = most if total is None else min(float(total), most)
    cells = sums.join(wanted.select("source", F.col("max_repeats").cast("double").alias("cap"), (F.lit(total) * F.col("share")).alias("want_source")), "source")
    everything = wanted.agg(F.sum("source_tokens")).first()[0] or 1
    for name, given in (("lang", _marginal(lang_targets, "lang")), ("topic", _marginal(topic_targets, "topic"))):
        if given is None:
            given = sums.groupBy(name).agg((F.sum("tokens") / F.lit(float(everything))).alias("want"))
        cells = cells.join(given.select(name, (F.lit(total) * F.col("want")).alias(f"want_{name}")), name, "left")
    planned = rake(cells).select("source", "lang", "topic", "weight")
    uniform = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    d = eligible.join(planned, ["source", "lang", "topic"])
    d = d.withColumn("sure", F.floor(F.col("weight") + 1e-9)).withColumn("part", F.greatest(F.col("weight") - F.col("sure"), F.lit(0.0)))
    d = d.withColumn("turn", F.when(F.col("part") > 1e-9, uniform / F.col("part")))
    d = materialise(d.withColumn("turn", F.col("turn") / (F.col("turn") + 1)).drop("part", "weight"), "turns")
    cut = _cutoffs(d, wanted.select("source", (F.lit(total) * F.col("share")).alias("need")))
    chosen = d.join(cut, "source", "left").withColumn("repeats", (F.col("sure") + F.coalesce((F.col("turn") < F.col("cutoff")).cast("int"), F.lit(0))).cast("int")).filter("repeats > 0")
    selection = chosen.select(id_col, "source", "lang", "topic", "tokens", "repeats")
    used = selection.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("used_tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    report = t.join(wanted.select("source", "share", "source_tokens"), "source", "left").join(used, "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    report = report.select("source", "target_share", F.coalesce("share", F.lit(0.0)).alias("reachable_share"), F.coalesce(F.col("used_tokens") / F.sum("used_tokens").over(one), F.lit(0.0)).alias("actual_share"), zero(F.col("used_tokens")).alias("used_tokens"), zero(F.col("source_tokens")).alias("source_tokens"), zero(F.col("documents")).alias("documents"), "max_repeats", zero(F.col("most_repeats")).alias("most_repeats"))
    return Mix(selection, report)


def _cutoffs(d: DataFrame, need: DataFrame) -> DataFrame:
    """``source, cutoff``: the value of ``turn`` below which the documents' tokens come nearest to what is still needed."""
    upto = Window.partitionBy("source").orderBy("bin")  # at most BINS rows of a histogram

    def crossing(hist: DataFrame, left: DataFrame) -> DataFrame:
        """The first bin of each source whose running sum exceeds what is needed, and what is needed within it."""
        run = hist.join(left, "source").withColumn("under", F.sum("n").over(upto) - F.col("n"))
        hit = run.filter((F.col("under") <= F.col("left")) & (F.col("under") + F.col("n") > F.col("left")))
        return hit.select("source", "bin", "n", (F.col("left") - F.col("under")).alias("left"))

    sure = d.groupBy("source").agg(F.sum(F.col("sure") * F.col("tokens")).alias("sure"))
    left = need.join(sure, "source", "left").select("source", (F.col("need") - F.coalesce("sure", F.lit(0))).alias("left"))
    rows = d.filter("turn is not null").select("source", "turn", "tokens").withColumn("bin", F.floor(F.col("turn") * BINS))
    first = materialise(crossing(rows.groupBy("source", "bin").agg(F.sum("tokens").alias("n")), left), "crossing")
    inner = rows.join(first.select("source", "bin"), ["source", "bin"]).select("source", F.floor((F.col("turn") * BINS - F.col("bin")) * BINS).alias("fine"), "tokens")
    second = crossing(inner.groupBy("source", F.col("fine").alias("bin")).agg(F.sum("tokens").alias("n")), first.select("source", "left"))
    take = F.when(F.col("n") - F.col("left") < F.col("left"), F.lit(1)).otherwise(F.lit(0))  # the nearer side
    exact = first.select("source", F.col("bin").alias("at")).join(second, "source").select("source", ((F.col("at") + (F.col("bin") + take) / F.lit(float(BINS))) / F.lit(float(BINS))).alias("at"))
    # a source without a crossing needs all its documents (2 lies beyond every turn), one that needs none has none
    return left.join(exact, "source", "left").select("source", F.when(F.col("left") <= 0, F.lit(0.0)).otherwise(F.coalesce("at", F.lit(2.0))).alias("cutoff"))
