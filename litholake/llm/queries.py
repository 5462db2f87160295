"""Queries of the problems 4-8 over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litholake.llm import mixing, mojibake, quantiles, tokens, topn
from litholake.session import table

LEVELS = {("area_px", 50): 300.0, ("area_px", 95): 6000.0, ("score", 50): 25.0, ("score", 95): 60.0}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "defect_components", "component_id", "wafer_id", "cell_row", "cell_col", "score", "area_px").filter("wafer_id is not null")
    area = F.when(F.col("area_px") >= 0, F.col("area_px")).otherwise(F.lit(-1))
    return topn.top_n(c, ["wafer_id", "cell_row", "cell_col"], "score", "component_id", 5, [area])


def _wafer_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "defect_components", "component_id", "wafer_id", "area_px", "score").filter("wafer_id is not null")
    c = c.withColumns({m: F.when(F.col(m) >= 0, F.col(m)) for m in ("area_px", "score")})
    return quantiles.partial_sketches(quantiles.once_by_id(c, ["wafer_id"], ["area_px", "score"], "component_id"), ["wafer_id"], ["area_px", "score"])


def p5_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 95th percentile of each wafer and metric."""
    merged = quantiles.merge_sketches(_wafer_sketches(spark, sf_dir), ["wafer_id"], (0.5, 0.95), keep_sketch=False)
    return merged.select("wafer_id", "metric", "n", F.posexplode("q").alias("at", "value")).select("wafer_id", "metric", "n", F.when(F.col("at") == 0, 50).otherwise(95).alias("pct"), "value")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.lit(None).cast("double")
    for (metric, pct), v in LEVELS.items():
        level = F.when((F.col("metric") == metric) & (F.col("pct") == pct), F.lit(v)).otherwise(level)
    return p5_quantiles(spark, sf_dir).filter(F.col("value") > level).select("wafer_id", "metric", "pct")


def p5_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged sketch of each wafer and metric, to be stored and added to those of other days."""
    return quantiles.merge_sketches(_wafer_sketches(spark, sf_dir), ["wafer_id"]).select("wafer_id", "metric", "n", "sketch")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.encode_column(docs, "text", ["doc_id"], tokens.broadcast_encoder(spark))


def _mix(spark: SparkSession, sf_dir: str) -> mixing.Mix:
    """Topic of a document: the process group of its wafer."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "wafer_id")
    sized = tokens.encode_column(docs, "text", ["doc_id", "lang", "source", "wafer_id"], tokens.broadcast_encoder(spark), "tokens", counts_only=True)
    groups = table(spark, sf_dir, "wafers", "wafer_id", "source_group").select(F.lower(F.trim("wafer_id")).alias("w"), mixing.normal_name(F.col("source_group")).alias("topic")).dropDuplicates(["w"])
    lang = F.regexp_extract(F.lower(F.trim(F.coalesce("lang", F.lit("")))), "^[a-z]+", 0)
    known = sized.withColumn("w", F.lower(F.trim("wafer_id"))).join(groups, "w", "left").select("doc_id", "source", F.when(lang == "", F.lit("und")).otherwise(lang).alias("lang"), "topic", "tokens")
    return mixing.mix(known, table(spark, sf_dir, "mix_targets"))


def p7_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture, how often each is used, and their tokens."""
    return _mix(spark, sf_dir).selection


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each listed source."""
    return _mix(spark, sf_dir).shares


def p8_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each garbled document with its chains and the text as it was written, as far as it can be had."""
    return mojibake.find_garbled(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("field")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.judge_texts(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id")


QUERIES = {f.__name__: f for f in (p4_found, p5_found, p5_quantiles, p5_sketches, p6_ids, p7_selection, p7_shares, p8_found, p8_repaired)}
_ONCE = "(select distinct on (component_id) * from defect_components order by component_id, ingested_at)"
_VALUES = f"v as (select wafer_id, 'area_px' metric, area_px::double x from {_ONCE} where wafer_id is not null and area_px >= 0 union all select wafer_id, 'score', score from {_ONCE} where wafer_id is not null and score >= 0 and not isnan(score))"
ORACLES: dict[str, str] = {
    "p4_found": f"""select wafer_id, cell_row, cell_col, rank_no::int as rank_no, component_id from (select *, row_number() over (partition by wafer_id, cell_row, cell_col
 order by score desc, case when area_px >= 0 then area_px else -1 end desc, component_id) rank_no from {_ONCE} where wafer_id is not null and score is not null and not isnan(score)) where rank_no <= 5""",
    "p5_found": f"""with {_VALUES}, q as (select wafer_id, metric, pct, quantile_cont(x, 0.5::double) a, quantile_cont(x, 0.95::double) b from v cross join (select unnest([50, 95]) pct) group by 1, 2, 3)
 select wafer_id, metric, pct from q where case when pct = 50 then a else b end > case when metric = 'area_px' and pct = 50 then 300 when metric = 'area_px' then 6000 when pct = 50 then 25 else 60 end""",
}
