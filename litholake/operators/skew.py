"""Hot keys: groups with far more rows than a fair share are split, all others stay whole.

A key is *hot* if it holds more than ``1 / (4 x partitions)`` of all rows, so there are at most ``4 x partitions`` hot keys
however large the table is; this proves the bound of the small table that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> tuple[DataFrame, int]:
    """The hot keys with ``__lit_salts``, the number of parts each falls into, and the number of rows of the table.

    One row per key crosses the shuffle from each task. Null keys count as keys."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = df.count()
    fair = max(total / (4.0 * parts), 1.0)
    return sizes.filter(F.col("n") > fair).select(*keys, F.ceil(F.col("n") / fair).cast("int").alias("__lit_salts")), total


def with_salts(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """``df`` with ``__lit_salts``: 1 for most rows, more for rows of hot keys. Rows, nulls and repeats stay."""
    hot, _ = hot_keys(df, keys, parts)
    hot = hot.select(*[F.col(k).alias(f"__lit_hot{i}") for i, k in enumerate(keys)], "__lit_salts")
    same = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__lit_hot{i}"))
        same = c if same is None else same & c
    joined = df.join(F.broadcast(hot), same, "left")  # at most four rows for each partition
    return joined.drop(*[f"__lit_hot{i}" for i in range(len(keys))]).withColumn("__lit_salts", F.coalesce("__lit_salts", F.lit(1)))
