"""The catalogue of device images with their annotations, its orders and its cell selector."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_annotations(images: DataFrame, key: str, annotations: DataFrame, defects: str, order: str) -> DataFrame:
    """``images`` with the ``defects`` array of the annotation of the same key in any letter case; an empty array without
    one. Of several annotations of a key that with the largest ``order`` counts. Null keys find none. J2."""
    fold = lambda c: F.lower(F.trim(c))
    last = annotations.groupBy(fold(F.col(key)).alias("__k")).agg(F.max_by(defects, order).alias("__d")).filter("__k is not null")
    j = images.join(last, fold(F.col(key)) == F.col("__k"), "left")
    return j.withColumn(defects, F.coalesce("__d", F.array().cast(annotations.schema[defects].dataType))).drop("__k", "__d")


def device_order(row: str = "cell_row", col: str = "cell_col", key: str = "device") -> list[Column]:
    """Devices by row, column and key, those without a place last. O2."""
    return [F.col(row).asc_nulls_last(), F.col(col).asc_nulls_last(), F.col(key).asc_nulls_last()]


def in_declared_order(df: DataFrame, name: str, declared: Sequence[str]) -> DataFrame:
    """``df`` with ``position``: the place of ``name`` in the declared list (any letter case; of repeats the first), null for
    others, which come last. Sort by position and name. O3."""
    first: dict[str, int] = {}
    for i, n in enumerate(declared):
        first.setdefault(n.strip().lower(), i)
    place = df.sparkSession.createDataFrame(list(first.items()), "__n string, position int")
    return df.join(place, F.lower(F.trim(F.col(name))) == F.col("__n"), "left").drop("__n")


def select_cells(cells: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The cells (cell_row, cell_col) named as ``ROW-COL``; nothing wanted selects all. Raises with every name that is
    malformed or no cell. P16."""
    if not wanted:
        return cells
    parsed = {w: re.fullmatch(r"\s*(\d+)\s*-\s*(\d+)\s*", w) for w in wanted}
    asked = cells.sparkSession.createDataFrame([(w, *(map(int, m.groups()) if m else (None, None))) for w, m in parsed.items()], "__w string, cell_row int, cell_col int")
    unknown = [r[0] for r in asked.join(cells.select("cell_row", "cell_col").distinct(), ["cell_row", "cell_col"], "left_anti").select("__w").orderBy("__w").collect()]  # names that were typed in
    if unknown:
        raise ValueError("unknown cells: " + ", ".join(unknown))
    return cells.join(asked.drop("__w").distinct(), ["cell_row", "cell_col"], "left_semi")
