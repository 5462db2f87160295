"""Top N items within every group (problem 4), by statistics-guided skipping.

The input is written once to the shared folder, clustered: range-partitioned and sorted by group, then by rank order, in
Parquet files with small row groups. Each task then takes some of those files, reads only their footers, and visits the
row groups in descending order of their maximum score. A row group that holds one group only and whose maximum lies
strictly below that group's current N-th score is skipped unread; a row group with several groups always holds one that
appears nowhere else in the file, so it is read. Equal scores are never skipped, which keeps the tie rule exact. A group
of millions is spread over many files; each file yields at most N rows of a group, and these few are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litholake.session import scratch_path

ROW_GROUP_BYTES = 512 << 10
#: Row groups grow with the input so that no more than about this many footers entries exist in all.
MAX_ROW_GROUPS = 1 << 17
#: Names of object stores in Hadoop's addresses and in Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def row_group_size(df: DataFrame) -> int:
    """Bytes of a row group, from the optimiser's estimate of the input's size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(ROW_GROUP_BYTES, min(size // MAX_ROW_GROUPS, 128 << 20))


def _group_key(groups: Sequence[str]) -> Column:
    """The group as one string whose order keeps groups together; a null is a value of its own."""
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("v"), F.col(g).cast("string")), F.lit("n")) for g in groups])


def write_clustered(df: DataFrame, groups: Sequence[str], score: str, ties: Sequence[Column], id_col: str, row_group_bytes: int | None = None) -> tuple[str, T.StructType]:
    """Stores group columns, score, tie keys and id, clustered by group and sorted by rank; returns path and schema."""
    row_group_bytes = row_group_bytes or row_group_size(df)
    tie_cols = [t.alias(f"tie{i}") for i, t in enumerate(ties)]
    flat = df.select(_group_key(groups).alias("grp"), F.col(score).cast("double").alias("score"), *tie_cols, F.col(id_col).alias("item"), *[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)])
    flat = flat.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("item").isNotNull())
    order = [F.col("grp").asc(), F.col("score").desc(), *[F.col(f"tie{i}").desc() for i in range(len(ties))], F.col("item").asc()]
    path = scratch_path(df.sparkSession, "topn")
    flat.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", min(row_group_bytes, 1 << 16)).parquet(path)
    return path, flat.schema


def _open(uri: str) -> pq.ParquetFile:
    scheme, colon, rest = uri.partition("://")
    fs, path = pafs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)
    return pq.ParquetFile(fs.open_input_file(path))


def _first_rows(grp: pa.Array, item: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in rank order: the first row of each item of each group, and the number of its group in the row group."""
    g = np.cumsum(np.concatenate([[0], ~pc.equal(grp[1:], grp[:-1]).to_numpy(zero_copy_only=False)]))
    ids = item.dictionary_encode()
    _, first = np.unique(g * (len(ids.dictionary) + 1) + ids.indices.to_numpy(), return_index=True)
    first.sort()
    return first, g[first]


def scan_file(source: pq.ParquetFile, n: int) -> tuple[pa.Table, int, int]:
    """Candidates for the first ``n`` of each group in one clustered file, and how many row groups were read and skipped.

    Only the first and the last group of a row group can go on in another one; their best rows are remembered. An item
    that comes again with a better row is passed on again: the best row is chosen at the end."""
    meta = source.metadata
    names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    ranges = []
    for r in range(meta.num_row_groups):
        g, s = (meta.row_group(r).column(names[c]).statistics for c in ("grp", "score"))
        known = g is not None and s is not None and g.has_min_max and s.has_min_max
        lone = g.min if known and g.min == g.max else None
        ranges.append((s.max if known else float("inf"), r, lone.decode() if isinstance(lone, bytes) else lone))
    ranges.sort(key=lambda x: (-x[0], x[1]))
    held: dict[str, dict[object, float]] = {}  # best score of each item, for groups that may go on
    parts, read, skipped = [], 0, 0
    for top, r, lone in ranges:
        scores = sorted(held.get(lone, {}).values(), reverse=True) if lone is not None else []
        if len(scores) >= n and top < scores[n - 1]:
            skipped += 1
            continue
        read += 1
        t = source.read_row_group(r).combine_chunks()
        if not t.num_rows:
            continue
        grp, item = t["grp"].combine_chunks(), t["item"].combine_chunks()
        first, g = _first_rows(grp, item)
        begins = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        rank = np.arange(len(first)) - begins[np.cumsum(np.isin(np.arange(len(first)), begins)) - 1]
        few = t.take(pa.array(first[rank < n]))
        of = few["grp"].combine_chunks()
        for name in {of[0].as_py(), of[-1].as_py()}:
            mine = pc.filter(few, pc.equal(of, name))
            best = held.setdefault(name, {})
            for i, s in zip(mine["item"].to_pylist(), mine["score"].to_pylist(), strict=True):
                best[i] = max(best.get(i, s), s)
            held[name] = dict(sorted(best.items(), key=lambda x: -x[1])[:n])
        parts.append(few)
    return (pa.concat_tables(parts) if parts else source.schema_arrow.empty_table()), read, skipped


def top_n(df: DataFrame, groups: Sequence[str], score: str, id_col: str, n: int = 5, ties: Sequence[Column] = (), row_group_bytes: int | None = None) -> DataFrame:
    """The ``n`` rows of every group with the highest ``score``: group columns, ``rank_no`` from 1, ``id_col``.

    Order: score descending, then each of ``ties`` descending, then the smallest id, so the choice never depends on the
    layout. Rows with a null or NaN score or a null id take no part; null group columns form a group of their own
    (filter them before, if they shall not). A repeated id counts once within its group, by its best row. Groups with fewer
    rows come out whole; empty input gives an empty result. Tie expressions must not be null. Extra columns of ``df`` play
    no part. Row groups grow with the input (``row_group_bytes`` fixes them), so that there is a bounded number of them."""
    spark = df.sparkSession
    path, schema = write_clustered(df, groups, score, ties, id_col, row_group_bytes)
    files = spark.read.schema(schema).parquet(path).inputFiles()  # as many as partitions were written

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                found, _, _ = scan_file(_open(uri), n)
                yield from found.to_batches()

    if not files:
        return spark.createDataFrame([], schema).select(*[F.col(f"g{i}").alias(g) for i, g in enumerate(groups)], F.lit(1).alias("rank_no"), F.col("item").alias(id_col))
    listed = spark.createDataFrame([(f,) for f in files], "uri string").repartition(len(files))
    found = listed.mapInArrow(scan, schema)
    best = F.struct("score", *[F.col(f"tie{i}") for i in range(len(ties))])
    once = found.repartition("grp").groupBy("grp", "item", *[F.col(f"g{i}") for i in range(len(groups))]).agg(F.max(best).alias("best"))  # one shuffle serves both
    w = Window.partitionBy("grp").orderBy(F.col("best").desc(), F.col("item").asc())
    ranked = once.withColumn("rank_no", F.row_number().over(w)).filter(F.col("rank_no") <= n)
    return ranked.select(*[F.col(f"g{i}").alias(g) for i, g in enumerate(groups)], "rank_no", F.col("item").alias(id_col))
