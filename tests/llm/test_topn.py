import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from litholake.llm import topn


def brute(rows, n):
    best = {}
    for g, i, s, a in set(rows):
        if s is not None and s == s and i is not None:
            best.setdefault(g, {})[i] = (-s, -(a if a is not None and a >= 0 else -1), i)
    return sorted((g, k + 1, t[2]) for g, v in best.items() for k, t in enumerate(sorted(v.values())[:n]))


def test_against_brute_force_with_hot_group_and_ties(spark):
    r = random.Random(2)
    rows = [(("hot" if r.random() < 0.6 else f"g{r.randint(0, 40)}"), i, float(r.randint(0, 30)), r.choice([None, -1, 3, 4])) for i in range(6000)]
    rows += rows[:300] + [("nan", 9001, float("nan"), 1), ("nan", 9002, None, 1), ("few", 9003, 1.0, None)]
    df = spark.createDataFrame(rows, "g string, i long, s double, a int").withColumn("rank_no", F.lit("clash"))
    area = F.when(F.col("a") >= 0, F.col("a")).otherwise(F.lit(-1))
    got = sorted(tuple(x) for x in topn.top_n(df, ["g"], "s", "i", 5, [area], row_group_bytes=2048).collect())
    assert got == brute(rows, 5)
    assert topn.top_n(df.limit(0), ["g"], "s", "i", 5).count() == 0


def test_null_groups_form_their_own(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("n", 3, 1.0)], "g string, i long, s double")
    assert sorted((r.g or "", r.rank_no, r.i) for r in topn.top_n(df, ["g"], "s", "i", 1).collect()) == [("", 1, 2), ("n", 1, 3)]


def test_row_groups_below_the_nth_score_are_skipped(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.col("id").alias("i"), (F.col("id") % 50_000).cast("double").alias("s"))
    path, _ = topn.write_clustered(df, ["g"], "s", [], "i", row_group_bytes=64 << 10)
    read = skipped = found = 0
    for f in spark.read.parquet(path).inputFiles():
        t, a, b = topn.scan_file(topn._open(f), 5)
        read, skipped, found = read + a, skipped + b, found + t.num_rows
        assert pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups == a + b
    assert skipped > read and found < 200


def test_uneven_redeliveries_count_once_by_their_best_row(spark):
    rows = [("g", 1, 10.0), ("g", 2, 9.5), ("g", 1, 9.0), ("g", 3, 8.0), ("g", 4, 7.0), ("g", 4, 7.5)]
    df = spark.createDataFrame(rows, "g string, i long, s double")
    assert [r.i for r in topn.top_n(df, ["g"], "s", "i", 3).orderBy("rank_no").collect()] == [1, 2, 3]
    r = random.Random(4)
    rows = [(r.choice(["hot", "a", "b"]), r.randint(0, 60), float(r.randint(0, 400))) for _ in range(9000)]
    best = {}
    for g, i, s in rows:
        best[g, i] = max(best.get((g, i), s), s)
    want = [(g, k + 1, i) for g in ("a", "b", "hot") for k, (_, i) in enumerate(sorted((-s, i) for (h, i), s in best.items() if h == g)[:5])]
    got = topn.top_n(spark.createDataFrame(rows, df.schema), ["g"], "s", "i", 5, row_group_bytes=2048).collect()
    assert sorted(map(tuple, got)) == want


def test_addresses_of_object_stores(spark):
    assert topn.SCHEMES["s3a"] == "s3"
    assert topn.row_group_size(spark.range(10)) == topn.ROW_GROUP_BYTES
