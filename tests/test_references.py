import datetime as dt

from pyspark.sql import functions as F

from litholake.operators.references import PATH_KEYS, canonical_segments, is_reference, orphan_references, why_orphaned, with_path_keys


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_masks_and_match_semantics(spark):
    refs = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, None, None), (4, "b", None), (5, "a", "y"), (6, None, "x")], "id int, k1 string, k2 string")
    targets = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", None)], "k1 string, k2 string")
    found = {m: [r[0] for r in rows(orphan_references(refs, targets, ["k1", "k2"], m), "id")] for m in ("simple", "full", "partial", "identical")}
    assert found["simple"] == [5]
    assert found["full"] == [2, 4, 5, 6]
    assert found["partial"] == [5]  # ("b", null) agrees with (4, "b", null) on all that is known
    assert found["identical"] == [2, 3, 5, 6]


def test_packed_keys_do_not_collide(spark):
    refs = spark.createDataFrame([(1, "a\u00012:bc", "d"), (2, "1:a", "b")], "id int, k1 string, k2 string")
    targets = spark.createDataFrame([("a", "bc\u00011:d"), ("1", "a\u0001b")], "k1 string, k2 string")
    assert rows(orphan_references(refs, targets, ["k1", "k2"], "simple"), "id") == [(1,), (2,)]


def test_lives_slices_and_nulls(spark):
    t = lambda d, h=0: dt.datetime(2025, 1, d, h)
    targets = spark.createDataFrame([("p", t(1), t(20)), ("p", t(25), None), ("q", None, t(5)), ("p", t(1), t(20))], "k string, a timestamp, d timestamp")
    refs = spark.createDataFrame([(1, "p", t(1)), (2, "p", t(20)), (3, "p", t(19, 23)), (4, "p", t(25)), (5, "q", t(4)), (6, "q", t(5)), (7, "p", None), (8, "r", t(3)), (8, "r", t(3))], "id int, k string, at timestamp")
    out = orphan_references(refs, targets, ["k"], "simple", "at", "a", "d", step_seconds=3 * 86400)
    assert rows(out, "id") == [(2,), (6,), (7,), (8,), (8,)]
    assert out.columns == refs.columns


def test_empty_sides_and_clashing_columns(spark):
    refs = spark.createDataFrame([(1, "p", "left")], "id int, k string, extra string")
    none = spark.createDataFrame([], "k string, extra int, id string")
    assert rows(orphan_references(refs, none, ["k"]), "id", "extra") == [(1, "left")]
    assert orphan_references(refs.limit(0), none, ["k"]).count() == 0


def test_paths(spark):
    paths = ["E:\\runs\\Aligned_Cells\\W\\s\\k\\F.png", "./aligned_cells//W/./s/x/../k/f.PNG ", "/f.png", "..\\..\\f.png", " None ", "", None, "a/b/aligned_cells/c/aligned_cells/d"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    seg = {r.i: r.s for r in df.select("i", canonical_segments(F.col("p")).alias("s")).collect()}
    assert seg[0] == seg[1] == ["aligned_cells", "w", "s", "k", "f.png"]
    assert seg[2] == seg[3] == ["f.png"]
    assert seg[7] == ["aligned_cells", "c", "aligned_cells", "d"]
    assert [r.i for r in df.filter(is_reference(F.col("p"))).orderBy("i").collect()] == [0, 1, 2, 3, 7]
    keyed = {r.i: [r[k] for k in PATH_KEYS] for r in with_path_keys(df, "p").collect()}
    assert keyed[0] == ["f.png", "k", "s", "w", "aligned_cells"] and keyed[2] == ["f.png", None, None, None, None]


def test_long_and_unbounded_lives_are_few_rows(spark):
    t = lambda x: None if x is None else dt.datetime.fromisoformat(x)
    lives = [("a", None, "2024-01-01"), ("b", "1900-01-01", "2024-06-01"), ("b", "2024-07-01", "2024-07-02"), ("c", None, None), ("d", "2024-05-01", None), ("e", "2024-03-01T10:00:00", "2024-03-01T10:00:01"), ("f", "2024-05-01", "2024-04-01")]
    targets = spark.createDataFrame([(k, t(a), t(b)) for k, a, b in lives], "k string, a timestamp, b timestamp")
    asked = [(k, m) for k in "abcdefg" for m in ("1800-01-01", "1950-01-01", "2023-12-31T23:59:59", "2024-01-01", "2024-03-01T10:00:00", "2024-06-01", "2024-07-01T12:00:00", None)] * 2
    refs = spark.createDataFrame([(i, k, t(m)) for i, (k, m) in enumerate(asked)], "i int, k string, m timestamp")
    alive = lambda k, m: m is not None and any(k == x and (a is None or t(a) <= m) and (b is None or t(b) > m) for x, a, b in lives)
    gone = orphan_references(refs, targets, ["k"], "identical", "m", "a", "b")
    assert sorted(r.i for r in gone.collect()) == [i for i, (k, m) in enumerate(asked) if not alive(k, t(m))]
    why = {(r.k, r.m): r.reason for r in why_orphaned(gone, targets, ["k"], "identical", "m", "a").collect()}
    assert why["g", t("2024-01-01")] == "missing" and why["d", t("2024-01-01")] == "late" and why["a", t("2024-06-01")] == "deleted" and why["c", None] == "undated"
