import json

import numpy as np
import pyarrow as pa

from litholake.operators import nested


def points(df):
    return sorted(tuple(r)[:5] for r in df.collect())


def test_metadata_shapes(spark):
    good = {"gds_corners_um": [[1, 2], [3], None, {"x": 4, "y": 5.5}, ["a", 1], [True, 1], [1, 2, 3]], "overlapping_tiles": "[[7, 8], 9]"}
    texts = [json.dumps(good), "\ufeff" + json.dumps([good]), json.dumps(json.dumps(good)), "{\"gds_corners_um\": [[NaN, 1]]}", json.dumps(good)[:-3], None, "", "[1]", json.dumps([good, good]), "{\"gds_corners_um\": {\"x\": 1}}", "{\"gds_corners_um\": [[1" + "0" * 400 + ", 2]]}"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, texts[0], "no id")], "record_id long, metadata string, parent_id string")
    got = points(nested.metadata_points(df))
    each = [("gds_corners_um", 0, -1), ("gds_corners_um", 3, -1), ("gds_corners_um", 6, -1), ("overlapping_tiles", 0, -1)]
    assert got == sorted([("cell_records", i, *e) for i in (0, 1, 2) for e in each] + [("cell_records", 3, "gds_corners_um", 0, -1), ("cell_records", 10, "gds_corners_um", 0, -1)])


def test_defect_arrays(spark):
    schema = "entry_id long, defects array<struct<polygon_px:array<array<double>>, score:double>>"
    df = spark.createDataFrame([(1, [([[1.0, 2.0], [3.0], None, [4.0, None], [5.0, 6.0, 7.0]], 1.0), None, (None, 2.0), ([], 3.0)]), (2, []), (3, None), (1, [([[9.0, 9.0]], 1.0)])], schema)
    assert points(nested.defect_points(df.filter("entry_id <> 1 or size(defects) > 1"))) == [("device_entries", 1, "defects", 0, 0), ("device_entries", 1, "defects", 0, 4), ("device_entries", 1, "defects", 2, -1), ("device_entries", 1, "defects", 3, -1)]
    assert len({r[1:] for r in points(nested.defect_points(df))}) in (1, 4)  # a repeated id counts once


def test_bodies(spark):
    d = {"polygon_px": [[1, 2], {"x": 1, "y": 2}, [1]]}
    bodies = [{"images": [{"image": "a", "defects": [d, 3, {"polygon_px": "[[1,1]]"}]}, {"image": "b"}, 5, {"image": "c", "defects": d}]}, {"annotations": {"f": [d], "g": 3, "h": []}}, {"f": [None], "version": 2}, {"images": None, "f": [d]}, {"annotations": [1]}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "result_id long, body string")
    assert points(nested.body_points(df)) == sorted(("detector_results", *t) for t in [(0, "a", 0, 0), (0, "a", 0, 1), (0, "a", 2, 0), (0, "b", -1, -1), (0, "c", 0, 0), (0, "c", 0, 1), (1, "f", 0, 0), (1, "f", 0, 1), (1, "h", -1, -1), (2, "f", -1, -1)])


def test_empty_tables(spark):
    assert nested.body_points(spark.createDataFrame([], "result_id long, body string")).count() == 0
    assert nested.metadata_points(spark.createDataFrame([], "record_id long, metadata string")).count() == 0


def test_offset_kernel_on_sliced_arrays():
    arr = pa.array([[9], [1, 2], None, [], [3]], pa.list_(pa.int64())).slice(1)
    parents, place, values = nested.list_layout(arr)
    assert parents.tolist() == [0, 0, 3] and place.tolist() == [0, 1, 0] and values.to_pylist() == [1, 2, 3]
    assert nested.expand(np.zeros(0, np.int64))[0].tolist() == []


def brute_points(value):
    if isinstance(value, str):
        try:
            value = loads(value)
        except (ValueError, RecursionError):
            return []
    number = lambda v: type(v) in (int, float)
    out = []
    for k, e in enumerate(value if isinstance(value, list) else []):
        a, b = (e[0], e[1]) if isinstance(e, list) and len(e) >= 2 else (e.get("x"), e.get("y")) if isinstance(e, dict) else (None, None)
        if number(a) and number(b):
            out.append((k, float(a), float(b)))
    return out


def loads(value):
    while isinstance(value, str):
        value = json.loads(value.removeprefix("\ufeff"))
    return value


def brute_object(text):
    try:
        value = loads(text)
    except (ValueError, RecursionError):
        return None
    value = value[0] if isinstance(value, list) and len(value) == 1 and isinstance(value[0], dict) else value
    return value if isinstance(value, dict) else None


def test_index_equals_a_parser_on_random_and_broken_texts():
    import random

    r = random.Random(6)

    def value(depth):
        k = r.random()
        if depth > 3 or k < 0.35:
            return r.choice([1, -2.5, 1e30, True, None, "a", "é\n\"q\"\\", float("nan"), float("inf"), "[[1,2]]", "{\"x\":1}", "", 0])
        if k < 0.7:
            return [value(depth + 1) for _ in range(r.randint(0, 4))]
        return {r.choice(["x", "y", "gds_corners_um", "k\"é", "overlapping_tiles", "polygon_px"]): value(depth + 1) for _ in range(r.randint(0, 4))}

    texts = []
    for _ in range(1500):
        v = {"gds_corners_um": value(1), "overlapping_tiles": value(1)} if r.random() < 0.6 else value(0)
        t = json.dumps(v, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]))
        if r.random() < 0.15:
            t = json.dumps(t)
        for _ in range(r.choice([0, 0, 1, 2])):
            i = r.randint(0, max(len(t) - 1, 0))
            t = t[:i] + r.choice(["", "", ",", "]", "}", "\"", "\\", "\\u00e9", "[", "{", ":", "1", " ", "\t", "x", "-", "0", "\ufeff"]) + t[i + r.randint(0, 2) :]
        texts.append(t)
    texts += ["", " ", "\ufeff{}", "{} {}", "[1,]", "{\"a\":1,}", "01", "1.", ".5", "-", "+1", "1e5", "\"\\x\"", "\"\\u12g4\"", "\"a\tb\"", "nul", "{\"a\" 1}", "{\"gds_corners_um\":[1],\"gds_corners_um\":[[1,2]]}", "\\", "\"\\", "{\"a\":\"\\\\\"}", "[\u00a01]"]
    texts += ["{\"gds_corners_um\":[[1,2]],\"gds_corners\\u005fum\":[[3,4],[5,6]]}"]
    got = {i: [] for i in range(len(texts))}
    for ix, row, token in nested.objects_of(pa.array(texts)):
        for name in ("gds_corners_um", "overlapping_tiles"):
            owner, place, ok, x, y = nested.points_of(ix, ix.member(token, name))
            for k in np.flatnonzero(ok):
                got[row[owner[k]]].append((name, int(place[k]), x[k], y[k]))
    for i, t in enumerate(texts):
        o = brute_object(t)
        want = [(n, *p) for n in ("gds_corners_um", "overlapping_tiles") for p in (brute_points(o.get(n)) if o is not None else [])]
        assert repr(sorted(map(repr, got[i]))) == repr(sorted(repr((n, k, np.float64(x), np.float64(y))) for n, k, x, y in want)), t
    live = nested.JsonIndex(pa.array(texts)).live
    for t, ok in zip(texts, live.tolist(), strict=True):
        try:
            json.loads(t.removeprefix("\ufeff"))
            assert ok, t
        except ValueError:
            assert not ok, t


def test_related_tables(spark):
    body = {"images": [{"image": "a", "defects": [{}, 3, {}]}, 7, {"image": 5}]}
    df = spark.createDataFrame([(1, json.dumps(body)), (2, json.dumps({"f": [{}], "g": 1})), (3, "{")], "result_id long, body string")
    assert sorted(map(tuple, nested.body_images(df).collect()), key=repr) == [(1, 0, "a", 2), (1, 2, None, 0), (2, 0, "f", 1)]
    m = nested.metadata_members(df.select("result_id", "body").withColumn("body", df["body"]), "result_id", "body", ("g", "f"))
    assert [tuple(r) for r in m.collect()] == [(2, "g", None, 1.0)]
    rows = spark.createDataFrame([(1, [("t", 1.0), None, (None, 2.0)]), (2, None), (3, [])], "id long, d array<struct<kind:string, score:double>>")
    assert sorted(map(tuple, nested.child_rows(rows, "id", "d", ["kind", "score"]).collect()), key=repr) == [(1, 0, "t", 1.0), (1, 2, None, 2.0)]
