import random

import numpy as np
import pytest

from litholake.llm.quantiles import DyadicCountSketch, decode, encode, merge_sketches, once_by_id, pack, partial_sketches, subtract_sketches


def rank_error(values, x, q):
    v = np.sort(values)
    r = np.ceil(q * len(v))
    lo, hi = np.searchsorted(v, x - abs(x) * 2**-15, "left"), np.searchsorted(v, x + abs(x) * 2**-15, "right")
    return max(0, lo + 1 - r, r - hi) / len(v)


@pytest.mark.parametrize("kind", ["uniform", "lognormal", "ties", "one octave", "negative"])
@pytest.mark.parametrize("n", [20, 700, 200_000])
def test_error_bound(kind, n):
    r = np.random.default_rng(3)
    v = {"uniform": r.random(n) * 1000, "lognormal": r.lognormal(3, 2, n), "ties": r.integers(0, 7, n).astype(float), "one octave": 64 + r.random(n) * 60, "negative": -r.lognormal(0, 1, n)}[kind]
    s = DyadicCountSketch().update(encode(v))
    for q in (0.01, 0.5, 0.95, 0.99):
        x = s.quantile(q)
        assert rank_error(v, x, q) < 0.015


def test_codes_keep_order_and_integers():
    v = np.array([-1e9, -2.5, -0.0, 0.0, 1.0, 82.0, 65536.0, 1e30])
    c = encode(v)
    assert (np.diff(c) >= 0).all() and [decode(int(x)) for x in c[2:7]] == [0.0, 0.0, 1.0, 82.0, 65536.0]


def test_merging_and_deleting_are_exact():
    r = np.random.default_rng(5)
    a, b = encode(r.random(40_000)), encode(r.random(300))
    both = DyadicCountSketch().update(np.concatenate([a, b]))
    merged = DyadicCountSketch().absorb(pack(a)).absorb(pack(b))
    assert (both.rows == merged.rows).all() and (both.exact == merged.exact).all()
    again = DyadicCountSketch().absorb(both.to_bytes()).update(b, -1)
    assert (again.rows == DyadicCountSketch().update(a).rows).all() and again.n == 40_000
    assert DyadicCountSketch().quantile(0.5) is None


def test_frames(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["hot", "hot", "b", None]), r.choice([None, -1, r.randint(0, 500)]), r.choice([float("nan"), r.random() * 100 - 50])) for i in range(4000)]
    df = spark.createDataFrame(rows + rows[:500] + [(None, "b", 5, 1.0)], "id long, g string, a int, s double")
    sketch = lambda d, **k: partial_sketches(once_by_id(d, ["g"], ["a", "s"], "id"), ["g"], ["a", "s"], **k)
    parts = sketch(df)
    got = {(x.g, x.metric): x for x in merge_sketches(parts, ["g"], (0.5,)).collect()}
    for g in ("hot", "b", None):
        for k, m in enumerate(("a", "s")):
            v = np.array([x[2 + k] for x in rows if x[1] == g and x[2 + k] is not None and x[2 + k] == x[2 + k]], float)
            assert got[g, m].n == len(v) and rank_error(v, got[g, m].q[0], 0.5) < 0.015
    for other in (merge_sketches(parts, ["g"]), sketch(df, budget=1000), sketch(df).repartition(7)):
        again = {(x.g, x.metric): x.q[0] for x in merge_sketches(other, ["g"], (0.5,)).collect()}
        assert again == {k: x.q[0] for k, x in got.items()}
    assert merge_sketches(sketch(df.limit(0)), ["g"], (0.5,)).count() == 0


def test_days_are_subtracted(spark):
    df = spark.range(30_000).selectExpr("cast(id % 2 as string) g", "cast(id % 977 as double) x", "id < 9000 old")
    keep = {(x.g, x.sketch, x.n) for x in merge_sketches(partial_sketches(df.filter("not old"), ["g"], ["x"]), ["g"]).collect()}
    rest = subtract_sketches(partial_sketches(df, ["g"], ["x"]), partial_sketches(df.filter("old"), ["g"], ["x"]), ["g"], (0.5,)).collect()
    assert {(x.g, x.sketch, x.n) for x in rest} == keep and all(x.n == 10_500 for x in rest)
    none = subtract_sketches(partial_sketches(df, ["g"], ["x"]), partial_sketches(df, ["g"], ["x"]), ["g"], (0.5,)).collect()
    assert all(x.n == 0 and x.q == [None] for x in none)
