import random

from litholake.llm.mixing import mix, rake


def docs(spark, n=4000):
    r = random.Random(3)
    rows = [(i, r.choice(["A", "a ", "b-x", "b_X", "c", None, "unlisted"]), r.choice(["en", "de", None]), r.choice(["t1", "t2"]), r.choice([0, 5, 40, 300])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, tokens long")


def test_shares_caps_and_report(spark):
    rows, df = docs(spark)
    targets = spark.createDataFrame([("a", 0.3, 1), ("B_x", 0.2, 3), ("c", 0.4, 5), ("nowhere", 0.1, 2), ("c", 0.4, 5), ("bad", None, 1)], "source string, target_share double, max_repeats int")
    m = mix(df, targets)
    picked = m.selection.collect()
    share = {r.source: r for r in m.shares.collect()}
    assert set(share) == {"a", "b_x", "c", "nowhere"} and share["nowhere"].actual_share == 0
    for s, cap in (("a", 1), ("b_x", 3), ("c", 5)):
        assert abs(share[s].actual_share - share[s].reachable_share) < 0.003
        assert max(r.repeats for r in picked if r.source == s) <= cap
    assert abs(share["c"].reachable_share - 0.4 / 0.9) < 1e-9
    assert len({r.doc_id for r in picked}) == len(picked) and all(r.tokens > 0 for r in picked)
    again = mix(df.repartition(7), targets)
    assert sorted(map(tuple, again.selection.collect())) == sorted(map(tuple, picked))


def test_empty_and_total(spark):
    rows, df = docs(spark, 500)
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    assert mix(df.limit(0), targets).selection.count() == 0
    small = mix(df, targets, total=2000.0).selection.collect()
    assert abs(sum(r.tokens * r.repeats for r in small) - 2000) <= 300
    assert mix(df, targets.limit(0)).selection.count() == 0


def test_wished_languages_and_topics(spark):
    _, df = docs(spark, 6000)
    targets = spark.createDataFrame([("a", 0.5, 3), ("c", 0.5, 3)], "source string, target_share double, max_repeats int")
    langs = spark.createDataFrame([("EN", 0.7), ("de", 0.3)], "lang string, target_share double")
    topics = spark.createDataFrame([("t1", 0.2), ("t2", 0.8)], "topic string, target_share double")
    m = mix(df.filter("lang is not null"), targets, total=60_000.0, lang_targets=langs, topic_targets=topics)
    rows = m.selection.collect()
    everything = sum(r.tokens * r.repeats for r in rows)
    share = lambda k, v: sum(r.tokens * r.repeats for r in rows if r[k] == v) / everything
    assert abs(share("source", "a") - 0.5) < 0.005
    assert abs(share("lang", "en") - 0.7) < 0.08 and abs(share("topic", "t1") - 0.2) < 0.08  # three deviations of the draw


def test_raked_weights_meet_all_marginals(spark):
    r = random.Random(5)
    cells = [(s, x, t, r.randint(100, 900), 5.0, 3000.0, {"en": 4200.0, "de": 1800.0}[x], {"t1": 1200.0, "t2": 4800.0}[t]) for s in "ab" for x in ("en", "de") for t in ("t1", "t2")]
    got = rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long, cap double, want_source double, want_lang double, want_topic double")).collect()
    for k, want in (("source", "want_source"), ("lang", "want_lang"), ("topic", "want_topic")):
        for v in {x[k] for x in got}:
            mine = [x for x in got if x[k] == v]
            assert abs(sum(x.weight * x.tokens for x in mine) - mine[0][want]) < 1
    assert all(x.weight <= 5 for x in got)


def test_hundreds_of_topics_keep_their_own_marginal(spark):
    df = spark.range(20_000).selectExpr("id doc_id", "if(id % 3 = 0, 'a', 'b') source", "concat('l', id % 50) lang", "concat('t', id % 210) topic", "10 tokens")
    targets = spark.createDataFrame([("a", 0.5, 4), ("b", 0.5, 4)], "source string, target_share double, max_repeats int")
    rows = mix(df, targets, total=40_000.0).selection.groupBy("topic").count().collect()
    assert len(rows) == 210 and min(r["count"] for r in rows) > 5 and {r.topic for r in rows} == {f"t{i}" for i in range(210)}
