import random

from litholake.llm import mojibake as m

WORDS = {
    "de": "Für die nächste Schicht sind noch Zellen übrig, bitte prüfen; größte Abweichung 3 µm".split(),
    "ru": "Угол поворота прежний, граница ячейки найдена неверно, просьба вырезать заново".split(),
    "fr": "La cellule présente une déchirure d’environ deux µm près du bord, à vérifier".split(),
}
ZH = ["边界检测失败，需要重新裁剪该器件。", "旋转角为零，比例保持不变，请再次确认。", "接缝附近的斑点是残留物，不计为缺陷。"]


def corpus():
    r = random.Random(8)
    clean = [" ".join(r.choices(WORDS[k], k=14)) + "." for k in r.choices(list(WORDS), k=500)] + ["".join(r.choices(ZH, k=3)) for _ in range(120)] + ["Etiqueta “AMANHÔ e gaveta “LÔ; camada √2 ≈ 1" for _ in range(40)]
    return r, clean


def test_steps_invert_what_went_wrong():
    for text, w, r in (("größer à 5 µm", "utf_8", "cp1252"), ("просьба", "utf_8", "cp1251"), ("просьба", "cp1251", "cp1252"), ("déchirure", "cp1252", "cp437"), ("边界检测", "gb18030", "cp1252")):
        garbled = text.encode(w).decode(r) if r != "cp1252" else "".join(m.READ["cp1252"][b] for b in text.encode(w))
        assert m.undo(garbled, (r, w)) == text
    assert m.undo("plain", ("cp1252", "utf_8")) is None


def test_segments_restore_the_text():
    for t in ("Eins. Zwei\r\ndrei! vier 旋转角为零，¾§Ô²µÄ。fünf", "", "\n\n", "旋转é"):
        assert "".join(m.segments_of(t)) == t


def test_time_is_in_proportion_to_the_text():
    import time

    for t in ("." * 300_000 + "é", "A" * 300_000 + "é", "é." * 150_000, "1," * 150_000 + "é", "漢a" * 100_000, "Ã" * 200_000):
        began = time.time()
        assert "".join(m.segments_of(t)) == t
        assert m.islands_of(t)
        assert time.time() - began < 3


def test_islands():
    assert m.islands_of("ab 53,2µm. x é") == ["2µm", " é "]
    assert m.islands_of("«x» 1,52 µ") == [" «x» ", " µ "] and m.islands_of("plain\n") == []


def test_found_and_repaired(spark):
    r, clean = corpus()
    rows = [(i, t, r.choice(["a", "B", None])) for i, t in enumerate(clean)]
    broken = {}
    for i in r.sample(range(500), 40):
        t = clean[i]
        kind = r.choice(["utf8-1252", "twice", "utf8-1251", "utf8-437", "lost"])
        once = lambda s: "".join(m.READ["cp1252"][b] for b in s.encode())
        bad = {"utf8-1252": lambda: once(t), "twice": lambda: once(once(t)), "utf8-1251": lambda: "".join(m.READ["cp1251"][b] for b in t.encode()), "utf8-437": lambda: t.encode().decode("cp437"), "lost": lambda: t.encode("cp1251" if any("а" <= c for c in t.lower()) else "cp1252", "replace").decode("utf-8", "replace")}[kind]()
        if bad != t:
            broken[i] = (bad, t, kind)
            rows[i] = (i, bad, rows[i][2])
    rows += [(9001, None, "a"), (9002, "", "a"), (9003, " ", None), (9004, "﻿plain text", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {x.doc_id: x for x in m.find_garbled(df).collect()}
    assert set(got) == set(broken)
    for i, (_, t, kind) in broken.items():
        assert kind == "lost" or got[i].repaired == t and got[i].complete
        assert kind != "lost" or not got[i].complete
    assert m.find_garbled(df.limit(0)).count() == 0


def test_posterior_follows_the_prior(spark):
    df = spark.createDataFrame([("k", "x", 2.0, 1), ("k", "x", 900.0, 2), ("k", "y", 1.0, 2)], "key string, chain string, ratio double, seg int")
    share = lambda odds: {(r.seg, r.chain): r.share for r in m.weighed(df, spark.createDataFrame([("k", "x", odds)], "key string, chain string, odds double"), ["seg"]).collect()}
    high, low = share(0.0), share(-6.0)
    assert high[1, "x"] > 0.8 > 0.5 > low[1, "x"] and low[2, "x"] > 0.999 > 0.01 > low[2, "y"]


def test_uncut_texts_count_their_segments(spark):
    texts = ["One. Two! Three? Four", "One.\nTwo.\r\n\nThree. ", "Für die Schicht. Noch größer.", "\n\n", "x"]
    assert [m.count_borders(t) for t in texts] == [len(m.segments_of(t)) for t in texts]
    docs = m._texts(spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, source string"), "doc_id", ["text"], "source")
    rows = {r.doc_id: r for r in m.cut_texts(docs).collect()}
    assert [rows[i].n for i in range(5)] == [len(m.segments_of(t)) for t in texts]
    assert [s.islands for s in rows[2].segs] == [m.islands_of(s) for s in m.segments_of(texts[2])]


def test_texts_garbled_four_times_are_restored(spark):
    r, clean = corpus()
    read = lambda s: "".join(m.READ["cp1252"][b] for b in s.encode())
    rows = [(i, t, "a", None) for i, t in enumerate(clean)]
    deep = {i: clean[i] for i in range(0, 60, 6)}
    for i, t in deep.items():
        rows[i] = (i, "clean", "a", read(read(read(read(t)))))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, note string")
    got = {(x.doc_id, x.field): x.repaired for x in m.find_garbled(df, text_cols=["text", "note"]).collect()}
    assert got == {(i, "note"): t for i, t in deep.items() if read(t) != t}


def test_many_sources_keep_their_own_prior(spark):
    rows = [(f"text|s{k}", [("utf_8<cp1252", 9.0 if k == 7 else 2.0)], 1) for k in range(600)] + [("text|", [("utf_8<cp1252", 12.0)], 40)]
    found = spark.createDataFrame(rows, "key string, c array<struct<chain: string, ratio: double>>, n long")
    sizes = found.selectExpr("key", "n * 50 as n")
    odds, many = m.fit_prior(found, sizes)
    own = {r.key: r.odds for r in odds.collect()}
    assert len(own) == 601 and many > 0
    assert own["text|"] > own["text|s7"] > own["text|s8"]


def test_all_counts_are_kept():
    c = m.Counts()
    c.add(m.code_points("abab\ufffdb"))
    c.add(m.code_points("ab"), None, -1.0)
    k, n = zip(*[(k, n) for b in c.rows() for k, n in zip(*(x.to_pylist() for x in b.columns), strict=True)], strict=True)
    got = dict(zip(k, n, strict=True))
    assert got[-1 - ord("a")] == 1 and got[-1 - ord("b")] == 2 and sum(v for k, v in got.items() if k >= 0) == 2 * m.PAIR_ROWS
