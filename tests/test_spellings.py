import random

from pyspark.sql import functions as F

from weftline.functions import lexicon as L
from weftline.operators import spellings as S

GROUP = {"ab": ("abc", "b"), "cd": ("bc", "abc"), "é": ("éa", " a"), "none": ("zzzz",), "blank": (" ",)}


def test_equals_lexicon_matches(spark):
    r = random.Random(3)
    texts = ["", None, "abc", "  abc　", "zzzzz" * 30, *["".join(r.choice("abcdéz \n　😀") for _ in range(r.randint(0, 80))) for _ in range(300)]]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, standard string")
    want = {x.id: x.h for x in df.select("id", F.sort_array(L.matches(F.col("text"), GROUP)).alias("h")).collect()}
    for most in (S.PART, 4):
        got = S.with_hits(df, "text", GROUP, most=most)
        assert got.columns == ["id", "text", "standard", "hits"]
        assert {x.id: x.hits for x in got.collect()} == want


def test_plan_does_not_grow_with_the_lexicon(spark):
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(10_000)]
    group = {f"group {i}": tuple(words[i::50]) for i in range(50)}
    texts = [" ".join(r.choices(words, k=20)) for _ in range(20)]
    df = spark.createDataFrame([*enumerate(texts)], "id int, text string")
    got = S.with_hits(df, "text", group)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    ranked = L.candidates(group)
    for x in got.collect():
        best = {}
        for spelling, standard in ranked:
            if spelling in texts[x.id]:
                best.setdefault(standard, spelling)
        places = {s: texts[x.id].index(w) for s, w in best.items()}
        assert [(h["standard"], h["evidence"]) for h in x.hits] == sorted((s, texts[x.id][max(p - 14, 0) : p + len(best[s]) + 14].strip()) for s, p in places.items())


def test_empty_lexicon_and_table(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, text string")
    assert [x.hits for x in S.with_hits(df, "text", {}).collect()] == [[]]
    assert S.with_hits(df.where("id = 2"), "text", GROUP).collect() == []


def test_parts_keep_standards_whole():
    made = S.parts(GROUP, 6)
    owner = {}
    for i, part in enumerate(made):
        for spelling, standard, _ in part:
            assert owner.setdefault(standard, i) == i
    assert sorted((s, t) for p in made for s, t, _ in p) == sorted(L.candidates(GROUP))


def test_rules_are_the_same_with_a_wide_lexicon(spark, monkeypatch):
    from weftline.operators import extract as X

    lexicon = {"major": {"m1": ("law", "art"), "m2": ("arts",)}, "degree": {"d": ("phd",)}, "cities": {"Ulm": ()}}
    rows = [(1, "h", "law and arts in Ulm phd"), (2, None, "art"), (3, "x", None)]
    df = spark.createDataFrame(rows, "id int, title string, text string")
    plain = X.extract(df, "title", "text", lexicon).orderBy("id").collect()
    monkeypatch.setattr(X, "WIDE", 1)
    wide = X.extract(df, "title", "text", lexicon)
    assert "MapInArrow" in wide._jdf.queryExecution().optimizedPlan().toString()
    assert wide.orderBy("id").collect() == plain
