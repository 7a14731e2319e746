import json
import random

from pyspark.sql import functions as F

from weftline.functions import payload as P
from weftline.sources.crawl import DEPTH, LIST_PATHS, records_of

SHAPES = [
    '{"data": {"records": [{"a": 1}]}}',
    '{"z": {"note": "[{\\"x\\": 1}]", "body": {"hits": [{"u": 1}, 2]}}, "a": [{"late": 1}]}',
    '{"a": {"b": {"c": {"d": [{"deep": 1}]}}}}',
    '{"a": {"b": {"c": [{"edge": 1}]}}}',
    '{"rows": [1, 2], "q": {"o\'dd \\"key\\"": [{"k": {"l": [1]}}]}}',
    '[{"top": 1}]', "[1, 2]", "7", "null", "{}", "not json", "", '{"data": [], "b": [[{"in": 1}]], "c": [{}]}',
]


def some(r, depth=0):
    kind = r.random()
    if depth > 4 or kind < 0.35:
        return r.choice([1, 0, None, True, "", "x", '[{"a": 1}]', '{"rows": [{}]}', 2.5])
    if kind < 0.6:
        return [some(r, depth + 1) for _ in range(r.randint(0, 3))]
    names = ["data", "rows", "z", "list", "b", "records", "a b", "x.y"]
    return {k: some(r, depth + 1) for k in r.sample(names, r.randint(0, 4))}


def wanted(text, given=""):
    try:
        found, at = records_of(json.loads(text), given)
    except ValueError:
        return None
    return None if found is None else (at, found)


def test_located_equals_search_in_python(spark):
    r = random.Random(5)
    texts = SHAPES + [json.dumps(some(r)) for _ in range(400)]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "id int, t string")
    for given in ("", "z", "data.rows"):
        got = {x.id: x.f for x in df.select("id", P.located(F.col("t"), LIST_PATHS, given, DEPTH).alias("f")).collect()}
        assert got.pop(-1) is None
        have = [None if (f := got[i]) is None else (f["at"], f["records"]) for i in range(len(texts))]
        want = [wanted(t, given) for t in texts]
        for t, h, w in zip(texts, have, want, strict=True):
            assert (h is None) == (w is None), t
            if h:
                assert h[0] == w[0], t
                # Elements that are text come as text, all others as JSON; null stays null.
                assert [x if x is None or isinstance(y, str) else json.loads(x) for x, y in zip(h[1], w[1], strict=True)] == w[1], t


def test_record_rows_keep_order_and_columns(spark):
    df = spark.createDataFrame([(1, SHAPES[1]), (2, "{}"), (3, None)], "id int, t string")
    rows = P.record_rows(df, "t", LIST_PATHS).orderBy("place").collect()
    assert [(x.id, x.at, x.place, x.record) for x in rows] == [(1, "z.body.hits", 0, '{"u":1}'), (1, "z.body.hits", 1, "2")]


def test_first_filled(spark):
    cases = [('{"a": " ", "b": 0, "c": {"d": " x "}}', "x"), ('{"a": "0"}', "0"), ('{"b": false, "a": null}', ""), ('{"b": 12}', "12"), ("[1]", ""), ("oops", ""), (None, "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = df.select("i", P.first_filled(F.col("t"), ["a", "b", "c.d"]).alias("v")).orderBy("i").collect()
    assert [x.v for x in got] == [v for _, v in cases]


def test_envelope(spark):
    long = "m" * 200
    df = spark.createDataFrame([(1, json.dumps({"msg": long, "code": 3, "data": {"x": 1}, "ok": True, "list": [1], "none": None})), (2, "[1]"), (3, None)], "i int, t string")
    got = {x.i: x.e for x in df.select("i", P.envelope(F.col("t")).alias("e")).collect()}
    assert got[1]["names"] == ["msg", "code", "data", "ok", "list", "none"]
    assert got[1]["scalars"] == {"msg": "m" * 80, "code": "3", "ok": "true", "none": None}
    assert got[2] is None and got[3] is None
