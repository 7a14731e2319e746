import random
import re

from pyspark.sql import functions as F

from weftline.functions import lexicon as L
from weftline.functions import text as T

#: Plain, looking around, anchored, possessive, and matching nothing.
PATTERNS = [r"a(b+)", r"(?<=c)(a)b", r"^(ca)", r"(b)$", r"(a*+)b", r"\b(ab)\b", r"c(x?)", r"(x?)"]


def test_first_match_equals_re(spark):
    r = random.Random(2)
    texts = ["", "b", "cab", *["".join(r.choice("abcx \n😀") for _ in range(r.randint(0, 60))) for _ in range(200)]]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "id int, t string")
    got = {x.id: x for x in df.select("id", *[T.match_first(F.col("t"), [p]).alias(f"p{i}") for i, p in enumerate(PATTERNS)]).collect()}
    for i, t in enumerate(texts):
        for k, p in enumerate(PATTERNS):
            # Before a final line break $ matches in both.
            m, hit = re.search(p, t), got[i][f"p{k}"]
            assert (hit is None) == (m is None), (t, p)
            if m:
                assert (hit["value"], hit["evidence"]) == (m[1], t[max(m.start() - 14, 0) : m.end() + 14].strip()), (t, p)
    assert got[-1]["p0"] is None


def test_stripped_knows_all_white_space(spark):
    assert T.WHITE_SPACE == "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f")
    rows = spark.createDataFrame([(T.WHITE_SPACE + "a b" + T.WHITE_SPACE,), (T.WHITE_SPACE,), ("",), (None,)], "t string")
    assert [x[0] for x in rows.select(T.stripped(F.col("t"))).collect()] == ["a b", "", "", None]


def test_let_works_once_and_passes_nulls(spark):
    rows = spark.createDataFrame([(2,), (None,)], "n int").select(T.let(F.col("n") + 1, lambda x: F.coalesce(x * x, F.lit(0))).alias("v"))
    assert [x.v for x in rows.collect()] == [9, 0]


def test_spellings_and_their_suffixes_go_together(spark):
    suffixes, group = ("ing", "tion", "."), {"x": ["on"], "y": ["aa"]}
    texts = ["ontion", "ontion here", "on.tion", "onontion", "a mentiontion on", "onion.", "", "aating aaaing", "aaaing", "x" * 40 + "ontion, oning and one", "on"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "id int, t string")
    hit = L.match_unless_followed(F.col("t"), group, suffixes, whole=True)
    got = {r.id: r.h for r in df.select("id", hit.alias("h")).collect()}
    for i, t in enumerate(texts):
        want = None
        for spelling, value in L.candidates(group):
            masked = re.sub(rf"{spelling}(?:ing|tion|\.)", lambda m: "#" * len(m[0]), t)
            if want is None and (at := masked.find(spelling)) >= 0:
                want = (value, t[max(at - 14, 0) : at + len(spelling) + 14].strip())
        assert (got[i] and tuple(got[i])) == want, t
    assert got[-1] is None and got[0] is None
    # Without whole, what stands inside a suffix counts.
    assert df.where("id = 0").select(L.match_unless_followed(F.col("t"), group, suffixes)["value"]).first()[0] == "x"
