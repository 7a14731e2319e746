import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from weftline.llm.divergence import source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=3, top=200):
    """rows: (text, lang, source)."""
    docs = [(TERM.findall((t or "").translate(FOLD)), a or "", s or "") for t, a, s in rows]
    out = []
    for lang in {a for _, a, _ in docs}:
        mine = [(w, s) for w, a, s in docs if a == lang]
        held = Counter(x for w, _ in mine for x in set(w))
        kept = {x for x, n in held.items() if n >= least}
        counts = defaultdict(Counter)
        for w, s in mine:
            counts[s].update(x for x in w if x in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, x: 1 + 10**9 * (c[x] + 1) // (sum(c.values()) + len(kept))  # noqa: E731, B023
        f = lambda p, q: (p - q) ** 2 // q
        for s in counts:
            parts = {
                "pair": [(t, sum(f(share(counts[s], x), share(counts[t], x)) for x in kept)) for t in counts if t != s],
                "term": [(x, f(share(counts[s], x), share(whole, x))) for x in kept if counts[s][x] and share(counts[s], x) > share(whole, x)],
            }
            for part, found in parts.items():
                found.sort(key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, s, part, x, v, i + 1) for i, (x, v) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def check(spark, rows, **more):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string").repartition(3)
    assert sorted(map(tuple, source_divergence(df, **more).collect())) == brute(rows, **more)


def test_divergence_against_definition(spark):
    rnd = random.Random(11)
    words = ["the", "The", "a", "Élan", "élan", "x1y", "naïve", "日本", "zz", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(" ".join(rnd.choices(words, k=rnd.randrange(40))), rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", "s4", None])) for _ in range(90)]
    check(spark, rows)
    check(spark, rows, least=5, top=3)


def test_divergence_of_odd_tables(spark):
    check(spark, [])
    check(spark, [(None, None, None), ("", "en", "a"), ("one two", "en", "b")])  # no term is kept
    check(spark, [("same text", "en", s) for s in "aabbbcc"] + [(None, "en", "d"), ("one", "fr", "a")])  # ties, repeats, a source without terms
    check(spark, [("x" * 200_000 + " " + "tail " * 50_000, "en", "a")] * 3 + [("tail", "en", "b")])


def test_other_columns_play_no_part(spark):
    rows = [(f"word{i % 3} other", "en", f"s{i % 2}") for i in range(12)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    odd = df.select("*", *(F.lit(9).alias(c) for c in ("term", "n", "docs", "item", "value", "rank", "p", "q", "zero")))
    assert sorted(map(tuple, source_divergence(odd).collect())) == brute(rows)


def test_a_common_term_and_a_hot_source(spark):
    rows = [("common " + ("rare" if i % 7 == 0 else "often often"), "en", "hot" if i % 3 else f"s{i % 30}") for i in range(400)]
    check(spark, rows)
