import hashlib
import random

from pyspark.sql import functions as F

from weftline.llm.fuzzyhash import _ratio, fingerprint_documents, fingerprints, likeness


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_distance_against_table():
    rnd = random.Random(8)
    for _ in range(200):
        a = "".join(rnd.choices("abcd", k=rnd.randrange(9, 60)))
        b = a[:20] + "".join(rnd.choices("abcd", k=rnd.randrange(0, 30)))
        if any(c * 4 in a + "|" + b for c in "abcd"):
            continue
        got = _ratio(a, b)
        assert got == 0 or abs(got - 2 * lcs(a, b) / (len(a) + len(b))) < 1e-12


def test_fingerprint_of_a_text_does_not_depend_on_its_batch():
    rnd = random.Random(1)
    texts = [bytes(rnd.choices(b"abcdefgh \n\xc3", k=rnd.choice([0, 1, 5, 100, 3000, 40_000]))) for _ in range(60)] + [b"a" * 5000, b"\0" * 20]
    together = fingerprints(texts)
    assert together == [fingerprints([t])[0] for t in texts]
    assert all(len(f.split(":")[1]) <= 64 and len(f.split(":")[2]) <= 32 for f in together)


def test_likeness_of_edits():
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefghijk", k=rnd.randrange(2, 9)))
    text = lambda: " ".join(word() for _ in range(rnd.randrange(200, 900)))
    near, far = [], []
    for _ in range(60):
        a, b = text(), text()
        half = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        fa, fb, fh = fingerprints([a.encode(), b.encode(), half.encode()])
        near.append(likeness(fa, fh))
        far.append(likeness(fa, fb))
    assert sum(x > 0.3 for x in near) >= 54 and max(far) < 0.2
    assert likeness(fa, fa) == 1.0


def test_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-5, None), (-6, ""), (None, "none"), (3, "zz"), (10**15, "\U0001f600é" * 50)], "doc_id long, text string")
    df = df.unionByName(extra).withColumn("range", F.lit("x")).withColumn("key", F.lit(1))
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (d, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        e = (t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()
        ft, fe, fn = fingerprints([t.encode(), e, n.encode()])
        want.append((d, len(t), hashlib.sha256(e).hexdigest(), ft, fe, likeness(ft, fe), likeness(ft, fn)))
    got = [tuple(r) for r in fingerprint_documents(df.repartition(5)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert fingerprint_documents(df.limit(0)).count() == 0
    assert [tuple(r)[:2] for r in fingerprint_documents(df.where("doc_id = 7")).collect()] == [(7, len(rows[[r[0] for r in rows].index(7)][1]))]


def test_letters_cover_a_text_with_a_repetitive_stretch():
    rnd = random.Random(11)
    words = lambda n: " ".join("".join(rnd.choices("abcdefghijk", k=rnd.randrange(2, 9))) for _ in range(n))
    for stretch in ["spam ", "a", "one line that comes again\n", "abcdefg"]:
        for times in (300, 1000):
            for _ in range(5):
                run, back = stretch * times, words(600)
                text, end_edited, other = run + back, run + back[: len(back) // 2] + words(300), run + words(600)
                a, b, c = fingerprints([t.encode() for t in (text, end_edited, other)])
                assert 16 <= len(a.split(":")[1]) <= 64 and 8 <= len(a.split(":")[2]) <= 32
                assert likeness(a, b) > 0.5
                # A changed part takes its share of the letters, wherever it stands.
                assert likeness(a, c) < 1 - len(back) / len(text) / 2


def test_a_line_more_in_a_list_changes_little():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghijk", k=rnd.randrange(2, 9)))
    line = "the same fixed line at the end of every block\n"
    blocks = [" ".join(word() for _ in range(6)) + "\n" + line for _ in range(400)]
    for parts, more in ((blocks, line), ([line] * 100, line), ([line] * 400, line), (["spam "] * 900, "spam "), (blocks + [line] * 400, line)):
        text = "".join(parts)
        for at in (0, len(parts) // 2, len(parts) // 3, len(parts)):
            edited = "".join(parts[:at]) + more + "".join(parts[at:])
            a, b = fingerprints([text.encode(), edited.encode()])
            assert likeness(a, b) > 0.9, (at, a, b)
    text, edited = "".join(blocks), "".join([word() + "\n", *blocks])
    assert likeness(*fingerprints([text.encode(), edited.encode()])) > 0.9


def test_very_long_texts():
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdefghijk", k=rnd.randrange(2, 9))) for _ in range(3000)]
    text = " ".join(rnd.choices(words, k=500_000))
    half = len(text) // 2
    a, b, c = fingerprints([x.encode() for x in (text, text[:half] + " one more word" + text[half:], text[:half])])
    assert 16 <= len(a.split(":")[1]) <= 64 and likeness(a, b) > 0.9 and likeness(a, c) > 0.3
