import random

from pyspark.sql import functions as F

from weftline.llm.templates import ALIKE, DEPTH, FIELD, deduplicate_lines, tokens_of


def brute(rows, least):
    """rows in corpus order."""
    counts, first = {}, {}
    for k, (_, t) in enumerate(rows):
        for line in {tuple(tokens_of(x)) for x in (t or "").split("\n")} - {()}:
            counts[line] = counts.get(line, 0) + 1
        for i, x in enumerate((t or "").split("\n")):
            first.setdefault(tuple(tokens_of(x)), (k, i))
    leaves = {}
    for line in counts:
        leaves.setdefault((len(line), line[:DEPTH]), []).append(line)
    stays = {}
    for members in leaves.values():
        templates = []
        for line in sorted(members, key=lambda x: (-counts[x], first[x])):
            share = [sum(a == b for a, b in zip(line, t[0])) for t in templates]
            best = max(range(len(share)), key=lambda i: (share[i], -i), default=None)
            if best is None or share[best] < ALIKE * len(line):
                templates.append([list(line), [line]])
            else:
                t = templates[best]
                t[0] = [a if a == b else FIELD for a, b in zip(t[0], line)]
                t[1].append(line)
        for _, lines in templates:
            if sum(counts[x] for x in lines) >= least:
                for x in lines:
                    stays[x] = min(first[y] for y in lines)
    out = []
    for k, (d, t) in enumerate(rows):
        lines = (t or "").split("\n")
        kept = [x for i, x in enumerate(lines) if stays.get(tuple(tokens_of(x)), (k, i)) == (k, i)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(df, least=5):
    rows = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    got = [tuple(r) for r in deduplicate_lines(df, least).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, least)))


def test_templates_against_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["red", "blue", "fox", "runs", "far", "x7", "12"])
    frames = [[word() for _ in range(rnd.choice([1, 2, 5, 8]))] for _ in range(12)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rnd.randrange(0, 7)):
            line = list(rnd.choice(frames))
            if rnd.random() < 0.5:
                line[rnd.randrange(len(line))] = rnd.choice(["alpha", "beta", f"id{rnd.randrange(99)}", "red"])
            lines.append(" ".join(line) + rnd.choice(["", " ", "\t"]))
        rows.append((i * 31 % 97, "\n".join(lines)))
    rows += [(None, "red fox runs"), (None, ""), (5, "extra"), (200, None), (201, "\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit("x")).withColumn("part", F.lit(1))
    for least in (2, 5, 30):
        check(df, least)
    assert deduplicate_lines(df.limit(0)).count() == 0


def test_table_of_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), 3)


def test_support_is_of_documents(spark):
    city = lambda names: "\n".join(f"The city of {x} lies far north" for x in names)
    one = spark.createDataFrame([(1, city("ABCDEFG")), (2, "other"), (3, city("HI"))], "doc_id long, text string")
    assert {tuple(r) for r in deduplicate_lines(one, 5).collect()} == {(1, 7, 0, city("ABCDEFG")), (2, 1, 0, "other"), (3, 2, 0, city("HI"))}
    # A second line of a document and a repeated line add nothing; a fifth document does.
    rows = [(i, city([f"{chr(65 + i)}", f"{chr(75 + i)}", f"{chr(65 + i)}"])) for i in range(5)]
    four = spark.createDataFrame(rows[:4], "doc_id long, text string")
    assert sum(r.n_dropped for r in deduplicate_lines(four, 5).collect()) == 0
    five = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(r.n_dropped for r in deduplicate_lines(five, 5).collect()) == 14
