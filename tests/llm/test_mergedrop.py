import random

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from weftline.llm.mergedrop import DropoutEncoder, decode_documents, default_path, encode_documents, round_trips


def strange_texts():
    rnd = random.Random(7)
    alphabet = [" ", "  ", "a", "the", "é", "日本", "\n", "\t", "\U0001f600", "\x00", "ﬁ", "  ", "ing", "Zz", "!", "é"]
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(0, 30))) for _ in range(500)] + ["", " ", "   "]


def test_without_dropout_ids_are_the_library_s(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=default_path())
    enc = DropoutEncoder(default_path(), 1, 0.0)
    texts = [t for t in strange_texts() if "\0" not in t] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for t in texts:
        assert enc.encode(t, 5).tolist() == sp.encode(t), t


def test_dropout_varies_repeats_and_is_lossless():
    enc, again, other = (DropoutEncoder(default_path(), s, 0.3) for s in (1, 1, 2))
    plain = DropoutEncoder(default_path(), 1, 0.0)
    word = "international communication between organisations " * 20
    assert enc.encode(word, 1).tolist() == again.encode(word, 1).tolist()
    assert enc.encode(word, 1).tolist() != enc.encode(word, 2).tolist()
    assert enc.encode(word, 1).tolist() != other.encode(word, 1).tolist()
    assert len(enc.encode(word, 1)) > len(plain.encode(word, 1))
    for t in [*strange_texts(), "▁", " ▁x▁ ", "▁▁ ▁"]:
        assert enc.decode(enc.encode(t, 9)) == t
    whole = DropoutEncoder(default_path(), 1, 1.0)
    assert len(whole.encode("abc de", 1)) == 7


def test_side_by_side_against_one_by_one():
    rnd = random.Random(9)
    for dropout in (0.0, 0.2, 0.7):
        enc = DropoutEncoder(default_path(), 6, dropout)
        units = ["▁" * rnd.randrange(0, 4) + "".join(rnd.choices(["in", "t", "er", "e", "a", "日", "s", "Q", "é"], k=rnd.randrange(1, 20))) for _ in range(3000)] + ["▁", "▁▁▁▁▁▁▁", "x"]
        units = [u for u in units if len(u) < 48]
        variants = np.array([rnd.randrange(4) for _ in units])
        got = enc._side_by_side(units, variants)
        for u, v, g in zip(units, variants.tolist(), got, strict=True):
            assert g == enc._written(enc.segment(u, v)), u


def test_share_of_skipped_merges():
    enc = DropoutEncoder(default_path(), 3, 0.25)
    skipped = [enc._skips(f"unit{i}", v)(a, a + 2) for i in range(300) for v in range(4) for a in range(5)]
    assert abs(np.mean(skipped) - 0.25) < 0.02


def test_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = df.unionByName(spark.createDataFrame([(None, "no id"), (1, None), (1, ""), (-7, "▁ é")], "doc_id long, text string")).withColumn("ids", F.lit("x"))
    rows = round_trips(df, seed=4).collect()
    assert len(rows) == df.count() and all(r.lossless for r in rows)
    back = decode_documents(encode_documents(df, seed=4))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))
    assert round_trips(df.limit(0)).count() == 0


def test_repeated_rows_a_long_unit_and_no_rows(spark):
    long = "abc" * 20_000
    rows = [(5, "some text"), (5, "some text"), (6, long), (None, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = encode_documents(df, seed=2)
    assert len({tuple(r.ids) for r in encoded.where("doc_id = 5").collect()}) == 1
    assert sorted(map(str, decode_documents(encoded).collect())) == sorted(map(str, df.collect()))
    assert encode_documents(df.limit(0)).collect() == []


def test_each_occurrence_is_segmented_by_itself():
    enc, plain = (DropoutEncoder(default_path(), 20, d) for d in (0.1, 0.0))
    word, times = " international", 3000
    whole = plain.encode("x" + word, 1)[1:].tolist()
    seen, kept = {}, 0
    for key in range(20):
        text = "x" + word * (times // 20)
        pieces = [enc.vocabulary.bytes_of[i] for i in enc.encode(text, key).tolist()]
        cut, at = [], -1 - len("x")
        for p in pieces:  # the first space is not in the text
            cut.append((at, p))
            at += len(p)
        for i in range(times // 20):
            lo, hi = i * len(word), (i + 1) * len(word)
            got = tuple(p for a, p in cut if lo - 1 < a < hi)
            assert b"".join(got).decode() == word
            seen[got] = seen.get(got, 0) + 1
            kept += len(got) == len(whole)
    assert len(seen) > 20
    # In the plain way where no merge of it was skipped, about 0.9 for each.
    assert 0.15 < kept / times < 0.9
    # What is remembered, and the order of batches, play no part.
    texts = ["a strange word " * 30, "international word " * 50, "", "x" * 100]
    again = DropoutEncoder(default_path(), 20, 0.1)
    for _ in range(3):
        assert [x.tolist() for x in enc.encode_batch(texts, [1, 2, 3, 4])] == [again.encode(t, k).tolist() for k, t in reversed(list(enumerate(texts, 1)))][::-1]
