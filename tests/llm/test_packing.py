import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm.bytebpe import Encoder
from weftline.llm.packing import best_fit_decreasing, packed

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_are_the_library_s():
    rnd = random.Random(4)
    alphabet = ["'s", "'re", "'", "ll", "don't", " ", "  ", "\n", "\t", " ", "\u0085", "a", "Z", "é", "ß", "9", "²", "½", "!", "?!", "'ve", "_", "\x1c", "\x00", "​", "日", "\U0001f600", "ʰ", "<|endoftext|>", "x'll", "'t's", "´"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(0, 25))) for _ in range(4000)] + ["", " ", "  ", "'", "it's", "\n\n a", "a \n"]
    enc, want = Encoder(PATH), library().encode_batch(texts, add_special_tokens=False)
    for lo in range(0, len(texts), 500):
        ids, cut = enc.encode(texts[lo : lo + 500])
        for i, w in enumerate(want[lo : lo + 500]):
            assert ids[cut[i] : cut[i + 1]].tolist() == w.ids, texts[lo + i]


def test_best_fit_against_scan():
    rnd = random.Random(2)
    for window in (8, 100, 2048):
        lengths = np.array([rnd.randrange(1, window + 1) for _ in range(300)])
        rooms, expected = [], {}
        for i in np.argsort(-lengths, kind="stable").tolist():
            fits = [r for r in rooms if r >= lengths[i]]
            room = min(fits, default=window)
            if fits:
                rooms.remove(room)
            rooms.append(room - lengths[i])
            expected[i] = window - room
        where, offset = best_fit_decreasing(lengths, window)
        assert [expected[i] for i in range(300)] == offset.tolist()
        assert len(rooms) == len(set(where.tolist()))


def test_pieces(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (0, "again"), (-3, "word é " * 3000)], "doc_id long, text string")
    df = df.unionByName(extra).withColumn("length", F.lit("x")).withColumn("pack_group", F.lit(0))
    rows = packed(df.repartition(3)).collect()
    t, left = library(), {}
    for i, text in ((r.doc_id, r.text) for r in df.collect()):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = np.array(ids[s : s + 2048], "<u4")
            key = (i, s, len(part), zlib.crc32(part.tobytes()), len(ids))
            left[key] = left.get(key, 0) + 1
    for r in rows:
        left[tuple(r)[:5]] -= 1
    assert set(left.values()) == {0}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(sequences) <= total / 2048 * 1.02 + 1
    assert packed(df.limit(0)).count() == 0
