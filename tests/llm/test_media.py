import hashlib
import io
import random
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm.media import GEAR, MOST_CHUNK, _cut, chunk_ends, feature_of, gear_hashes, media_digests, payload_of, read_media, samples, store_media, wav


def test_gear_hash_against_steps():
    data = np.frombuffer(bytes(random.Random(1).choices(range(256), k=500)), np.uint8)
    h, out = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(GEAR[b])) % 2**64
        out.append(h)
    assert gear_hashes(data).tolist() == out


def test_wav_is_read_by_the_standard_library():
    media = wav(payload_of("päyload".encode()))
    with wave.open(io.BytesIO(media)) as w:
        assert (w.getnchannels(), w.getsampwidth()) == (1, 1)
        assert w.readframes(w.getnframes()) == samples(media) == payload_of("päyload".encode())
    with pytest.raises(ValueError):
        samples(b"RIFF----WAVE")


def test_cuts_move_with_the_content():
    rnd = random.Random(3)
    a = bytes(rnd.choices(b"abcdefgh ", k=200_000))
    (_, one), (_, two) = list(_cut([a, b"inserted" + a]))
    assert len(set(one) & set(two)) > 0.8 * len(set(one))
    assert all(len(c) <= MOST_CHUNK for c in one + two)
    alone = next(iter(_cut([b"inserted" + a])))
    assert alone[1] == two  # what stands before a file in a batch plays no part
    assert chunk_ends(gear_hashes(np.zeros(50_000, np.uint8)))[-1] == 50_000


def test_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(1, None), (-2, ""), (None, "x" * 64), (-3, "y" * 65), (-4, "long é " * 20_000)], "doc_id long, text string")
    df = df.unionByName(extra).withColumn("media_id", F.lit("x")).withColumn("data", F.lit(1))
    want = []
    for r in df.collect():
        t = (r.text or "").encode()
        p = t + bytes(-len(t) % 64 if t else 64)
        m = wav(p)
        want.append((r.doc_id, len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature_of(p)))
    got = [tuple(r)[:8] for r in media_digests(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert media_digests(df.limit(0)).count() == 0


def test_store_keeps_a_chunk_once_and_refuses_damage(spark):
    rnd = random.Random(8)
    words = lambda n: " ".join("".join(rnd.choices("abcdefghijk", k=rnd.randrange(2, 9))) for _ in range(n))
    passage = words(800)
    texts = [words(40) + passage + words(9 * i) for i in range(6)] + ["same text " * 500, words(90) * 4]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    rows, store = store_media(df)
    packs, chunks = store.packs.collect(), {r.digest: r.data for r in store.chunks.collect()}
    assert rows.count() == 3 * len(texts) and len(packs) == len(texts)
    digests = [[bytes(d) for d in r.digests] for r in packs]
    own = [d for row, r in zip(digests, packs) for d, c in zip(row, r.own) if c]
    chunks = {bytes(d): bytes(c) for d, c in chunks.items()}
    assert len(own) == len(set(own)) and not set(own) & set(chunks)
    assert set(own) | set(chunks) == {d for row in digests for d in row}
    assert len(chunks) > 5 and store.chunks.count() == len(chunks)
    assert read_media(store).count() == len(texts)
    broken = store._replace(chunks=store.chunks.withColumn("data", F.lit(next(iter(chunks.values())))))
    with pytest.raises(Exception, match="chunk"):
        read_media(broken).collect()
    with pytest.raises(Exception, match="chunk"):
        read_media(store._replace(packs=store.packs.withColumn("own", F.reverse("own")))).collect()


def test_files_of_different_length_share_the_chunks_of_a_passage():
    rnd = random.Random(5)
    words = lambda n: b" ".join(bytes(rnd.choices(b"abcdefghijk", k=rnd.randrange(2, 9))) for _ in range(n))
    shared, total = 0, 0
    for _ in range(20):
        passage = words(120)
        (_, one), (_, two) = _cut([words(30) + passage, words(75) + passage + words(40)])
        shared += sum(map(len, set(one) & set(two)))
        total += len(passage)
    assert shared > 0.4 * total
    # A text and the same with more at its end: one start, though the headers differ.
    text = words(60)
    (_, one), (_, two) = _cut([text, text + words(200)])
    assert one[0] == two[0]
