import numpy as np

from weftline.llm import textvec as V
from weftline.llm.backoff import score_documents
from weftline.llm.minhash import near_duplicates
from weftline.llm.packing import packed


def thue_morse(n):
    """Two words over a and b that a polynomial modulo 2**64 takes for the same."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_span_hashes_tell_words_apart():
    for n in (8, 64, 1024, 4096):
        x, y = thue_morse(n)
        buf = np.frombuffer((x + y + x).encode(), np.uint8)
        start = np.array([0, n, 2 * n])
        for symbols, alphabet in ((buf, 256), (buf.astype(np.uint32), 600), (buf.astype(np.uint32), 1 << 21)):
            h = V.span_hash(symbols, start, start + n, alphabet)
            assert h[0] == h[2] != h[1]
    assert len(set(V.span_hash(np.zeros(300, np.uint8), np.zeros(300, np.int64), np.arange(300)).tolist())) == 300


def test_block_hashes_against_bytes():
    buf = np.frombuffer(("".join(thue_morse(256)) + "abba" * 40).encode(), np.uint8)
    for levels in (0, 1, 5, 6):
        h = V.block_hashes(buf, levels)
        of = {}
        for i, x in enumerate(h.tolist()):
            assert of.setdefault(buf[i : i + (1 << levels)].tobytes(), x) == x
        assert len(h) == len(buf) - (1 << levels) + 1 and len(set(of.values())) == len(of)


def test_long_words_in_operators(spark):
    rows = []
    for n in (1024, 2048, 4096):
        x, y = thue_morse(n)
        rows += [(len(rows), x), (len(rows) + 1, y)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.kept for r in near_duplicates(docs).collect())
    crc = {r.doc_id: r.ids_crc32 for r in packed(docs).collect() if r.start == 0}
    assert len(set(crc.values())) == len(rows)
    # No word occurs twice, so each backs off to its own count of one.
    assert len({round(r.log_score, 9) for r in score_documents(docs).collect()}) == 1


def test_large_ids_beside_null_in_packing(spark):
    ids = [9007199254740993, 9007199254740995, None, None, 3]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in packed(docs).collect()) == sorted(map(str, ids))


def test_many_equal_rows_are_dealt_apart(spark):
    docs = spark.createDataFrame([(None, "same text")] * 200, "doc_id long, text string").coalesce(1)
    groups = {r.sequence_id >> 32 for r in packed(docs, group_rows=20).collect()}
    assert len(groups) > 5
