import numpy as np
from pyspark.sql import functions as F

from weftline.llm.language import ByteNetwork, identify, op8_language_id, train, windows_of


def test_gradients_against_differences():
    net = ByteNetwork(["a", "b", "c"])
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(1)
    x, y = rng.integers(1, 200, (5, 40)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        p = np.concatenate([net.probabilities(x[i : i + 1]) for i in range(5)]).astype(np.float64)
        h, _, _ = net.pooled(x)
        z = np.maximum(h, 0) @ net.p["out"] + net.p["shift"]
        return float(-(z - np.log(np.exp(z).sum(1, keepdims=True)))[np.arange(5), y].mean()), p

    g = net._gradients(x, y)
    for k in net.p:
        flat, want = net.p[k].reshape(-1), g[k].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            if k == "filter" and not net.mask.reshape(-1)[i]:
                continue
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()[0]
            flat[i] = old - 1e-6
            down = loss()[0]
            flat[i] = old
            assert abs((up - down) / 2e-6 - want[i]) < 1e-4


def test_windows_tile_the_text():
    texts = [b"", b"x" * 192, b"y" * 193, b"z" * 1000]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    w, doc, held = windows_of(buf, np.cumsum([0, *map(len, texts)]))
    for i, t in enumerate(texts):
        assert b"".join(bytes(r[:h]) for r, h in zip(w[doc == i], held[doc == i])) == t


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).alias("ok"), "score").collect()
    assert sum(r.ok for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "hello there", "en"), (2, None, "en"), (3, "", None), (4, "123 !?", "fr"), (4, "été à la", "fr"), (None, "日本", "xx")], "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {(r.doc_id, r.lang_pred) for r in identify(docs, train(docs)).collect()}
    assert {(2, "und"), (3, "und"), (4, "und")} <= got and len(got) == 6
    assert all(r.lang_pred == "und" for r in identify(docs, train(docs.limit(0))).collect())
    assert identify(docs.limit(0), None).count() == 0
