import zlib

import numpy as np
import pytest

from tallyspark.llm import language_id as L


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = L.Network(["a", "b", "c"])
    x, y = rng.integers(0, 256, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    _, grads = net.gradients(x, y)
    for name, g in grads.items():
        for _ in range(4):
            i = np.unravel_index(np.abs(g).argmax(), g.shape) if _ == 0 else tuple(rng.integers(0, n) for n in g.shape)
            w, e = net.weights[name], 1e-4
            w[i] += e
            up = net.gradients(x, y)[0]
            w[i] -= 2 * e
            down = net.gradients(x, y)[0]
            w[i] += e
            assert abs((up - down) / (2 * e) - g[i]) < 1e-4, name


def test_inference_equals_training_forward():
    rng = np.random.default_rng(2)
    net = L.Network(["a", "b"])
    x = rng.integers(0, 256, (9, 4)).astype(np.uint8)
    kept = [net._forward(x, d) for d in (0, 1)]
    probs = net.positions(x)
    for t in range(9):
        s = net.weights["out"] @ np.concatenate([kept[0][t][5], kept[1][t][5]]) + net.weights["bias"]
        p = np.exp(s - s.max(axis=0))
        assert np.allclose(probs[t], p / p.sum(axis=0), atol=1e-5)


def test_pooling_covers_whole_texts_and_no_padding():
    net = L.Network(["a", "b"])
    texts = [b"x", b"", b"hello " * 100, b"q" * L.LANE, b"r" * (L.LANE + 1)]
    got = net.pooled(texts)
    for t, row in zip(texts, got):
        lanes = [t[i:i + L.LANE] for i in range(0, len(t), L.LANE)]
        total = np.zeros(2)
        for lane in lanes:
            x = np.frombuffer(lane, np.uint8)[:, None]
            total += net.positions(x)[:, :, 0].sum(axis=0)
        assert np.allclose(row, total / max(1, len(t)), atol=1e-6)


def test_learns_and_handles_odd_rows(spark, docs):
    words = {"xx": "kako zima rodu ", "yy": "the with thing ", "zz": "queux oiseau él "}
    rows = [(i, (words[k] * (3 + i % 40))[i % 5:], k) for i, k in enumerate(list(words) * 60)]
    odd = [(1001, None, "xx"), (1002, "", "xx"), (1003, "12 34 !? ½", "yy"), (1004, "the with thing " * 3000, None), (None, "zima kako", "xx")]
    out = {r.doc_id: r for r in L.language_id(spark, docs(rows + odd)).collect()}
    assert len(out) == len(rows) + len(odd)
    for i, _, k in rows:
        assert out[i].lang_pred == k and 0 <= out[i].score <= 1
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1001, 1002, 1003))
    assert out[1004].lang_pred == "yy" and out[None].lang_pred == "xx" and not out[None].held_out


def test_held_out_labels_are_not_read(spark, docs):
    rows = [(i, "abc def ghi", "aa" if zlib.crc32(str(i).encode()) % 4 != 2 else "bb") for i in range(80)]
    assert {r.lang_pred for r in L.language_id(spark, docs(rows)).collect()} == {"aa"}


def test_nothing_to_learn(spark, docs):
    assert L.language_id(spark, docs([])).count() == 0
    got = L.language_id(spark, docs([(1, "some text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = L.language_id(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
