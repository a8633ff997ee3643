import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import suffix_dedup as S


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, texts, length, q, ids=None):
    df = spark.createDataFrame([(i, t, "x") for i, t in zip(ids or range(len(texts)), texts)], "doc_id long, text string, data string")
    return S.summary(spark, df, length, q).collect()


def corpus(rng):
    word = lambda: rng.choice(["al", "be", "ga ", "dé", "\n", "x" * 7, "ß"])
    prose = lambda n: "".join(word() for _ in range(n))
    shared = [prose(40) for _ in range(5)]
    texts = [None, "", "short", "ab" * 200, "a" * 300, "a" * 17, "a" * 16]
    for i in range(60):
        texts.append(prose(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 9):] + prose(rng.randint(0, 40)))
    texts += [texts[20], texts[21], texts[21] + "!", shared[0] + shared[1] + shared[0], texts[22][5:]]
    return texts


def test_matches_brute_force(spark):
    rng = random.Random(1)
    texts = corpus(rng)
    for length, q in ((16, 8), (37, 12)):
        got = {r.doc_id: tuple(r)[1:] for r in run(spark, texts, length, q)}
        assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_hot_buckets_and_chunks_give_the_same(spark, monkeypatch):
    texts = corpus(random.Random(2))
    want = brute(texts, 20)
    monkeypatch.setattr(S, "LOCAL_KINDS", 2)
    monkeypatch.setattr(S, "SEARCHED", 50)
    monkeypatch.setattr(S, "REFINED", 200)
    for names in (S.SENT_NAMES, 0):
        monkeypatch.setattr(S, "SENT_NAMES", names)
        got = {r.doc_id: tuple(r)[1:] for r in run(spark, texts, 20, 9)}
        assert [got[i] for i in range(len(texts))] == want


def test_chunks_of_a_long_text_hold_every_window(monkeypatch):
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 30, 500, 19, 20)]
    for chunk in (25, 40, 10**6):
        monkeypatch.setattr(S, "CHUNK", chunk)
        seen = sorted((d, lo + k) for d, lo, n, *_ in S.text_blocks(texts, 20, 9) for k in range(n))
        assert seen == [(d, i) for d, t in enumerate(texts) for i in range(len(t) - 19)]


def test_repeated_and_null_ids(spark):
    text = "this is one text of some length, " * 2
    texts = [text + "a", text + "a", text + "b", "only here and nowhere else at all", "only here and nowhere else at all"]
    ids = [3, 3, 3, None, 5]
    got = Counter(tuple(r) for r in run(spark, texts, 16, 8, ids))
    assert got == Counter((i, *b) for i, b in zip(ids, brute(texts, 16)))


def test_texts_of_one_null_id_whose_hashes_share_31_bits(spark):
    made = spark.range(200_000).select(F.concat(F.lit("text "), F.md5(F.col("id").cast("string"))).alias("text"))
    named = made.withColumn("k", F.pmod(F.xxhash64(F.col("text").cast("binary"), F.lit(True)), F.lit(2**31 - 1)))
    a, b = named.groupBy("k").agg(F.sort_array(F.collect_list("text")).alias("t")).where("size(t) > 1").orderBy("k").first().t[:2]
    texts = [a, b, "more " + a[3:], "none"]
    got = Counter(tuple(r)[1:] for r in run(spark, texts, 16, 8, [None] * 4))
    assert got == Counter(brute(texts, 16))


def test_production_length(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice(["th", "er", "on", "an"]) for _ in range(3)) for _ in range(n))
    passage = prose(60)
    texts = [prose(80) + passage[i:250 + i] + prose(30) for i in range(6)] + [prose(200) for _ in range(5)]
    texts += [passage[:199], passage[:200], passage[:200]]
    got = {r.doc_id: tuple(r)[1:] for r in run(spark, texts, S.LENGTH, S.Q)}
    assert [got[i] for i in range(len(texts))] == brute(texts, 200)


def test_refinement_separates_exactly():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    for length in (8, 13, 16, 40):
        owner, start, bucket = S.refined(texts, length)
        windows = [texts[d][i:i + length] for d, i in zip(owner, start)]
        assert len(windows) == sum(max(0, len(t) - length + 1) for t in texts)
        assert len(set(zip(windows, bucket.tolist()))) == len(set(windows)) == len(set(bucket.tolist()))


def test_anchor_is_leftmost_minimum():
    rng = np.random.default_rng(5)
    for w in (1, 2, 5, 8):
        h = rng.integers(0, 6, 100).astype(np.uint64)
        assert S.anchors(h, w).tolist() == [i + int(h[i:i + w].argmin()) for i in range(100 - w + 1)]


def test_empty_table_and_kept_bytes(spark):
    assert run(spark, [], 16, 8) == []
    df = spark.createDataFrame([(1, "unique " + "é" * 20), (2, "é" * 20 + " other")], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in S.deduplicated(spark, df, 16, 8).collect()}
    assert got == {1: b"unique ", 2: b" other"}
