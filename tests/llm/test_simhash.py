import random
import re

import numpy as np
import xxhash

from tallyspark.llm import simhash_dedup as S


def brute_fingerprint(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, h):
    ids = list(range(len(prints)))
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in ids:
        for j in ids[:i]:
            if (prints[i] ^ prints[j]).bit_count() <= h:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in ids]


def test_fingerprint_matches_definition():
    for text in ["", None, " \n", "One", "a B c", "a b c d e", "x " * 50, "Été à\tB\x0bc\x85d ÀB e f g h", "w\x1cx y z q"]:
        assert S.fingerprint(text, 4) == brute_fingerprint(text, 4)
    rng = random.Random(1)
    text = " ".join(rng.choice("alpha beta gamma delta Eps".split()) for _ in range(300))
    assert S.fingerprint(text, 4) == brute_fingerprint(text, 4)


def test_gray_rank_inverts_gray_code():
    n = np.arange(1000, dtype=np.uint64)
    assert (S.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def clustered(rng, clusters, size, bits=3):
    out = set()
    for _ in range(clusters):
        base = rng.getrandbits(64)
        for _ in range(size):
            fp = base
            for b in rng.sample(range(64), rng.randint(0, bits)):
                fp ^= 1 << b
            out.add(fp)
    return list(out)


def test_index_finds_every_pair():
    rng = random.Random(2)
    fps = np.array(clustered(rng, 6, 60), np.uint64)
    group = np.sort(np.array([rng.randint(0, 4) for _ in fps]))
    order = np.lexsort((S.gray_rank(fps), group))
    fps, group = fps[order], group[order]
    a, b = S.GrayIndex(fps, group).pairs(np.arange(len(fps)), 4)
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
            if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= 4}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_links_connect_as_all_pairs_do(spark):
    rng = random.Random(3)
    fps = [*clustered(rng, 8, 25, 4), 0, 1, 2**63, 2**64 - 1]
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    prints = df.selectExpr("fp", "fp AS doc_id")
    want = brute_components(fps, 4)
    by = {}
    for s, c in zip(signed, want):
        by.setdefault(c, []).append(s)
    want = {s: min(by[c]) for s, c in zip(signed, want)}
    for rows in (S.BUCKET_ROWS, 5):
        edges = S.links(spark, df, 4, rows).collect()
        assert len(edges) < 200 * 15
        from tallyspark.llm.components import components
        got = {r.node: r.component for r in components(spark, S.links(spark, df, 4, rows)).collect()}
        assert {s: got.get(s, s) for s in signed} == want
    got = {r.fp: r.component_id for r in S.fingerprint_components(spark, prints, 4).collect()}
    assert got == want


def test_near_duplicates_edge_rows(spark, docs):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(5, None), (3, ""), (9, " \n "), (7, "alone here with five words"), (7, "alone here with five words"),
            (2, long), (8, long + " more"), (None, "no id at all"), (4, "A b"), (6, "a\tB")]
    out = sorted(map(tuple, S.near_duplicates(spark, docs(rows)).collect()), key=str)
    comp = {(d, f): c for d, f, c in out}
    assert len(out) == len(rows)
    assert {c for (d, f), c in comp.items() if f == "0" * 16} == {3}
    assert [c for (d, f), c in comp.items() if d in (2, 8)] == [2, 2]
    assert [c for (d, f), c in comp.items() if d in (4, 6)] == [4, 4]
    assert comp[(None, next(f for d, f, _ in out if d is None))] is None
    kept = sorted(r.doc_id if r.doc_id is not None else -1 for r in S.keep_one(spark, docs(rows)).collect())
    assert kept == [-1, 2, 3, 4, 7]
    assert S.near_duplicates(spark, docs([])).count() == 0
