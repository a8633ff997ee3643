import math

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import ann


def brute(rows, top, step):
    good = [(i, v) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows if v is not None and i is not None
            and all(x is not None and math.isfinite(x) for x in v) and any(v))]
    out = {}
    for q, v in good:
        if q % step == 0:
            near = sorted((-math.fsum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:top]
            out[q] = [(i, -s) for s, i in near]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, h1 string")
    out = {}
    for r in sorted(ann.neighbours(spark, df, F.col("vec_id") % 5 == 0, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (3, 7), (8, 8)):
        d1, d2 = rng.standard_normal(n), rng.standard_normal(m)
        d1[0] = d1[-1]
        cells = ann.visited_cells(d1, d2, np.ones(n * m, np.int64), n * m)
        assert sorted(cells) == list(range(n * m))
        sums = [d1[c // m] + d2[c % m] for c in cells]
        assert sums == sorted(sums) or np.allclose(sums, sorted(sums))
    counts = np.array([0, 5, 5, 5])
    assert len(ann.visited_cells(np.zeros(2), np.zeros(2), counts, 6)) == 2


def test_exact_where_all_is_visited(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.round(rng.standard_normal(6), 1).astype(np.float32)]) for i in range(150)]
    same = [float(x) for x in np.array([0.3, -0.2, 0.5, 0.1, 0.9, 0.4], np.float32)]
    rows += [(1000 + i, same) for i in range(70)]
    rows += [(2000, None), (2005, [0.0] * 6), (2010, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2015, [float("nan")] * 6),
             (2020, [float("inf")] * 6), (2025, [1.0] * 3), (None, same), (1000, same), (5, rows[5][1]), (2030, [])]
    rows[7] = (7, rows[3][1])
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 6], 9, 5)
    assert run(spark, rows, top=9) == want


def test_fewer_than_asked_and_none(spark):
    assert run(spark, [(0, [1.0, 0.0]), (3, [0.5, 0.5])], top=20) == {0: [(3, 0.5)]}
    assert run(spark, [], top=3) == {}
    assert run(spark, [(5, [1.0, 2.0])], top=3) == {}


def test_recall_of_a_partial_visit(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAST_ENTRIES", 50)
    monkeypatch.setattr(ann, "BLOCK_ENTRIES", 100)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 40)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((12, 8))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 12] + 0.2 * rng.standard_normal(8)]) for i in range(800)]
    want, got = brute(rows, 10, 5), run(spark, rows, top=10, visit=0.6)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(v) for q, v in brute(rows, 800, 5).items()}
    assert all(exact[q][i] == s for q in got for i, s in got[q])
