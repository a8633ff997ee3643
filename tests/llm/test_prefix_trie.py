import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import prefix_trie as P
from tallyspark.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"


def content(r, x):
    return hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()


def sequences(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            by[c].append((turn is not None, turn or 0, content(r, x), r, x))
    return {c: [t[3:] for t in sorted(v)] for c, v in by.items()}


def rebuilt(rows):
    convs, out = sequences(rows), {}
    for c, seq in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + seq[h:]
    return out


def brute(convs):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in convs.items():
        seq = tuple(seq)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                kids[seq[:d - 1]].add(seq[:d])
        ends[seq].append(c)
    total, out = {}, []
    for p in sorted(members, key=len, reverse=True):
        below = [total[k] for k in kids[p]]
        total[p] = (sum(b[0] for b in below) or 1, (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(b[1] for b in below))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), *total[p],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(250, 280), 1000, 1001]:
        shared = rng.choice((0, 0, 1, 3))
        for t in range(rng.choice((1, 2, 5, 7, 9))):
            text = f"turn {t}" if t < shared else rng.choice(("", "a", "Ünï", "z" * rng.randint(1, 9), str(rng.random())))
            rows.append((c, t, rng.choice(("user", "bot")) if t >= shared else "user", text))
    same = [(0, "user", "hi"), (1, "bot", "there")]
    rows += [(c, *t) for c in range(3000, 3060) for t in same]
    rows += [(50, None, "user", "first"), (50, 1, None, None), (50, 1, "user", "tie"), (50, 1, "user", "tie"), (50, -3, "user", "")]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_conversations_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = table(P.trie(spark, P.branched(spark, P.named_turns(spark, df))))
    assert got == brute(rebuilt(rows))


def test_plain_conversations_equal_brute_force(spark):
    rows = corpus(3)
    got = table(P.trie(spark, P.members(P.named_turns(spark, spark.createDataFrame(rows, SCHEMA)))))
    assert got == brute(sequences(rows))


def test_query_and_sql_agree(spark, tmp_path):
    rows = [r for r in corpus(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    # columns that clash with names used inside, and names that need quotes
    odd = df.withColumns({"part": F.lit(1), "node": F.lit("x"), "name": F.lit(2.5), "conv": F.lit(None).cast("int"), "`a.b`": F.lit(0), "pos": F.lit("p"), "digest": F.lit("")})
    odd.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.sql(Q.ORACLE_SQL["op13_prefix_trie"])
    got = Q.op13_prefix_trie(spark, str(tmp_path))
    assert got.columns == want.columns
    assert table(got) == sorted(want.fetchall(), key=lambda r: r[:2]) == brute(rebuilt(rows))


def test_conversations_that_span_many_tasks(spark):
    rows = [(7, t, "user", f"{t % 5}") for t in range(600)] + [(8, t, "user", f"{t % 5}") for t in range(450)]
    rows += [(9, 0, "user", "0"), (6, 0, "bot", "x")]
    turns = P.named_turns(spark, spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.conv, r.pos) for r in turns.collect()) == sorted((c, t + 1) for c, t, *_ in rows)
    assert table(P.trie(spark, P.members(turns))) == brute(sequences(rows))


def test_subtree_totals_of_any_shape(spark):
    rng = random.Random(5)
    shapes = {
        "chain": [(i, i - 1 if i else None) for i in range(300)],
        "star": [(i, 0 if i else None) for i in range(200)],
        "caterpillar": [(i, i - 2 if i % 2 == 0 else i - 1) for i in range(2, 200)] + [(0, None), (1, 0)],
        "forest": [(i, None if i < 4 else rng.randrange(i)) for i in range(300)],
    }
    for name, edges in shapes.items():
        value = {i: rng.randint(-5, 50) for i, _ in edges}
        want = dict(value)
        parent = dict(edges)
        depth = {}
        for i in sorted(parent):
            p, d = parent[i], 0
            while p is not None:
                p, d = parent[p], d + 1
            depth[i] = d
        for i in sorted(parent, key=depth.get, reverse=True):
            if parent[i] is not None:
                want[parent[i]] += want[i]
        tree = spark.createDataFrame([(i, p, value[i], 1) for i, p in edges], "node long, parent long, v long, n long")
        got = P.subtree_totals(spark, tree, ["v", "n"]).collect()
        assert len(got) == len(edges) and {r.node: r.v for r in got} == want, name


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.trie(spark, P.branched(spark, P.named_turns(spark, empty))).count() == 0
    assert P.trie(spark, P.members(P.named_turns(spark, empty))).count() == 0
