import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import collocations as C
from tallyspark.llm import queries as Q


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)) if w]


def counted(rows, longest):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + m])) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    return f, n


def brute(rows, longest, least, top, percent=100):
    f, n = counted(rows, longest)
    found = [(lang, p, a) for (lang, p), a in f.items() if len(p) > 1 and a >= least]
    inside = {}
    for lang, p, a in found:
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                key = lang, p[i:i + m]
                inside[key] = max(inside.get(key, 0), a)
    out = []
    for lang in sorted(n):
        rows = []
        for which, p, a in found:
            if which == lang and 100 * inside.get((lang, p), -1) < percent * a:
                score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                     for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "Été", "été", "x\x00y", "naïve", "zz-top", "#", "\xa0", "日本", *(f"w{i}" for i in range(25))]
    shared = [[rng.choice(vocab) for _ in range(rng.randint(2, 7))] for _ in range(6)]
    rows = [(900, None, "aa"), (901, "", "aa"), (902, " \t .,;:!? \n\x0b\x0c\r", None), (903, "lone", "bb"), (904, "q " * 300, "cc")]
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 40)):
            words += rng.choice(shared) if rng.random() < 0.4 else [rng.choice(vocab)]
            words.append(rng.choice((" ", "\t", "  ", ". ", ",", "\n", "\r\n", "; ", " ", " ", " ")))
        text = "".join(w if w.strip(" \t.,\n\r;") == "" else f" {w} " for w in words)
        rows.append((i, text, rng.choice(("aa", "aa", "bb", None, "und"))))
    return rows + rows[5:9]


def table(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("seed", "longest", "least", "top", "percent"), [(1, 5, 4, 40, 100), (2, 3, 2, 1000, 60), (3, 2, 6, 5, 100)])
def test_equals_brute_force(spark, docs, seed, longest, least, top, percent):
    rows = corpus(seed)
    got = table(C.collocations(spark, docs(rows).repartition(6), longest, least, top, percent))
    assert got == brute(rows, longest, least, top, percent) and got


def test_query_and_sql_agree(spark, docs, tmp_path):
    rows = corpus(4) * 12
    odd = docs(rows).withColumns({"part": F.lit(1), "phrase": F.lit("x"), "n": F.lit(2.5), "mass": F.lit(None).cast("int"), "`a.b`": F.lit(0)})
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(Q.ORACLE_SQL["op12_phrase_collocations"])
    got = Q.op12_phrase_collocations(spark, str(tmp_path))
    assert got.columns == want.columns
    assert table(got) == sorted(want.fetchall()) == brute(rows, 5, 100, 2000)


def test_one_very_long_text_and_one_hot_phrase(spark, docs):
    rng = random.Random(5)
    rows = [(1, " ".join(rng.choice(("so", "it", "goes", "on")) for _ in range(200_000)), "aa")]
    rows += [(i, "the same few words", "aa") for i in range(2, 500)]
    got = table(C.collocations(spark, docs(rows), 4, 100, 50))
    assert got == brute(rows, 4, 100, 50)


def test_empty_tables_and_nothing_frequent(spark, docs):
    assert C.collocations(spark, docs([])).count() == 0
    assert C.collocations(spark, docs([(1, "a b c", "aa"), (2, None, None)])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 10**11
    rows = [("aa", 0, "", 10**14), ("aa", 1, "x", big), ("aa", 1, "y", big), ("aa", 2, "x y", big - 1)]
    got = C.scored(spark.createDataFrame(rows, "lang string, n_words int, phrase string, n long")).collect()
    assert [r.score for r in got] == [1000 * (big - 1) * 10**14 // (big * big)]


def test_merged_summaries_keep_every_frequent_hash(monkeypatch):
    """Many more hashes than counters: whatever reaches the threshold
    survives, and what survives is bounded by the capacity."""
    monkeypatch.setattr(C, "ROW_ENTRIES", 16)
    rng = random.Random(6)
    shift, least = 60, 50
    stream = [rng.getrandbits(64) for _ in range(6000)]
    hot = [rng.getrandbits(64) for _ in range(12)]
    for x in hot:
        stream += [x] * rng.randint(least, 3 * least)
    rng.shuffle(stream)
    rows = []
    for k in range(0, len(stream), 500):
        h, c = np.unique(np.array(stream[k:k + 500], np.uint64), return_counts=True)
        rows += [r for b in C._rows(h, c.astype(np.int64), shift) for r in b.to_pylist()]
    rows.sort(key=lambda r: r["part"])
    masses = Counter()
    for r in rows:
        masses[r["part"]] += r["mass"]
    assert sum(masses.values()) == len(stream)
    batches = [pa.RecordBatch.from_pylist(rows[k:k + 7], schema=pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])) for k in range(0, len(rows), 7)]
    field, kept = np.zeros(1 << C.FIELD_BITS - 3, np.uint8), 0
    stretch = len(field) >> 4
    for b in C._survivors(shift, dict(masses), least)(iter(batches)):
        for r in b.to_pylist():
            field[r["part"] * stretch:(r["part"] + 1) * stretch] = np.frombuffer(r["bits"], np.uint8)
            kept += r["kept"]
            assert r["kept"] <= 2 * (C.SLACK * masses[r["part"]] // least + 1) + 64 * C.ROW_ENTRIES
    assert C._set(field, np.array(hot, np.uint64)).all()
    assert kept < 0.05 * len(set(stream))
    assert C._set(field, np.array(stream, np.uint64)).sum() < len(stream)


def test_reduced_summaries():
    h, c = np.arange(6, dtype=np.uint64), np.array([1, 5, 2, 2, 9, 1])
    assert C.reduced(h, c, 6)[2] == 0
    got = C.reduced(h, c, 2)
    assert (got[0].tolist(), got[1].tolist(), got[2]) == ([1, 4], [3, 7], 2)


def test_phrases_under_one_hash_are_counted_apart():
    words = C.Words("aa", ["a b a b c a c a b"])
    at = np.arange(8)
    assert dict(C._exact(words, 2, at, np.zeros(8, np.uint64))) == {b"a b": 3, b"b a": 1, b"b c": 1, b"c a": 2, b"a c": 1}


def test_packed_hashes_come_back():
    for h in (np.zeros(0, np.uint64), np.array([0, 1, 2**63, 2**64 - 1], np.uint64)):
        assert (C._unpacked(C._packed(h)) == h).all()
