import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check(rows, got, plain, size):
    want = [(d, [*plain(t), 0]) for d, t in rows]
    by = {}
    for r in got:
        by.setdefault((r.sequence_id, r.offset), r)
    assert len(by) == len(got)
    at = 0
    for (sequence, offset), r in sorted(by.items()):
        assert sequence * size + offset == at
        assert 0 < r.length <= size - offset
        at += r.length
    assert at == sum(len(x) for _, x in want)
    docs = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        docs.setdefault(r.doc_id, []).append(r)
    for d, ids in want:
        if sum(x == d for x, _ in want) == 1:
            assert [r.start for r in docs[d]] == list(np.cumsum([0, *(r.length for r in docs[d])])[:-1])
            assert sum(r.length for r in docs[d]) == len(ids)
            for r in docs[d]:
                assert r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())


ROWS = [(1, "Hello world"), (2, None), (3, ""), (4, "x y " * 900), (5, "naïve café"), (5, "naïve café"), (None, "no id"),
        (6, "a<|endoftext|>b"), (7, "日本語 “quoted” … ὠ0"), (8, " \u0085 \t\n  tab"), (9, "don't I'LL 123 4.5")]


@pytest.mark.parametrize("size", [7, 1024])
def test_pieces(spark, docs, plain, size):
    got = packing.pieces(spark, docs(ROWS).repartition(3), PATH, size).collect()
    check(ROWS, got, plain, size)


def test_sequences_are_the_concatenation(spark, docs, plain):
    tokens = packing.token_table(spark, docs(ROWS).repartition(4), PATH)
    for size in (5, 64):
        rows = {r.sequence_id: r.ids for r in packing.sequences(spark, tokens, size).collect()}
        assert sorted(rows) == list(range(len(rows)))
        assert all(len(rows[i]) == size for i in range(len(rows) - 1))
        pieces = packing.cut(spark, tokens, size).collect()
        for p in pieces:
            ids = rows[p.sequence_id][p.offset:p.offset + p.length]
            assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p.ids_crc32


def test_fast_encoder_equals_the_library(plain):
    rng = random.Random(1)
    encode = packing.ByteTokenizer(PATH)
    assert encode.fast is not None
    for _ in range(3000):
        text = "".join(chr(rng.choice((rng.randrange(256), rng.randrange(32, 127), 32, 10, 39))) for _ in range(rng.randint(0, 40)))
        assert encode(text).tolist() == plain(text), repr(text)


def test_empty_table(spark, docs):
    assert packing.pieces(spark, docs([]), PATH).count() == 0
