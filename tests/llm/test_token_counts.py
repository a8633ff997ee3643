import random

import public_tokenizers
import pytest
import sentencepiece

from tallyspark.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  a  b\n\tc ", "<s>x</s><unk>", "▁under▁", "Hello world", "a" * 3000, "日本語テキスト", "🙂🙂", "\x00nul",
         "naïve ﬁ Ａ", "x  \n\n  y", "thingesly " * 50, "   ", "word" + " " * 37 + "end", "é" * 100, "  z"]


@pytest.fixture(scope="module")
def library():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return lambda text: len(model.encode(text or ""))


def test_counts_equal_the_library(library):
    rng = random.Random(2)
    merger = T.PairMerger(PATH)
    texts = [t or "" for t in TEXTS]
    for _ in range(2000):
        pool = rng.choice(("abcdefgh  \n", "thinger ng", "éàü ßñ", "▁ a", "日本 a\t", "0123456789 .,-"))
        texts.append("".join(rng.choice(pool) for _ in range(rng.randint(0, 60))))
    for t in texts:
        assert merger.count(t) == library(t), repr(t)


def test_kept_counts_stay_bounded(monkeypatch):
    monkeypatch.setattr(T, "KEPT_SEGMENTS", 10)
    merger = T.PairMerger(PATH)
    merger.count(" ".join(f"w{i}" for i in range(100)))
    assert len(merger.kept) <= 10


def test_table(spark, docs, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, "again")]
    got = sorted((tuple(r) for r in T.token_counts(docs(rows), PATH, limit=100).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), library(t), library(t) > 100) for i, t in rows), key=str)
    assert got == want
    assert T.token_counts(docs([]), PATH).count() == 0
