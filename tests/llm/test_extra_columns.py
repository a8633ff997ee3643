"""Columns of any name pass through every stage that returns documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import collocations, decontamination, language_id, line_dedup, packing, secret_scan, simhash_dedup, token_counts
from tests.llm.test_decontamination import prose

NAMES = ["a.b", "__k1", "__k2", "__gone", "__letters", "__n1", "__n2", "part", "fp", "rid", "col_0", "size", "kept_id", "with space", "c0"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 30) + "\n" + prose(rng, 12), "aa", "s") for i in range(25)]
    rows += [(100, rows[3][1], "aa", "s"), (101, rows[4][1] + " x", "aa", "s"), (None, "lone words here", None, None), (102, None, "aa", "s"), (103, "", "aa", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    for k, name in enumerate(NAMES):
        df = df.withColumn(name, F.concat(F.lit(f"{k}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return df


STAGES = {
    "language_id": lambda spark, docs: language_id.accepted(spark, docs, None),
    "line_dedup": lambda spark, docs: line_dedup.deduplicated(spark, docs),
    "simhash_dedup": lambda spark, docs: simhash_dedup.keep_one(spark, docs),
    "decontamination": lambda spark, docs: decontamination.decontaminated(
        spark, docs, spark.createDataFrame([(1, docs.where("doc_id = 7").first().text)], "item_id long, text string")),
}


def test_stages_are_the_pipelines():
    assert list(STAGES) == [n for n, _ in corpus_pipeline.STAGES[:-1]]


@pytest.mark.parametrize("name", STAGES)
def test_other_columns_come_back_as_they_were(spark, table, name):
    out = STAGES[name](spark, table)
    assert out.columns == table.columns and [t for _, t in out.dtypes] == [t for _, t in table.dtypes]
    rows = out.collect()
    assert 20 < len(rows) <= table.count()
    for r in rows:
        own = "none" if r.doc_id is None else str(r.doc_id)
        assert [r[c] for c in NAMES] == [f"{k}-{own}" for k in range(len(NAMES))]


def test_operators_do_not_look_at_other_columns(spark, table):
    import public_tokenizers
    plain = table.select("doc_id", "text", "lang", "source", "n_chars")
    runs = [lambda d: secret_scan.secrets(spark, d), lambda d: collocations.collocations(spark, d, 2, 5, 10),
            lambda d: line_dedup.summary(spark, d), lambda d: simhash_dedup.near_duplicates(spark, d),
            lambda d: token_counts.token_counts(d, public_tokenizers.path("piece_bpe_32k.model")),
            lambda d: packing.pieces(spark, d, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "length", "ids_crc32")]
    for run in runs:
        assert sorted(map(str, run(table).collect())) == sorted(map(str, run(plain).collect()))
