from tallyspark.llm import simhash_dedup as S

A, B, C = ("alpha beta gamma delta epsilon", "one two three four five six seven", "red green blue white black brown")


def kept(spark, docs, rows):
    return sorted(((r.doc_id, r.text) for r in S.keep_one(spark, docs(rows)).collect()), key=str)


def test_every_component_keeps_one_row(spark, docs):
    # rows without ids are not one document
    assert kept(spark, docs, [(None, A), (None, B), (None, B), (None, C), (4, C)]) == sorted([(None, A), (None, B), (4, C)], key=str)
    # two texts under one id, each alone in its component
    assert kept(spark, docs, [(5, A), (5, B), (5, B)]) == [(5, A), (5, B)]
    # a text whose component has a smaller id does not come back by its own
    assert kept(spark, docs, [(5, A), (5, B), (3, B)]) == [(3, B), (5, A)]
    # null and empty texts are linked
    assert kept(spark, docs, [(2, None), (1, ""), (1, ""), (None, None)]) == [(1, "")]
