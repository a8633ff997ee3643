import random

from tallyspark.llm.components import components


def test_chains_hubs_and_loops(spark):
    rng = random.Random(1)
    names = rng.sample(range(-10**9, 10**9), 400)
    chain = list(zip(names[:150], names[1:151]))
    hub = [(names[200], n) for n in names[201:300]]
    ring = list(zip(names[300:320], [*names[301:320], names[300]]))
    edges = [e if rng.random() < 0.5 else e[::-1] for e in chain + hub + ring] + [(names[350], names[350])] + hub[:5]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for part in (names[:151], names[200:300], names[300:320]):
        want |= dict.fromkeys(part, min(part))
    assert got == want


def test_no_edges(spark):
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0
