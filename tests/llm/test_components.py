import random

from ledgerloom.llm.components import connected_components

from .plain import components


def test_against_plain(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 90)]
    rng.shuffle(chain)
    star = [(100, 100 + i) for i in range(1, 60)]
    mixed = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(80)]
    edges = chain + star + mixed + [(500, 500)] + chain[:5]
    want = components(501, edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"), "a", "b").collect()}
    assert got == {n: want[n] for n in {x for e in edges if e[0] != e[1] for x in e}}


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
