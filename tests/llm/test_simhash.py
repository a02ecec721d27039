import random

import pytest

from ledgerloom.llm import simhash

from .plain import simhash as plain_simhash
from .plain import simhash_classes


def test_fingerprints():
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "A b\tc\x0bd  e\x1cf\x85g é É", "x y z " * 500]
    for t in texts:
        assert simhash.fingerprint_text(t) == plain_simhash(t)
    assert simhash.fingerprint_text(None) == 0


def corpus(n, seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijkl") * rng.randint(1, 3) for _ in range(rng.randint(1, 60))] for _ in range(n // 5)]
    docs = []
    for i in range(n):
        words = list(rng.choice(base))
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = "edit"
        docs.append((i * 3, " ".join(words)))
    return docs + [(n * 3 + k, t) for k, t in enumerate((None, "", "  ", "Same text here", "same  TEXT here"))]


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_classes_at_every_cell_size(spark, parts):
    docs = corpus(150, parts)
    want = simhash_classes(docs)
    found = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), parts=parts, tile=16).collect()
    assert {r.doc_id: (r.fingerprint % (1 << 64), r.component_id) for r in found} == want and len(found) == len(docs)


def test_forest_of_a_dense_group_is_linear():
    import numpy as np

    prints = np.array([0] + [1 << b for b in range(64)] + [(1 << b) | 1 for b in range(1, 64)], np.uint64)
    ids = np.arange(len(prints))[::-1].copy()
    a, b = simhash.forest((ids, prints), None, 3)
    assert len(a) == len(prints) - 1 and set(b.tolist()) == {0}


def test_odd_rows(spark):
    rows = [(5, "same words in here", "f"), (5, "same words in here", "f"), (None, "same words in here", None), (2, "same words in here", "g"), (None, "alone it stands", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in found) == [(-1, -1), (-1, 2), (2, 2), (5, 2), (5, 2)]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.fingerprint or "") for r in kept.collect()) == [(-1, ""), (-1, "h"), (2, "g")]
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_hex(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(-1,), (10,)], "fp long").select(simhash.hex16(F.col("fp")).alias("h"))
    assert [r.h for r in df.collect()] == ["f" * 16, "000000000000000a"]
