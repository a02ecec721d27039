import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import periodic, queries

from .plain import WORD


def lyndon(word):
    """Longest Lyndon word from each place: smaller than all its own suffixes."""
    return [max(j - i for j in range(i + 1, len(word) + 1) if all(word[i:j] < word[k:j] for k in range(i + 1, j))) for i in range(len(word))]


def runs(words, least=12):
    """All runs (start, length, period) by comparing all words at every distance; a stretch keeps its smallest period."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            if j + q - i >= max(least, 2 * q) and not any(words[i : j + q - p] == words[i + p : j + q] for p in range(1, q)):
                found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def digest(text, h):
    """The contract of op11, from one text and the CRC of its id."""
    words = WORD.findall(text or "")
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    all_runs, gone = runs(words), set()
    for s, m, q in all_runs:
        gone |= set(range(s + q, s + m))
    best = min(all_runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in all_runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(all_runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=18))
def test_grouping_gives_the_lyndon_array(word):
    assert periodic.lyndon_array(word) == lyndon(word)
    assert periodic.lyndon_array([2 - x for x in word]) == lyndon([2 - x for x in word])


def sequences():
    block = st.lists(st.integers(0, 5), min_size=1, max_size=12)
    return st.lists(st.tuples(block, st.integers(1, 5)), max_size=5).map(lambda parts: [w for b, k in parts for w in b * k])


@settings(max_examples=300, deadline=None)
@given(sequences())
def test_runs_and_stretches(word):
    words = [b"w%d" % w for w in word]
    assert periodic.runs_in_text(words) == runs(words)
    short = periodic.runs_of(np.array(word, np.int64), 2) if word else set()
    assert sorted((s, e - s, q) for s, e, q in short) == sorted(runs(word, 2))


def test_unique_words_leave_no_stretch():
    assert list(periodic.stretches(np.arange(1000))) == []
    rng = random.Random(1)
    words = [rng.randrange(10**9) for _ in range(500)] + [1, 2, 3, 4, 5, 6] * 3 + [rng.randrange(10**9) for _ in range(500)]
    assert list(periodic.stretches(np.array(words))) == [(500, 518)]


@pytest.mark.parametrize("words", [[b"a"] * 300_000, [b"%d" % (i % 40_000) for i in range(120_000)]])
def test_long_texts(words):
    period = len(set(words))
    assert periodic.runs_in_text(words) == [(0, len(words), period)]
    assert periodic.collapse(words, [(0, len(words), period)]).split() == words[:period]


def test_query_digests(spark, tmp_path):
    rng = random.Random(3)
    plain = ["alpha", "Béta", "γ", "don't", "x y", "1", "2"]
    texts = [None, "", " \t\n", "a b " * 8, "a\x0bb\x0cc\r" * 6, "a\x1cb\x85c " * 7]
    texts += [" ".join(rng.choices(plain, k=rng.randint(0, 60))) for _ in range(150)]
    texts += [" ".join(["one two three"] * rng.randint(1, 9) + rng.choices(plain, k=5)) for _ in range(40)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "a b c " * 9, "s"), (3, texts[3], "s")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_runs(spark, str(tmp_path)).collect()
    want = [(i, *digest(t, 1 if i is None else zlib.crc32(b"%d" % i))) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(zlib.crc32(b"%d" % i) % 10 == 0 for i, *_ in rows if i is not None) > 10


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "id int, Runs string")
    with pytest.raises(ValueError):
        periodic.with_runs(docs.withColumn("text", F.lit("a")))
    empty = spark.createDataFrame([], "text string, start int")
    assert periodic.with_runs(empty).columns == ["text", "start", "runs", "collapsed"] and periodic.with_runs(empty).count() == 0
