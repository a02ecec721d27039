import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import queries, spelling


def plain_counts(docs):
    """Words of the contract of op13 with their counts, from (id, text) rows."""
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32((b"" if key is None else b"%d:" % key) + run.encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return rows


def some_words(rng, letters, size, lengths):
    words = set()
    while len(words) < size:
        w = "".join(rng.choices(letters, k=rng.choice(lengths)))
        words |= {w, w[:2] + rng.choice(letters) + w[2:], w[:1] + w[2:], w[:3] + rng.choice(letters) + w[4:], w[::-1], "".join(sorted(w))}
    return sorted(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("abZÀÉ×ßÿĀ .\n1Ω", max_size=30)), max_size=6))
def test_runs_of_letters_and_their_crc(texts):
    runs, rows = spelling.letter_runs(pa.array(texts, pa.string()))
    want = [(i, re.sub("[A-Z]", lambda m: m[0].lower(), r)) for i, t in enumerate(texts) for r in re.findall("[A-Za-zÀ-ÿ]+", t or "")]
    assert list(zip(rows.tolist(), runs.to_pylist())) == want
    prefixes = [b"%d:" % i for i in range(len(texts))]
    assert spelling.keyed_crc32(prefixes, runs, rows).tolist() == [zlib.crc32(prefixes[i] + r.encode()) for i, r in want]


def test_crc_of_long_runs():
    texts = ["a" * 5, "é" * 300, "b" * 64, "c" * 65, "d" * 100_000]
    runs, rows = spelling.letter_runs(pa.array(texts))
    assert spelling.keyed_crc32([b"7:"] * 5, runs, rows).tolist() == [zlib.crc32(b"7:" + t.encode()) for t in texts]


@pytest.mark.parametrize("cell,asking", [(spelling.CELL, spelling.ASKING), (24, 16)])
def test_groups_equal_all_pairs(spark, monkeypatch, cell, asking):
    """Whole trees, and trees whose upper levels are split in Spark."""
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "ASKING", asking)
    monkeypatch.setattr(spelling, "LEAF", 4)
    rng = random.Random(4)
    words = some_words(rng, "abcdeé", 400, [5, 6, 6, 6, 7]) + ["longer" * 40, "longer" * 40 + "s", "ab" + "longer" * 40]
    counts = {w: int(3 * 1.5 ** rng.randint(0, 12)) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    if cell == 24:
        rows = spelling.cells(table).where("NOT asks").groupBy("tree", "node").count().collect()
        assert len(rows) > 20 and max(r["count"] for r in rows) <= 24
    assert {tuple(r) for r in spelling.variant_groups(table).collect()} == plain_groups(counts)


def test_words_of_the_same_letters_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 16)
    monkeypatch.setattr(spelling, "ASKING", 8)
    import itertools

    words = ["".join(p) for p in itertools.permutations("abcde")] + ["abcdef", "abxde", "abcd" * 2]
    counts = {w: 3 + i for i, w in enumerate(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variant_groups(table).collect()} == plain_groups(counts)


def test_chains_lead_to_the_last_form(spark):
    words = ["a" * i + "b" * (40 - i) for i in range(40)]
    counts = {w: 2**k for k, w in enumerate(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = {r.word: r for r in spelling.variant_groups(table).collect()}
    assert {r.root for r in rows.values()} == {words[-1]} and rows[words[0]].form == words[1] and rows[words[-1]].form is None


def test_query(spark, tmp_path):
    rng = random.Random(8)
    words = some_words(rng, "abcÉé", 120, [5, 6, 7])
    docs = [(i, " ".join(rng.choices(words, k=40)).capitalize() + ".") for i in range(120)]
    docs += [(None, "Wordy wordy wordy"), (5, None), (6, ""), (7, "12 ..."), (8, "x" * 70_000), (8, "x" * 70_000), (8, "x" * 70_000)]
    spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, word int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_spelling(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_groups(plain_counts(docs))


def test_empty(spark):
    assert spelling.variant_groups(spelling.word_counts(spark.createDataFrame([], "text string, word int"))).count() == 0
    none = spark.createDataFrame([("one two three",)], "text string")
    assert spelling.variant_groups(spelling.word_counts(none)).count() == 0
