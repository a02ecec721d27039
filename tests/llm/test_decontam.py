import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import decontam

from .plain import align


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.lists(st.integers(-1, 5), max_size=25))
def test_alignment(item, passage):
    a, b = np.array(item), np.array(passage, int)
    assert abs(decontam.similarity(a, b)[0] - align(item, passage)) < 1e-9


def test_words():
    found = decontam.words(pa.array(["It's ÉTÉ, 12!", None, "", " a\nb "])).to_pylist()
    assert found == [["it", "s", "été", "12"], [""], [""], ["a", "b"]]


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(14, 40)))) for i in range(30)]
    items += [(100, "too short"), (101, ""), (102, None), (103, items[0][1])]
    docs, planted = [], {}
    for d in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        if d % 3 == 0:
            item = rng.choice(items[:30])
            copy = item[1].upper().split() if d % 2 else item[1].split()
            if d % 9 == 0:  # one word in ten edited, dropped or doubled
                for _ in range(max(1, len(copy) // 10)):
                    k = rng.randrange(len(copy))
                    copy[k : k + 1] = rng.choice([["edit"], [], [copy[k]] * 2])
            at = rng.randint(0, len(words))
            words[at:at] = copy
            planted[d] = item[0]
        docs.append((d, ", ".join(words) if d % 4 else "\n".join(words)))
    return docs, items, planted


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, leaks string"), spark.createDataFrame(items, "item_id long, text string")


def test_planted_passages_and_clean_documents(spark):
    docs, items, planted = corpus()
    docs += [(500, None), (501, ""), (502, "so it is too short a text"), (None, items[3][1]), (None, "clean")]
    d, i = frames(spark, docs, items)
    rows = decontam.summary(decontam.find_leaks(d, i, out="_l"), out="_l").collect()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {k for k, r in got.items() if r.contaminated} == set(planted)  # five words make a passage, two don't
    assert all(planted[k] in got[k]["items"] and got[k].best_score >= 0.6 for k in planted)
    assert [r.contaminated for r in rows if r.doc_id is None] == [True, False]


def test_score_is_that_of_the_whole_text(spark):
    docs, items, planted = corpus(8)
    d, i = frames(spark, docs, items)
    by = dict(items)
    for r in decontam.find_leaks(d, i, out="_l").collect():
        for hit in r["_l"]:
            item, text = (decontam.words(pa.array([t]))[0].as_py() for t in (by[hit["item"]], r.text))
            assert abs(hit["score"] - align(item, text[hit["start"] :])) < 1e-9 or hit["score"] <= align(item, text)


def test_blocks_find_the_same(spark):
    docs, items, _ = corpus(6)
    d, i = frames(spark, docs, items)
    one = {r.doc_id: [(x["item"], x["start"]) for x in r["_l"]] for r in decontam.find_leaks(d, i, out="_l").collect()}
    many = {r.doc_id: sorted((x["item"], x["start"]) for x in r["_l"]) for r in decontam.find_leaks(d, i, out="_l", max_seeds=600).collect()}
    assert one == many


def test_drop_and_empty(spark):
    docs, items, planted = corpus(7)
    d, i = frames(spark, docs, items)
    kept = decontam.drop_leaks(d, i)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {x for x, _ in docs} - set(planted)
    assert decontam.drop_leaks(d.limit(0), i).count() == 0 and decontam.drop_leaks(d, i.limit(0)).count() == len(docs)


def found_in(spark, texts, items):
    d, i = frames(spark, list(enumerate(texts)), items)
    return {r.doc_id: [(x["item"], x["start"]) for x in r["_l"]] for r in decontam.find_leaks(d, i, out="_l").collect()}


def test_edited_copies_are_found_as_by_aligning_all_pairs(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([5, 7, 12, 15, 25, 40])))) for k in range(25)]
    texts = []
    for k in range(250):
        copy = rng.choice(items)[1].split()
        rate = rng.choice([4, 5, 6])
        copy = [w if (j + 1) % rate else "edit" for j, w in enumerate(copy)] if k % 2 else [x for w in copy for x in ([w, "more"] if rng.random() < 0.5 else [w])]
        around = rng.choices(vocabulary, k=20)
        texts.append(" ".join(around[:10] + copy + around[10:]))
    got = found_in(spark, texts, items)
    for d, text in enumerate(texts):
        want = {i for i, item in items if align(item.split(), text.split()) >= 0.6 - 1e-12}
        assert {i for i, _ in got[d]} == want


def test_every_copy_of_an_item_counts(spark):
    item = " ".join(f"w{k}" for k in range(12))
    got = found_in(spark, [" ".join([item] * 70), f"x {item} y {item}"], [(1, item)])
    assert got == {0: [(1, 12 * k) for k in range(70)], 1: [(1, 1), (1, 14)]}


def test_ids_that_are_shared_or_null_and_scripts_without_spaces(spark):
    a, b, c, d = ("one two three four five six", "red green blue black white grey", "sun moon star sky cloud rain", "\u6211\u4eec\u4eca\u5929\u53bb\u5317\u4eac")
    got = found_in(spark, [a, b, c, f"\u4ed6\u8bf4{d}\u4e86"], [(1, a), (1, b), (None, c), (4, d)])
    assert got == {0: [(1, 0)], 1: [(1, 0)], 2: [(None, 0)], 3: [(4, 2)]}
