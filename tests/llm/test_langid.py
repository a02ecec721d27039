import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid
from ledgerloom.llm.queries import language_model

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_counts_are_those_of_the_whole_text(monkeypatch):
    text = "Ärger: 12 Straßen! " * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "PIECE", 7)
    assert (langid.counts(text) == whole).all() and whole.sum() == len("ärger straßen ".encode()) * 50 + 1 - 2
    assert langid.counts("!! 12").sum() <= 1


def plain_nearest(text, model):
    """Language and cosine of a text by dictionaries of trigrams."""
    folded = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in text.lower())
    line = b" " + b" ".join(folded.encode().split()) + b" "
    bag = {}
    for i in range(len(line) - 2):
        bucket = (int.from_bytes(line[i : i + 3], "big") * 2654435761 % 2**32) >> 20
        bag[bucket] = bag.get(bucket, 0) + 1
    weights = {b: math.log1p(n) * float(model.idf[b]) for b, n in bag.items()}
    norm = math.sqrt(sum(w * w for w in weights.values())) or 1
    cosines = [sum(w * float(c[b]) for b, w in weights.items()) / norm for c in model.centroids]
    best = max(range(len(cosines)), key=lambda k: cosines[k])
    return model.langs[best], cosines[best], sum(bag.values())


@needs_tables
def test_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL").limit(150)
    model = language_model(docs)
    for r in langid.identify(docs.select("text"), model).collect():
        if r.language.lang != "und":
            lang, cosine, n = plain_nearest(r.text, model)
            assert abs(cosine - r.language.score) < 1e-4
            assert lang == r.language.lang or abs(cosine - r.language.score) < 1e-6
            floor = model.floor[model.langs.index(lang), min(int(math.log2(max(n, 1))), langid.BANDS - 1)]
            assert r.language.rejected == (r.language.score < floor) or abs(cosine - floor) < 1e-4


@needs_tables
@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_a_language_that_was_not_learned_is_rejected(spark, left_out):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL")
    model = language_model(docs.where(F.col("lang") != left_out))
    assert left_out not in model.langs
    rows = langid.identify(docs, model).where("length(text) > 100").collect()
    assert np.mean([r.language.rejected for r in rows if r.lang == left_out]) >= 0.9
    assert np.mean([r.language.rejected for r in rows if r.lang not in (left_out, None)]) < 0.02


def test_floors():
    bands = np.array([6] * 30 + [9] * 30 + [7] * 3)
    got = langid.floors(np.where(bands == 6, 0.4, 0.8), bands)
    assert got[6] == 0.2 and got[9] == 0.4 and got[12] == 0.4 and abs(got[7] - (0.2 + 0.2 / 3)) < 1e-12 and got[4] == 0.1
    assert not langid.floors(np.ones(5), np.arange(5)).any()


def test_many_labels_and_taken_names(spark):
    docs = spark.createDataFrame([(i, f"wort{i} und text", f"lang{i:04}") for i in range(1200)], "doc_id long, text string, lang string")
    model = langid.fit(docs, clusters=1)
    assert len(set(model.langs)) == 1200
    with pytest.raises(ValueError, match="Text"):
        langid.identify(docs, model, out="Text")


def test_held_out(spark):
    import zlib

    rows = spark.range(50).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


@needs_tables
def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_model(docs)
    assert sorted(set(model.langs)) == ["de", "en", "es", "fr"] and len(model.langs) == 16
    rows = langid.identify(docs.withColumn("score", F.lit("x")), model).where(langid.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.language.lang == r.lang for r in rows]) > 0.97
    assert np.mean([r.language.rejected for r in rows]) < 0.01
    odd = [(1, None), (2, ""), (3, "12 !!"), (4, "Съешь же ещё этих мягких французских булок"), (5, "qxzj vkwq zzxq jjqv wvkx qqzx " * 20), (6, rows[0].text), (6, rows[0].text)]
    found = langid.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert [r.language.lang for r in found[:3]] == ["und"] * 3 and [r.language.score for r in found[:3]] == [0.0] * 3
    assert all(r.language.rejected for r in found[:5]) and found[5].language == found[6].language and not found[5].language.rejected
    assert all(0 <= r.language.score <= 1 for r in found)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.langs == ()
    rows = langid.identify(docs, model).collect()
    assert [(r.language.lang, r.language.rejected) for r in rows] == [("und", False), ("und", True), ("und", True)]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma" if i % 2 else "uno dos tres", "xx" if langid_held(i) else ("aa" if i % 2 else "bb")) for i in range(60)], "doc_id long, text string, lang string")
    assert set(language_model(docs).langs) == {"aa", "bb"}


def langid_held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 3 == 1
