import hashlib
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import bpe, decontam, langid
from ledgerloom.llm.queries import BOILERPLATE, MIN_CHARS, MIN_PAGES, ORACLES, PATTERN, QUERIES, RANKS, language_model

from .plain import simhash_classes, without_boilerplate

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(QUERIES)
    assert [n for n in QUERIES if n.startswith("op")] == list(QUERIES) and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_each_stage_against_its_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("language", F.lit(1)).cache()
    model = language_model(docs)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["language_id"](spark, docs, SF)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in langid.identify(docs.drop("language"), model).where("NOT language.rejected").collect()}
    rows = out.collect()
    assert {r.doc_id for r in rows} == kept and len(rows) >= 0.98 * docs.count()

    clean = stages["line_dedup"](spark, out, SF)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts == without_boilerplate([(r.doc_id, r.source, r.text) for r in rows], BOILERPLATE, MIN_PAGES, MIN_CHARS) and texts != {r.doc_id: r.text for r in rows}

    single = stages["near_dedup"](spark, clean, SF)
    assert single.columns == docs.columns
    classes = simhash_classes(list(texts.items()))
    left = {r.doc_id: r.text for r in single.collect()}
    assert left == {i: texts[i] for i, (_, root) in classes.items() if i == root}

    free = stages["decontaminate"](spark, single, SF)
    assert free.columns == docs.columns
    found = decontam.find_leaks(single, spark.read.parquet(f"{SF}/benchmark.parquet"), out="_l")
    bad = {r.doc_id for r in found.where(F.size("_l") > 0).collect()}
    assert {r.doc_id for r in free.collect()} == set(left) - bad

    encode = bpe.encoding(RANKS, PATTERN).encode_ordinary
    for r in stages["tokenize"](spark, free, SF).collect():
        ids = encode(left[r.doc_id] or "")
        assert list(r.token_ids) == ids and r.decoded_sha256 == hashlib.sha256((left[r.doc_id] or "").encode()).hexdigest()


def test_odd_documents_pass_every_stage(spark):
    rows = [
        (None, None, None, None, None), (None, "The and that is of in.", "en", "s", 1), (1, "", "en", "s", 0), (2, "The and that is of in.", None, None, None),
        (3, "The and that is of in the house by the river.", "en", "s", 5), (3, "The and that is of in the house by the river.", "en", "s", 5), (4, "word " * 100_000, "en", "s", 9),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, line int, _language string")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = stage(spark, docs, SF)
    found = docs.collect()
    assert sum(r.doc_id == 3 for r in found) == 1 and {4, None} <= {r.doc_id for r in found}
