"""The corpus pipeline: five operators, each over all that the one before has kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``.  ``run`` writes each stage's result as Parquet to the shared
checkpoint folder and reads it again, so a lost executor repeats one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontam, langid, linededup, simhash
from ledgerloom.llm.common import fresh, stored, table
from ledgerloom.llm.queries import BOILERPLATE, HOST, MIN_CHARS, MIN_PAGES, PATTERN, RANKS, language_model


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; rejected ones go."""
    found = fresh("_language", docs)
    return langid.identify(docs, language_model(docs), out=found).where(~F.col(found)["rejected"]).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their site; ``n_chars`` follows the text."""
    cleaned = linededup.drop_boilerplate(docs, F.col(HOST), ratio=BOILERPLATE, min_pages=MIN_PAGES, min_chars=MIN_CHARS)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, the one with the smallest id: 3-word shingles, 3 bits."""
    return simhash.keep_first(docs, width=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digests of a round trip."""
    encoded = bpe.round_trip(docs.select("doc_id", "text"), RANKS, PATTERN)
    ids = F.col("token_ids")
    return encoded.select(
        "doc_id",
        ids,
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

#: SQL can't express SimHash classes, alignments or BPE; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
