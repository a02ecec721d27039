"""Registered queries of the ten operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, dac, decontam, embdedup, langid, licenses, linededup, periodic, pii, quality, simhash, spelling, tokencount
from .common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
HOST = "source"
#: Lines on more than so large a share and at least so many of a site's pages, of so many characters, are boilerplate.
#: In the test tables a line of ordinary text stands on one page of a site, or on two if a near copy is there (0.4 % of a
#: site's pages at most); lines that are repeated on purpose stand on 0.1 to 13 % of them, most of their occurrences above 1 %.
BOILERPLATE, MIN_PAGES, MIN_CHARS = 0.01, 3, 10
#: Lowest quality score that is kept: only clear cases go.
KEEP = 0.2
#: Documents of more tokens are over the limit.
TOKEN_LIMIT = 1024


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from the documents that aren't held out."""
    return langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by nearest centroid; learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(F.col("text"), language_model(docs)).alias("p")
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), found)
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents")
    found = decontam.find_leaks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"), out="leaks")
    return decontam.summary(found, "doc_id", "leaks")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.summary(pii.find_pii(docs), "doc_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings at a cosine of 0.95."""
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its site (its source)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_boilerplate(docs, F.col(HOST), ratio=BOILERPLATE, min_pages=MIN_PAGES, min_chars=MIN_CHARS, dropped="n_dropped")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from weak labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, quality.fit(docs))
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= KEEP).alias("kept"))


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, number and checksum of each document's ids."""
    folder = scratch_path(spark, "tokens")
    manifest = dac.write_tokens(table(spark, sf_dir, "documents"), folder, WORD_BPE)
    return dac.read_documents(manifest, folder)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, and the digest of the bytes that its ids decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, RANKS, PATTERN), "doc_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document by its own notices or its nearest directory's; paths are source/lang/id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.licenses(docs, path)


def with_period(text: Column, key: Column) -> Column:
    """The words of every tenth text (by the CRC of its key) from one place on repeat those from there."""
    h = F.crc32(key.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat(F.slice(w, F.lit(1), a), F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(w, a + i % p)))

    planted = F.array_join(F.transform(F.array(words), lambda w: F.array_join(repeat(w), " ")), " ")
    return F.when((h % 10 == 0) & (F.size(words) > 0), planted).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of which get a repeating end first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", with_period(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.with_runs(docs, "text")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("m"), F.array_join(lines, "").alias("lines"), "collapsed")
    length, period = F.col("m.length"), -F.col("m.period")
    return rows.select(
        "doc_id", "n_runs", (-F.col("m.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, TOKEN_LIMIT)


def misspelt(runs: pa.LargeStringArray, rows: np.ndarray, keys: list) -> pa.Array:
    """Runs of letters, of which those whose keyed CRC 97 divides lose a letter."""
    crc = spelling.keyed_crc32([b"" if k is None else b"%d:" % k for k in keys], runs, rows)
    hit = np.flatnonzero(crc % 97 == 0)
    whole = runs.take(pa.array(hit)).to_pylist()
    places = (crc[hit] % np.array([max(1, len(w)) for w in whole], np.uint32)).tolist() if whole else []
    cut = pa.array([w[:i] + w[i + 1 :] for w, i in zip(whole, places)], pa.large_string())
    rest = runs.filter(pa.array(crc % 97 != 0))
    return pa.concat_arrays([rest, cut])


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some of which lose a letter first."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), key="doc_id", edit=misspelt)
    return spelling.variant_groups(words)


QUERIES = {f.__name__: f for f in (op1_language, op2_decontaminate, op3_pii, op4_simhash, op5_embeddings, op6_line_dedup, op7_quality, op8_tokens, op9_bpe, op10_licenses, op11_runs, op12_counts, op13_spelling)}

ORACLES = {
    "op5_embeddings": """
        WITH RECURSIVE links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.95),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        best AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(best.b, vec_id)) AS component_id,
            vec_id = least(vec_id, coalesce(best.b, vec_id)) AS kept
        FROM embeddings LEFT JOIN best ON best.a = vec_id LEFT JOIN degree ON degree.a = vec_id""",
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, source, md5(text) AS page, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
        totals AS (SELECT source, count(DISTINCT text) AS total FROM documents GROUP BY source),
        common AS (
            SELECT source, trim(line, ' ') AS line FROM lines JOIN totals USING (source) WHERE length(trim(line, ' ')) >= {MIN_CHARS}
            GROUP BY source, trim(line, ' '), total HAVING count(DISTINCT page) >= {MIN_PAGES} AND count(DISTINCT page) / total > {BOILERPLATE}),
        marked AS (
            SELECT l.doc_id, l.line, l.place, c.line IS NOT NULL AS gone FROM lines l
            LEFT JOIN common c ON c.source = l.source AND c.line = trim(l.line, ' ')),
        per AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS n_dropped FROM marked GROUP BY doc_id)
        SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, coalesce(n_dropped, 0) AS n_dropped
        FROM documents LEFT JOIN per USING (doc_id)""",
}
