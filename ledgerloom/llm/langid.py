"""Operator 1: language by nearest centroid.

A text becomes a TF-IDF vector over hashed byte trigrams of its lower-cased
letters (everything else counts as a space), normalised to length one.  Each
language has several centroids, found by spherical k-means on a bounded sample
of its labelled texts.  The language of the closest centroid by cosine wins; a
text is rejected if its cosine is below half of what all but one in a hundred
labelled texts of that language and about its length reach.

Document frequencies come from all training texts.  ``sample`` (a parameter)
bounds the expected number of sampled texts a language; that sample, the
different texts that a hash of the text draws, only places centroids and radii.
A sampled text reaches its language's task as its counts, 16 KB however long
it is.  The model is a few arrays of fixed size a language.

Defined results: null text and text without a letter get ``und``, score 0, and
are rejected.  Without any labelled text every language is ``und`` with score 0
and nothing but such texts is rejected.  Ties go to the language first in
alphabetical order.  Texts are read whole, in bounded pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import must_be_free, stored

#: Size of the hashed feature space.
DIM = 1 << 12
#: Bytes of a text that are counted at once.
PIECE = 1 << 22
#: A text is rejected below this part of this quantile of the cosines of labelled texts of its language and
#: length band; bands with fewer of them take it from their neighbours.
SLACK, QUANTILE, LEAST = 0.5, 0.01, 20
BANDS = 24

LETTER = re.compile(r"[^\W\d_]")
# letters and bytes above ASCII stay, all else is a space
FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]  # a language per centroid
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    floor: np.ndarray  # lowest cosine accepted, by centroid and length band


def counts(text: str) -> np.ndarray:
    """Trigram counts of a text, in hashed buckets."""
    line = b" " + b" ".join(text.lower().encode().translate(FOLD).split()) + b" "
    total = np.zeros(DIM, np.int64)
    for at in range(0, len(line) - 2, PIECE):
        b = np.frombuffer(line, np.uint8, min(PIECE + 2, len(line) - at), at).astype(np.uint32)
        code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761) >> 20
        total += np.bincount(code, minlength=DIM)
    return total


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows of count rows (a zero row stays zero)."""
    x = np.log1p(raw.astype(np.float32)) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def band(raw: np.ndarray) -> np.ndarray:
    """Length band of count rows: the power of two in their number of trigrams."""
    return np.log2(np.maximum(raw.sum(axis=1), 1)).astype(int).clip(0, BANDS - 1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Up to ``k`` unit centroids of unit rows."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[near == c].sum(axis=0) for c in range(len(centres)) if (near == c).any()])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


def floors(cosines: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Lowest cosine accepted in each length band.

    Bands without enough texts lie between their neighbours.  Below the first
    that has them it falls with the root of the length, as chance adds more to
    short texts; without any band nothing is too far.
    """
    every = np.arange(BANDS)
    known = np.array([b for b in every if (bands == b).sum() >= LEAST], int)
    if not len(known):
        return np.zeros(BANDS)
    at = np.array([np.quantile(cosines[bands == b], QUANTILE) for b in known]) * SLACK
    return np.interp(every, known, at) * np.where(every < known[0], 2.0 ** ((every - known[0]) / 2), 1)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = 1500, clusters: int = 4) -> Model:
    """Model of the labelled rows of ``docs`` (callers drop rows that must not be learned from)."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = stored(rows.groupBy("lang").agg(F.count("lang").alias("n")), "languages")
    n = sizes.agg(F.sum("n")).first()[0]
    if not n:
        return Model((), np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), np.zeros((0, BANDS)))
    seen = rows.select("text").mapInArrow(_document_frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIM)
    for r in seen:
        df[r["bucket"]] = r["n"]
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    chance = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(sizes, "lang").where(chance < F.lit(float(sample)) / F.col("n")).select("lang", "text").distinct()
    counted = drawn.select("lang", _count_column(F.col("text")).alias("raw"))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        raw = np.stack([np.frombuffer(c, "<i4") for c in sorted(group["raw"])])
        x = vectors(raw, idf)
        centres = kmeans(x, clusters)
        floor = floors((x @ centres.T).max(axis=1), band(raw))
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centres": [centres.astype(np.float32).ravel()], "floor": [floor]})

    placed = counted.groupBy("lang").applyInPandas(place, "lang string, centres array<float>, floor array<double>").collect()
    placed.sort(key=lambda r: r["lang"])
    centres = [np.array(r["centres"], np.float32).reshape(-1, DIM) for r in placed]
    langs = tuple(r["lang"] for r, c in zip(placed, centres) for _ in c)
    floor = [np.array(r["floor"]) for r, c in zip(placed, centres) for _ in c]
    if not langs:
        return Model((), idf, np.zeros((0, DIM), np.float32), np.zeros((0, BANDS)))
    return Model(langs, idf, np.concatenate(centres), np.stack(floor))


def _count_column(text: Column) -> Column:
    """Trigram counts of a text as bytes of fixed size."""

    @F.arrow_udf("binary")
    def counted(column: pa.Array) -> pa.Array:
        return pa.array([np.minimum(counts(value.as_py()), 2**31 - 1).astype("<i4").tobytes() for value in column], pa.binary())

    return counted(text)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DIM, np.int64)
    for batch in batches:
        for value in batch.column(0):
            total += counts(value.as_py()) > 0
    used = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])


def predict(text: Column, model: Model) -> Column:
    """Struct (lang, score, rejected) of a text column."""
    arrays = model.idf, model.centroids, model.floor, model.langs

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def nearest(column: pa.Array) -> pa.Array:
        idf, centroids, floor, langs = arrays
        lang, score, rejected = ["und"] * len(column), np.zeros(len(column)), np.ones(len(column), bool)
        turn: list[tuple[int, np.ndarray]] = []

        def finish():
            at = [k for k, _ in turn]
            raw = np.stack([c for _, c in turn])
            if len(langs):
                cos = vectors(raw, idf) @ centroids.T
                best = cos.argmax(axis=1)
                score[at] = np.clip(cos.max(axis=1), 0, 1)
                rejected[at] = score[at] < floor[best, band(raw)]
                for k, b in zip(at, best):
                    lang[k] = langs[b]
            else:
                rejected[at] = False
            turn.clear()

        for k, value in enumerate(column):
            text = value.as_py()
            if text and LETTER.search(text):
                turn.append((k, counts(text)))
                if len(turn) == 256:
                    finish()
        if turn:
            finish()
        return pa.StructArray.from_arrays([pa.array(lang), pa.array(score), pa.array(rejected)], names=["lang", "score", "rejected"])

    return nearest(text)


def held_out(id: Column) -> Column:
    """The third of ids that nothing is learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with (lang, score, rejected) in column ``out``."""
    must_be_free(docs, out)
    return docs.withColumn(out, predict(F.col(text), model))
