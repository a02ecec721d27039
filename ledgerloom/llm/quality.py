"""Operator 7: quality by weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text.  The
votes of all texts, as counts per combination of votes, go through
expectation-maximisation, which estimates the share of good texts and each
labeller's accuracies without any true label.  The posterior of a combination
is its texts' soft label.  A linear scorer over hashed byte trigrams learns
these labels on a bounded sample (``sample``, expected rows, taken by a hash of
the text) and then scores every text.

The table of combinations has at most 3^labellers rows, whatever the input.

Defined results: null, empty and blank texts score 0 and are not kept; without
any other text the scorer stays at 0.5 and keeps.  Equal texts score equally.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import must_be_free

#: Buckets of the scorer, and bytes of a text that are counted at once.
DIM = 1 << 12
PIECE = 1 << 22

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|<>{}[]\\^~_=@+")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
GOOD, NONE, BAD = 2, 1, 0
#: A word of letters with one mark after it at most.
PLAIN = re.compile(r"(?<!\S)[^\W\d_]+[.,;:!?]?(?!\S)")


def _vote(bad: bool, good: bool = False) -> int:
    return BAD if bad else GOOD if good else NONE


def votes(text: str) -> list[int]:
    """The labellers' votes on a text that isn't blank: 2 good, 1 nothing, 0 bad.

    Most labellers look for one defect and say nothing without it; plain words and sentence marks
    also speak for a text, and overlap with all others.
    """
    raw = text.encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    letters, size, n = max(1, seen[LETTERS].sum()), len(raw), max(1, len(words))
    plain = sum(1 for _ in PLAIN.finditer(text)) / n
    ends = (seen[46] + seen[63] + seen[33]) / n
    fresh, echo = len(set(words)) / n, sum(map(eq, words, words[1:])) / n
    return [
        _vote(plain < 0.75, plain > 0.95 and echo < 0.05 and (n < 50 or fresh > 0.3)),
        _vote(seen[SYMBOLS].sum() / size > 0.03),
        _vote(seen[UPPER].sum() / letters > 0.3),
        _vote(text.count("!!") / n > 0.1),
        _vote(len(lines) >= 3 and len(set(lines)) < 0.7 * len(lines)),
        _vote(n >= 50 and fresh < 0.25),
        _vote(echo > 0.2),
        _vote(not 2 <= letters / n <= 14),
        _vote(n >= 30 and ends < 0.01, 0.02 < ends < 0.4),
        _vote(text.count(" | ") / n > 0.1),
        _vote(seen[DIGITS].sum() / size > 0.15),
    ]


LABELLERS = 11


@dataclass(frozen=True)
class Labels:
    """What expectation-maximisation found."""

    prior: float  # share of good texts
    chances: np.ndarray  # [labeller, vote, class]: chance of a vote given bad (0) or good (1)

    def posterior(self, combination: np.ndarray) -> np.ndarray:
        """Chance that texts with these votes (rows) are good."""
        logs = np.log(self.chances)
        score = np.tile(np.log([1 - self.prior, self.prior]), (len(combination), 1))
        for j in range(combination.shape[1]):
            score += logs[j, combination[:, j]]
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))


def estimate(combination: np.ndarray, weight: np.ndarray, rounds: int = 100) -> Labels:
    """Accuracies of the labellers from combinations of votes and how many texts have them."""
    good, bad = (combination == GOOD).sum(axis=1), (combination == BAD).sum(axis=1)
    p = np.where(2 * bad > good, 0.1, 0.9)  # starts from the votes: defects are rare and say more
    for _ in range(rounds):
        soft = np.stack([weight * (1 - p), weight * p], axis=1)
        chances = np.stack([[soft[combination[:, j] == v].sum(axis=0) for v in range(3)] for j in range(combination.shape[1])]) + 1.0
        chances /= chances.sum(axis=1, keepdims=True)
        found = Labels(float(np.clip(soft[:, 1].sum() / weight.sum(), 0.01, 0.99)), chances)
        last, p = p, found.posterior(combination)
        if np.abs(p - last).max() < 1e-6:
            break
    return found


def features(text: str) -> np.ndarray:
    """Row of hashed byte trigrams, case and marks included, digits as one, and of their variety.

    The variety (how many buckets are in use, for the text's length) tells repetition apart.
    """
    raw = np.frombuffer(f"  {text}  ".encode(), np.uint8)
    total = np.zeros(DIM, np.float32)
    for at in range(0, len(raw) - 2, PIECE):
        b = raw[at : at + PIECE + 2]
        b = np.where(DIGITS[b], 48, b).astype(np.uint32)
        code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2246822519) >> 20
        total += np.bincount(code, minlength=DIM)
    size, used = int(total.sum()), int((total > 0).sum())
    variety = size.bit_length() * 32 + int(31 * used / min(size, DIM))
    total = np.log1p(total)
    total /= np.linalg.norm(total)
    total[(variety * 2654435761 >> 8) % DIM] += 0.5
    return total


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 8.0, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic scorer for soft labels; both classes weigh alike."""
    x, y = x.astype(np.float32), y.astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    mass = np.maximum(np.array([(1 - y).sum(), y.sum()], np.float32), 1e-9)
    weight = y / mass[1] / 2 + (1 - y) / mass[0] / 2
    target = (y / mass[1] / 2) / weight
    step = np.zeros_like(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        error = weight * (p - target)
        step = 0.9 * step + np.append(error @ x + decay * w[:-1], error.sum())
        w -= rate * step
    return w


def _combinations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of combinations of votes, a code each (base 3)."""
    total: dict[int, int] = {}
    for batch in batches:
        for value in batch.column(0):
            code = 0
            for v in votes(value.as_py()):
                code = code * 3 + v
            total[code] = total.get(code, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"])


@dataclass(frozen=True)
class Scorer:
    labels: Labels | None
    weights: np.ndarray


def fit(docs: DataFrame, text: str = "text", sample: int = 4000) -> Scorer:
    """Labellers' accuracies over all texts, and the scorer that a bounded sample of them trains."""
    rows = docs.select(F.col(text).alias("text")).where(r"text RLIKE '\\S'")
    seen = rows.mapInArrow(_combinations, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    if not seen:
        return Scorer(None, np.zeros(DIM + 1))
    codes, weight = np.array([r["code"] for r in seen]), np.array([r["n"] for r in seen], float)
    combination = codes[:, None] // 3 ** np.arange(LABELLERS - 1, -1, -1) % 3
    labels = estimate(combination, weight)
    share = min(1.0, sample / weight.sum())
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()  # copies are drawn together

    # what a sampled text teaches goes to the one training task as numbers of fixed size, however long it is
    lesson = _lesson(F.col("text"), labels)
    taught = drawn.select(F.md5("text").alias("text"), lesson.alias("lesson")).select("text", "lesson.row", "lesson.good")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text")  # by digest: one order, wherever the rows come from
        x = np.stack([np.frombuffer(r, "<f4") for r in group["row"]])
        return pd.DataFrame({"w": [train(x, group["good"].to_numpy())]})

    found = taught.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "w array<double>").first()
    return Scorer(labels, np.array(found["w"]) if found else np.zeros(DIM + 1))


def _lesson(text: Column, labels: Labels) -> Column:
    """Struct (row: features as bytes, good: posterior label) of a text that isn't blank."""

    @F.arrow_udf("struct<row:binary,good:double>")
    def taught(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        good = labels.posterior(np.array([votes(t) for t in texts], int).reshape(len(texts), LABELLERS))
        rows = pa.array([features(t).astype("<f4").tobytes() for t in texts], pa.binary())
        return pa.StructArray.from_arrays([rows, pa.array(good, pa.float64())], names=["row", "good"])

    return taught(text)


def score(text: Column, scorer: Scorer) -> Column:
    """Chance (0 to 1) that a text is good; 0 for a blank one."""
    weights = scorer.weights

    @F.arrow_udf("double")
    def scores(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column))
        for k, value in enumerate(column):
            text = value.as_py()
            if text and text.strip():
                out[k] = 1 / (1 + np.exp(-np.clip(features(text) @ weights[:-1] + weights[-1], -500, 500)))
        return pa.array(out)

    return scores(text)


def classify(docs: DataFrame, scorer: Scorer, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of ``text`` in column ``out``."""
    must_be_free(docs, out)
    return docs.withColumn(out, score(F.col(text), scorer))
