"""Operator 2: benchmark decontamination by seeds that lose nothing and Smith-Waterman alignment.

Test items and documents become lower-cased words (runs of letters and digits;
single characters in scripts without spaces).  Seeds are pairs of adjacent item
words, or single words for items of under ten.  An alignment that reaches the
threshold holds a least number of its item's seeds (``needed``), so only item
and text with that many seeds inside the longest possible alignment meet.  Pairs
that stand in more than ``item_share`` of the items may be left out, never more
than that number allows.  So the seeds lose no passage, whatever its edits.

Smith-Waterman (match 1, mismatch and gap -0.5) scores a passage against the
item; the score divided by the item's length is the similarity.  What lies on
both sides of an accepted alignment is aligned again, until no part reaches the
threshold.  Passages with too few of the item's words to reach it are not
aligned, which changes no result.

Seeds meet the documents in blocks of items with at most ``max_seeds`` seeds
(16 bytes each), the bound of what a task holds; more items mean more passes
over a stored copy, never a lost item.  The word ids of a block come from the
block's own words, so a document word costs one hash lookup in Arrow.  Nothing
is shuffled: every row is judged by itself.

Defined results: null and empty texts have no passages; items with fewer than
``n`` words are no passage that could be told from ordinary phrases, and match
nothing; equal items all count, and so do all texts under one id and items with
a null id; items with a null text are left out.  Ids of documents are not used.
An empty benchmark finds nothing, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, fresh, must_be_free, stored

#: Seeds of a block of items.
MAX_SEEDS = 1 << 21
#: Bytes of text that are cut into words at once.
PIECE = 1 << 22


def words(column: pa.Array) -> pa.ListArray:
    """Lower-cased words of each text; a null text has none."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(column, "")), r"[^\p{L}\p{N}]+", " ")
    return pc.split_pattern(pc.utf8_trim(plain, " "), " ")


def tokens(column: pa.Array) -> pa.ListArray:
    """``words``, with every character of a script without spaces as a word of its own."""
    unspaced = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
    return words(pc.replace_substring_regex(pc.fill_null(column, ""), unspaced, r" \1 "))


def needed(size: int, threshold: float) -> tuple[int, int]:
    """Words of a seed, and how many seeds an alignment that reaches the threshold holds at least.

    With m of the item's words matched and e edits, m - e / 2 >= threshold * size, and e edits leave m - 1 - e
    adjacent pairs; m is at most the item's size.
    """
    pairs = math.ceil((2 * threshold - 1) * size - 1 - 1e-9)
    return (2, pairs) if pairs >= 1 else (1, max(1, math.ceil(threshold * size - 1e-9)))


def reach(size: int, threshold: float) -> int:
    """Words of a text that an alignment can span: all of the item and the most insertions."""
    return size + math.ceil(2 * (1 - threshold) * size)


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each run of n word ids; 0 where a word is unknown (-1)."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    known = np.ones(len(out), bool)
    for k in range(n):
        part = ids[k : k + len(out)]
        known &= part >= 0
        out = (out ^ (part.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.where(known, np.maximum(out, 1), 0).astype(np.uint64)


def similarity(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best local alignment score over the item's length, and where in the passage it ends."""
    gap = 0.5
    slope = gap * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1)
    best, end = 0.0, 0
    for word in item:
        step = np.zeros(len(row))
        step[1:] = np.maximum(row[:-1] + np.where(passage == word, 1.0, -0.5), row[1:] - gap)
        row = np.maximum(np.maximum.accumulate(np.maximum(step, 0) + slope) - slope, 0)
        k = int(row.argmax())
        if row[k] > best:
            best, end = float(row[k]), k
    return best / max(1, len(item)), end


class Block:
    """Seeds of some items, as sorted arrays; items are known by their place in ``items``: (ids, words)."""

    def __init__(self, items: list[tuple[list, list[str]]], n: int, item_share: float, threshold: float):
        items = [(ids, ws) for ids, ws in items if len(ws) >= n]
        self.names = [ids for ids, _ in items]
        self.vocabulary = pa.array(sorted({w for _, ws in items for w in ws}), pa.string())
        self.items = [pc.index_in(pa.array(ws, pa.string()), self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) for _, ws in items]
        self.reach = np.array([reach(len(ids), threshold) for ids in self.items], np.int64)
        self.need = np.zeros(len(items), np.int64)
        width = np.zeros(len(items), np.int64)
        for k, ids in enumerate(self.items):
            width[k], self.need[k] = needed(len(ids), threshold)
        self.seeds = {}
        for w in (1, 2):
            own = {k: np.unique(grams(self.items[k], w), return_counts=True) for k in np.nonzero(width == w)[0].tolist()}
            seeds, held = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s for s, _ in own.values())]), return_counts=True)
            pairs = []
            for k, (found, times) in own.items():
                share = held[np.searchsorted(seeds, found)]
                for s in np.argsort(-share, kind="stable"):
                    if share[s] > max(1, item_share * len(items)) and times[s] < self.need[k]:
                        self.need[k] -= times[s]  # left out: so many fewer are sure to be there
                    else:
                        pairs.append((int(found[s]), k))
            pairs.sort()
            self.seeds[w] = np.array([s for s, _ in pairs], np.uint64), np.array([k for _, k in pairs], np.int64)

    def hits(self, ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions and items of all seeds in runs of word ids (``doc``: their texts), for each width of a seed."""
        for width, (seeds, owners) in self.seeds.items():
            if not len(seeds):
                continue
            hashes = grams(ids, width)
            first = np.searchsorted(seeds, hashes, "left")
            many = np.searchsorted(seeds, hashes, "right") - first
            many[(hashes == 0) | (doc[: len(hashes)] != doc[width - 1 :])] = 0  # not over the end of a text
            at = np.nonzero(many)[0]
            reps = many[at]
            owner = np.repeat(first[at], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            yield np.repeat(at, reps), owners[owner]


LEAKS = "array<struct<item:bigint,start:int,score:double>>"


def _passages(block: Block, ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first, end) of each passage; ``ids``: words of all texts, ``offsets``: where texts start."""
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for at, item in block.hits(ids, doc_of):
        doc = doc_of[at]
        order = np.lexsort((at, item, doc))
        at, item, doc = at[order], item[order], doc[order]
        # with the seeds that an alignment needs at least, inside its longest span
        end = np.arange(len(at)) + block.need[item] - 1
        first = np.nonzero(end < len(at))[0]
        end = end[first]
        first = first[(doc[end] == doc[first]) & (item[end] == item[first]) & (at[end] - at[first] <= block.reach[item[first]])]
        low = np.maximum(offsets[doc[first]], at[first] - block.reach[item[first]])
        high = np.minimum(offsets[doc[first] + 1], at[first] + block.reach[item[first]])
        new = np.ones(len(first), bool)
        new[1:] = (doc[first[1:]] != doc[first[:-1]]) | (item[first[1:]] != item[first[:-1]]) | (low[1:] > high[:-1])
        starts = np.nonzero(new)[0]
        ends = np.append(starts[1:], len(first)) - 1
        for k, e in zip(starts, ends[: len(starts)]):
            yield int(doc[first[k]]), int(item[first[k]]), int(low[k]), int(high[e])


def _align(wanted: np.ndarray, ids: np.ndarray, low: int, high: int, threshold: float) -> Iterator[tuple[int, int, float]]:
    """(first, end, score) of alignments in ``ids[low:high]`` that don't overlap: the best, then those beside it."""
    todo = [(low, high)]
    while todo:
        low, high = todo.pop()
        there = ids[low:high]
        if np.isin(wanted, there).sum() < threshold * len(wanted) or np.isin(there, wanted).sum() < threshold * len(wanted):
            continue
        score, end = similarity(wanted, there)
        if score >= threshold:
            # the same alignment read backwards tells where it starts
            first = end - similarity(wanted[::-1], there[:end][::-1])[1]
            yield low + first, low + end, score
            todo += [(low, low + first), (low + end, high)]


def _leaks(block: Block, item: int, ids: np.ndarray, low: int, high: int, threshold: float) -> Iterator[tuple[int, float]]:
    """(first, score) of the leaks of one passage; a long one in windows, each for what starts in its first part."""
    wanted, span = block.items[item], int(block.reach[item])
    while low < high:
        last = low + 4 * span + 2 * span
        turn = high if last >= high else low + 4 * span
        after = turn
        for first, end, score in _align(wanted, ids, low, min(high, last), threshold):
            if first < turn:
                yield first, score
                after = max(after, end)
        low = after


def _judge(block: Block, threshold: float, texts: pa.Array) -> list[list[dict]]:
    """Leaks of each text: all alignments that reach the threshold."""
    lists = tokens(texts)
    ids = pc.fill_null(pc.index_in(lists.flatten(), block.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    out: list[dict] = [{} for _ in range(len(texts))]
    for doc, item, low, high in _passages(block, ids, offsets):
        for first, score in _leaks(block, item, ids, low, high, threshold):
            for name in block.names[item]:
                key = name, int(first - offsets[doc])
                out[doc][key] = max(score, out[doc].get(key, 0.0))
    order = lambda found: sorted(found.items(), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1]))
    return [[{"item": i, "start": s, "score": v} for (i, s), v in order(found)] for found in out]


def blocks(items: DataFrame, id: str, text: str, n: int, item_share: float, threshold: float, max_seeds: int) -> Iterator[Block]:
    """Distinct texts in blocks; each is fetched by its own job, so the driver holds one at a time."""
    named = items.select(F.col(id).cast("bigint").alias("item"), F.col(text).alias("text")).where("text IS NOT NULL")
    named = named.groupBy("text").agg(F.collect_set(F.struct("item")).alias("ids"))  # a null id is one too
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    turns = max(1, -(-chars // max_seeds))  # a word is a character at least
    for turn in range(turns):
        rows = named.where(F.pmod(F.xxhash64("text"), F.lit(turns)) == turn).orderBy("text").collect()
        listed = tokens(pa.array([r["text"] for r in rows], pa.string())).to_pylist()
        kept: dict[tuple, set] = {}
        for r, ws in zip(rows, listed):
            kept.setdefault(tuple(w for w in ws if w), set()).update(x["item"] for x in r["ids"])
        yield Block([(list(names), list(ws)) for ws, names in kept.items()], n, item_share, threshold)


def leaks_in(text: Column, block, threshold: float) -> Column:
    """Leaks of a text column from one block (a Spark broadcast): array of (item, start, score)."""

    @F.arrow_udf(LEAKS)
    def judge(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        rows = [r for part in by_bytes(batch, "text", PIECE) for r in _judge(block.value, threshold, part.column("text"))]
        return pa.array(rows, pa.list_(pa.struct([("item", pa.int64()), ("start", pa.int32()), ("score", pa.float64())])))

    return judge(text)


def find_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "leaks",
    n: int = 5, threshold: float = 0.6, item_share: float = 0.05, max_seeds: int = MAX_SEEDS,
) -> DataFrame:
    """``docs`` with the leaks of each text in column ``out``.

    A leak: the item, the position of its first word in the text (from 0) and the score.
    """
    must_be_free(docs, out)
    found = docs.withColumn(out, F.array().cast(LEAKS))
    for k, block in enumerate(blocks(items, item_id, item_text, n, item_share, threshold, max_seeds)):
        if k:
            found = stored(found, "leaks")
        shared = docs.sparkSession.sparkContext.broadcast(block)
        here = leaks_in(F.col(text), shared, threshold)
        found = found.withColumn(out, F.concat(out, here) if k else here)
    return found


def summary(found: DataFrame, id: str = "doc_id", out: str = "leaks") -> DataFrame:
    """Per row: ``id``, contaminated, n_leaks, items (ids, ascending) and best_score (0 without a leak)."""
    return found.select(
        id,
        (F.size(out) > 0).alias("contaminated"),
        F.size(out).cast("bigint").alias("n_leaks"),
        F.array_sort(F.array_distinct(F.col(out)["item"])).alias("items"),
        F.coalesce(F.array_max(F.col(out)["score"]), F.lit(0.0)).alias("best_score"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a leaked passage."""
    out = fresh("_leaks", docs)
    return find_leaks(docs, items, text, out=out, **how).where(F.size(out) == 0).drop(out)
