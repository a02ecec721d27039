"""Operator 13: groups of spelling variants, by k-d trees over letter-count vectors.

One inserted, deleted or replaced letter changes a word's letter counts by at
most two in sum: a replaced letter takes one from a count and adds one to
another, an inserted one adds one.  So near words are found by range searches
in k-d trees over the letter-count vectors, one tree a word length, asked by
the words of that length (one more, one less) and by those one letter shorter
(one more).  Hits are then verified letter by letter.

A tree's upper part lives in Spark (:func:`cells`): nodes with more than
``CELL`` words are split, all of a level at once, at the letter count that
halves them best, found by an aggregate over (node, letter, count).  Words go
down with the splits; a word that asks goes down both sides while its
allowance reaches over the split, so it comes to every cell that can hold a near
word, and to few others.  The cells, with the words that ask in parts of
``ASKING``, are then searched side by side (:func:`search_cell`), each with the
lower part of its tree in numpy.  Words with the same letters can't be split;
a cell of too many of them is dealt in parts, too.

Words are counted over whole texts: maximal runs of A-Z, a-z and U+00C0 to
U+00FF, only A-Z lower-cased.  Null text: no words.  Repeated rows count again.
Ties between forms go to the smallest word in code-point order.  An empty
table, or one without a repeated word, gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, stored

#: Words of a cell, and words that ask in one part of it.
CELL = 1 << 14
ASKING = 1 << 14
#: Letters of a cell: long words make smaller cells.
CELL_LETTERS = 1 << 18
#: Distinct vectors in a leaf of a cell's tree.
LEAF = 48
#: Pairs that are verified at once.
PAIRS = 1 << 19
#: Bytes of text that are split into words at once, but for longer texts.
BATCH_BYTES = 1 << 23
#: Rows that a task holds before it adds up the counts of equal words.
HELD = 1 << 20

# --- counting words ------------------------------------------------------------
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CRC = np.zeros(256, np.uint32)
for _k in range(256):
    _c = _k
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    CRC[_k] = _c


def letter_runs(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Runs of letters of a column of texts, lower-cased in A-Z, and the row of each."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(ends[0]), int(ends[-1])
    if first == last:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    data = LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[first:last]]
    lead = data == 0xC3  # U+00C0 to U+00FF are this byte and one more
    letter = (data >= 97) & (data <= 122) | lead
    letter[1:] |= lead[:-1]
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    own = ends[:-1][np.diff(ends) > 0] - first
    starts[own] = letter[own]  # a text's first letter begins a run, whatever ends the text before
    stops = letter.copy()
    stops[:-1] &= ~letter[1:] | starts[1:]
    at = np.flatnonzero(starts)
    offsets = np.append(0, np.cumsum(np.flatnonzero(stops) - at + 1)).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[letter]))
    return runs, np.searchsorted(ends - first, at, side="right") - 1


def keyed_crc32(prefixes: list[bytes], runs: pa.LargeStringArray, rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each run's bytes after the prefix of its row: a byte of all runs at a time."""
    if not len(runs):
        return np.zeros(0, np.uint32)
    seeds = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
    state = seeds[rows] ^ np.uint32(0xFFFFFFFF)
    offsets = np.frombuffer(runs.buffers()[1], np.int64)
    data = np.frombuffer(runs.buffers()[2], np.uint8)
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes > 64)
    short = np.flatnonzero(sizes <= 64)
    short = short[np.argsort(-sizes[short], kind="stable")]
    left = sizes[short]
    for k in range(int(left[0]) if len(left) else 0):
        some = short[: np.searchsorted(-left, -k, side="left")]  # runs of more than k bytes
        old = state[some]
        state[some] = CRC[(old ^ data[offsets[some] + k]) & 255] ^ (old >> np.uint32(8))
    out = state ^ np.uint32(0xFFFFFFFF)
    for k in long.tolist():
        out[k] = zlib.crc32(data[offsets[k] : offsets[k + 1]].tobytes(), int(seeds[rows[k]]))
    return out


Edit = Callable[[pa.LargeStringArray, np.ndarray, list], pa.Array]


def word_counts(docs: DataFrame, text: str = "text", least_letters: int = 5, least_rows: int = 3, key: str | None = None, edit: Edit | None = None) -> DataFrame:
    """``(word, n)`` of words with at least so many letters and occurrences.

    ``edit`` may change the runs of a batch before they are counted; it gets
    them, the row of each and the values of ``key``.  Counts are added up by
    task before the shuffle, again map-side, then by word.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def total() -> pa.Table:
            summed = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return summed.rename_columns(["word", "n"])

        for batch in (piece for whole in batches for piece in by_bytes(whole, text, BATCH_BYTES)):
            runs, rows = letter_runs(batch.column(0))
            if edit is not None:
                runs = edit(runs, rows, batch.column(1).to_pylist())
            runs = runs.filter(pc.greater_equal(pc.utf8_length(runs), least_letters))
            found = runs.value_counts()
            held.append(pa.table({"word": found.field(0).cast(pa.string()), "n": found.field(1)}))
            if sum(len(t) for t in held) > HELD:
                held[:] = [total()]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from total().to_batches()

    columns = [text] if key is None else [text, key]
    parts = docs.select(*columns).mapInArrow(counted, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_rows)


# --- the upper part of the trees -------------------------------------------------
def _counted(letter: Column) -> Column:
    """How often the row's word holds a letter."""
    return F.length("word") - F.length(F.replace("word", letter, F.lit("")))


def _limit(tree: str) -> Column:
    """Words that a cell of this word length may hold."""
    return F.greatest(F.lit(16), F.least(F.lit(CELL), F.lit(CELL_LETTERS) / F.col(tree))).cast("bigint")


def _splits(points: DataFrame, big: DataFrame) -> DataFrame:
    """``(tree, node, letter, most)`` for each of the ``big`` nodes: words with at most ``most`` of a letter go left."""
    letters = F.array_distinct(F.filter(F.split("word", ""), lambda c: c != ""))
    rows = points.join(big, ["tree", "node"]).select("tree", "node", "points", "word", F.explode(letters).alias("letter"))
    held = rows.groupBy("tree", "node", "points", "letter", _counted(F.col("letter")).alias("count")).agg(F.count(F.lit(1)).alias("words"))
    down = Window.partitionBy("tree", "node", "letter").orderBy(F.col("count").desc())  # a row per count: a few
    right = held.select("tree", "node", "letter", "points", (F.col("count") - 1).alias("most"), F.sum("words").over(down).alias("right"))
    even = F.least("right", F.col("points") - F.col("right"))
    best = right.withColumn("even", even).where("even > 0").groupBy("tree", "node")
    order = F.struct("even", "letter", "most")
    return best.agg(F.max(order).alias("s")).select("tree", "node", F.col("s.letter").alias("letter"), F.col("s.most").alias("most"))


def cells(words: DataFrame) -> DataFrame:
    """Words in the cells of the trees: ``(tree, node, asks, word, n, more, less)``.

    Each word is a point of its length's tree (``asks`` false) and asks in that
    tree (one more and one less letter) and in the next one (one more).  A row
    that asks is there once for each cell within its allowance.
    """
    length = F.length("word")

    def kind(tree: Column, asks: bool, more: int, less: int) -> Column:
        return F.struct(tree.alias("tree"), F.lit(1).cast("bigint").alias("node"), F.lit(asks).alias("asks"), F.lit(more).alias("more"), F.lit(less).alias("less"))

    kinds = F.array(kind(length, False, 0, 0), kind(length, True, 1, 1), kind(length + 1, True, 1, 0))
    rows = words.select("word", "n", F.explode(kinds).alias("k")).select("k.tree", "k.node", "k.asks", "word", "n", "k.more", "k.less")
    while True:
        rows = stored(rows, "cells")
        points = rows.where(~F.col("asks"))
        sizes = points.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("points"))
        # a row per node; stored, so that the joins with them are planned by their size and don't move the words
        big = stored(sizes.where(F.col("points") > _limit("tree")), "nodes")
        splits = None if big.isEmpty() else stored(_splits(points, big), "splits")
        if splits is None or splits.isEmpty():
            return rows
        have = _counted(F.col("letter"))
        over, short = have - F.col("most"), F.col("most") + 1 - have  # letters to lose to go left, to win to go right
        none = F.lit(None).cast("struct<node:bigint,more:int,less:int>")

        def side(right: int, more: Column, less: Column) -> Column:
            return F.struct((F.col("node") * 2 + right).alias("node"), more.cast("int").alias("more"), less.cast("int").alias("less"))

        left = F.when(over <= F.when(F.col("asks"), F.col("less")).otherwise(0), side(0, F.col("more"), F.col("less") - F.greatest(over, F.lit(0)))).otherwise(none)
        right = F.when(short <= F.when(F.col("asks"), F.col("more")).otherwise(0), side(1, F.col("more") - F.greatest(short, F.lit(0)), F.col("less"))).otherwise(none)
        stay = F.struct(F.col("node"), F.col("more"), F.col("less"))
        ways = F.when(F.col("letter").isNull(), F.array(stay)).otherwise(F.array_compact(F.array(left, right)))
        went = rows.join(splits, ["tree", "node"], "left").withColumn("way", F.explode(ways))
        rows = went.select("tree", "way.node", "asks", "word", "n", "way.more", "way.less")


# --- the lower part, in one task ---------------------------------------------------
def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def letter_counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(codes), len(letters)), np.int32)
    rows = np.arange(len(codes))
    for column in range(codes.shape[1]):
        counts[rows, np.searchsorted(letters, codes[:, column])] += 1
    return counts


def unary(counts: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Counts as bits, so that the L1 distance is the number of differing bits."""
    letter = np.repeat(np.arange(len(most)), most)
    step = np.arange(len(letter)) - np.repeat(np.cumsum(most) - most, most)
    packed = np.packbits(counts[:, letter] > step, axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(packed).view(np.uint64)


class Tree:
    """A k-d tree over distinct vectors, with the box of each node."""

    def __init__(self, counts: np.ndarray, bits: np.ndarray, leaf: int = LEAF):
        self.counts, self.bits, self.leaf = counts, bits, leaf
        self.root = self._node(np.arange(len(counts)))

    def _node(self, own: np.ndarray) -> tuple:
        held = self.counts[own]
        low, high = held.min(axis=0), held.max(axis=0)
        if len(own) <= self.leaf:
            return low, high, own, None
        letter = int(held.var(axis=0).argmax())
        value = held[:, letter]
        most = int(np.median(value))
        most -= most >= value.max()
        right = value > most
        return low, high, None, (self._node(own[~right]), self._node(own[right]))

    def within(self, counts: np.ndarray, bits: np.ndarray, more: int, less: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (asking, held) of vectors with exactly ``more`` and ``less`` letters between them."""
        todo = [(self.root, np.arange(len(counts)))]
        while todo:
            (low, high, own, children), asking = todo.pop()
            asked = counts[asking]
            reach = (np.maximum(low - asked, 0).sum(axis=1) <= more) & (np.maximum(asked - high, 0).sum(axis=1) <= less)
            asking = asking[reach]
            if not len(asking):
                continue
            if children:
                todo += [(c, asking) for c in children]
                continue
            step = max(1, PAIRS // len(own))
            for a in range(0, len(asking), step):
                some = asking[a : a + step]
                differ = bits[some][:, None, :] ^ self.bits[own][None, :, :]
                i, j = np.nonzero(np.bitwise_count(differ).sum(axis=2, dtype=np.int64) == more + less)
                if len(i):
                    yield some[i], own[j]


def one_edit(asking: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one replaced letter, or by one that ``held`` has more."""
    if asking.shape[1] == held.shape[1]:
        return (asking != held).sum(axis=1) == 1
    front = np.logical_and.accumulate(asking == held[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((asking == held[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= asking.shape[1]


def _members(labels: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by label, and where each label's rows begin."""
    return np.argsort(labels, kind="stable"), np.searchsorted(np.sort(labels), np.arange(n + 1))


def _expand(i: np.ndarray, j: np.ndarray, a: tuple, b: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows for pairs of labels, about :data:`PAIRS` at a time."""
    (rows_a, from_a), (rows_b, from_b) = a, b
    # a pair of labels becomes a row of the first label's times all of the second's
    ni = from_a[i + 1] - from_a[i]
    one = np.repeat(np.arange(len(i)), ni)
    place = np.arange(len(one)) - np.repeat(np.cumsum(ni) - ni, ni)
    left, width, begin = rows_a[from_a[i[one]] + place], (from_b[j + 1] - from_b[j])[one], from_b[j[one]]
    cut = (np.cumsum(width) - width) // PAIRS
    bounds = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(left)]
    for s, e in zip(bounds, bounds[1:]):
        w = width[s:e]
        offset = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
        yield np.repeat(left[s:e], w), rows_b[np.repeat(begin[s:e], w) + offset]


def _rank(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of each word (a row of code points) by falling n, then by code points."""
    rank = np.empty(len(codes), np.int64)
    rank[np.lexsort([*codes.T[::-1], -n])] = np.arange(len(codes))
    return rank


def _distinct(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct row's number, and the number of each row."""
    order = np.lexsort(bits.T)
    new = np.ones(len(bits), bool)
    new[1:] = (bits[order[1:]] != bits[order[:-1]]).any(axis=1)
    labels = np.empty(len(bits), np.int64)
    labels[order] = np.cumsum(new) - 1
    return order[new], labels


FOUND = "word string, near bigint, best_n bigint, best string"


def search_cell(cell: pa.Table) -> pa.Table:
    """Near words of one cell: per word its number of near words here and the best of them.

    The words of the tree's own length get what they ask for; a word that is a
    letter shorter and the word that it asks for get each other.
    """
    asks = cell["asks"].to_numpy(zero_copy_only=False).astype(bool)
    words, n = cell["word"].to_pylist(), cell["n"].to_numpy()
    tree = cell["tree"][0].as_py()
    length = np.array([len(w) for w in words])
    sides = {"held": np.flatnonzero(~asks), "same": np.flatnonzero(asks & (length == tree)), "shorter": np.flatnonzero(asks & (length < tree))}
    out: list[tuple[str, int, int, str]] = []
    if len(sides["held"]) and asks.any():
        codes = {s: code_points([words[k] for k in rows]) for s, rows in sides.items() if len(rows)}
        letters = np.unique(np.concatenate([np.unique(c) for c in codes.values()]))
        counts = {s: letter_counts(c, letters) for s, c in codes.items()}
        most = np.max([c.max(axis=0) for c in counts.values()], axis=0)
        distinct = {}
        for s, c in counts.items():
            bits = unary(c, most)
            first, labels = _distinct(bits)
            distinct[s] = c[first], bits[first], _members(labels, len(first))
        held = Tree(*distinct["held"][:2])
        rank = {s: _rank(codes[s], n[rows]) if s in codes else np.zeros(0, np.int64) for s, rows in sides.items()}
        near = {s: np.zeros(len(rows), np.int64) for s, rows in sides.items()}
        best = {(s, t): np.full(len(sides[s]), len(words), np.int64) for s, t in (("same", "held"), ("shorter", "held"), ("held", "shorter"))}
        for s, less in (("same", 1), ("shorter", 0)):
            if s not in codes:
                continue
            vectors, bits, members = distinct[s]
            for i, j in held.within(vectors, bits, 1, less):
                for a, b in _expand(i, j, members, distinct["held"][2]):
                    ok = one_edit(codes[s][a], codes["held"][b])
                    a, b = a[ok], b[ok]
                    np.add.at(near[s], a, 1)
                    np.minimum.at(best[s, "held"], a, rank["held"][b])
                    if s == "shorter":
                        np.add.at(near["held"], b, 1)
                        np.minimum.at(best["held", s], b, rank[s][a])
        for (s, t), places in best.items():
            by_rank = sides[t][np.argsort(rank[t])]
            for k in np.flatnonzero(near[s]).tolist():
                other = by_rank[places[k]]
                out.append((words[sides[s][k]], int(near[s][k]), int(n[other]), words[other]))
    return pa.Table.from_pydict(
        {name: [r[k] for r in out] for k, name in enumerate(("word", "near", "best_n", "best"))},
        pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]),
    )


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of each word of ``(word, n)`` that has near words; best: largest n, then smallest."""
    rows = cells(words)
    keys = ["tree", "node"]
    asking = F.sum(F.col("asks").cast("bigint"))
    sizes = rows.groupBy(*keys).agg((F.count(F.lit(1)) - asking).alias("points"), asking.alias("asking")).where("points > 0 AND asking > 0")

    def parts(count: str, size: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(count) / size)).cast("int")

    # a cell is over the limit only if all its words have the same letters: those are dealt in parts, too
    sizes = sizes.select(*keys, parts("points", 2 * _limit("tree")).alias("of_points"), parts("asking", F.least(F.lit(ASKING), _limit("tree"))).alias("of_asking"))
    sizes = stored(sizes, "nodes")
    both = rows.join(sizes, keys)
    place = F.xxhash64("word")
    own_point, own_asking = F.pmod(place, F.col("of_points")).cast("int"), F.pmod(place, F.col("of_asking")).cast("int")
    every = F.sequence(F.lit(0), F.when(F.col("asks"), F.col("of_points")).otherwise(F.col("of_asking")) - 1)
    dealt = both.withColumn("each", F.explode(every)).select(
        *keys, "asks", "word", "n",
        F.when(F.col("asks"), F.col("each")).otherwise(own_point).alias("point_part"),
        F.when(F.col("asks"), own_asking).otherwise(F.col("each")).alias("asking_part"),
    )
    found = dealt.groupBy(*keys, "point_part", "asking_part").applyInArrow(search_cell, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


# --- forms and roots -------------------------------------------------------------
def variant_groups(words: DataFrame, factor: int = 2) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of each word of ``(word, n)``, a row per word.

    A word's form is its near word of largest n, if that is at least ``factor``
    (2 or more) times its own; its root is the last word that the forms lead to.  As n
    doubles at each step, a way has less than 63 of them, and each round below
    doubles what is known of it.
    """
    words = stored(words.select("word", "n"), "words")
    formed = F.col("best_n") >= F.col("n") * factor
    table = words.join(near_words(words), "word", "left").select(
        "word", F.when(formed, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n"),
    )
    table = stored(table, "forms")
    ways = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))  # words that aren't their own root
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "ways")
        ways = step.select("word", "root")
        if step.where("went").isEmpty():
            break
    rooted = table.join(ways, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
