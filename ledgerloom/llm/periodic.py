"""Operator 11: periodic runs of words, from Lyndon arrays by Baier's grouping.

A run is a stretch of words with a smallest period q, at least two periods and
``least`` words long, that neither neighbour extends.  Every run has a Lyndon
root: a place where the longest Lyndon word, by the order of the words or by
the reverse order, is one period long.  So, per text:

1. The first phase of Baier's suffix sorter groups all suffixes by their
   longest Lyndon prefix, from the highest group down; the length of a suffix's
   group when its turn comes is its entry of the Lyndon array.  It runs once
   under each order (:func:`lyndon_array`).
2. Each entry (i, q) is extended by the longest common extensions of the places
   i and i + q to both sides; long enough ones are runs (:func:`runs_of`).

The grouping is linear, but it is a loop over words, so stretches that can hold
no run are left out first.  Four words that occur once in a text lie in no two
periods of a run, so within a run at most three such places follow each other;
a text is cut where four do (:func:`stretches`).  This takes no run away: see
the proof there.

Words are maximal parts between blanks and the control characters from tab to
carriage return.  Null or empty text: no words, no runs, the collapsed text is
empty.  Ties between runs are ordered by start, then period.  Rows are treated
one by one, so repeated rows, null ids and further columns don't matter.  An
empty table gives no rows.  A text is held once, with some numbers a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import must_be_free

#: Runs are at least so many words long.
LEAST = 12
#: Words per place in :func:`stretches`; a third of the shortest run, so that its ends repeat.
GRAM = 4


def lyndon_array(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place; ``word`` holds numbers.

    Groups of suffixes with the same known prefix are taken from the highest
    down.  For a member at i, the nearest place j to the left that is not yet
    taken begins a longer Lyndon word, by the member's: what lies between has
    been taken and is higher.  Places that k members hit move to a new group
    just above their old one, k prefixes longer.
    """
    n = len(word)
    length = [0] * n
    symbols = sorted(set(word))
    first = {s: g for g, s in enumerate(symbols)}
    members: list[list[int]] = [[] for _ in symbols]
    group = [first[s] for s in word]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]  # members that still belong to the group
    prefix = [1] * len(symbols)
    below = list(range(-1, len(symbols) - 1))
    above = [*range(1, len(symbols)), -1]
    left = list(range(n))  # itself while not taken, then a place further left
    now = len(symbols) - 1
    while now >= 0:
        if size[now]:
            own = prefix[now]
            taken = [i for i in members[now] if group[i] == now]
            for i in taken:
                length[i] = own
                left[i] = i - 1
            hits: dict[int, int] = {}
            for i in taken:
                j = i - 1
                while j >= 0 and left[j] != j:
                    j = left[j]
                k = i - 1
                while k >= 0 and left[k] != k:  # shorten the way for those that follow
                    left[k], k = j, left[k]
                if j >= 0:
                    hits[j] = hits.get(j, 0) + 1
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in hits.items():
                moved.setdefault((group[j], -times), []).append(j)
            for (old, times), places in sorted(moved.items()):  # most hits first, each one below the last
                longer = prefix[old] - times * own
                if size[old] == len(places):
                    prefix[old] = longer  # all of the group's rest moves: it is the new group
                    continue
                new = len(members)
                members.append(places)
                size.append(len(places))
                prefix.append(longer)
                size[old] -= len(places)
                for j in places:
                    group[j] = new
                top = above[old]
                below.append(old)
                above.append(top)
                above[old] = new
                if top >= 0:
                    below[top] = new
        now = below[now]
    return length


def stretches(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts [a, b) of a text, each run of which lies in one of them; ``codes``: equal numbers for equal words.

    Take a run [s, e) of period q and the places of its word groups of four, s to
    e - 4.  Place i has an equal one at i + q if i + q <= e - 4, or at i - q if
    i - q >= s.  Places with neither are those above e - 4 - q and below s + q:
    2q + 3 - (e - s) <= 3 of them, next to each other, and neither s nor e - 4 is
    one, as e - s >= q + 4.  So four such places in a row end a stretch, and no
    run goes over them.  (Groups are compared by a hash; equal hashes of
    different groups only make a stretch longer.)
    """
    n = len(codes) - GRAM + 1
    if n < LEAST - GRAM + 1:
        return
    mixed = codes.astype(np.uint64)
    grams = np.zeros(n, np.uint64)
    for k in range(GRAM):
        grams = (grams ^ mixed[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    places = np.flatnonzero(again)
    if not len(places):
        return
    cuts = np.flatnonzero(np.diff(places) > GRAM)
    for a, b in zip(places[np.append(0, cuts + 1)].tolist(), places[np.append(cuts, len(places) - 1)].tolist()):
        if b + GRAM - a >= LEAST:
            yield a, b + GRAM


def _common(codes: np.ndarray, i: int, j: int, step: int) -> int:
    """Longest common extension of places i and j, to the right (``step`` 1) or to the left (-1)."""
    room = len(codes) - max(i, j) if step > 0 else min(i, j) + 1
    done, block = 0, 32
    while done < room:
        take = min(block, room - done)
        if step > 0:
            differ = codes[i + done : i + done + take] != codes[j + done : j + done + take]
        else:
            differ = (codes[i - done - take + 1 : i - done + 1] != codes[j - done - take + 1 : j - done + 1])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done += take
        block *= 4
    return done


def runs_of(codes: np.ndarray, least: int = LEAST) -> set[tuple[int, int, int]]:
    """Runs (start, end, period) of at least ``least`` words; ``codes``: equal numbers for equal words."""
    n = len(codes)
    _, ranks = np.unique(codes, return_inverse=True)
    word = ranks.astype(np.int64)
    found: set[tuple[int, int, int]] = set()
    for ordered in (word, word.max(initial=0) - word):
        periods = np.array(lyndon_array(ordered.tolist()), np.int64)
        # a run needs max(q, least - q) >= least / 2 words of extension, so a quarter of ``least`` on one side
        near = max(1, least // 4)
        at = np.arange(n)
        right = (at + periods + near) <= n
        for k in range(near):
            right[right] = word[at[right] + k] == word[at[right] + periods[right] + k]
        back = (at >= near) & (at + periods <= n)
        for k in range(1, near + 1):
            back[back] = word[at[back] - k] == word[at[back] + periods[back] - k]
        chosen = np.flatnonzero(right | back)
        until: dict[int, int] = {}  # end of the last run of a period; Lyndon words of one length don't overlap
        for i, q in zip(chosen.tolist(), periods[chosen].tolist()):
            if i + q <= until.get(q, -1):
                continue
            start = i - _common(word, i - 1, i + q - 1, -1)
            end = i + q + _common(word, i, i + q, 1)
            if end - start >= max(least, 2 * q):
                found.add((start, end, q))
                until[q] = end
    return found


def runs_in_text(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a text's words, by start, then period."""
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    parts = list(stretches(codes)) if least >= LEAST else [(0, len(words))]
    found = []
    for a, b in parts:
        number: dict[bytes, int] = {}
        exact = np.fromiter((number.setdefault(w, len(number)) for w in words[a:b]), np.int64, b - a)
        found += [(a + s, e - s, q) for s, e, q in runs_of(exact, least)]
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by blanks: of each run only its first period stays."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def find_runs(text: Column) -> Column:
    """Struct (runs: array of (start, length, period), collapsed: string) of a text column; never null."""

    @F.arrow_udf("struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def found(column: pa.Array) -> pa.Array:
        offsets, rows, texts = [0], [], []
        for value in column:
            # bytes are split at blanks and the control characters from tab to carriage return, and nowhere else
            words = (value.as_py() or "").encode().split()
            runs = runs_in_text(words)
            rows += runs
            offsets.append(len(rows))
            texts.append(collapse(words, runs).decode())
        fields = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        structs = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
        return pa.StructArray.from_arrays([lists, pa.array(texts, pa.string())], names=["runs", "collapsed"])

    return found(text)


def with_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of ``text`` and the text without their repeats; both names must be free."""
    must_be_free(docs, runs, collapsed)
    found = find_runs(F.col(text))
    return docs.withColumns({runs: found["runs"], collapsed: found["collapsed"]})
