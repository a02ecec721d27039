"""Operator 5: near-duplicate embeddings by sorted projection passes.

Equal vectors become one class.  Each pass orders the classes lexicographically
by a key of concatenated random hashes (the signs of random projections) and
compares every class with its ``window`` next neighbours; pairs with a cosine of
at least ``threshold`` in double precision are united over all passes.  The
order is a distributed range sort with dense positions, cut into blocks that
take the window's rows from the block before; no block grows with the data.

Windows alone would miss pairs in dense groups.  So, after the passes, the
members of each component meet in tiles and all their pairs are compared: every
link between members is counted, however many they are.

The first passes follow the number of vectors.  In each of them every class
reports how many sign bits it shares with the neighbours at the window's ends: a
pair that shares more meets.  With how near the class is to those bits' planes,
that gives the chance that a pair at the threshold has met, wherever vectors are
crowded.  Classes for which it stays below
``recall`` go on among themselves, in rounds of further passes whose planes go
through the middle of those that are left, so that they part a crowd that lies
on one side of all planes through the origin.  The rounds end when every class
has its recall (a pair is settled once one of its two is), when those that are
left are in one component, or when a whole round of ``ROUND`` passes has joined
no two components any more.

Defined results: vectors that are null, zero, empty or hold null or non-finite
components link with nothing and are their own component; vectors of different
length never link.  A null id gives a null component and links with nothing.
Repeated ids and rows count as vectors of their own.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components
from .simhash import join_labels

#: Bits of a sort key, rows of a block and vectors of a tile.
BITS = 64
BLOCK = 2048
TILE = 512
#: The most passes of a further round.
ROUND = 32


def passes_for(n: int, threshold: float, window: int, recall: float) -> int:
    """Passes after which a pair at the threshold has met with probability ``recall``.

    Two vectors at angle t share a sign bit with probability 1 - t/pi; those that share their first
    log2(n / window) bits are within a window of each other, about.
    """
    bits = max(0.0, math.log2(max(1, n) / window))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if meet >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def unit(rows: list) -> np.ndarray:
    """Unit rows in double precision; scaled first, so that no square over- or underflows."""
    x = np.array(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def middle_of(classes: DataFrame) -> dict[int, np.ndarray]:
    """Mean of the unit vectors of each length; the driver gets a number for each component, not for each vector."""
    most = F.array_max(F.transform("vec", F.abs))
    scaled = F.transform("vec", lambda x: x / most)
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    each = classes.select(scaled.alias("scaled"), F.size("vec").alias("dim")).select("dim", norm.alias("norm"), F.posexplode("scaled").alias("place", "x"))
    rows = each.groupBy("dim", "place").agg(F.avg(F.col("x") / F.col("norm")).alias("mean")).collect()
    middle = {r["dim"]: np.zeros(r["dim"]) for r in rows}
    for r in rows:
        middle[r["dim"]][r["place"]] = r["mean"]
    return middle


def sort_keys(vectors: Column, passes: int, seed: int, middle: dict[int, np.ndarray] | None = None) -> Column:
    """One big-endian key of random projection signs per pass: array of binary, in the order of passes.

    ``middle``: the point that the planes go through, by length of vectors; the origin without it.
    """

    @F.arrow_udf("array<binary>")
    def keys(column: pa.Array) -> pa.Array:
        out: list[list[bytes] | None] = [None] * len(column)
        lengths = np.array([len(v) for v in column])
        for dim in np.unique(lengths):
            rows = np.nonzero(lengths == dim)[0]
            x = unit([column[int(r)].as_py() for r in rows])
            head = int(dim).to_bytes(4, "big")  # vectors of one length stand together
            parts = []
            for k in range(passes):
                planes = planes_of(seed, k, int(dim))
                parts.append(np.packbits(x @ planes > _at(middle, int(dim)) @ planes, axis=1))
            for i, r in enumerate(rows):
                out[r] = [head + p[i].tobytes() for p in parts]
        return pa.array(out, pa.list_(pa.binary()))

    return keys(vectors)


def _at(middle: dict[int, np.ndarray] | None, dim: int) -> np.ndarray:
    return np.zeros(dim) if middle is None else middle[dim]


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their dense place from 0 in a global order, without a single-task sort."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("mid", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("mid", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    counts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    bases = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = ranged.join(bases, part == F.col("part"))
    return placed.withColumn("pos", F.col("base") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("mid", "part", "base")


def shared_bits(keys: np.ndarray, turn: np.ndarray, window: int) -> np.ndarray:
    """Leading bits that each key shares with the one ``window`` places on; -1 across passes or lengths of vectors."""
    left, right = keys[:-window], keys[window:]
    apart = np.unpackbits(left[:, 4:] ^ right[:, 4:], axis=1)
    bits = np.where(apart.any(axis=1), apart.argmax(axis=1), apart.shape[1])
    return np.where((turn[:-window] == turn[window:]) & (left[:, :4] == right[:, :4]).all(axis=1), bits, -1)


def planes_of(seed: int, turn: int, dim: int) -> np.ndarray:
    return np.random.default_rng([seed, turn, dim]).standard_normal((dim, BITS))


def out_of_window(x: np.ndarray, planes: np.ndarray, threshold: float, bits: np.ndarray, after: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Chance that a neighbour at the threshold, in a random direction, lies after (or before) a row and shares
    no more than ``bits`` leading bits with it.

    It depends on how far a row is from each plane; where vectors are crowded, the planes that part them are near.
    """
    angle, dim = math.acos(min(1.0, max(-1.0, threshold))), len(planes)
    along = x @ planes
    far = along - middle @ planes
    across = np.sqrt(np.maximum((planes**2).sum(axis=0) - along**2, 1e-12) / max(1, dim - 1))
    z = np.clip(np.abs(far) / max(math.tan(angle), 1e-12) / across, -8, 8)
    # the normal distribution function, to 2e-4
    agree = np.exp(-np.cumsum(np.log1p(np.exp(-1.5976 * z - 0.07056 * z**3)), axis=1)) if dim > 1 else np.ones(far.shape)
    first = np.hstack((1 - agree[:, :1], agree[:, :-1] - agree[:, 1:]))  # chance that this bit is the first to differ
    there = (far > 0) != after[:, None]  # a row's 0 differs from a later row's 1
    out = (first * there * (np.arange(BITS) <= bits[:, None])).sum(axis=1)
    return out + np.where(bits == BITS, agree[:, -1] / 2, 0)  # where whole keys are equal, their order tells nothing


def near_in_block(block: pd.DataFrame, window: int, threshold: float, seed: int, middle: dict[int, np.ndarray] | None = None) -> pd.DataFrame:
    """Spanning forest of the links found in one block, and what each class may still miss.

    Rows of an earlier pass are not compared.  Rows with a null ``b`` tell the chance that a pair of a class
    is out of the window in a pass, for each side; a side that ends before the window does is seen whole.
    """
    block = block.sort_values("pos")
    ids, turn, dims = block["id"].to_numpy(), block["turn"].to_numpy(), block["vec"].map(len).to_numpy()
    crowded = pd.DataFrame({"a": ids[:0], "turn": turn[:0], "lost": np.zeros(0)})
    if len(block) > window:
        keys = np.frombuffer(b"".join(block["key"]), np.uint8).reshape(len(block), -1)
        bits = shared_bits(keys, turn, window)
        known = np.nonzero(bits >= 0)[0]
        ends, bits, after = np.concatenate((known, known + window)), np.tile(bits[known], 2), np.arange(2 * len(known)) < len(known)
        lost = np.zeros(len(ends))
        for t, dim in {*zip(turn[ends].tolist(), dims[ends].tolist())}:
            own = np.nonzero((turn[ends] == t) & (dims[ends] == dim))[0]
            lost[own] = out_of_window(unit(block["vec"].iloc[ends[own]].tolist()), planes_of(seed, t, dim), threshold, bits[own], after[own], _at(middle, dim))
        crowded = pd.DataFrame({"a": ids[ends], "turn": turn[ends], "lost": lost}).groupby(["a", "turn"], as_index=False).sum()
    lengths = block["vec"].map(len).to_numpy()
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    labels = np.arange(len(ids))
    for dim in np.unique(lengths):  # runs of one length stand together
        own = np.nonzero(lengths == dim)[0]
        x, t = unit(block["vec"].iloc[own].tolist()), turn[own]
        for at in range(0, len(own), 256):
            cos = x[at : at + 256] @ x[at : at + 256 + window].T
            i, j = np.nonzero(cos >= threshold)
            ok = (j > i) & (j - i <= window)
            i, j = i[ok] + at, j[ok] + at
            same = t[i] == t[j]
            join_labels(labels, rank[own[i[same]]], rank[own[j[same]]])
    ordered = np.sort(ids, kind="stable")
    moved = np.nonzero(labels != np.arange(len(ids)))[0]
    found = pd.DataFrame({"a": ordered[moved], "b": ordered[labels[moved]], "turn": 0, "lost": 0.0})
    crowded["b"] = None
    return pd.concat([found.astype({"b": object}), crowded])[["a", "b", "turn", "lost"]]


def window_links(
    classes: DataFrame, threshold: float, window: int, passes: int, seed: int, middle: dict[int, np.ndarray] | None = None, block: int = BLOCK
) -> DataFrame:
    """What ``near_in_block`` says of all blocks of the passes, stored; ``classes``: id and vec."""
    keyed = classes.select("id", F.posexplode(sort_keys(F.col("vec"), passes, seed, middle)).alias("turn", "key"))
    placed = positions(stored(keyed, "keys"), ["turn", "key", "id"]).join(classes, "id")
    home = F.floor(F.col("pos") / block)
    both = F.when(F.col("pos") % block >= block - window, F.array(home, home + 1)).otherwise(F.array(home))
    blocks = placed.select("id", "turn", "pos", "key", "vec", F.explode(both).alias("block"))
    return stored(blocks.groupBy("block").applyInPandas(lambda b: near_in_block(b, window, threshold, seed, middle), "a bigint, b bigint, turn int, lost double"), "windows")


def joining(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between two of the components ``roots`` (node, root), stored."""
    of = [roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
    both = links.join(of[0], "a", "left").join(of[1], "b", "left")
    return stored(both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"), "joining")


def all_windows(classes: DataFrame, n: int, threshold: float, window: int, recall: float, seed: int) -> DataFrame:
    """Edges ``(a, b)`` from which the components of all linked pairs follow; ``classes``: id and vec, ``n`` of them."""
    passes, rest, edges, missed, middle, roots = passes_for(n, threshold, window, recall), classes, None, None, None, None
    turn = ran = 0
    while True:
        found = window_links(rest, threshold, window, passes, seed + 1000 * turn, middle)
        here = found.where("b IS NOT NULL").select("a", "b")
        news = here if edges is None else joining(here, roots)
        if edges is not None and news.isEmpty():
            if passes == ROUND:
                return edges
        else:
            edges = news if edges is None else edges.unionByName(news)
            roots = stored(connected_components(edges, "a", "b"), "components")
        turn, ran = turn + 1, ran + passes
        sides = found.where("b IS NULL").groupBy("a", "turn").agg(F.sum("lost").alias("lost"))
        chance = F.least(F.greatest("lost", F.lit(1e-12)), F.lit(1.0))
        each = sides.groupBy(F.col("a").alias("id")).agg((F.sum(F.log(chance)) + (passes - F.count("a")) * math.log(1e-12)).alias("miss"))
        if missed is not None:
            each = each.join(missed.withColumnRenamed("miss", "before"), "id").select("id", (F.col("miss") + F.col("before")).alias("miss"))
        missed = stored(each.where(F.col("miss") > math.log(1 - recall)), "crowded")
        left, total = missed.agg(F.count("id"), F.sum("miss")).first()
        if not left:
            return edges
        rest = missed.select("id").join(classes, "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
        rest = stored(rest.select("id", "vec", F.coalesce("root", "id").alias("root")), "crowded-vectors")
        low, high = rest.agg(F.min("root"), F.max("root")).first()
        if low == high:  # those that are left are one component already
            return edges
        rest = rest.select("id", "vec")
        middle = middle_of(rest)
        mean = min(total / left / ran, -1e-9)  # what a pass has settled of the classes that are left
        passes = min(max(math.ceil(math.log(1 - recall) / mean) - ran, 1), ROUND)


def _count(threshold: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for mine, others, same in zip(batch.column("tile"), batch.column("other"), batch.column("same").to_pylist()):
                a, b = mine.as_py(), others.as_py()
                lengths = {len(r["vec"]) for r in a} & {len(r["vec"]) for r in b}
                for dim in lengths:
                    left, right = ([r for r in t if len(r["vec"]) == dim] for t in (a, b))
                    near = unit([r["vec"] for r in left]) @ unit([r["vec"] for r in right]).T >= threshold
                    if same:
                        np.fill_diagonal(near, False)
                    ids.append([r["id"] for r in left])
                    found.append(near @ np.array([r["copies"] for r in right]))
                    if not same:
                        ids.append([r["id"] for r in right])
                        found.append(near.T @ np.array([r["copies"] for r in left]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)), pa.array(np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64))], names=["id", "n"]
            )

    return count


def link_counts(members: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """``(id, n)``: vectors of other classes that each class links with inside its component.

    ``members``: root, id, vec and copies.  The sums come in parts, one for each pair of tiles.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count("id") / tile).alias("k"))
    tiles = members.join(sizes, "root").withColumn("sub", F.pmod(F.xxhash64("id"), "k"))
    tiles = tiles.repartition("root", "sub")  # else a large component stays where the join has put it
    tiles = stored(tiles.groupBy("root", "sub", "k").agg(F.collect_list(F.struct("id", "copies", "vec")).alias("tile")), "vector-tiles")
    # the numbers of the pairs come first, so that both joins are on a tile and none on a component
    pairs = tiles.select("root", "sub", F.explode(F.sequence("sub", F.col("k") - 1)).alias("sub2"))
    met = pairs.join(tiles.select("root", "sub", "tile"), ["root", "sub"])
    others = tiles.select("root", F.col("sub").alias("sub2"), F.col("tile").alias("other"))
    met = met.join(others, ["root", "sub2"]).select("tile", "other", (F.col("sub") == F.col("sub2")).alias("same"))
    return met.mapInArrow(_count(threshold), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, window: int = 64, recall: float = 0.99, seed: int = 7
) -> DataFrame:
    """Per vector: ``id``, n_links, component_id (smallest id reachable) and kept."""
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    good = F.col("id").isNotNull() & F.coalesce(finite, F.lit(False))
    rows = rows.select("id", F.when(good, F.col("vec")).alias("vec"))
    classes = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.min("id").alias("rep"), F.count("id").alias("copies"))
    classes = stored(classes.select(F.col("rep").alias("id"), "copies", "vec"), "classes")
    n = classes.count()
    edges = all_windows(classes.select("id", "vec"), n, threshold, window, recall, seed)
    roots = connected_components(edges, "a", "b").withColumnRenamed("node", "id")
    members = roots.join(classes, "id")
    found = link_counts(members, threshold)
    labelled = classes.join(roots, "id", "left").join(found, "id", "left")
    labelled = labelled.select("vec", F.coalesce("root", "id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.join(labelled, "vec", "left")
    component = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(id), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
