"""Operator 4: SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in Arrow batches.  Equal fingerprints become one
representative (smallest id) by a combined aggregate, so copies never meet.
Each fingerprint is cut into equal bit fields; the population counts of the
fields name its cell.  Two fingerprints within the radius have cells whose
counts differ by no more than the radius in total, so all other cell pairs are
skipped.  Cells are packed into tiles of bounded size, tile pairs meet in an
equi-join, and numpy compares them by exclusive-or and bit counts.  Each tile
pair gives a spanning forest of its links, never the pairs themselves; the
forests' components are the classes.

Defined results: null, empty and word-less texts have fingerprint zero and link
like any other.  A null id can't name a document: such rows get a fingerprint
and the component of their fingerprint, but never are a component's id.
Repeated ids and rows are kept row by row.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components

#: Fingerprints in a tile, about (16 bytes each).
TILE = 4096
#: Shingles that are counted at once; longer texts take several turns.
CHUNK = 1 << 16
#: Cells in use, about, when random fingerprints are cut into so many fields.
CELLS = {1: 16, 2: 136, 4: 4_660, 8: 1_300_000}


def fingerprint_text(text: str | None, width: int = 3) -> int:
    """Unsigned SimHash of a text's word shingles: bits set in over half of the XXH64 (seed 42) values."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()  # both are ASCII-only on bytes
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    n = len(words) - width + 1
    starts, ends = starts[:n].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = b"".join([xxh64_digest(line[s:e], 42) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """SimHash of a text column as a bigint (the 64 bits, two's complement)."""

    @F.arrow_udf("bigint")
    def prints(column: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint_text(v.as_py(), width) for v in column), np.uint64, len(column))
        return pa.array(values.view(np.int64))

    return prints(text)


def join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union the nodes i[k] and j[k]; labels hold each node's smallest known member and stay flat."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (flat := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = flat


def forest(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray] | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (id, smaller id) of the links between two tiles, or inside one (right: None).

    A tile: its ids and fingerprints (uint64).
    """
    prints = left[1]
    others, ids = (prints, left[0]) if right is None else (right[1], np.concatenate((left[0], right[0])))
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")  # labels in the order of ids
    labels = np.arange(len(ids))
    shift = 0 if right is None else len(prints)
    step = max(1, (1 << 20) // max(1, len(others)))
    for at in range(0, len(prints), step):
        near = np.bitwise_count(prints[at : at + step, None] ^ others[None, :]) <= radius
        i, j = np.nonzero(near)
        i += at
        if right is None:
            i, j = i[i < j], j[i < j]
        join_labels(labels, rank[i], rank[j + shift])
    ordered = np.sort(ids, kind="stable")
    moved = labels != np.arange(len(ids))
    return ordered[moved], ordered[labels[moved]]


def _fields(fp: Column, parts: int) -> list[Column]:
    bits = 64 // parts
    mask = F.lit(-1) if bits == 64 else F.lit((1 << bits) - 1)
    return [F.bit_count(F.shiftrightunsigned(fp, k * bits).bitwiseAND(mask.cast("bigint"))).cast("bigint") for k in range(parts)]


def _code(counts: list[Column]) -> Column:
    code = F.lit(0).cast("bigint")
    for c in counts:  # counts 0..64 and steps up to the radius never leave 0..127
        code = code * 128 + c + 16
    return code


def _steps(parts: int, radius: int) -> list[int]:
    """Code differences of a cell to itself and to the later half of its neighbours."""
    found = {(0,) * parts}
    for _ in range(radius):
        found |= {d[:k] + (d[k] + s,) + d[k + 1 :] for d in found for k in range(parts) for s in (-1, 1)}
    codes = [sum(x * 128 ** (parts - 1 - k) for k, x in enumerate(d)) for d in found]
    return sorted(c for c in codes if c >= 0)


def _pairs(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column("same").to_pylist()
            out_a, out_b = [], []
            for k, one in enumerate(same):
                a = _tile(batch.column("tile")[k])
                src, dst = forest(a, None if one else _tile(batch.column("other")[k]), radius)
                out_a.append(src)
                out_b.append(dst)
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a), pa.int64()), pa.array(np.concatenate(out_b), pa.int64())], names=["a", "b"])

    return compare


def _tile(value: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    rows = value.values
    return rows.field("id").to_numpy(), rows.field("fp").to_numpy().view(np.uint64)


def links(prints: DataFrame, radius: int = 3, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Forest edges ``(a, b)`` that connect all fingerprints within ``radius`` bits.

    ``prints``: unique ``fp`` and ``id`` (bigint, no nulls), read twice.  ``parts`` (1, 2, 4 or 8 bit
    fields) sets how fine the cells are and never what is found; by default it
    follows the number of fingerprints, so that cells hold a tile's worth.
    """
    if parts is None:
        n = prints.count()
        parts = next((p for p, cells in CELLS.items() if n <= cells * tile), 8)
    cells = prints.select("id", "fp", _code(_fields(F.col("fp"), parts)).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("fp") / tile).alias("k"))
    tiles = (
        cells.join(sizes, "cell")
        .withColumn("sub", F.pmod(F.xxhash64("fp"), "k"))
        .repartition("cell", "sub")  # else a large cell stays where the join has put it
        .groupBy("cell", "sub")
        .agg(F.sort_array(F.collect_list(F.struct("id", "fp"))).alias("tile"))
    )
    tiles = stored(tiles, "tiles")
    near = tiles.withColumn("step", F.explode(F.array(*[F.lit(s).cast("bigint") for s in _steps(parts, radius)])))
    near = near.select((F.col("cell") + F.col("step")).alias("cell"), "sub", "tile", (F.col("step") == 0).alias("home"))
    others = tiles.select("cell", F.col("sub").alias("sub2"), F.col("tile").alias("other"))
    met = near.join(others, "cell").where(~F.col("home") | (F.col("sub") <= F.col("sub2")))
    met = met.select("tile", "other", (F.col("home") & (F.col("sub") == F.col("sub2"))).alias("same"))
    return met.mapInArrow(_pairs(radius), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3, parts: int | None = None, tile: int = TILE
) -> DataFrame:
    """Per row: ``id``, ``fingerprint`` (bigint) and ``component_id`` (smallest id reachable by links)."""
    prints = docs.select(F.col(id).cast("bigint").alias("id"), fingerprint(F.col(text), width).alias("fp"))
    prints = stored(prints, "prints")
    named = prints.where("id IS NOT NULL")
    reps = stored(named.groupBy("fp").agg(F.min("id").alias("id")), "reps")
    roots = connected_components(links(reps, radius, parts, tile), "a", "b")
    classes = reps.join(roots.withColumnRenamed("node", "id"), "id", "left").select("fp", F.coalesce("root", "id").alias("root"))
    out = prints.join(classes, "fp", "left")
    return out.select(F.col("id").alias(id), F.col("fp").alias("fingerprint"), F.col("root").alias("component_id"))


def hex16(fp: Column) -> Column:
    """16 lowercase hex digits of a bigint's 64 bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` with one document left of each group: the one with the smallest id.

    Rows with a null id can't be told apart and stay.  Of rows that repeat the
    surviving id, the one with the smallest text stays.
    """
    from pyspark.sql import Window

    from .common import fresh

    found = near_duplicates(docs, id, text, width, radius)
    key, first = fresh("_keep_id", docs), fresh("_keep_first", docs)
    best = found.where(F.col(id) == F.col("component_id")).select(F.col(id).alias(key)).distinct()
    rows = docs.join(best, F.col(id).cast("bigint") == F.col(key)).withColumn(first, F.row_number().over(Window.partitionBy(key).orderBy(F.col(text))))
    return rows.where(F.col(first) == 1).select(*docs.columns).unionByName(docs.where(F.col(id).isNull()))
