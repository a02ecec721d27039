"""Operator 10: licences by sparse TF-IDF cosine and nearest-ancestor directories.

Every line of a text (in windows, if it is long), every run of a template's own
number of words anywhere in it, and the text as a whole become sparse TF-IDF
vectors over the words of the licence templates; words outside them only
lengthen the vector.  The closest template by cosine names the
licence if it reaches the threshold.  The words' document frequencies are
counted over the lines of all texts.  A line of which too little lies in the
templates' vocabulary can't reach the threshold and is skipped, which changes
no result.

A file whose text as a whole is a licence (or whose name says so) speaks for
its directory.  Each distinct directory is expanded into its ancestors and
joined with the directories that have a licence; the deepest one wins, and
files without a licence of their own take their directory's.  Only that last
join touches files, with one row per directory on the other side.

Defined results: null and empty texts have no licence of their own; null paths
have no directory and inherit nothing; if a directory has several licence
files, the one with the highest score, then the first by name, counts; equal
cosines go to the template listed first.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, fresh, stored
from .decontam import words

#: Bytes of text at once; words of a window and of the step to the next one.
PIECE = 1 << 22
WINDOW, STEP = 40, 20

# Names and usual notices of public licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "The MIT License (MIT). Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004. Terms and conditions for use, reproduction, and distribution."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: neither the name of the copyright holder nor the names of its contributors may be used to endorse products."),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"


@dataclass(frozen=True)
class Space:
    """The templates' vocabulary, its weights, and the templates as unit rows."""

    names: tuple[str, ...]
    vocabulary: pa.Array
    idf: np.ndarray
    other: float  # weight of a word outside the vocabulary
    rows: np.ndarray


def _terms(texts: list[str]) -> list[list[str]]:
    return [[w for w in ws if w] for ws in words(pa.array(texts, pa.string())).to_pylist()]


def vocabulary(templates=TEMPLATES) -> pa.Array:
    return pa.array(sorted({w for ws in _terms([t for _, t in templates]) for w in ws}), pa.string())


def space(df: np.ndarray, n_lines: int, templates=TEMPLATES) -> Space:
    """Weights from the numbers of lines that hold each word of the vocabulary."""
    known = vocabulary(templates)
    idf = np.log((1 + n_lines) / (1 + df)) + 1
    rows = np.zeros((len(templates), len(known)))
    for k, ws in enumerate(_terms([t for _, t in templates])):
        np.add.at(rows[k], pc.index_in(pa.array(ws), known).to_numpy(zero_copy_only=False), 1)
    rows *= idf
    return Space(tuple(n for n, _ in templates), known, idf, float(np.median(idf)), rows / np.linalg.norm(rows, axis=1, keepdims=True))


def _lines(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row of each line, and the lines."""
    lists = pc.split_pattern(pc.fill_null(column, ""), "\n")
    return pc.list_parent_indices(lists).to_numpy(), lists.flatten()


def _ids(lines: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word ids (-1: outside the vocabulary) of all lines, and where each line starts."""
    lists = words(lines)
    flat = lists.flatten()
    ids = pc.fill_null(pc.index_in(flat, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = lists.offsets.to_numpy().astype(np.int64)
    blank = pc.equal(flat, "").to_numpy(zero_copy_only=False)  # an empty line's only word
    return np.where(blank, -2, ids), starts - starts[0]


def _frequencies(known: pa.Array):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for part in by_bytes(batch, batch.schema.names[0], PIECE):
                ids, starts = _ids(_lines(part.column(0))[1], known)
                line = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                pairs = np.unique(line[ids >= 0] * len(known) + ids[ids >= 0])
                df += np.bincount(pairs % len(known), minlength=len(known))
                n += len(np.unique(line[ids > -2]))
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(known)), -1], pa.int32()), pa.array([*df, n], pa.int64())], names=["word", "n"])

    return count


def fit(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> Space:
    """Weights counted over the lines of all texts; the driver gets a number per word of the templates."""
    known = vocabulary(templates)
    found = docs.select(F.col(text)).mapInArrow(_frequencies(known), "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {r["word"]: r["n"] for r in found}
    return space(np.array([seen.get(k, 0) for k in range(len(known))]), seen.get(-1, 0), templates)


def _closest(ids: np.ndarray, first: np.ndarray, last: np.ndarray, at: Space, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Closest template and cosine of each run ``ids[first:last]``; cosine 0 where it can't reach the threshold."""
    best, cosine = np.zeros(len(first), np.int64), np.zeros(len(first))
    outside = np.concatenate(([0], np.cumsum(ids == -1)))
    inside = np.concatenate(([0], np.cumsum(ids >= 0)))
    far = (outside[last] - outside[first]) * at.other**2  # repeated outside words count as different ones
    for k in np.nonzero(inside[last] > inside[first])[0]:
        own = ids[first[k] : last[k]]
        own = own[own >= 0]
        if len(own) ** 2 * at.idf.max() ** 2 * (1 - threshold**2) < threshold**2 * far[k]:
            continue  # even if all its known words were one
        weights = np.bincount(own, minlength=len(at.idf)) * at.idf
        size = weights @ weights
        if size < threshold**2 * (size + far[k]):
            continue
        cos = at.rows @ weights / np.sqrt(size + far[k])
        best[k], cosine[k] = cos.argmax(), cos.max()
    return best, cosine


def scan_batch(column: pa.Array, at: Space, threshold: float) -> list[dict]:
    """Per text: licence and score of its closest line, and whether the text as a whole is a licence."""
    row, lines = _lines(column)
    ids, starts = _ids(lines, at.vocabulary)
    n = np.diff(starts)
    steps = np.maximum(1, -(-(n - WINDOW) // STEP) + 1)
    line = np.repeat(np.arange(len(n)), steps)
    turn = np.arange(len(line)) - np.repeat(np.cumsum(steps) - steps, steps)
    first = starts[line] + turn * STEP
    last = np.minimum(first + WINDOW, starts[line + 1])
    best, cosine = _closest(ids, first, last, at, threshold)
    bounds = starts[np.searchsorted(row, np.arange(len(column) + 1))]
    whole, whole_cosine = _closest(ids, bounds[:-1], bounds[1:], at, threshold)
    out = [{"license": None, "score": 0.0, "whole": False} for _ in range(len(column))]
    hits = np.nonzero(cosine >= threshold)[0]
    for k in hits[np.lexsort((best[hits], -cosine[hits]))][::-1]:  # the best of a text comes last
        out[row[line[k]]] |= {"license": at.names[best[k]], "score": min(1.0, float(cosine[k]))}
    for k in np.nonzero(whole_cosine >= threshold)[0]:
        out[k]["whole"] = True
        if whole_cosine[k] > out[k]["score"]:
            out[k] |= {"license": at.names[whole[k]], "score": min(1.0, float(whole_cosine[k]))}
    return out


def slide_batch(column: pa.Array, at: Space, lengths: list[int], threshold: float, found: list[dict]) -> list[dict]:
    """``found`` (of ``scan_batch``) with closer notices anywhere in a text, across lines and beside other words.

    For each template, a window of its own number of words slides over the words of the text, one at a time; at
    the end it is cut.  The sums of single words' weights give an upper bound of each window's cosine, so that few
    windows are compared exactly.
    """
    lists = words(column)
    flat = lists.flatten()
    ids = pc.fill_null(pc.index_in(flat, at.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    text = np.repeat(np.arange(len(column)), np.diff(bounds))
    weights = np.append(at.idf, at.other)[ids]  # -1 is the last
    weights[blank] = 0
    size = np.concatenate(([0.0], np.cumsum(weights**2)))
    near = []
    for k, width in enumerate(lengths):
        dot = np.concatenate(([0.0], np.cumsum(np.append(at.rows[k] * at.idf, 0.0)[ids])))
        last = np.minimum(np.arange(len(ids)) + width, bounds[text + 1])
        most = dot[last] - dot[:-1]
        square = size[last] - size[:-1]
        first = np.nonzero((most > 0) & (most >= (threshold - 1e-6) * np.sqrt(square)))[0]
        near.append(np.stack([text[first], -most[first] / np.sqrt(square[first]), np.full(len(first), k), first, last[first]], axis=1))
    near = np.concatenate(near)
    out = [dict(f) for f in found]
    for row, bound, k, first, last in near[np.lexsort((near[:, 3], near[:, 2], near[:, 1], near[:, 0]))].tolist():
        best = out[int(row)]
        if -bound <= best["score"]:
            continue
        own = ids[int(first) : int(last)]
        vector = np.bincount(own[own >= 0], minlength=len(at.idf)) * at.idf
        # repeated outside words count as different ones
        cosine = min(1.0, float(at.rows[int(k)] @ vector / np.sqrt(vector @ vector + (own < 0).sum() * at.other**2)))
        if cosine >= threshold and cosine > best["score"] + 1e-9:
            best |= {"license": at.names[int(k)], "score": cosine}
    return out


FOUND = "struct<license:string,score:double,whole:boolean>"


def scan(text: Column, at: Space, threshold: float = 0.7, templates=TEMPLATES) -> Column:
    """The licence found in a text column: struct (license, score, whole)."""
    lengths = [len(ws) for ws in _terms([t for _, t in templates])]

    @F.arrow_udf(FOUND)
    def found(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        parts = [part.column(0) for part in by_bytes(batch, "text", PIECE)]
        rows = [r for part in parts for r in slide_batch(part, at, lengths, threshold, scan_batch(part, at, threshold))]
        return pa.array(rows, pa.struct([("license", pa.string()), ("score", pa.float64()), ("whole", pa.bool_())]))

    return found(text)


def directory(path: Column) -> Column:
    """What stands before the last slash; the root is the empty string."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(files: DataFrame, path: str, license: str, score: str, speaks: Column, out: str = "inherited", origin: str = "inherited_from") -> DataFrame:
    """``files`` with the licence of the nearest ancestor directory that has a licence file, and that directory.

    ``speaks``: the files whose licence holds for their directory.
    """
    own, up = fresh("_dir", files), fresh("_up", files)
    tagged = files.withColumn(own, directory(F.col(path)))
    spoken = tagged.where(speaks & F.col(license).isNotNull() & F.col(own).isNotNull())
    first = Window.partitionBy(own).orderBy(F.col(score).desc(), F.col(path))  # top one, limited map-side
    holders = spoken.select(own, license, score, path).withColumn("_first", F.row_number().over(first)).where("_first = 1").select(F.col(own).alias(up), F.col(license).alias(out))
    holders = stored(holders, "license-dirs")
    dirs = tagged.where(F.col(own).isNotNull()).select(own).distinct()
    parts = F.split(F.col(own), "/", -1)
    # a directory, its parents and the root
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    ancestors = dirs.select(own, F.explode(F.array_distinct(above)).alias(up))
    nearest = ancestors.join(holders, up).groupBy(own).agg(F.max(F.struct(F.length(up).alias("depth"), F.col(up).alias("at"), F.col(out).alias("license"))).alias("best"))
    # stored, so that the last join is between two plain inputs, of which a hot directory's side can be split
    nearest = stored(nearest.select(own, F.col("best.license").alias(out), F.col("best.at").alias(origin)), "nearest-dirs")
    return tagged.join(nearest, own, "left").drop(own)


def licenses(docs: DataFrame, path: Column, id: str = "doc_id", text: str = "text", threshold: float = 0.7, at: Space | None = None) -> DataFrame:
    """Per row: ``id``, path, license, score, via (header, file, inherited or null) and the directory it came from."""
    at = at or fit(docs, text)
    rows = docs.select(F.col(id).alias("id"), path.alias("path"), scan(F.col(text), at, threshold).alias("own"))
    rows = rows.select("id", "path", F.col("own.license").alias("license"), F.col("own.score").alias("score"), F.col("own.whole").alias("whole"))
    rows = stored(rows, "licenses")
    speaks = F.col("whole") | F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    found = inherit(rows, "path", "license", "score", speaks)
    via = F.when(F.col("license").isNotNull(), F.when(speaks, "file").otherwise("header")).when(F.col("inherited").isNotNull(), "inherited")
    return found.select(
        F.col("id").alias(id), "path", F.coalesce("license", "inherited").alias("license"), "score", via.alias("via"), F.when(F.col("license").isNull(), F.col("inherited_from")).alias("inherited_from")
    )
