import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import licenses


def plain_cosine(words, at):
    """Best cosine of a run of words to a template, over a dense vector with a place for each outside word."""
    known = at.vocabulary.to_pylist()
    outside = [w for w in words if w not in known]
    vector = np.zeros(len(known) + len(outside))
    for w in words:
        if w in known:
            vector[known.index(w)] += at.idf[known.index(w)]
    vector[len(known) :] = at.other
    if not vector.any():
        return 0.0
    return max(float(np.append(r, np.zeros(len(outside))) @ vector) for r in at.rows) / np.linalg.norm(vector)


def test_scan_against_dense_vectors():
    rng = np.random.default_rng(2)
    vocabulary = [*licenses.vocabulary().to_pylist(), *"abcdefgh"]
    texts = [t for _, t in licenses.TEMPLATES] + [None, "", "\n\n"]
    for _ in range(200):
        lines = [" ".join(rng.choice(vocabulary, rng.integers(0, 15))) for _ in range(rng.integers(1, 4))]
        if rng.random() < 0.4:
            lines.append(licenses.TEMPLATES[rng.integers(len(licenses.TEMPLATES))][1])
        texts.append("\n".join(lines))
    at = licenses.space(np.arange(len(licenses.vocabulary())) % 50, 1000)
    for text, got in zip(texts, licenses.scan_batch(pa.array(texts, pa.string()), at, 0.7)):
        runs = licenses._terms((text or "").split("\n"))
        lines = [ws[k : k + licenses.WINDOW] for ws in runs for k in range(0, max(1, len(ws) - licenses.STEP), licenses.STEP)]
        whole = plain_cosine([w for ws in runs for w in ws], at)
        best = max([whole, *(plain_cosine(ws, at) for ws in lines)])
        assert got["whole"] == (whole >= 0.7) and abs(got["score"] - (best if best >= 0.7 else 0)) < 1e-9
    for (name, text), got in zip(licenses.TEMPLATES, licenses.scan_batch(pa.array([t for _, t in licenses.TEMPLATES]), at, 0.7)):
        assert got["license"] == name and got["whole"]


def test_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    prose = "The committee met on Tuesday and talked at length about rivers, bridges and the cost of bread."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/x.py", prose), (3, "a/b/c/y.py", prose), (4, "a/b/COPYING", apache), (5, "a/b/z.py", prose),
        (6, "top.py", prose), (7, "a/own.py", f"{prose}\nLicensed under CC BY-NC 4.0.\n{prose}"), (8, None, prose), (9, None, mit), (10, "ab/x.py", prose),
        (11, "a/b", prose), (12, "d/L1", mit), (13, "d/L0", mit), (14, "d/x", None), (14, "d/x", None), (15, "", ""),
    ]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, p string, text string, license string")
    found = licenses.licenses(docs, F.col("p"))
    got = {r.doc_id: (r.license, r.via, r.inherited_from) for r in found.collect()}
    assert found.count() == len(rows)
    assert got == {
        1: ("MIT", "file", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "inherited", "a/b"), 4: ("Apache-2.0", "file", None),
        5: ("Apache-2.0", "inherited", "a/b"), 6: (None, None, None), 7: ("CC-BY-NC-4.0", "header", None), 8: (None, None, None), 9: ("MIT", "file", None),
        10: (None, None, None), 11: ("MIT", "inherited", "a"), 12: ("MIT", "file", None), 13: ("MIT", "file", None), 14: ("MIT", "inherited", "d"), 15: (None, None, None),
    }
    assert licenses.licenses(docs.limit(0), F.col("p")).count() == 0
    root = spark.createDataFrame([(1, "LICENSE", mit), (2, "deep/er/x", prose)], "doc_id long, p string, text string")
    assert [r.license for r in licenses.licenses(root, F.col("p")).orderBy("doc_id").collect()] == ["MIT", "MIT"]


def test_notices_across_lines_and_beside_other_words(spark):
    prose = "The committee met on Tuesday and talked at length about rivers, bridges and the cost of bread."
    templates = dict(reversed(licenses.TEMPLATES))
    gpl = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and "redistribute" in t).split()
    mit = templates["MIT"].split()
    header = "\n".join("# " + " ".join(gpl[k : k + 9]) for k in range(0, len(gpl), 9))
    rows = [
        (1, "Copyright (c) 2024 Jane Doe. Released under the MIT License.", "MIT"),
        (2, "Copyright 2020 Foo Inc. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        (3, f"{prose} Licensed under CC BY-NC 4.0. {prose}", "CC-BY-NC-4.0"),
        (4, f"{prose}\n{' '.join(mit[:3])}\n{' '.join(mit[3:])}\n{prose}", "MIT"),
        (5, "\n".join([header, *[prose] * 12]), "GPL-3.0"),
        (6, "\n".join([prose] * 12), None),
    ]
    docs = spark.createDataFrame([(i, f"d{i}/x", t) for i, t, _ in rows], "doc_id long, p string, text string")
    got = {r.doc_id: r.license for r in licenses.licenses(docs, F.col("p"), at=licenses.space(np.arange(len(licenses.vocabulary())) % 50, 1000)).collect()}
    assert got == {i: n for i, _, n in rows}
