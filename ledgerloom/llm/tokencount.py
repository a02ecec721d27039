"""Operator 12: token counts, by batch encoding in an Arrow function that returns lengths only.

The texts of a batch are cut at every safe place, so that long texts become
many short parts; equal parts of the batch are encoded once; and the different
ones are dealt to library calls of about equal bytes.  Ids never leave the
library: a call returns lengths, which are summed up by text.

Safe places are blanks and line feeds after a printable ASCII character.  In a
byte-level tokenizer white space stands only at the start of a match, or in a
match of nothing else, so a match always begins there; an added token's string
(``<|endoftext|>``) holds no white space, so none is cut.  A text without such a
place (a million letters in a row) is one part, as its merges may go over any
of its characters.  Tokenizers of another kind (see :func:`can_cut`) get whole
texts, in calls of about equal bytes all the same.

Null text: the empty text, no tokens.  Strings of special tokens inside a text
count as the library's default has them: as the special token.  Repeated rows,
null ids and further columns don't matter, since the count is a column of the
text alone.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one library call gets, about.
CALL_BYTES = 1 << 18


@lru_cache(maxsize=4)
def counter(file: str) -> Callable[[list[str]], list[int]]:
    """Function from texts to their token counts; kept by the Python worker."""
    if file.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def can_cut(file: str) -> bool:
    """Whether parts cut at safe places have the text's own tokens: byte-level splitting by the default pattern, nothing else."""
    if not file.endswith(".json"):
        return False
    with open(file, encoding="utf-8") as lines:
        spec = json.load(lines)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    added = spec.get("added_tokens") or []
    whole = not any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
    return bool(plain and whole and not spec.get("normalizer") and not spec.get("post_processor"))


def safe_parts(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Texts without nulls, cut at every safe place: the parts in order, and the text that each belongs to."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(ends[0]), int(ends[-1])
    if first == last:
        return texts.slice(0, 0), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    starts = np.zeros(last - first, bool)
    starts[1:] = ((data[1:] == 32) | (data[1:] == 10)) & (data[:-1] > 32) & (data[:-1] < 127)
    own = ends[:-1][np.diff(ends) > 0] - first
    starts[own] = True
    starts = np.flatnonzero(starts)
    offsets = np.append(starts, last - first).astype(np.int64)
    parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return parts, np.searchsorted(ends - first, starts, side="right") - 1


def count_parts(parts: pa.LargeStringArray, count: Callable[[list[str]], list[int]], call_bytes: int = CALL_BYTES) -> np.ndarray:
    """Token counts of different strings, in calls of about equal bytes."""
    sizes = pc.binary_length(parts).to_numpy(zero_copy_only=False)
    total = int(sizes.sum())
    calls = max(1, round(total / call_bytes))
    call = (np.cumsum(sizes) - sizes) * calls // max(1, total)  # the call in whose share a part begins
    cuts = [0, *(np.flatnonzero(np.diff(call)) + 1).tolist(), len(parts)]
    found = [count(parts.slice(a, b - a).to_pylist()) for a, b in zip(cuts, cuts[1:]) if b > a]
    return np.concatenate([np.asarray(f, np.int64) for f in found]) if found else np.zeros(0, np.int64)


def count_batch(column: pa.Array, file: str, call_bytes: int = CALL_BYTES) -> np.ndarray:
    """Token counts of an Arrow column of texts."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    parts, owner = safe_parts(texts) if can_cut(file) else (texts, np.arange(len(texts)))
    coded = parts.dictionary_encode()
    lengths = count_parts(coded.dictionary, counter(file), call_bytes)[coded.indices.to_numpy()]
    return np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)


def token_count(text: Column, file: str) -> Column:
    """Tokens (bigint, never null) of a text column by the tokenizer in ``file`` (which every executor has)."""

    @F.arrow_udf("bigint")
    def counted(column: pa.Array) -> pa.Array:
        return pa.array(count_batch(column, file), pa.int64())

    return counted(text)


def count_tokens(docs: DataFrame, file: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: the key, n_bytes (UTF-8), n_tokens and whether they are over ``limit``."""
    size = F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint")
    found = docs.select(key, size.alias("n_bytes"), token_count(F.col(text), file).alias("n_tokens"))
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
