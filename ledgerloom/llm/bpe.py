"""Operator 9: byte-level BPE encoding and decoding with the tiktoken library.

A local rank file (the path is a parameter; it must exist on every executor)
and the pattern that splits texts before merges make the encoding.  Long texts
are cut at places where the pattern always starts a new match, so the ids are
those of the whole text, and the library gets pieces of about equal size.
Where a text has no such place it goes on uncut; the one thing that the
library's pattern can't take in any length, white space, is handed to its merges directly.

Null text: encoded as the empty text (no ids).  Null ids: decoded as no bytes.
Texts that spell special tokens are ordinary text.  Ids outside the rank file
raise.  Decoding gives raw bytes: ids that end inside a character are kept.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import must_be_free

#: Longer texts are cut at the first safe place after so many characters.
PIECE_CHARS = 1 << 16

#: A space or line feed after a letter, a digit or another printable ASCII character: no match of the
#: pattern goes over it, since white space can only stand at the start of a match, and none looks back.
SAFE = re.compile(r"(?<=[!-~]|[^\W_])[ \n]")

#: More white space than that in a row is not handed to the pattern, whose look-ahead takes a stack frame a character.
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{65536,}")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file; kept by the Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Consecutive parts of a text, cut at safe places at least ``size`` characters apart."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str | None, rank_file: str, pattern: str, size: int = PIECE_CHARS) -> list[int]:
    """Ids of a text.

    In a long run of white space the pattern matches all of it at the end of a
    text, and else all but the last character, which may begin the next match.
    """
    own = encoding(rank_file, pattern)
    if not text:
        return []
    if len(text) <= size:
        return own.encode_ordinary(text)
    ids, start = [], 0
    for run in WHITE.finditer(text):
        ids += [i for piece in pieces(text[start : run.start()], size) for i in own.encode_ordinary(piece)]
        start = run.end() if run.end() == len(text) else run.end() - 1
        ids += own._core_bpe.encode_single_piece(text[run.start() : start].encode())
    return ids + [i for piece in pieces(text[start:], size) for i in own.encode_ordinary(piece)]


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """Token ids (array of int) of a text column."""

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        offsets, values = [0], array("i")
        for value in column:
            values.extend(encode_text(value.as_py(), rank_file, pattern))
            offsets.append(len(values))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(values, np.int32)))

    return ids(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes (binary) that a column of token ids stands for."""

    @F.arrow_udf("binary")
    def raw(column: pa.Array) -> pa.Array:
        to_bytes = encoding(rank_file, pattern).decode_bytes
        return pa.array([to_bytes(value.as_py() or []) for value in column], pa.binary())

    return raw(ids)


def encode_decode(text: Column, rank_file: str, pattern: str) -> Column:
    """Struct (ids, raw) of a text column: its token ids and the bytes decoded from them, in one go.

    Two chained functions would encode twice, as Spark evaluates them side by side.
    """

    @F.arrow_udf("struct<ids:array<int>,raw:binary>")
    def both(column: pa.Array) -> pa.Array:
        to_bytes = encoding(rank_file, pattern).decode_bytes
        offsets, values, raw = [0], array("i"), []
        for value in column:
            ids = encode_text(value.as_py(), rank_file, pattern)
            values.extend(ids)
            offsets.append(len(values))
            raw.append(to_bytes(ids))
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(values, np.int32)))
        return pa.StructArray.from_arrays([ids, pa.array(raw, pa.binary())], names=["ids", "raw"])

    return both(text)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "token_ids", raw: str = "decoded") -> DataFrame:
    """``docs`` with the ids of ``text`` and the bytes decoded from them."""
    must_be_free(docs, ids, raw)
    both = encode_decode(F.col(text), rank_file, pattern)
    return docs.withColumns({ids: both["ids"], raw: both["raw"]})


def digests(encoded: DataFrame, key: str, ids: str = "token_ids", raw: str = "decoded") -> DataFrame:
    """Per row: ``key``, n_tokens, ids_sha256 and decoded_sha256."""
    return encoded.select(
        key,
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(raw), 256).alias("decoded_sha256"),
    )
