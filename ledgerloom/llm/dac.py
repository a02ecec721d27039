"""Operator 8: token files as directly addressable codes.

Documents are range-partitioned and sorted by id; each task encodes its texts
with a tokenizers file, appends an end id to every document and writes files of
bounded size.  In a file each id is cut into 8-bit chunks: level 0 holds the
low chunk of every id, level k the k-th chunk of the ids that have one, and a
bitmap per level says which ids go on.  A rank directory (ones before every 512
bits) turns a place in one level into its place in the next, so any token is
read with a few byte reads and nothing around it is decoded.

File layout, little-endian: ``DAC1``, header length (u32), JSON header with the
counts and the place of each section, then the sections: ids of documents
(i64), null marks of these ids (u8), first token of each document and the end
(u64), and per level chunks (u8), bitmap (u64 words) and directory (u32; the
last level has neither).

Files are written next to their final name and renamed, with names and contents
that depend on the data only, so a repeated task replaces its own files.  A
manifest table (file, documents, tokens) is stored after all tasks have ended;
only files it lists are read back.  The folder must be one that all executors
share; it is opened by URI through ``pyarrow.fs``.

Defined results: null text is the empty text (the end id alone); documents with
equal or null ids are written each, ordered by id (nulls first), then a hash of
the text; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, stored

MAGIC = b"DAC1"
CHUNK = 8
RANK_BITS = 512
#: Tokens after which a task starts another file.
FILE_TOKENS = 1 << 22
#: Parts that a worker remembers the ids of: those that have come again, and new ones.
WORDS, NEW_WORDS = 300_000, 200_000


# --- encoding -------------------------------------------------------------------------------------

PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Marks before which a text is cut if they follow an ASCII letter, which normalising leaves as one letter.
MARKS = b".,!?;:"
#: Bytes of text that are encoded at once, but for longer texts.
TURN_BYTES = 1 << 22


def _bytes(chars: bytes) -> np.ndarray:
    """A table of all bytes that marks some."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


IS_SPACE, IS_MARK = _bytes(b" \t\n\r\x0b\x0c"), _bytes(MARKS)
IS_UPPER, IS_LETTER = _bytes(bytes(range(65, 91))), _bytes(bytes([*range(65, 91), *range(97, 123)]))


def text_parts(texts: pa.LargeStringArray, fold: bool) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Parts of texts without nulls, white space left out, and the number of parts before each text and at the end.

    Texts are cut at ASCII white space and before marks that follow an ASCII
    letter.  ``fold``: A-Z become a-z, unless a byte of another script follows,
    which might be a mark to join with, or the batch spells something like a
    special token.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(ends[0]), int(ends[-1])
    if first == last:
        return texts.slice(0, 0), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    bounds = ends - first
    keep = ~IS_SPACE[data]
    starts = keep.copy()
    starts[1:] &= ~keep[:-1] | (IS_LETTER[data[:-1]] & IS_MARK[data[1:]])
    own = bounds[:-1][np.diff(bounds) > 0]
    starts[own] = keep[own]
    stops = keep.copy()
    stops[:-1] &= ~keep[1:] | starts[1:]
    at = np.flatnonzero(starts)
    if fold and b"<|" not in data.tobytes():
        upper = IS_UPPER[data]
        upper[:-1] &= data[1:] < 128
        data = data + (upper.view(np.uint8) << 5)
    offsets = np.append(0, np.cumsum(np.flatnonzero(stops) - at + 1)).astype(np.int64)
    parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[keep]))
    return parts, np.searchsorted(at, bounds)


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and never joins over it.

    Texts are cut into parts (:func:`text_parts`); the different parts of a turn
    are encoded once, and the ids of all are gathered by numpy.  Parts are
    remembered: new ones on probation, at most :data:`NEW_WORDS`, and those that
    have come in another turn for longer, at most :data:`WORDS`.  Full memories
    lose all on probation, or the older half.

    ``fold``: the tokenizer lower-cases.  ``direct``: a word of Latin letters is
    one unit for the file's merges, so it goes straight to them and skips the
    steps that would leave it as it is (both are found with probe words on loading).
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.fold = self._library(["AÀ"]) == self._library(["aà"])
        probes = ["a", "le", "été", "straße", "ñandú", "tokenizer", "thtionheon", "ÿþý", "zzzzqqqqx"]
        self.direct = self.fold and [self._merge(w) for w in probes] == self._library(probes)

    def _library(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _merge(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return array("I", [t.id for t in self.merges(shown)]).tobytes()

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Ids of new parts."""
        found: dict[str, bytes] = {}
        if self.direct:
            for part in parts:
                if part.isalpha() if part.isascii() else PLAIN.fullmatch(part):
                    found[part] = self._merge(part.lower())
        rest = [p for p in parts if p not in found]
        for at in range(0, len(rest), 4096):
            turn = rest[at : at + 4096]
            found.update(zip(turn, self._library(turn)))
        return [found[p] for p in parts]

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts, remembered or learnt."""
        found = list(map(self.known.get, parts))
        missing = [k for k, ids in enumerate(found) if ids is None]
        learn = []
        for k in missing:
            ids = self.new.pop(parts[k], None)
            if ids is None:
                learn.append(k)
            else:
                found[k] = self.known[parts[k]] = ids
        if len(self.known) > WORDS:
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
        for k, ids in zip(learn, self._learn([parts[k] for k in learn])):
            found[k] = ids
            if len(parts[k]) <= 64:  # longer ones hardly come again
                self.new[parts[k]] = ids
        if len(self.new) > NEW_WORDS:
            self.new = {}
        return found

    def encode_arrow(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place of each text's first and the end."""
        parts, place = text_parts(pc.fill_null(texts.cast(pa.large_string()), ""), self.fold)
        coded = parts.dictionary_encode()
        each = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.array([len(ids) for ids in each], np.int64) // 4
        ids, begins = np.frombuffer(b"".join(each), np.uint32), np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        size = sizes[which]
        ends = np.append(0, np.cumsum(size))
        source = np.repeat(begins[which] - ends[:-1], size)
        source += np.arange(len(source))
        return ids[source], ends[place]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, at = self.encode_arrow(pa.array(texts, pa.large_string()))
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# --- the file format ------------------------------------------------------------------------------


def pack(doc_ids: list[int | None], tokens: list[np.ndarray]) -> bytes:
    """One file of documents and their ids."""
    starts = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype("<u8")
    rest = np.concatenate([np.zeros(0, np.uint32), *tokens]).astype(np.uint32)
    sections = [
        ("doc_ids", np.array([i or 0 for i in doc_ids], "<i8").tobytes()),
        ("null_ids", np.array([i is None for i in doc_ids], "u1").tobytes()),
        ("starts", starts.tobytes()),
    ]
    levels = 0
    while levels == 0 or len(rest):
        more = rest >> CHUNK > 0
        sections.append((f"chunks{levels}", (rest & 0xFF).astype("u1").tobytes()))
        if more.any():
            bits = np.packbits(np.concatenate((more, np.zeros(-len(more) % RANK_BITS, bool))), bitorder="little")
            ones = np.bitwise_count(bits.view("<u8")).reshape(-1, RANK_BITS // 64).sum(axis=1)
            sections.append((f"bits{levels}", bits.tobytes()))
            sections.append((f"ranks{levels}", (np.cumsum(ones) - ones).astype("<u4").tobytes()))
        rest = rest[more] >> CHUNK
        levels += 1
    places, at = {}, 0
    for name, data in sections:
        places[name] = [at, len(data)]
        at += len(data)
    header = json.dumps({"docs": len(doc_ids), "tokens": int(starts[-1]), "levels": levels, "sections": places}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *[data for _, data in sections]])


class DacFile:
    """A token file read through ``read(start, length)``: of bytes in memory, or of an open file."""

    def __init__(self, read):
        if read(0, 4) != MAGIC:
            raise ValueError("not a DAC1 file")
        size = int.from_bytes(read(4, 4), "little")
        self.header = json.loads(read(8, size))
        self._read, self._base = read, 8 + size
        self.docs, self.tokens, self.levels = (self.header[k] for k in ("docs", "tokens", "levels"))

    @classmethod
    def of(cls, data: bytes) -> DacFile:
        view = memoryview(data)
        return cls(lambda start, length: bytes(view[start : start + length]))

    @classmethod
    def open(cls, uri: str) -> DacFile:
        store, path = fs.FileSystem.from_uri(uri)
        return cls(_reader(store.open_input_file(path)))

    def _array(self, name: str, kind: str, start: int = 0, count: int | None = None) -> np.ndarray:
        at, size = self.header["sections"].get(name, (0, 0))
        width = np.dtype(kind).itemsize
        count = size // width - start if count is None else count
        return np.frombuffer(self._read(self._base + at + start * width, count * width), kind)

    def doc_ids(self) -> list[int | None]:
        return [None if null else int(i) for i, null in zip(self._array("doc_ids", "<i8"), self._array("null_ids", "u1"))]

    def starts(self) -> np.ndarray:
        return self._array("starts", "<u8").astype(np.int64)

    def token(self, i: int) -> int:
        """The id at place ``i``, by a few bytes of each level."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            value |= int(self._array(f"chunks{level}", "u1", i, 1)[0]) << (CHUNK * level)
            if f"bits{level}" not in self.header["sections"]:
                break
            block, bit = divmod(i, RANK_BITS)
            words = self._array(f"bits{level}", "<u8", block * (RANK_BITS // 64), bit // 64 + 1)
            if not int(words[-1]) >> (bit % 64) & 1:
                break
            below = int(words[-1]) & ((1 << (bit % 64)) - 1)
            i = int(self._array(f"ranks{level}", "<u4", block, 1)[0]) + int(np.bitwise_count(words[:-1]).sum()) + below.bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        levels = [self._array(f"chunks{k}", "u1").astype(np.uint32) for k in range(self.levels)]
        values = levels[-1]
        for k in range(self.levels - 2, -1, -1):
            more = np.unpackbits(self._array(f"bits{k}", "u1"), count=len(levels[k]), bitorder="little").astype(bool)
            levels[k][more] += values << CHUNK
            values = levels[k]
        return values


def _reader(handle):
    def read(start: int, length: int) -> bytes:
        handle.seek(start)
        return handle.read(length)

    return read


# --- Spark ----------------------------------------------------------------------------------------

MANIFEST = "file string, part int, docs bigint, tokens bigint, bytes bigint"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = 1, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the token files of ``docs`` into ``folder`` (a URI) and return the stored manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part, count = encoder(tokenizer), TaskContext.get().partitionId(), 0
        store, path = fs.FileSystem.from_uri(folder)  # each task opens its own
        end, ids, held, size = np.array([end_id], np.uint32), [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal count, size
            name = f"tokens-{part:06d}-{count:06d}.dac"
            data = pack(ids, held)
            own = f"{path}/_{name}-{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                out.write(data)
            store.move(own, f"{path}/{name}")
            row = [[name], [part], [len(ids)], [size], [len(data)]]
            count, size = count + 1, 0
            ids.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["file", "part", "docs", "tokens", "bytes"])

        for batch in batches:
            for turn in by_bytes(batch, "text", TURN_BYTES):
                found, at = words.encode_arrow(turn.column("text"))
                for i, a, b in zip(turn.column("id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    ids.append(i)
                    held.append(np.concatenate((found[a:b], end)))
                    size += b - a + 1
                    if size >= file_tokens:
                        yield flush()
        if ids:
            yield flush()

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    # rows of one id, or without an id, may be many: a hash of the text deals them, too
    rows = rows.withColumn("place", F.xxhash64("text"))
    ranged = rows.repartitionByRange("id", "place").sortWithinPartitions("id", "place", "text").select("id", "text")
    return stored(ranged.mapInArrow(write, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame, folder: str, id: str = "doc_id") -> DataFrame:
    """Per document, decoded from the files: ``id``, start, n_tokens, ids_crc32 and file.

    ``start``: ids of all documents before it.  The files' offsets are a running sum over the
    manifest, a row per file.
    """
    spark = manifest.sparkSession
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.dac").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file"), batch.column("content")):
                file = DacFile.of(content.as_buffer())
                tokens, starts = file.all().astype("<u4"), file.starts()
                sums = [zlib.crc32(tokens[s:e].tobytes()) for s, e in zip(starts[:-1], starts[1:])]
                columns = [pa.array([name.as_py()] * file.docs, pa.string()), pa.array(file.doc_ids(), pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "doc", "first", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(decode, "file string, doc bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    joined = rows.join(bases, "file")
    return joined.select(F.col("doc").alias(id), (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", "file")
