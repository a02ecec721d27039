import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import dac
from ledgerloom.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["İ.", "\u0958.", "e\u0301,", "It's", "don't,", "ÉTÉ.", "été", "naïve!", "x\xa0y", "\x1c", " ", "é.", "İ", "ΣΑΣ", "ß", "12ab", "...", "a.b", "<|endoftext|>", "中文", "🙂", "'s", "l'été,", "A#b", "  ", "\n", "_x_", "ñ?", "Word", "word", "WORD;", "<|EndOfText|>", "x<|startoftext|>y", "I\u0307", "A\u030a.", "ab,'s", "\u0301", "a\xa0b", "\x85"]


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PARTS), max_size=20).map(" ".join), st.lists(st.sampled_from(PARTS), max_size=20).map("".join)))
def test_words_encode_as_the_library_does(text):
    assert dac.encoder(PATH).encode([text])[0].tolist() == library([text])[0]


def test_a_batch_encodes_as_its_texts_do():
    rng = random.Random(7)
    texts = [None if k % 9 == 0 else rng.choice(["", " ", "\n"]).join(rng.choices(PARTS, k=rng.randint(0, 30))) for k in range(300)]
    ids, at = dac.encoder(PATH).encode_arrow(pa.array(texts).slice(3))
    want = library([t or "" for t in texts[3:]])
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(dac, "WORDS", 3)
    monkeypatch.setattr(dac, "NEW_WORDS", 2)
    own, texts = dac.WordEncoder(PATH), ["one two three four", "two, three. five", "", "one"]
    assert [own.encode([t])[0].tolist() for t in texts] == library(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1).map(lambda x: x >> (x % 29)), max_size=400), max_size=6))
def test_any_token_is_read_directly(docs):
    file = dac.DacFile.of(dac.pack(list(range(len(docs))), [np.array(d, np.uint32) for d in docs]))
    flat = [t for d in docs for t in d]
    assert file.all().tolist() == flat and file.tokens == len(flat)
    assert file.starts().tolist() == np.cumsum([0, *map(len, docs)]).tolist()
    for i in random.Random(1).sample(range(len(flat)), min(25, len(flat))):
        assert file.token(i) == flat[i]
    with pytest.raises(IndexError):
        file.token(len(flat))


def test_files_and_documents(spark):
    rng = random.Random(2)
    words = ["alpha", "Béta,", "gamma.", "DELTA", "don't", "12"]
    docs = [(i * 7 % 101 - 20, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(101)]
    docs[5] = (docs[5][0], None)
    docs.append((1000, "very long " * 5_000))
    folder = scratch_path(spark, "tokens-test")
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int").repartition(5)
    manifest = dac.write_tokens(df, folder, PATH, file_tokens=300)
    rows = sorted(dac.read_documents(manifest, folder).collect(), key=lambda r: r.start)
    docs.sort(key=lambda d: d[0])
    want, start = [], 0
    for (i, _), ids in zip(docs, library([t or "" for _, t in docs])):
        ids = np.array([*ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == want
    assert manifest.count() > 5 and manifest.agg({"tokens": "sum"}).first()[0] == start
    first = manifest.orderBy("file").first()
    file = dac.DacFile.open(f"{folder}/{first.file}")
    assert file.tokens == first.tokens and [file.token(k) for k in range(20)] == file.all()[:20].tolist()


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (3, "c"), (3, "c")], "doc_id long, text string")
    folder = scratch_path(spark, "tokens-odd")
    rows = dac.read_documents(dac.write_tokens(df, folder, PATH), folder).collect()
    assert sorted((r.start, r.doc_id) for r in rows) == [(0, None), (2, None), (4, 3), (6, 3)]
    folder = scratch_path(spark, "tokens-none")
    assert dac.read_documents(dac.write_tokens(df.limit(0), folder, PATH), folder).count() == 0
