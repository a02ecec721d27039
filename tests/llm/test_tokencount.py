import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import queries, tokencount

FILE = public_tokenizers.path("byte_bpe_50k.json")
FRAGMENTS = ["it's", " ", "  ", "\n", "\n\n", "é", "12", "'s", "_", "\x1c", "\xa0", "!!", "word", "中文", "🙂", "<|endoftext|>", " <|endoftext|>\n", "|>", "a"]


def library(texts, file=FILE):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(file)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.lists(st.sampled_from(FRAGMENTS), max_size=40).map("".join)), max_size=8), st.integers(1, 200))
def test_counts_are_the_librarys(texts, call_bytes):
    column = pa.array(texts, pa.string())
    assert tokencount.count_batch(column, FILE, call_bytes).tolist() == library(texts)
    assert tokencount.count_batch(column.slice(1), FILE, call_bytes).tolist() == library(texts[1:])


def test_parts_are_the_text():
    texts = pa.array(["a b\nc", "", "  x  y", "é é. é", " z"], pa.large_string())
    parts, owner = tokencount.safe_parts(texts)
    assert parts.to_pylist() == ["a", " b", "\nc", "  x", "  y", "é é.", " é", " z"]
    assert owner.tolist() == [0, 0, 0, 2, 2, 3, 3, 4]


def test_calls_have_about_equal_bytes():
    sizes = []

    def count(texts):
        sizes.append(sum(map(len, texts)))
        return [len(t) for t in texts]

    words = ["x" * random.Random(k).randint(1, 30) for k in range(2_000)]
    assert tokencount.count_parts(pa.array(words, pa.large_string()), count, 1_000).tolist() == [len(w) for w in words]
    assert max(sizes) < 1_100 and min(sizes[:-1]) > 800


@pytest.mark.parametrize("text", ["word " * 100_000, "a" * 300_000, " " * 300_000, "\n" * 300_000, "中文" * 100_000, "x " + " " * 200_000 + "y"])
def test_long_texts(text):
    assert tokencount.count_batch(pa.array([text, "a"]), FILE).tolist() == library([text, "a"])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_get_whole_texts(name):
    file = public_tokenizers.path(name)
    texts = ["A b  c.", None, "it's\n été", ""]
    assert not tokencount.can_cut(file) and tokencount.can_cut(FILE)
    if name.endswith(".model"):
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=file).encode([t or "" for t in texts])]
    else:
        want = library(texts, file)
    assert tokencount.count_batch(pa.array(texts), file).tolist() == want


def test_query(spark, tmp_path):
    texts = [None, "", "one two", "one two", "été <|endoftext|> x", "long " * 2_000]
    rows = [(i if i else None, t, 7) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op12_counts(spark, str(tmp_path)).collect()}
    assert got == {(k, len((t or "").encode()), n, n > 1024) for (k, t, _), n in zip(rows, library(texts))}
    assert tokencount.count_tokens(spark.createDataFrame([], "doc_id long, text string"), FILE, 5).count() == 0
