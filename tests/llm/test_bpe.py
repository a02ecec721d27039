import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TEXT = st.one_of(st.text(max_size=80), st.lists(st.sampled_from(["it's", " ", "  ", "\n", "\n\n", "été", "12", "'s", "_", "\x1c", "\xa0", "!!", "word", "中文", "🙂"]), max_size=40).map("".join))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 12))
def test_cutting_changes_no_id(text, size):
    whole = bpe.encoding(RANKS, PATTERN).encode_ordinary(text)
    assert "".join(bpe.pieces(text, size)) == text
    assert bpe.encode_text(text, RANKS, PATTERN, size) == whole
    assert bpe.encoding(RANKS, PATTERN).decode_bytes(whole) == text.encode()


def test_round_trip(spark):
    texts = ["", None, "plain", "<|endoftext|> it's été\n\n 中文 🙂", "long word " * 30_000, "a" * 100_000, " " * 5_000, "plain"]
    docs = spark.createDataFrame([(k if k else None, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = bpe.digests(bpe.round_trip(docs, RANKS, PATTERN), "doc_id").collect()
    encode = bpe.encoding(RANKS, PATTERN).encode_ordinary
    for r, t in zip(rows, texts):
        ids = encode(t or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.digests(bpe.round_trip(docs.limit(0), RANKS, PATTERN), "doc_id").count() == 0


@pytest.mark.parametrize("unit", [" ", "\n", "\t", "\u3000", " \n", "!", "a", "7", "中", "é"])
def test_runs_of_any_length(unit):
    """Against the pattern on runs that it can take, by the merges of one piece beyond."""
    own = bpe.encoding(RANKS, PATTERN)
    for text in (unit * 70_000, "x" + unit * 70_000 + "y", unit * 70_000 + " y", "a b " + unit * 66_000 + "\nc " + unit * 66_000):
        assert bpe.encode_text(text, RANKS, PATTERN) == own.encode_ordinary(text)
    whole = unit * (2_000_000 if unit.isspace() else 300_000)
    ids = bpe.encode_text(f"word{whole}", RANKS, PATTERN)
    assert own.decode_bytes(ids) == f"word{whole}".encode()
    if unit.isspace():
        assert ids == own.encode_ordinary("word") + own._core_bpe.encode_single_piece(whole.encode())


def test_five_million_blanks_in_a_query(spark, tmp_path):
    from ledgerloom.llm import queries

    texts = [" " * 5_000_000, "\n" * 5_000_000, "a" + " " * 5_000_000 + "b"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op9_bpe(spark, str(tmp_path)).collect()}
    assert [rows[i].decoded_sha256 for i in range(3)] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_each_value_is_encoded_once(spark):
    docs = spark.range(3).selectExpr("id AS doc_id", "'a b' AS text")
    plan = bpe.digests(bpe.round_trip(docs, RANKS, PATTERN), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.split("ArrowEvalPython")[1].count("both(") == 1


def test_decoding_keeps_split_characters(spark):
    from pyspark.sql import functions as F

    ids = bpe.encode_text("🙂", RANKS, PATTERN)
    df = spark.createDataFrame([(ids[:1],), (ids,), (None,), ([],)], "ids array<int>")
    raw = [bytes(r.raw) for r in df.select(bpe.decode(F.col("ids"), RANKS, PATTERN).alias("raw")).collect()]
    assert raw[1] == "🙂".encode() and raw[1].startswith(raw[0]) and raw[2:] == [b"", b""]
