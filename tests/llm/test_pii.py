import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import pii

from .plain import base_spans

ALPHABET = "0123456789.-+@() aZ_%:é\n"
PARTS = ["4111111111111111", "4111 1111-1111 1111", "a@b.c", "+1 (555) 010-9999", "10.0.0.256", "1.2.3.4.5.6.7.8", "@", "+", ".", " ", "-", "7", "x"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(ALPHABET, max_size=60), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s for s in pii.find(text) if s[0] in pii.BASE] == base_spans(text)


def test_added_kinds_are_validated():
    text = 'token = "9f8e7d6c5b4a" password: hunter iban: GB82 WEST 1234 5698 7654 32, IBAN GB83 WEST 1234 5698 7654 32 ssn 123-45-6789 https://me:pw@host.example/x'
    found = [(k, text[s:e]) for k, s, e in pii.find(text) if k not in pii.BASE]
    assert found == [
        ("account", "GB82 WEST 1234 5698 7654 32"),
        ("account", "123-45-6789"),
        ("secret", "9f8e7d6c5b4a"),
        ("url", "https://me:pw@host.example"),
    ]
    assert not [s for s in pii.find("my account is fine; the token was lost, http://example.com/a") if s]


def test_long_texts_stay_linear():
    text = "a@" * 200_000 + "1" * 200_000 + "+1" * 100_000 + "1." * 100_001 + " a@b.co"
    spans = pii.find(text)
    assert ("email", len(text) - 6, len(text)) in spans and sum(k == "ip" for k, _, _ in spans) == 25_000


def test_summary(spark):
    texts = [(1, "mail a@b.co or +1 (555) 010-9999"), (2, None), (3, ""), (1, "mail a@b.co or +1 (555) 010-9999"), (None, "10.0.0.1")]
    docs = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, pii_spans string")
    rows = pii.summary(pii.find_pii(docs, out="_s"), "doc_id", "_s").collect()
    assert len(rows) == 5
    for r, (i, t) in zip(rows, texts):
        want = base_spans(t)
        assert r.doc_id == i and r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in want) for kind in pii.BASE)
    assert pii.summary(pii.find_pii(docs.limit(0), out="_s"), "doc_id", "_s").count() == 0
