"""Operator 3: personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs
before a digit, digits, schemes and identifier cues.  From each anchor a small
deterministic parser reads outwards, sets the boundaries and validates.

Base kinds, each leftmost and non-overlapping, as code point offsets with an
exclusive end:

- ``email``: local part, at-sign, labels joined by dots;
- ``ip``: four runs of digits joined by dots, none above 255;
- ``card``: digits with single spaces or hyphens between, 16 to 19 of them, passing Luhn;
- ``phone``: plus sign, digits and ``space ( ) . -``, ending in a digit, 8 to 15 digits.

A candidate that fails validation is dropped and its text is not tried again.
The method adds (and never takes away): ``account`` (a value after an account
cue: an IBAN passing mod 97, or a ddd-dd-dddd number), ``secret`` (a value of 8
or more characters holding a digit, after a credential cue and ``=`` or ``:``)
and ``url`` (a scheme followed by user information and a host).

Null text: as the empty text, no spans.  Texts are read whole; work is linear in their length.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import must_be_free

BASE = ("email", "ip", "card", "phone")
EXTRA = ("account", "secret", "url")
SPANS = "array<struct<kind:string,start:int,end:int>>"

DIGITS = frozenset("0123456789")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
RUN = re.compile(r"[0-9]+")
DIAL = re.compile(r"\+[0-9][ ().0-9-]*")
AUTHORITY = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9.-]*[A-Za-z0-9]")
ASSIGN = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_./+=-]{8,})")
AFTER_ACCOUNT = re.compile(r"[ \t]*(?:no\.?|number|#)?[ \t]*[:=]?[ \t]*")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

ACCOUNT_CUES = ("iban", "ssn", "account", "social security")
SECRET_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://")


@lru_cache(maxsize=1)
def anchors():
    """The automaton over all anchors; built once a worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign in "@" + "0123456789":
        found.add_word(sign, ("@" if sign == "@" else "d", 1))
    for digit in "0123456789":
        found.add_word("+" + digit, ("+", 2))
    for words, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    for scheme in SCHEMES:
        found.add_word(scheme, ("url", len(scheme)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by kind as listed, then start."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in BASE + EXTRA}
    free = dict.fromkeys(spans, 0)  # where the next match of a kind may start
    run_end = 0  # end of the last run of digits seen
    for last, (sign, width) in anchors().iter(text) if text else ():
        at = last + 1 - width
        if sign == "d":
            if at >= free["card"] and (m := CHAIN.match(text, at)):
                free["card"] = m.end()
                digits = re.sub("[ -]", "", m[0]) if m.end() - at <= 64 else ""
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans["card"].append(m.span())
            if at >= run_end:
                run_end = RUN.match(text, at).end()
                if at >= free["ip"] and (m := QUAD.match(text, at)):
                    free["ip"] = m.end()
                    if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                        spans["ip"].append(m.span())
        elif sign == "@":
            start = at
            while start > free["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                free["email"] = m.end()
                spans["email"].append((start, m.end()))
        elif sign == "+":
            if at >= free["phone"]:
                end = DIAL.match(text, at).end()
                while text[end - 1] not in DIGITS:
                    end -= 1
                if end >= at + 4:  # plus, digit, one of the class, digit
                    free["phone"] = end
                    if 8 <= sum(c in DIGITS for c in text[at:end]) <= 15:
                        spans["phone"].append((at, end))
        elif sign == "url":
            if at >= free["url"] and (m := AUTHORITY.match(text, last + 1)):
                free["url"] = m.end()
                spans["url"].append((at, m.end()))
        elif sign == "secret":
            m = ASSIGN.match(text, last + 1)
            if m and m.start(1) >= free["secret"] and not DIGITS.isdisjoint(m[1]):
                free["secret"] = m.end(1)
                spans["secret"].append(m.span(1))
        elif not (at and text[at - 1].isalnum()):
            start = AFTER_ACCOUNT.match(text, last + 1).end()
            m = _account(text, start)
            if m and start >= free["account"]:
                free["account"] = m
                spans["account"].append((start, m))
    return [(kind, s, e) for kind, found in spans.items() for s, e in found]


def _account(text: str, start: int) -> int | None:
    """End of a valid account value that starts here."""
    if m := SSN.match(text, start):
        return m.end()
    if m := IBAN.match(text, start):
        for end in range(m.end(), m.start() + 14, -1):  # the longest part that passes
            value = text[start:end].replace(" ", "")
            if text[end - 1] != " " and len(value) >= 15 and iban_ok(value):
                return end
    return None


def spans(text: Column) -> Column:
    """The spans of a text column: array of (kind, start, end)."""

    @F.arrow_udf(SPANS)
    def found(column: pa.Array) -> pa.Array:
        rows = [[{"kind": k, "start": s, "end": e} for k, s, e in find(v.as_py())] for v in column]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        return pa.array(rows, pa.list_(kind))

    return found(text)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """``docs`` with the spans of ``text`` in column ``out``."""
    must_be_free(docs, out)
    return docs.withColumn(out, spans(F.col(text)))


def of_kinds(found: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))


def spelled(found: Column, kinds: tuple[str, ...] = BASE + EXTRA) -> Column:
    """Spans of some kinds as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(of_kinds(found, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(marked: DataFrame, key: str, out: str = "pii_spans") -> DataFrame:
    """Per row: ``key``, n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    found = F.col(out)
    counts = [F.size(of_kinds(found, (kind,))).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    return marked.select(key, *counts, F.sha2(spelled(found, BASE), 256).alias("base_sha256"), spelled(found).alias("spans"))
