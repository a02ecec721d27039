"""Column -> Column helpers (inventory C12 C13 C14 I11 I13 I21 J9b J15 J16).

All built from native ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the hashing convention and the SCD2 open end.
NULL_TOKEN = "∅"
HASH_SEPARATOR = "||"
OPEN_END = date(9999, 12, 31)
MONEY = "decimal(10,2)"
GOLD_MONEY = "decimal(12,2)"
# Sums and balances: one busy account passes ten digits long before 18.
BALANCE = "decimal(20,2)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_zero(type_: str = GOLD_MONEY) -> Column:
    """I21 typed zero: ``0.00`` as decimal(12,2) by default."""
    return F.lit(0).cast(type_)


def open_end() -> Column:
    """I21 open end of an SCD2 interval, ``9999-12-31``."""
    return F.lit(OPEN_END)


def ts_ntz(text: str) -> Column:
    """A zone-free timestamp literal (parquet fixtures read as timestamp_ntz)."""
    return F.lit(text).cast("timestamp_ntz")


def mask_tail(c: str | Column, keep: int = 4, mask: str = "****") -> Column:
    """Keep the last ``keep`` characters behind a fixed mask."""
    return F.concat(F.lit(mask), F.substring(col_(c), -keep, keep))


def age_band(dob: str | Column, as_of: str | Column | date, width: int = 10) -> Column:
    """``floor(floor(days/365.25)/width)*width`` rendered as ``"30-39"``.

    ``as_of`` is an argument (never ``current_date``) so results are stable.
    NULL date of birth gives a NULL band.
    """
    as_of_c = F.lit(as_of) if isinstance(as_of, date) else col_(as_of)
    years = F.floor(F.datediff(as_of_c, col_(dob)) / F.lit(365.25))
    start = (F.floor(years / F.lit(width)) * F.lit(width)).cast("int")
    return F.concat(start.cast("string"), F.lit("-"), (start + F.lit(width - 1)).cast("string"))


def iso_dow(d: str | Column) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday."""
    return F.weekday(col_(d)) + F.lit(1)


def date_key(d: str | Column) -> Column:
    """Smart integer key ``yyyymmdd`` computed arithmetically (no string formatting)."""
    c = col_(d)
    return (F.year(c) * F.lit(10000) + F.month(c) * F.lit(100) + F.dayofmonth(c)).cast("int")


def signed(amount: str | Column, direction: str | Column, inflow: str = "inflow") -> Column:
    """C14: ``+amount`` for inflows, ``-amount`` for every other direction."""
    a = col_(amount)
    return F.when(col_(direction) == F.lit(inflow), a).otherwise(-a)


def _hash(parts: Iterable[Column]) -> Column:
    tokens = [F.coalesce(p.cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *tokens), 256)


def row_hash(cols: Iterable[str]) -> Column:
    """sha256 hex over the columns in sorted-name order, NULL as the token."""
    return _hash(F.col(c) for c in sorted(cols))


def hash_key(cols: Iterable[str]) -> Column:
    """sha256 hex over trimmed key columns in the given order."""
    return _hash(F.trim(F.col(c).cast("string")) for c in cols)


def hash_diff(cols: Iterable[str]) -> Column:
    """sha256 hex over attribute columns in sorted-name order, untrimmed."""
    return row_hash(cols)


def packed(c: str | Column) -> Column:
    """A sha256 hex digest as its 32 bytes, half of what a shuffle moves otherwise.

    Any other text becomes its bytes with 33 zeros behind them, so that
    different values stay different; digests keep their order.
    """
    c = col_(c)
    text = F.concat(c.cast("binary"), F.lit(bytearray(33)))
    # the bytes are made once: what is no hex digits has none
    return F.when((F.octet_length(c) == 64) & (F.lower(c) == c), F.coalesce(F.unhex(c), text)).otherwise(text)


def key_bytes(c: str | Column) -> Column:
    """Bytes that stand for a key: a digest is :func:`packed`, other texts keep theirs, unless they could be taken for packed ones.

    Texts of less than 32 bytes are shorter than any packed value, and longer ones get :func:`packed`'s zeros (65 bytes at least).
    """
    c = col_(c)
    return F.when(F.octet_length(c) < 32, c.cast("binary")).otherwise(packed(c))


def unpacked(c: str | Column) -> Column:
    """The text that :func:`packed` was made of."""
    c = col_(c)
    text = F.substring(c, F.lit(1), F.length(c) - 33).cast("string")
    return F.when(F.length(c) == 32, F.lower(F.hex(c))).otherwise(text)


def unambiguous_hash(cols: Iterable[str]) -> Column:
    """H11 variant: length-prefixed parts, so separators inside values and the
    NULL token cannot collide.  Not used by default (compatibility)."""
    parts = []
    for c in cols:
        s = F.col(c).cast("string")
        parts.append(F.when(s.isNull(), F.lit("N")).otherwise(F.concat(F.length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat_ws("|", *parts), 256)


def percent(num: str | Column, den: str | Column, scale: int = 1) -> Column:
    """``round(num / den * 100, scale)`` in decimal arithmetic, HALF_UP.

    Money inputs are decimal(20,2); the quotient then carries 14 decimals, so
    the final rounding is exact for any realistic amount.
    """
    n = col_(num).cast("decimal(20,2)")
    d = col_(den).cast("decimal(20,2)")
    return F.round(n * F.lit(100) / d, scale).cast(f"decimal(18,{scale})")
