"""Conform bronze entities into silver (inventory J1-J4, C7 C8 C11-C13, D2 D4 D5).

Each function returns a :class:`~ledgerloom.operators.clean.Split`: ``valid``
is the silver table, ``rejected`` the quarantine rows with a ``reason``
(``null_key``, ``bad_type``, ``orphan`` or ``bad_<column>`` for a value that
does not cast).
Direct identifiers (name, email, address) are never projected (C11), so
column pruning drops them at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import MONEY, age_band, mask_tail
from .clean import CastRule, LookupRule, ParentRule, Split, dedupe_latest, validate


def _project(split: Split, columns: Sequence[Column | str]) -> Split:
    return split.project(columns)


# the only user columns silver keeps besides the key; ties are broken on them alone
USER_KEPT = ("date_of_birth", "signup_date")


def _latest(bronze: DataFrame, key: str, tie_break: Sequence[str], complete: bool = True) -> DataFrame:
    """The latest row of each key; rows without a key are the split's own matter."""
    return dedupe_latest(bronze, [key], ["_ingested_at"], tie_break, complete, null_keys="drop")


def conform_users(
    bronze: DataFrame,
    as_of: date | Column,
    tie_break: Sequence[str] = USER_KEPT,
) -> Split:
    """Latest row per user, PII dropped, date of birth generalised to a band.

    Name, email and address are neither projected nor used to break ties, so
    the scan never reads them (C11), and rejected rows don't hold them either.
    A date that does not cast gives a NULL band or date, and the user stays.
    """
    safe = bronze.select("user_id", *USER_KEPT, "_ingested_at")
    split = validate(_latest(safe, "user_id", tie_break, complete=False), []).with_keyless(safe.where(F.col("user_id").isNull()))
    born, signup = (F.col(c).try_cast("date") for c in USER_KEPT)
    return _project(split, ["user_id", age_band(born, as_of).alias("age_band"), signup.alias("signup_date")])


def conform_accounts(
    bronze: DataFrame,
    users: DataFrame,
    account_types: DataFrame,
    tie_break: Sequence[str] = ("account_id",),
) -> Split:
    """Latest per account, type resolved to its id, number masked, owner checked."""
    split = validate(
        _latest(bronze, "account_id", tie_break),
        [
            LookupRule("account_type", account_types, "type_name", "account_type_id", "bad_type"),
            CastRule("opened_date", "date"),
            ParentRule("user_id", users, "user_id", "orphan"),
        ],
    )
    return _project(
        split.with_keyless(bronze.where(F.col("account_id").isNull())),
        [
            "account_id",
            "user_id",
            "account_type_id",
            mask_tail("account_number").alias("account_number_masked"),
            "opened_date",
        ],
    )


def conform_transactions(
    bronze: DataFrame,
    accounts: DataFrame,
    transaction_types: DataFrame,
    tie_break: Sequence[str] = ("transaction_id",),
) -> Split:
    """Latest per transaction, type resolved, money typed, account checked."""
    split = validate(
        _latest(bronze, "transaction_id", tie_break),
        [
            LookupRule("transaction_type", transaction_types, "type_name", "transaction_type_id", "bad_type"),
            CastRule("amount", MONEY),
            CastRule("transaction_ts", "timestamp_ntz"),
            ParentRule("account_id", accounts, "account_id", "orphan"),
        ],
    )
    return _project(
        split.with_keyless(bronze.where(F.col("transaction_id").isNull())),
        ["transaction_id", "account_id", "transaction_type_id", "amount", "currency", "transaction_ts"],
    )


def conform_goals(
    bronze: DataFrame,
    users: DataFrame,
    tie_break: Sequence[str] = ("goal_id",),
) -> Split:
    """Latest per goal, name trimmed, money and dates typed, owner checked."""
    split = validate(
        _latest(bronze, "goal_id", tie_break),
        [
            CastRule("target_amount", MONEY),
            CastRule("current_amount", MONEY),
            CastRule("created_date", "date"),
            CastRule("target_date", "date"),
            ParentRule("user_id", users, "user_id", "orphan"),
        ],
    )
    return _project(
        split.with_keyless(bronze.where(F.col("goal_id").isNull())),
        [
            "goal_id",
            "user_id",
            F.trim("goal_name").alias("goal_name"),
            "target_amount",
            "current_amount",
            "created_date",
            "target_date",
        ],
    )
