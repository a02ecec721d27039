"""Seeds, dedupe, validate-and-split and conform."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators import conform
from ledgerloom.operators.clean import CastRule, LookupRule, ParentRule, dedupe_latest, latest_by, validate
from ledgerloom.sources import seeds

ACC_COLS = ["account_id", "user_id", "account_type", "account_number", "opened_date", "_ingested_at"]
TXN_COLS = ["transaction_id", "account_id", "transaction_type", "amount", "currency", "transaction_ts", "_ingested_at"]


def _users(spark, ids):
    return spark.createDataFrame([(u,) for u in ids], ["user_id"])


def test_seed_lookups(spark):
    at = seeds.account_types(spark)
    tt = seeds.transaction_types(spark)
    assert at.count() == 3 and tt.count() == 4
    assert at.select("type_name").distinct().count() == 3
    assert tt.select("type_name").distinct().count() == 4
    inflow = {r["type_name"] for r in tt.where(F.col("direction") == "inflow").collect()}
    assert inflow == {"deposit", "roundup", "investment_contribution"}
    assert dict(at.dtypes)["account_type_id"] == "int"


def test_accounts_resolve_type_and_mask(spark):
    bronze = spark.createDataFrame(
        [("a1", "u1", "savings", "GB12345676070", date(2024, 1, 1), datetime(2026, 1, 1))], ACC_COLS
    )
    split = conform.conform_accounts(bronze, _users(spark, ["u1"]), seeds.account_types(spark))
    rows = split.valid.collect()
    assert len(rows) == 1
    assert rows[0]["account_type_id"] == 1
    assert rows[0]["account_number_masked"] == "****6070"
    assert "account_type" not in split.valid.columns and "account_number" not in split.valid.columns
    assert split.rejected.count() == 0


def test_accounts_keep_latest(spark):
    bronze = spark.createDataFrame(
        [
            ("a1", "u1", "savings", "GB0000000001111", date(2024, 1, 1), datetime(2026, 1, 1)),
            ("a1", "u1", "savings", "GB0000000002222", date(2024, 1, 1), datetime(2026, 6, 1)),
        ],
        ACC_COLS,
    )
    split = conform.conform_accounts(bronze, _users(spark, ["u1"]), seeds.account_types(spark))
    assert [r["account_number_masked"] for r in split.valid.collect()] == ["****2222"]


def test_accounts_bad_type_and_orphan_rejected(spark):
    bronze = spark.createDataFrame(
        [
            ("a1", "u1", "BOGUS", "GB1", date(2024, 1, 1), datetime(2026, 1, 1)),
            ("a2", "u9", "savings", "GB2", date(2024, 1, 1), datetime(2026, 1, 1)),
            ("a3", None, "savings", "GB3", date(2024, 1, 1), datetime(2026, 1, 1)),
            ("a4", "u1", None, "GB4", date(2024, 1, 1), datetime(2026, 1, 1)),
            ("a5", "u9", "BOGUS", "GB5", date(2024, 1, 1), datetime(2026, 1, 1)),
        ],
        ACC_COLS,
    )
    split = conform.conform_accounts(bronze, _users(spark, ["u1"]), seeds.account_types(spark))
    assert split.valid.count() == 0
    reasons = {r["account_id"]: r["reason"] for r in split.rejected.collect()}
    # enum rule comes first: a5 is both, reported as bad_type; NULL label and NULL key fail
    assert reasons == {"a1": "bad_type", "a2": "orphan", "a3": "orphan", "a4": "bad_type", "a5": "bad_type"}
    assert split.rejected.columns == ACC_COLS + ["reason"]


def test_transactions_resolve_type_and_money(spark):
    bronze = spark.createDataFrame(
        [
            ("t1", "a1", "withdrawal", 100.50, "GBP", datetime(2026, 1, 2, 10), datetime(2026, 1, 3)),
            ("t1", "a1", "withdrawal", 250.75, "GBP", datetime(2026, 1, 2, 10), datetime(2026, 1, 1)),
        ],
        TXN_COLS,
    )
    accounts = spark.createDataFrame([("a1",)], ["account_id"])
    split = conform.conform_transactions(bronze, accounts, seeds.transaction_types(spark))
    rows = split.valid.collect()
    assert len(rows) == 1
    assert rows[0]["transaction_type_id"] == 2
    assert rows[0]["amount"] == Decimal("100.50")
    assert dict(split.valid.dtypes)["amount"] == "decimal(10,2)"


def test_transactions_bad_type_rejected(spark):
    bronze = spark.createDataFrame(
        [("t1", "a1", "refund", 1.0, "GBP", datetime(2026, 1, 2), datetime(2026, 1, 3))], TXN_COLS
    )
    split = conform.conform_transactions(bronze, spark.createDataFrame([("a1",)], ["account_id"]), seeds.transaction_types(spark))
    assert split.valid.count() == 0
    assert [r["reason"] for r in split.rejected.collect()] == ["bad_type"]


def test_uncastable_value_is_rejected_not_nulled(spark):
    df = spark.createDataFrame([("k1", "12.50"), ("k2", "abc"), ("k3", None)], ["k", "amount"])
    split = validate(df, [CastRule("amount", "decimal(10,2)")])
    assert {r["k"]: r["amount"] for r in split.valid.collect()} == {"k1": Decimal("12.50"), "k3": None}
    assert [(r["k"], r["amount"], r["reason"]) for r in split.rejected.collect()] == [("k2", "abc", "bad_amount")]


def test_validate_with_lookup_and_parent_rules(spark):
    df = spark.createDataFrame([("x", "p1"), ("y", "p1"), ("x", "p2")], ["label", "parent"])
    lookup = spark.createDataFrame([("x", 7)], ["name", "label_id"])
    parents = spark.createDataFrame([("p1",), ("p1",)], ["pid"])
    split = validate(df, [LookupRule("label", lookup, "name", "label_id"), ParentRule("parent", parents, "pid")])
    assert [(r["label"], r["parent"], r["label_id"]) for r in split.valid.collect()] == [("x", "p1", 7)]
    assert sorted(r["reason"] for r in split.rejected.collect()) == ["orphan_parent", "unknown_label"]


def test_dedupe_tie_break_is_deterministic(spark):
    ts = datetime(2026, 1, 1)
    df = spark.createDataFrame([("k", ts, 1, "a"), ("k", ts, 3, "b"), ("k", ts, 2, "c")], ["key", "_ingested_at", "tb", "v"])
    out = dedupe_latest(df, ["key"], ["_ingested_at"], ["tb"]).collect()
    assert [r["v"] for r in out] == ["b"]


def test_latest_by_matches_window(spark):
    df = spark.createDataFrame(
        [("k1", 1, "a"), ("k1", 3, "b"), ("k2", 2, "c"), ("k2", 2, "d")], ["key", "load", "payload"]
    )
    out = {r["key"]: r["payload"] for r in latest_by(df, ["key"], ["load"]).collect()}
    assert out == {"k1": "b", "k2": "d"}


def test_users_band_and_pii(spark):
    bronze = spark.createDataFrame(
        [("u1", "Ann", "a@x", date(1990, 6, 15), "1 St", date(2020, 1, 1), datetime(2026, 1, 1)),
         ("u2", "Bob", "b@x", None, "2 St", date(2021, 1, 1), datetime(2026, 1, 1))],
        ["user_id", "full_name", "email", "date_of_birth", "address", "signup_date", "_ingested_at"],
    )
    users = conform.conform_users(bronze, date(2026, 1, 1)).valid
    assert users.columns == ["user_id", "age_band", "signup_date"]
    bands = {r["user_id"]: r["age_band"] for r in users.collect()}
    assert bands == {"u1": "30-39", "u2": None}  # NULL date of birth keeps a NULL band (H9)


def test_goals_trim_cast_and_orphans(spark):
    bronze = spark.createDataFrame(
        [("g1", "u1", "  House ", "1000", "250.5", "2024-01-01", "2025-01-01", datetime(2026, 1, 1)),
         ("g2", "u9", "Car", "10", "1", "2024-01-01", "2025-01-01", datetime(2026, 1, 1))],
        ["goal_id", "user_id", "goal_name", "target_amount", "current_amount", "created_date", "target_date", "_ingested_at"],
    )
    split = conform.conform_goals(bronze, _users(spark, ["u1"]))
    g = split.valid.collect()
    assert len(g) == 1 and g[0]["goal_name"] == "House" and g[0]["current_amount"] == Decimal("250.50")
    assert g[0]["created_date"] == date(2024, 1, 1)
    assert [r["reason"] for r in split.rejected.collect()] == ["orphan"]


def test_dedupe_full_tie_survivor_depends_on_content_only(spark):
    ts = datetime(2026, 1, 1)
    rows = [("k", ts, f"v{i}") for i in range(20)]
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows, "key string, _ingested_at timestamp, v string").repartition(n)
        assert [r["v"] for r in dedupe_latest(df, ["key"], ["_ingested_at"]).collect()] == ["v9"]


def test_rows_without_a_key_are_all_kept_or_all_rejected(spark):
    ts = datetime(2026, 1, 1)
    df = spark.createDataFrame([(None, ts, "a"), (None, ts, "a"), ("k", ts, "b"), (None, ts, "c")], "key string, _ingested_at timestamp, v string")
    assert sorted(r["v"] for r in dedupe_latest(df, ["key"]).collect()) == ["a", "a", "b", "c"]
    assert [r["v"] for r in dedupe_latest(df, ["key"], null_keys="drop").collect()] == ["b"]
    bronze = spark.createDataFrame(
        [(None, "u1", "savings", "GB1", date(2024, 1, 1), ts), (None, "u1", "savings", "GB1", date(2024, 1, 1), ts), ("a1", "u1", "savings", "GB2", date(2024, 1, 1), ts)],
        ACC_COLS,
    )
    for split in (s := conform.conform_accounts(bronze, _users(spark, ["u1"]), seeds.account_types(spark)), s.stored()):
        assert [r["account_id"] for r in split.valid.collect()] == ["a1"]
        assert [(r["account_id"], r["reason"]) for r in split.rejected.collect()] == [(None, "null_key")] * 2


def test_users_with_bad_dates_stay_without_a_band(spark):
    bronze = spark.createDataFrame(
        [("u1", "Ann", "a@x", "not a date", "1 St", "2020-01-01", datetime(2026, 1, 1)), (None, "Bob", "b@x", "1990-01-01", "2 St", "x", datetime(2026, 1, 1))],
        ["user_id", "full_name", "email", "date_of_birth", "address", "signup_date", "_ingested_at"],
    )
    split = conform.conform_users(bronze, date(2026, 1, 1))
    assert [tuple(r) for r in split.valid.collect()] == [("u1", None, date(2020, 1, 1))]
    assert [r["reason"] for r in split.rejected.collect()] == ["null_key"] and not {"full_name", "email", "address"} & set(split.rejected.columns)
