"""Map the read-only test tables onto the ledger's bronze shapes (FIXTURES.md).

Each mapping is a projection over one parquet scan, so Catalyst prunes the
scan to the columns used and pushes the filters into it.  The SQL text of the
same mappings lives in :mod:`ledgerloom.plans.oracles`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ts_ntz
from . import seeds

# Fixed values of the fixture mapping.
INGESTED_AT = "2026-01-01 00:00:00"
AS_OF = date(2026, 1, 1)
AS_OF_LATER = date(2036, 1, 1)
SCD2_RUN_DATE = date(2026, 2, 1)
SCD2_THIRD_RUN_DATE = date(2026, 3, 1)
#: Between the transactions, so that facts meet both versions.
ACCOUNT_CHANGE_DATE = date(1996, 6, 15)
CUSTOMER_CHANGE_DATE = date(1997, 1, 10)
LOAD_DATES = ("2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00")
HUB_LOAD1_BEFORE = date(2000, 1, 1)
TRANSACTION_TIE_BREAK = ("_src_partkey", "_src_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(base: date, n: Column) -> Column:
    return F.date_add(F.lit(base), n.cast("int"))


def _str(c: str) -> Column:
    return F.col(c).cast("string")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.users from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("U"), _str("c_custkey")).alias("user_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        _days(date(1945, 1, 1), (F.col("c_custkey") * 7919) % 20000).alias("date_of_birth"),
        F.concat(F.lit("Nation "), _str("c_nationkey")).alias("address"),
        _days(date(1990, 1, 1), F.col("c_custkey") % 1500).alias("signup_date"),
        ts_ntz(INGESTED_AT).alias("_ingested_at"),
    )


def _account_columns(priority: Column) -> list[Column]:
    return [
        F.concat(F.lit("A"), _str("o_orderkey")).alias("account_id"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("U-missing"))
        .otherwise(F.concat(F.lit("U"), _str("o_custkey")))
        .alias("user_id"),
        priority.alias("account_type"),
        F.concat(F.lit("GB"), F.lpad(_str("o_orderkey"), 12, "0")).alias("account_number"),
        F.to_date("o_orderdate").alias("opened_date"),
        ts_ntz(INGESTED_AT).alias("_ingested_at"),
    ]


def accounts(spark: SparkSession, sf_dir: str, priority: Column | None = None) -> DataFrame:
    """bronze.accounts from every row of ``orders``."""
    o = table(spark, sf_dir, "orders")
    return o.select(*_account_columns(priority if priority is not None else F.col("o_orderpriority")))


def changed_priority() -> Column:
    """Satellite load 2: ``o_orderpriority`` changes for ``o_orderkey % 10 = 0``."""
    p = F.col("o_orderpriority")
    return (
        F.when(F.col("o_orderkey") % 10 != 0, p)
        .when(p == F.lit("5-LOW"), F.lit("1-URGENT"))
        .otherwise(F.lit("5-LOW"))
    )


def padded_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.accounts in which every 20th account comes again, later, with a blank after its key."""
    rows = accounts(spark, sf_dir)
    key = F.regexp_extract("account_id", "[0-9]+", 0).cast("bigint")
    padded = accounts(spark, sf_dir, changed_priority()).where(key % 20 == 0)
    again = padded.withColumns({"account_id": F.concat("account_id", F.lit(" ")), "_ingested_at": ts_ntz(LOAD_DATES[1])})
    return rows.unionByName(again)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.transactions from ``lineitem``; not unique on transaction_id."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("T"), _str("l_orderkey"), F.lit("-"), _str("l_linenumber")).alias("transaction_id"),
        F.concat(F.lit("A"), _str("l_orderkey")).alias("account_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("transaction_type"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
        F.lit("GBP").alias("currency"),
        F.col("l_shipdate").alias("transaction_ts"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.col("l_partkey").alias("_src_partkey"),
        F.col("l_suppkey").alias("_src_suppkey"),
    )


def savings_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.savings_goals from every row of ``customer``."""
    c = table(spark, sf_dir, "customer")
    saved = F.abs(F.col("c_acctbal")).cast("decimal(10,2)")
    signup = _days(date(1990, 1, 1), F.col("c_custkey") % 1500)
    return c.select(
        F.concat(F.lit("G"), _str("c_custkey")).alias("goal_id"),
        F.concat(F.lit("U"), _str("c_custkey")).alias("user_id"),
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("goal_name"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(0).cast("decimal(10,2)"))
        .otherwise((saved + F.lit(500)).cast("decimal(10,2)"))
        .alias("target_amount"),
        saved.alias("current_amount"),
        F.date_add(signup, 30).alias("created_date"),
        F.date_add(signup, 30 + 365).alias("target_date"),
        ts_ntz(INGESTED_AT).alias("_ingested_at"),
    )


def account_types(spark: SparkSession) -> DataFrame:
    return seeds.account_types(spark, seeds.FIXTURE_ACCOUNT_TYPES)


def transaction_types(spark: SparkSession) -> DataFrame:
    return seeds.transaction_types(spark, seeds.FIXTURE_TRANSACTION_TYPES)


def users_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.users in which every 50th customer has no key and every 70th no date of birth."""
    u = users(spark, sf_dir).withColumn("_n", F.regexp_extract("user_id", "[0-9]+", 0).cast("bigint"))
    return u.select(
        F.when(F.col("_n") % 50 != 0, F.col("user_id")).alias("user_id"),
        "full_name", "email",
        F.when(F.col("_n") % 70 != 0, F.col("date_of_birth").cast("string")).otherwise(F.lit("unknown")).alias("date_of_birth"),
        "address", "signup_date", "_ingested_at",
    )


def user_scd2_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """SCD2 scenario input (user_id, age_band, signup_date).

    Load 1 omits ``c_custkey % 7 = 0``; load 2 has every user, and users with
    ``c_custkey % 10 = 0`` carry an age band computed a decade later.
    """
    from ..functions.scalars import age_band

    c = table(spark, sf_dir, "customer")
    if load == 1:
        c = c.where(F.col("c_custkey") % 7 != 0)
        as_of = F.lit(AS_OF)
    else:
        as_of = F.when(F.col("c_custkey") % 10 == 0, F.lit(AS_OF_LATER)).otherwise(F.lit(AS_OF))
    dob = _days(date(1945, 1, 1), (F.col("c_custkey") * 7919) % 20000)
    return c.select(
        F.concat(F.lit("U"), _str("c_custkey")).alias("user_id"),
        age_band(dob, as_of).alias("age_band"),
        _days(date(1990, 1, 1), F.col("c_custkey") % 1500).alias("signup_date"),
    )
