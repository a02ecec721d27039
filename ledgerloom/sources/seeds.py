"""Seed relations for closed enumerations (inventory A8 A9 J17f).

Seeds are literal lists turned into typed DataFrames with an explicit schema,
so ids are ``int`` and the planner knows the relation is tiny.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ACCOUNT_TYPE_SCHEMA = T.StructType(
    [
        T.StructField("account_type_id", T.IntegerType(), False),
        T.StructField("type_name", T.StringType(), False),
        T.StructField("category", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)

TRANSACTION_TYPE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_type_id", T.IntegerType(), False),
        T.StructField("type_name", T.StringType(), False),
        T.StructField("direction", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)

# The ledger domain's own enumerations (id, name, category|direction, description).
LEDGER_ACCOUNT_TYPES = [
    (1, "savings", "cash", "Instant/easy-access cash savings account"),
    (2, "investment", "investment", "Stocks & shares investment account"),
    (3, "pension", "retirement", "Personal pension account"),
]
LEDGER_TRANSACTION_TYPES = [
    (1, "deposit", "inflow", "Manual deposit into the account"),
    (2, "withdrawal", "outflow", "Withdrawal out of the account"),
    (3, "roundup", "inflow", "Spare change swept in from a linked card purchase"),
    (4, "investment_contribution", "inflow", "Contribution into an investment sub-account"),
]

# Enumerations for the test tables (see FIXTURES.md).  "4-NOT SPECIFIED"
# and "AO" are left out on purpose so that the bad-type path is exercised.
FIXTURE_ACCOUNT_TYPES = [
    (1, "1-URGENT", "priority", "Urgent order priority"),
    (2, "2-HIGH", "priority", "High order priority"),
    (3, "3-MEDIUM", "standard", "Medium order priority"),
    (4, "5-LOW", "standard", "Low order priority"),
]
FIXTURE_TRANSACTION_TYPES = [
    (1, "AF", "inflow", "Accepted line, finished"),
    (2, "NO", "inflow", "Normal line, open"),
    (3, "NF", "inflow", "Normal line, finished"),
    (4, "RF", "outflow", "Returned line, finished"),
    (5, "RO", "outflow", "Returned line, open"),
]


def literal_relation(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A literal relation (SQL ``VALUES``) with an explicit schema.

    Unlike ``createDataFrame`` over a Python list, the plan is a local relation
    with exact size statistics, so Catalyst's size-checked auto-broadcast
    plans joins against it as broadcast hash joins without running a job.
    """
    from pyspark.sql import functions as F

    names = [f.name for f in schema.fields]
    rel = spark.sql(seed_values_sql(rows, names))
    return rel.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def account_types(spark: SparkSession, rows=None) -> DataFrame:
    """Account-type lookup (account_type_id, type_name, category, description)."""
    return literal_relation(spark, rows or LEDGER_ACCOUNT_TYPES, ACCOUNT_TYPE_SCHEMA)


def transaction_types(spark: SparkSession, rows=None) -> DataFrame:
    """Transaction-type lookup (transaction_type_id, type_name, direction, description)."""
    return literal_relation(spark, rows or LEDGER_TRANSACTION_TYPES, TRANSACTION_TYPE_SCHEMA)


def seed_values_sql(rows, columns) -> str:
    """The same seed as a SQL ``VALUES`` relation (used by the oracles)."""

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, int):
            return f"CAST({v} AS INTEGER)"
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"
