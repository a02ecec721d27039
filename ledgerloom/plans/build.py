"""Persisted layer build: bronze -> silver -> gold (marts + star) and bronze -> vault.

Each layer is written as catalog tables and the next layer reads the stored
tables back, the way separate runs hand data over.  Re-running on unchanged
input is idempotent: the vault appends nothing and the SCD2 dimensions keep
their versions (the state is recomputed and shown in one switch, never MERGEd).

Ledger tables are bucketed on ``account_id`` (``buckets``, from the data's size), so the mart
aggregation and the account joins between silver tables read co-located
buckets instead of shuffling.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vault as V
from ..operators.calendar import date_bounds, date_dim, type_dim
from ..operators.conform import USER_KEPT
from ..operators.facts import facts_of, monthly_snapshot, resolve_transactions, unresolved_of
from ..operators.marts import account_summary, customer_360
from ..operators.scd2 import ACCOUNT_SPEC, CUSTOMER_SPEC, account_dim_input
from ..session import reliable_checkpoint
from ..sources import fixtures as fx
from ..sources import io


@dataclass
class BuildReport:
    rows: dict[str, int] = field(default_factory=dict)

    def add(self, result: io.WriteResult) -> None:
        self.rows[result.table] = result.rows


def _t(prefix: str, layer: str, name: str) -> str:
    return f"{prefix}_{layer}.{name}"


def build_bronze(spark: SparkSession, sf_dir: str, prefix: str, report: BuildReport) -> None:
    """A3: full reload of the four bronze tables from the test tables."""
    for name, frame in [
        ("users", fx.users(spark, sf_dir)),
        ("accounts", fx.accounts(spark, sf_dir)),
        ("transactions", fx.transactions(spark, sf_dir)),
        ("savings_goals", fx.savings_goals(spark, sf_dir)),
    ]:
        report.add(io.write_table(frame, _t(prefix, "bronze", name)))


def build_silver(spark: SparkSession, prefix: str, quarantine_dir: str, buckets: int, report: BuildReport) -> None:
    """J1-J4 from stored bronze; quarantine sides written every run (H8)."""
    from ..operators import conform

    b = lambda n: io.read_table(spark, _t(prefix, "bronze", n))
    s = lambda n: io.read_table(spark, _t(prefix, "silver", n))
    report.add(io.write_table(fx.account_types(spark), _t(prefix, "silver", "account_types")))
    report.add(io.write_table(fx.transaction_types(spark), _t(prefix, "silver", "transaction_types")))

    users = conform.conform_users(b("users"), fx.AS_OF)
    report.add(io.write_table(users.valid, _t(prefix, "silver", "users")))
    io.write_quarantine(users.rejected, f"{quarantine_dir}/users")
    accounts = conform.conform_accounts(b("accounts"), s("users"), s("account_types")).stored()
    report.add(io.write_table(accounts.valid, _t(prefix, "silver", "accounts"), bucket_by=(buckets, ["account_id"])))
    io.write_quarantine(accounts.rejected, f"{quarantine_dir}/accounts")
    txns = conform.conform_transactions(
        b("transactions"), s("accounts"), s("transaction_types"), fx.TRANSACTION_TIE_BREAK
    ).stored()
    report.add(io.write_table(txns.valid, _t(prefix, "silver", "transactions"), bucket_by=(buckets, ["account_id"])))
    io.write_quarantine(txns.rejected, f"{quarantine_dir}/transactions")
    goals = conform.conform_goals(b("savings_goals"), s("users")).stored()
    report.add(io.write_table(goals.valid, _t(prefix, "silver", "savings_goals")))
    io.write_quarantine(goals.rejected, f"{quarantine_dir}/savings_goals")


def build_gold(spark: SparkSession, prefix: str, buckets: int, report: BuildReport) -> None:
    """J6-J14 from stored silver; the account mart is read back for the customer mart."""
    s = lambda n: io.read_table(spark, _t(prefix, "silver", n))
    g = lambda n: io.read_table(spark, _t(prefix, "gold", n))
    summary = account_summary(s("accounts"), s("transactions"), s("account_types"), s("transaction_types"))
    report.add(io.write_table(summary, _t(prefix, "gold", "account_summary"), bucket_by=(buckets, ["account_id"])))
    report.add(io.write_table(customer_360(s("users"), g("account_summary"), s("savings_goals")), _t(prefix, "gold", "customer_360")))

    bounds = date_bounds(
        s("transactions").select(F.to_date("transaction_ts")), s("accounts").select("opened_date"),
        s("users").select("signup_date"),
    )
    report.add(io.write_table(date_dim(bounds), _t(prefix, "gold", "dim_date")))
    report.add(io.write_table(type_dim(s("transaction_types")), _t(prefix, "gold", "dim_transaction_type")))

    for name, incoming, spec in [
        ("dim_customer", s("users").select("user_id", "age_band", "signup_date"), CUSTOMER_SPEC),
        ("dim_account", account_dim_input(s("accounts"), s("account_types")), ACCOUNT_SPEC),
    ]:
        report.add(io.load_scd2(spark, incoming, _t(prefix, "gold", name), spec, fx.SCD2_RUN_DATE))

    resolved = reliable_checkpoint(resolve_transactions(s("transactions"), s("transaction_types"), g("dim_customer"), g("dim_account")))
    report.add(io.write_table(facts_of(resolved), _t(prefix, "gold", "fct_transaction")))
    report.add(io.write_table(unresolved_of(resolved), _t(prefix, "gold", "fct_transaction_unresolved")))
    snap = monthly_snapshot(s("transactions"), s("accounts"), s("transaction_types"), g("dim_customer"), g("dim_account"))
    report.add(io.write_table(snap, _t(prefix, "gold", "fct_account_monthly_snapshot")))


def build_vault(spark: SparkSession, prefix: str, load_date: str, report: BuildReport) -> None:
    """Insert-only deltas against the stored vault (hubs, then links, then satellites)."""
    keys = {"users": "user_id", "accounts": "account_id", "transactions": "transaction_id", "savings_goals": "goal_id"}
    latest: dict[str, DataFrame] = {}
    for src, key in keys.items():
        bronze = io.read_table(spark, _t(prefix, "bronze", src))
        if src == "users":  # PII is neither read nor stored
            bronze = bronze.select("user_id", *USER_KEPT, "_ingested_at")
        tb = fx.TRANSACTION_TIE_BREAK if src == "transactions" else ()
        # one pass feeds the source's hub, link and satellite
        latest[src] = reliable_checkpoint(V.latest_rows(bronze, key, tb))
    report.add(io.write_table(fx.account_types(spark), _t(prefix, "vault", "ref_account_type")))
    report.add(io.write_table(fx.transaction_types(spark), _t(prefix, "vault", "ref_transaction_type")))
    steps = [(h, V.load_hub) for h in V.HUBS] + [(lk, V.load_link) for lk in V.LINKS] + [(st, V.load_sat) for st in V.SATS]
    for spec, load in steps:
        table = _t(prefix, "vault", spec.name)
        existing = io.optional_table(spark, table)
        delta = load(spec, latest[spec.source], existing, load_date, None)
        report.add(io.write_insert_only(delta, table, existing is None))


def build_all(
    spark: SparkSession,
    sf_dir: str,
    prefix: str = "ledgerloom",
    quarantine_dir: str | None = None,
    buckets: int | None = None,
    load_date: str = fx.LOAD_DATES[0],
) -> BuildReport:
    """Every layer, persisted; returns rows written per table (Observation counts).

    ``buckets`` of the ledger tables follow the number of bronze transactions unless given.
    """
    from ..session import scratch_path

    report = BuildReport()
    io.ensure_schema(spark, *(f"{prefix}_{layer}" for layer in ("bronze", "silver", "gold", "vault")))
    build_bronze(spark, sf_dir, prefix, report)
    buckets = buckets or io.buckets_for(report.rows[_t(prefix, "bronze", "transactions")])
    build_silver(spark, prefix, quarantine_dir or scratch_path(spark, "quarantine"), buckets, report)
    build_gold(spark, prefix, buckets, report)
    build_vault(spark, prefix, load_date, report)
    return report


__all__ = ["build_all", "BuildReport"]
