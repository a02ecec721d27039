"""Layer builds over the test tables: bronze -> silver -> marts / star / vault.

These are lazy DataFrame graphs; nothing runs until a caller acts.  The
query registry and the bench compose them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import conform, marts
from ..operators.conform import USER_KEPT
from ..operators.clean import Split
from ..functions.scalars import hash_key
from ..session import released_shuffles, reliable_checkpoint
from ..sources import fixtures as fx


def _keep(df: DataFrame, materialize: bool) -> DataFrame:
    """Cut lineage by writing ``df`` once to the shared checkpoint folder.

    Used when many consumers read the same layer (the end-to-end checks), the
    way the stages hand over stored tables; reliable ``checkpoint`` survives
    executor loss, unlike a local cache.
    """
    return reliable_checkpoint(df) if materialize else df


#: Silver tables that more than one part of the star's builds reads: users by accounts and the customer
#: dimension; accounts by transactions, the account dimension and the snapshot.
SHARED = ("users", "accounts")


@dataclass
class Silver:
    """The six silver relations plus the quarantine sides, built from one sf folder.

    ``materialize``: what is written once to the checkpoint folder and read
    back by its consumers: everything (True), nothing (False), or the named
    tables.  A table that only one consumer reads is cheaper left lazy.
    """

    spark: SparkSession
    sf_dir: str
    materialize: bool | tuple[str, ...] = True

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        return _keep(df, self.materialize is True or (self.materialize and name in self.materialize))

    @cached_property
    def account_types(self) -> DataFrame:
        return fx.account_types(self.spark)

    @cached_property
    def transaction_types(self) -> DataFrame:
        return fx.transaction_types(self.spark)

    @cached_property
    def users_split(self) -> Split:
        return conform.conform_users(fx.users(self.spark, self.sf_dir), fx.AS_OF)

    @cached_property
    def users(self) -> DataFrame:
        return self._kept("users", self.users_split.valid)

    @cached_property
    def accounts_split(self) -> Split:
        return conform.conform_accounts(fx.accounts(self.spark, self.sf_dir), self.users, self.account_types)

    @cached_property
    def accounts(self) -> DataFrame:
        return self._kept("accounts", self.accounts_split.valid)

    @cached_property
    def transactions_split(self) -> Split:
        return conform.conform_transactions(
            fx.transactions(self.spark, self.sf_dir),
            self.accounts,
            self.transaction_types,
            fx.TRANSACTION_TIE_BREAK,
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self._kept("transactions", self.transactions_split.valid)

    @cached_property
    def goals_split(self) -> Split:
        return conform.conform_goals(fx.savings_goals(self.spark, self.sf_dir), self.users)

    @cached_property
    def goals(self) -> DataFrame:
        return self._kept("goals", self.goals_split.valid)

    def plan_account_summary(self) -> DataFrame:
        """The mart over stored silver tables, not stored itself."""
        return marts.account_summary(self.accounts, self.transactions, self.account_types, self.transaction_types)

    def plan_customer_360(self) -> DataFrame:
        return marts.customer_360(self.users, self.plan_account_summary(), self.goals)

    @cached_property
    def account_summary(self) -> DataFrame:
        return self._kept("account_summary", self.plan_account_summary())

    @cached_property
    def customer_360(self) -> DataFrame:
        return self._kept("customer_360", marts.customer_360(self.users, self.account_summary, self.goals))


@dataclass
class Star:
    """Kimball star over a :class:`Silver`: calendar, SCD2 dimensions (first load), facts."""

    silver: Silver

    @cached_property
    def bounds(self) -> DataFrame:
        from pyspark.sql import functions as F

        from ..operators.calendar import date_bounds

        s = self.silver
        return date_bounds(
            s.transactions.select(F.to_date("transaction_ts")),
            s.accounts.select("opened_date"),
            s.users.select("signup_date"),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        from ..operators.calendar import date_dim

        return self.silver._kept("dim_date", date_dim(self.bounds))

    @cached_property
    def dim_transaction_type(self) -> DataFrame:
        from ..operators.calendar import type_dim

        return type_dim(self.silver.transaction_types)

    @cached_property
    def account_input(self) -> DataFrame:
        from ..operators.scd2 import account_dim_input

        return account_dim_input(self.silver.accounts, self.silver.account_types)

    @cached_property
    def dim_customer(self) -> DataFrame:
        from ..operators.scd2 import CUSTOMER_SPEC, apply_scd2

        incoming = self.silver.users.select("user_id", "age_band", "signup_date")
        return self.silver._kept("dim_customer", apply_scd2(incoming, None, CUSTOMER_SPEC, fx.SCD2_RUN_DATE))

    @cached_property
    def dim_account(self) -> DataFrame:
        from ..operators.scd2 import ACCOUNT_SPEC, apply_scd2

        return self.silver._kept("dim_account", apply_scd2(self.account_input, None, ACCOUNT_SPEC, fx.SCD2_RUN_DATE))

    def plan_resolved(self) -> DataFrame:
        from ..operators.facts import resolve_transactions

        s = self.silver
        return resolve_transactions(s.transactions, s.transaction_types, self.dim_customer, self.dim_account)

    @cached_property
    def resolved(self) -> DataFrame:
        """Transactions with their dimension keys, evaluated once for the fact and its side output."""
        return self.silver._kept("resolved", self.plan_resolved())

    @cached_property
    def fct_transaction(self) -> DataFrame:
        from ..operators.facts import facts_of

        return facts_of(self.resolved)

    @cached_property
    def fct_unresolved(self) -> DataFrame:
        from ..operators.facts import unresolved_of

        return unresolved_of(self.resolved)

    @cached_property
    def activity(self) -> DataFrame:
        """Stored month activity: it is read for the balances and for the last month."""
        from ..operators.facts import month_activity

        return reliable_checkpoint(month_activity(self.silver.transactions, self.silver.transaction_types))

    def plan_monthly_snapshot(self) -> DataFrame:
        from ..operators.facts import monthly_snapshot

        s = self.silver
        return monthly_snapshot(s.transactions, s.accounts, s.transaction_types, self.dim_customer, self.dim_account, activity=self.activity)

    @cached_property
    def monthly_snapshot(self) -> DataFrame:
        return self.silver._kept("monthly_snapshot", self.plan_monthly_snapshot())


def scd2_customer_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two-load SCD2 scenario on customers: (state after load 1, state after load 2)."""
    from ..operators.scd2 import CUSTOMER_SPEC, apply_scd2

    first = reliable_checkpoint(apply_scd2(fx.user_scd2_load(spark, sf_dir, 1), None, CUSTOMER_SPEC, fx.SCD2_RUN_DATE))
    second = apply_scd2(fx.user_scd2_load(spark, sf_dir, 2), first, CUSTOMER_SPEC, fx.SCD2_RUN_DATE)
    return first, second


def versioned_dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(accounts, customers) with two versions of some keys each: every tenth changes between the transactions."""
    from pyspark.sql import functions as F

    from ..operators.scd2 import ACCOUNT_SPEC, CUSTOMER_SPEC, apply_scd2

    star = Star(Silver(spark, sf_dir, SHARED))
    accounts, users = star.account_input, star.silver.users.select("user_id", "age_band", "signup_date")

    def changed(rows: DataFrame, key: str, column: str) -> DataFrame:
        tenth = F.regexp_extract(key, "[0-9]+", 0).cast("bigint") % 10 == 0
        return rows.withColumn(column, F.when(tenth, F.lit("changed")).otherwise(F.col(column)))

    first_accounts = reliable_checkpoint(apply_scd2(accounts, None, ACCOUNT_SPEC, fx.SCD2_RUN_DATE))
    first_customers = reliable_checkpoint(apply_scd2(users, None, CUSTOMER_SPEC, fx.SCD2_RUN_DATE))
    return (
        apply_scd2(changed(accounts, "account_id", "account_type"), first_accounts, ACCOUNT_SPEC, fx.ACCOUNT_CHANGE_DATE),
        apply_scd2(changed(users, "user_id", "age_band"), first_customers, CUSTOMER_SPEC, fx.CUSTOMER_CHANGE_DATE),
    )


@dataclass
class Vault:
    """Data Vault raw layer over the bronze fixtures of one sf folder.

    The latest rows of a source, which feed its hub, link and satellite, are
    stored; the tables themselves only with ``store_tables``, for callers that
    read each of them more than once.
    """

    spark: SparkSession
    sf_dir: str
    materialize: bool = True
    silver: Silver | None = None
    store_tables: bool = False

    def __post_init__(self) -> None:
        self._loaded: dict[str, DataFrame] = {}
        self._silver = self.silver or Silver(self.spark, self.sf_dir, False)

    def bronze(self, source: str) -> DataFrame:
        return {
            "users": fx.users,
            "accounts": fx.accounts,
            "transactions": fx.transactions,
            "savings_goals": fx.savings_goals,
        }[source](self.spark, self.sf_dir)

    @staticmethod
    def tie_break(source: str) -> tuple[str, ...]:
        return fx.TRANSACTION_TIE_BREAK if source == "transactions" else ()

    def latest(self, source: str) -> DataFrame:
        """Latest bronze row per key of ``source``, computed once for its hub, link and satellite."""
        from ..operators.vault import latest_rows

        key = self.business_key(source)
        name = f"latest:{source}"
        if name not in self._loaded:
            bronze = self.bronze(source)
            if source == "users":  # PII is neither read nor stored
                bronze = bronze.select("user_id", *USER_KEPT, "_ingested_at")
            with released_shuffles(self.spark):
                self._loaded[name] = _keep(latest_rows(bronze, key, self.tie_break(source)), self.materialize)
        return self._loaded[name]

    @staticmethod
    def business_key(source: str) -> str:
        from ..operators.vault import HUBS

        return next(h.business_key for h in HUBS if h.source == source)

    def first_load(self, name: str) -> DataFrame:
        """The table after one load of everything (hub, link or satellite by name)."""
        if name not in self._loaded:
            self._loaded[name] = _keep(self._first_load(name, self.latest), self.store_tables)
        return self._loaded[name]

    def _first_load(self, name: str, rows_of: Callable[[str], DataFrame]) -> DataFrame:
        from ..operators import vault as v

        load = fx.LOAD_DATES[0]
        if name in v.HUB:
            spec = v.HUB[name]
            return v.load_hub(spec, rows_of(spec.source), None, load, None)
        if name in v.LINK:
            spec = v.LINK[name]
            return v.load_link(spec, rows_of(spec.source), None, load, None)
        spec = v.SAT[name]
        return v.load_sat(spec, rows_of(spec.source), None, load, None)

    def dealt(self, source: str) -> DataFrame:
        """The latest rows of ``source``, moved once to the partition of their hash key.

        Its hub, link and satellite, as projections of them, are partitioned by that key, which isn't moved.
        """
        return self.latest(source).repartition(hash_key([self.business_key(source)]))

    def hub_link_loads(self, name: str) -> tuple[DataFrame, DataFrame]:
        """Hub/link scenario on accounts: load 1 = opened before 2000, load 2 = all.
        Returns (table after load 1, rows appended by load 2)."""
        from pyspark.sql import functions as F

        from ..operators import vault as v

        all_rows = fx.accounts(self.spark, self.sf_dir)
        early = all_rows.where(F.col("opened_date") < F.lit(fx.HUB_LOAD1_BEFORE))
        if name in v.HUB:
            spec, load = v.HUB[name], v.load_hub
        else:
            spec, load = v.LINK[name], v.load_link
        first = reliable_checkpoint(load(spec, early, None, fx.LOAD_DATES[0]))
        return first, load(spec, all_rows, first, fx.LOAD_DATES[1])

    def sat_loads(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Satellite scenario on accounts: priority A -> B (key % 10 = 0) -> A.
        Returns (table after load 1, load-2 delta, load-3 delta); the second is stored,
        as the third is compared with it."""
        from ..operators import vault as v

        spec = v.SAT["sat_account_details"]
        s1 = self.sat_first()
        d2 = reliable_checkpoint(self.sat_second(s1))
        d3 = v.load_sat(spec, self.latest(spec.source), s1.unionByName(d2), fx.LOAD_DATES[2], None)
        return s1, d2, d3

    def sat_first(self) -> DataFrame:
        """The table after load 1: a projection of the stored latest rows, or stored itself where those aren't."""
        from ..operators import vault as v

        return _keep(v.load_sat(v.SAT["sat_account_details"], self.latest("accounts"), None, fx.LOAD_DATES[0], None), not self.materialize)

    def sat_second(self, first: DataFrame | None = None) -> DataFrame:
        """The load-2 delta alone, not stored."""
        from ..operators import vault as v

        changed = fx.accounts(self.spark, self.sf_dir, fx.changed_priority())
        return v.load_sat(v.SAT["sat_account_details"], changed, first or self.sat_first(), fx.LOAD_DATES[1])

    def tables(self, name: str) -> DataFrame:
        """A vault or reference table by name."""
        if name in ("account_types", "transaction_types"):
            return getattr(self._silver, name)
        return self.first_load(name)

    def rebuild(self, entity: str, **replaced: DataFrame) -> DataFrame:
        """A silver entity from the vault; ``replaced`` gives other states of tables by name."""
        from ..operators import vault as v

        def parents(name: str) -> DataFrame:
            return getattr(self._silver, name)

        if replaced or self.store_tables:
            return v.rebuild(entity, lambda n: replaced[n] if n in replaced else self.tables(n), parents, fx.AS_OF)
        source = v.SAT[v.REBUILDS[entity].sat].source
        own = {x.name for x in (*v.HUBS, *v.LINKS, *v.SATS) if x.source == source}
        return v.rebuild(entity, lambda n: self._first_load(n, self.dealt) if n in own else self.tables(n), parents, fx.AS_OF, pack=False)
