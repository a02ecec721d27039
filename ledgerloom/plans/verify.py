"""Cross-layer invariants over one built lakehouse, as a catalogue of facts about its tables.

Each entry says what must hold of a table: its key, the tables its columns
point to, which measure it shares with another table, what its history looks
like.  ``CATALOGUE`` is data; :func:`frames` compiles the entries about keys into
one pass over the stored tables and turns each other one into a check, and the
oracles turn the same entries into SQL, so both sides run the same list.

From the survey's hazard list: balances are compared over every account
version (H15) and the latest snapshot row of each account (H16); a hub must
hold every source key and may hold more (H18); a fact's key must match exactly
one dimension row (K3).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as K
from ..operators import vault as V
from ..session import released_shuffles, reliable_checkpoint
from ..sources import fixtures as fx
from .layers import Silver, Star, Vault


@dataclass(frozen=True)
class Fact:
    """``kind`` must hold of ``table``; ``column`` is its key or reference, ``other`` the table compared with."""

    kind: str
    table: str
    column: str = ""
    other: str = ""
    other_column: str = ""
    columns: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        parts = [self.kind, self.table, self.column, self.other, self.other_column]
        return " ".join(p for p in parts if p)


# keys that silver and star tables point to: table -> (column, target)
REFERENCES = {
    "accounts": (("user_id", "users"), ("account_type_id", "account_types")),
    "savings_goals": (("user_id", "users"),),
    "transactions": (("account_id", "accounts"), ("transaction_type_id", "transaction_types")),
}
DIMENSIONS = {"dim_account": "account_key", "dim_customer": "customer_key", "dim_date": "date_key", "dim_transaction_type": "transaction_type_key"}
FACT_KEYS = {
    "fct_transaction": ("account_key", "customer_key", "transaction_type_key"),
    "fct_account_monthly_snapshot": ("account_key", "customer_key"),
}
HISTORIES = {"dim_account": "account_id", "dim_customer": "user_id"}
REBUILT = {
    "users": ("user_id", ("age_band", "signup_date")),
    "accounts": ("account_id", ("account_number_masked", "account_type_id", "opened_date", "user_id")),
    "transactions": ("transaction_id", ("account_id", "amount", "currency", "transaction_ts", "transaction_type_id")),
    "savings_goals": ("goal_id", ("created_date", "current_amount", "goal_name", "target_amount", "target_date", "user_id")),
}


def catalogue() -> list[Fact]:
    hub_of = {h.hash_key: h.name for h in V.HUBS}
    facts = [Fact("filled", t) for t in ("account_summary", "accounts", "customer_360", "transactions")]
    facts += [Fact("points", t, c, target) for t, refs in REFERENCES.items() for c, target in refs]
    facts += [Fact("points", lk.name, hk, hub_of[hk]) for lk in V.LINKS for _, hk in lk.pairs]
    facts += [Fact("points", s.name, s.hash_key, hub_of[s.hash_key]) for s in V.SATS]
    facts += [Fact("key", t, k) for t, k in DIMENSIONS.items()]
    facts += [Fact("key", h.name, h.hash_key) for h in V.HUBS] + [Fact("key", lk.name, lk.link_key) for lk in V.LINKS]
    facts += [Fact("covers", h.name, h.business_key, f"bronze_{h.source}") for h in V.HUBS]
    dim_of = {k: d for d, k in DIMENSIONS.items()}
    facts += [Fact("one_match", t, k, dim_of[k]) for t, keys in FACT_KEYS.items() for k in keys]
    facts += [Fact("covers", "dim_date", "date_key", t) for t in FACT_KEYS]
    facts += [Fact(kind, t, k) for t, k in HISTORIES.items() for kind in ("one_open", "contiguous", "upright")]
    facts += [Fact("no_repeat", s.name, s.hash_key) for s in V.SATS]
    facts += [
        Fact("same_rows", "transactions", other="transactions_by_outcome"),
        Fact("same_sum", "customer_360", "total_balance", "account_summary", "balance", ("user_id",)),
        Fact("same_sum", "account_summary", "balance", "facts_by_account", "signed_amount", ("account_id",)),
        Fact("same_sum", "account_summary", "balance", "last_balances", "closing_balance", ("account_id",)),
    ]
    facts += [Fact("equal", f"rebuilt_{t}", key, t, columns=cols) for t, (key, cols) in REBUILT.items()]
    return facts


CATALOGUE = catalogue()


def account_key_map(dim_account: DataFrame) -> DataFrame:
    """Every version key -> its account."""
    return dim_account.select("account_key", "account_id")


def latest_snapshot_per_account(snapshot: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Newest snapshot row per account (H16), with the account id resolved."""
    # by version before the join, in hash aggregates, which need one number to order by: the snapshot is neither sorted
    # nor moved.  Of rows with one date the greatest balance counts, a null last; balances are under 10 ** 18.  The
    # greatest number is kept alone: less its date it is the balance, and a second value beside it would cost as much again
    none = F.lit("-1" + "0" * 19).cast("decimal(20,0)")
    day = F.col("date_key").cast("decimal(8,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)")
    place = day + F.coalesce(F.col("closing_balance").cast("decimal(20,2)"), none)
    versions = snapshot.groupBy("account_key").agg(F.max("date_key").alias("date_key"), F.max(place).alias("_place"))
    of_accounts = versions.join(account_key_map(dim_account), "account_key", "inner").groupBy("account_id")
    balance = F.col("_place") - day
    return of_accounts.agg(F.max("date_key").alias("date_key"), F.max("_place").alias("_place")).select(
        "account_id", "date_key", F.when(balance != none, balance).cast(snapshot.schema["closing_balance"].dataType).alias("closing_balance")
    )


def sums_per_account(fact: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Signed amounts of each account version (account_id, signed_amount), added up before the join with the accounts."""
    sums = fact.groupBy("account_key").agg(F.sum("signed_amount").alias("signed_amount"))
    return sums.join(account_key_map(dim_account), "account_key")


def tables(s: Silver, st: Star, v: Vault) -> dict[str, DataFrame]:
    """Every table that the catalogue names."""
    found = {n: getattr(s, n) for n in ("users", "accounts", "transactions", "account_types", "transaction_types", "account_summary", "customer_360")}
    found |= {n: getattr(st, n) for n in (*DIMENSIONS, "fct_transaction")}
    found |= {spec.name: v.first_load(spec.name) for spec in (*V.HUBS, *V.LINKS, *V.SATS)}
    found |= {f"bronze_{h.source}": v.bronze(h.source).select(h.business_key) for h in V.HUBS}
    found |= {"savings_goals": s.goals, "fct_account_monthly_snapshot": st.monthly_snapshot}
    found |= {
        "transactions_by_outcome": st.fct_transaction.select("transaction_id").unionByName(st.fct_unresolved.select("transaction_id")),
        "facts_by_account": sums_per_account(st.fct_transaction, st.dim_account),
        "last_balances": latest_snapshot_per_account(st.monthly_snapshot, st.dim_account),
        "rebuilt_users": v.rebuild("users"),
        "rebuilt_accounts": v.rebuild("accounts"),
        "rebuilt_transactions": v.rebuild("transactions"),
        "rebuilt_savings_goals": v.rebuild("savings_goals"),
    }
    return found


def rule(f: Fact) -> K.Rule | None:
    """The entry as a rule on key counts; None if it looks at the order of rows or compares whole ones."""
    match f.kind:
        case "filled":
            return K.filled_rule(f.label, f.table)
        case "key":
            return K.unique_rule(f.label, f.table, f.column)
        case "points":
            return K.points_rule(f.label, f.table, f.column, f.other)
        case "one_match":
            return K.one_match_rule(f.label, f.table, f.column, f.other)
        case "covers":
            return K.covers_rule(f.label, f.table, f.column, f.other)
        case "one_open":
            return K.one_open_rule(f.label, f.table, f.column)
        case "upright":
            return K.no_row_rule(f.label, f.table, "valid_to < valid_from")
        case "same_rows":
            return K.same_rows_rule(f.label, f.table, f.other)
        case "same_sum":
            return K.same_sum_rule(f.label, f.table, f.columns[0], f.column, f.other, f.other_column)
    return None


def check(f: Fact, t: dict[str, DataFrame]) -> DataFrame:
    """An entry that is no :func:`rule`, as a row."""
    match f.kind:
        case "contiguous":
            return K.scd2_contiguous(t[f.table], f.column, f.label)
        case "no_repeat":
            return K.hash_repeat(t[f.table], f.column, f.label)
        case "equal":
            return K.equal(t[f.table], t[f.other], f.column, [(c, c) for c in f.columns], f.label)
    raise ValueError(f.kind)


def frames(t: dict[str, DataFrame]) -> list[DataFrame]:
    """All checks of the catalogue: those on keys in one pass, the others each on their own."""
    rules = [r for r in map(rule, CATALOGUE) if r is not None]
    return [K.compile_rules(rules, t), *[check(f, t) for f in CATALOGUE if rule(f) is None]]


def build_layers(s: Silver, st: Star, v: Vault, threads: int = 8) -> None:
    """Build and store every layer once; layers that don't need each other are built by concurrent jobs.

    The vault's tables are stored only if ``v`` stores them, else as the latest rows that they are made of.
    """
    from concurrent.futures import ThreadPoolExecutor

    waves = [
        [(s, "users")],
        [(s, "accounts"), (s, "goals"), *((v, h.source) for h in V.HUBS)],
        [(s, "transactions"), (st, "dim_customer"), (st, "dim_account"), *((v, x.name) for x in (*V.HUBS, *V.LINKS, *V.SATS))],
        [(s, "account_summary"), (st, "dim_date"), (st, "resolved"), (st, "monthly_snapshot")],
        [(s, "customer_360")],
    ]
    sources = {h.source for h in V.HUBS}

    def build(owner, name: str):
        if owner is v:
            return v.latest(name) if name in sources else v.first_load(name)
        return getattr(owner, name)

    with ThreadPoolExecutor(threads) as pool:
        for wave in waves:
            list(pool.map(lambda x: build(*x), wave))


def e2e_checks(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All invariants over layers that are built once and stored in the checkpoint folder.

    The vault's tables are projections of the stored latest rows; stored
    themselves, their digests would be most of what is stored.  The checks are
    evaluated one after the other, and the shuffle files of each go with it.
    """
    s = Silver(spark, sf_dir)
    st, v = Star(s), Vault(spark, sf_dir, True, s)
    with released_shuffles(spark):
        build_layers(s, st, v)
        return [reliable_checkpoint(f) for f in frames(tables(s, st, v))]


def conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions dated after every version began all resolve: the fact has as many rows as silver.

    Dimension versions are opened at the earliest date of the calendar, so that no
    transaction precedes its account or its owner.
    """
    st = Star(Silver(spark, sf_dir))
    from ..operators.facts import facts_of, resolve_transactions

    early = st.bounds.select("start").scalar()
    dims = [d.withColumn("valid_from", F.least("valid_from", early)) for d in (st.dim_customer, st.dim_account)]
    resolved = resolve_transactions(st.silver.transactions, st.silver.transaction_types, *dims)
    return K.counts(facts_of(resolved), st.silver.transactions, "every transaction is a fact")


def crash_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 failure input: load 2's versions appended without closing the old ones."""
    from ..operators.scd2 import CUSTOMER_SPEC, new_versions, plan_scd2
    from .layers import scd2_customer_states

    first = scd2_customer_states(spark, sf_dir)[0]
    changes = plan_scd2(fx.user_scd2_load(spark, sf_dir, 2), first, CUSTOMER_SPEC, fx.SCD2_RUN_DATE)
    return first.unionByName(new_versions(changes, first, CUSTOMER_SPEC))


def reconstruct_after_change(spark: SparkSession, sf_dir: str, v: Vault | None = None) -> DataFrame:
    """Accounts rebuilt from the satellite *after load 2* (priorities changed); ``v``: a vault of the same folder."""
    v = v or Vault(spark, sf_dir)
    s1 = v.sat_first()
    return v.rebuild("accounts", sat_account_details=s1.unionByName(v.sat_second(s1)))


def pit_facts(s: Silver) -> DataFrame:
    return s.transactions.join(s.accounts.select("account_id", "user_id"), "account_id", "inner")
