"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .layers import SHARED, Silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# --- silver ---------------------------------------------------------------
@query("dedupe_latest")
def q_dedupe_latest(spark, sf_dir):
    """F1 on bronze transactions (ties broken by the source part/supplier keys)."""
    from ..operators.clean import dedupe_latest
    from ..sources import fixtures as fx

    return dedupe_latest(fx.transactions(spark, sf_dir), ["transaction_id"], ["_ingested_at"], fx.TRANSACTION_TIE_BREAK)


@query("conform_users")
def q_conform_users(spark, sf_dir):
    return Silver(spark, sf_dir, False).users


@query("conform_users_gaps")
def q_conform_users_gaps(spark, sf_dir):
    """J1 on users without a key or with a date that does not cast: the latter stay, with a NULL band."""
    from ..operators.conform import conform_users
    from ..sources import fixtures as fx

    return conform_users(fx.users_with_gaps(spark, sf_dir), fx.AS_OF).valid


@query("reject_users")
def q_reject_users(spark, sf_dir):
    """Users without a key are all rejected, none collapsed, and no direct identifier is kept."""
    from ..operators.conform import conform_users
    from ..sources import fixtures as fx

    return conform_users(fx.users_with_gaps(spark, sf_dir), fx.AS_OF).rejected


@query("conform_accounts")
def q_conform_accounts(spark, sf_dir):
    return Silver(spark, sf_dir, False).accounts


@query("reject_accounts")
def q_reject_accounts(spark, sf_dir):
    return Silver(spark, sf_dir, False).accounts_split.rejected


@query("conform_transactions")
def q_conform_transactions(spark, sf_dir):
    return Silver(spark, sf_dir, False).transactions


@query("reject_transactions")
def q_reject_transactions(spark, sf_dir):
    return Silver(spark, sf_dir, False).transactions_split.rejected


@query("conform_goals")
def q_conform_goals(spark, sf_dir):
    return Silver(spark, sf_dir, False).goals


# --- marts ----------------------------------------------------------------
@query("account_summary")
def q_account_summary(spark, sf_dir):
    return Silver(spark, sf_dir, ("accounts",)).plan_account_summary()


@query("customer_360")
def q_customer_360(spark, sf_dir):
    return Silver(spark, sf_dir, SHARED).plan_customer_360()


# --- calendar and star ------------------------------------------------------
def _star(spark, sf_dir, materialize=True):
    from .layers import Star

    return Star(Silver(spark, sf_dir, materialize))


@query("union_date_bounds")
def q_union_date_bounds(spark, sf_dir):
    """S1 + E7: month-snapped bounds over three date columns."""
    return _star(spark, sf_dir).bounds


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return _star(spark, sf_dir).dim_date


@query("dim_account_input")
def q_dim_account_input(spark, sf_dir):
    return _star(spark, sf_dir, False).account_input


@query("row_hash")
def q_row_hash(spark, sf_dir):
    """J9b over silver users' tracked columns."""
    from ..functions.scalars import row_hash

    users = Silver(spark, sf_dir, False).users
    return users.select("user_id", row_hash(["age_band", "signup_date"]).alias("row_hash"))


@query("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    """Dense keys in transaction-id order over all silver transactions."""
    from ..operators.scd2 import assign_keys

    txns = Silver(spark, sf_dir, False).transactions.select("transaction_id", "account_id")
    return assign_keys(txns, ["transaction_id"], "transaction_key")


@query("scd2_first_load")
def q_scd2_first_load(spark, sf_dir):
    from .layers import scd2_customer_states

    return scd2_customer_states(spark, sf_dir)[0]


@query("scd2_second_load")
def q_scd2_second_load(spark, sf_dir):
    from .layers import scd2_customer_states

    return scd2_customer_states(spark, sf_dir)[1]


@query("scd2_noop")
def q_scd2_noop(spark, sf_dir):
    """Re-applying load 2 to the state after load 2 changes nothing."""
    from ..operators.scd2 import CUSTOMER_SPEC, apply_scd2
    from ..sources import fixtures as fx
    from .layers import scd2_customer_states

    second = scd2_customer_states(spark, sf_dir)[1]
    return apply_scd2(fx.user_scd2_load(spark, sf_dir, 2), second, CUSTOMER_SPEC, fx.SCD2_RUN_DATE)


@query("scd2_current")
def q_scd2_current(spark, sf_dir):
    from ..operators.scd2 import current_rows
    from .layers import scd2_customer_states

    return current_rows(scd2_customer_states(spark, sf_dir)[1])


@query("dim_customer")
def q_dim_customer(spark, sf_dir):
    return _star(spark, sf_dir, False).dim_customer


@query("dim_account")
def q_dim_account(spark, sf_dir):
    return _star(spark, sf_dir, False).dim_account


@query("fct_transaction")
def q_fct_transaction(spark, sf_dir):
    from ..operators.facts import facts_of

    return facts_of(_star(spark, sf_dir, SHARED).plan_resolved())


@query("fct_unresolved")
def q_fct_unresolved(spark, sf_dir):
    from ..operators.facts import unresolved_of

    return unresolved_of(_star(spark, sf_dir, SHARED).plan_resolved())


@query("pit_join")
def q_pit_join(spark, sf_dir):
    """D7 against the two-version customer dimension of the SCD2 scenario."""
    from pyspark.sql import functions as F

    from ..operators.facts import pit_join
    from .layers import scd2_customer_states

    dim = scd2_customer_states(spark, sf_dir)[1]
    s = Silver(spark, sf_dir)
    accts = s.accounts.select("account_id", "user_id")
    txns = s.transactions.select("transaction_id", "account_id", F.to_date("transaction_ts").alias("txn_date"))
    facts = txns.join(accts, "account_id", "inner")
    return pit_join(facts, dim, "user_id", "user_id", "txn_date", {"customer_key": "customer_key", "age_band": "age_band"})


@query("month_spine")
def q_month_spine(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..operators.calendar import month_spine, through_month

    s = Silver(spark, sf_dir)
    through = through_month(s.transactions, F.to_date("transaction_ts"))
    spine = month_spine(s.accounts.select("account_id", "opened_date"), "opened_date", through)
    return spine.select("account_id", F.col("_month").alias("month"), F.col("_month_end").alias("month_end"), "date_key")


@query("month_activity")
def q_month_activity(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..operators.facts import month_activity

    s = Silver(spark, sf_dir, False)
    return month_activity(s.transactions, s.transaction_types).select(
        "account_id", F.col("_month").alias("month"), "month_inflow", "month_outflow", "transaction_count"
    )


@query("running_balance")
def q_running_balance(spark, sf_dir):
    """F8: closing balance per account and month (before the dimension joins)."""
    from pyspark.sql import functions as F

    from ..operators.facts import month_activity, monthly_balances
    from ..session import reliable_checkpoint

    s = Silver(spark, sf_dir, ("accounts",))
    activity = reliable_checkpoint(month_activity(s.transactions, s.transaction_types))
    through = activity.agg(F.max("_month").alias("through"))
    out = monthly_balances(s.accounts.select("account_id", "opened_date"), "opened_date", activity, through)
    return out.select("account_id", "date_key", "closing_balance", "month_net", "transaction_count")


@query("monthly_snapshot")
def q_monthly_snapshot(spark, sf_dir):
    return _star(spark, sf_dir, SHARED).plan_monthly_snapshot()


# --- data vault ---------------------------------------------------------------
def _vault(spark, sf_dir):
    from .layers import Vault

    return Vault(spark, sf_dir)


@query("hub_load")
def q_hub_load(spark, sf_dir):
    """hub_account after both loads (accounts opened before 2000, then all)."""
    first, delta = _vault(spark, sf_dir).hub_link_loads("hub_account")
    return first.unionByName(delta)


@query("hub_delta")
def q_hub_delta(spark, sf_dir):
    """Keys load 2 appends to hub_account."""
    return _vault(spark, sf_dir).hub_link_loads("hub_account")[1]


@query("link_load")
def q_link_load(spark, sf_dir):
    first, delta = _vault(spark, sf_dir).hub_link_loads("link_account_user")
    return first.unionByName(delta)


@query("link_delta")
def q_link_delta(spark, sf_dir):
    return _vault(spark, sf_dir).hub_link_loads("link_account_user")[1]


@query("sat_load")
def q_sat_load(spark, sf_dir):
    return _vault(spark, sf_dir).sat_loads()[0]


@query("sat_delta")
def q_sat_delta(spark, sf_dir):
    """Load 2 changes the priority of every tenth order."""
    return _vault(spark, sf_dir).sat_second()


@query("sat_delta_revert")
def q_sat_delta_revert(spark, sf_dir):
    """Load 3 changes it back (A -> B -> A re-emits A)."""
    return _vault(spark, sf_dir).sat_loads()[2]


@query("sat_current")
def q_sat_current(spark, sf_dir):
    """F7 over the three-load history."""
    from ..operators.vault import current

    s1, d2, d3 = _vault(spark, sf_dir).sat_loads()
    return current(s1.unionByName(d2).unionByName(d3), "account_hk")


@query("sat_transaction_load")
def q_sat_transaction_load(spark, sf_dir):
    """J16/J17e: transaction satellite first load (decimal and timestamp attributes hashed)."""
    return _vault(spark, sf_dir).first_load("sat_transaction_details")


@query("vault_reconstruct")
def q_vault_reconstruct(spark, sf_dir):
    """Silver accounts rebuilt from hub, current satellite, newest link and reference."""
    return _vault(spark, sf_dir).rebuild("accounts")


@query("vault_reconstruct_users")
def q_vault_reconstruct_users(spark, sf_dir):
    return _vault(spark, sf_dir).rebuild("users")


@query("vault_reconstruct_goals")
def q_vault_reconstruct_goals(spark, sf_dir):
    return _vault(spark, sf_dir).rebuild("savings_goals")


@query("vault_reconstruct_transactions")
def q_vault_reconstruct_transactions(spark, sf_dir):
    return _vault(spark, sf_dir).rebuild("transactions")


# --- checks: each kind on a passing and a failing input --------------------------
def _checks(*frames):
    from ..operators.checks import run_all

    return run_all(list(frames))


@query("check_unique")
def q_check_unique(spark, sf_dir):
    from ..operators import checks as K
    from ..sources import fixtures as fx

    st = _star(spark, sf_dir)
    return _checks(
        K.unique(st.dim_customer, ["customer_key"], "dim_customer.customer_key unique"),
        K.unique(fx.transactions(spark, sf_dir), ["transaction_id"], "bronze.transactions.transaction_id unique"),
    )


@query("check_fk")
def q_check_fk(spark, sf_dir):
    from ..operators import checks as K
    from ..sources import fixtures as fx

    s = Silver(spark, sf_dir)
    return _checks(
        K.fk(s.transactions, s.accounts, "account_id", name="silver.transactions -> accounts"),
        K.fk(fx.accounts(spark, sf_dir), s.users, "user_id", name="bronze.accounts -> silver.users"),
    )


@query("check_fk_fanout")
def q_check_fk_fanout(spark, sf_dir):
    from ..operators import checks as K
    from .layers import scd2_customer_states
    from .verify import pit_facts

    st = _star(spark, sf_dir)
    return _checks(
        K.fk_fanout(st.fct_transaction, st.dim_account, "account_key", name="fct_transaction.account_key"),
        K.fk_fanout(
            pit_facts(st.silver), scd2_customer_states(spark, sf_dir)[1], "user_id",
            name="transactions.user_id -> versioned customers",
        ),
    )


@query("check_counts")
def q_check_counts(spark, sf_dir):
    from ..operators import checks as K

    st = _star(spark, sf_dir)
    txns = st.silver.transactions
    return _checks(
        K.counts(
            st.fct_transaction.select("transaction_id").unionByName(st.fct_unresolved.select("transaction_id")),
            txns, "fct + unresolved == silver.transactions",
        ),
        K.counts(st.fct_transaction, txns, "fct_transaction == silver.transactions"),
    )


@query("check_nonempty")
def q_check_nonempty(spark, sf_dir):
    """The failing input is a vault re-run: loading the same data again appends nothing."""
    from ..operators import checks as K
    from ..operators import vault as V
    from ..sources import fixtures as fx
    from .layers import Vault

    s = Silver(spark, sf_dir)
    v = Vault(spark, sf_dir)
    spec = V.SAT["sat_account_details"]
    rerun = V.load_sat(spec, fx.accounts(spark, sf_dir), v.first_load(spec.name), fx.LOAD_DATES[1])
    return _checks(K.nonempty(s.accounts, "silver.accounts has rows"), K.nonempty(rerun, "sat re-run appends rows"))


@query("check_measure")
def q_check_measure(spark, sf_dir):
    from ..operators import checks as K
    from .verify import latest_snapshot_per_account, sums_per_account

    # the fact, the snapshot and the customers' balances are read once, so they aren't stored
    st = _star(spark, sf_dir, (*SHARED, "transactions", "account_summary", "dim_customer", "dim_account"))
    s = st.silver
    return _checks(
        K.measure(s.customer_360, "user_id", "total_balance", s.account_summary, "balance", "360 vs account_summary"),
        K.measure(
            s.account_summary, "account_id", "balance",
            sums_per_account(st.fct_transaction, st.dim_account), "signed_amount",
            "fct signed_amount vs account_summary",
        ),
        K.measure(
            s.account_summary, "account_id", "balance",
            latest_snapshot_per_account(st.monthly_snapshot, st.dim_account), "closing_balance",
            "latest snapshot vs account_summary",
        ),
    )


@query("check_scd2_current")
def q_check_scd2_current(spark, sf_dir):
    from ..operators import checks as K
    from .layers import scd2_customer_states
    from .verify import crash_state

    return _checks(
        K.scd2_current(scd2_customer_states(spark, sf_dir)[1], "user_id", "second load"),
        K.scd2_current(crash_state(spark, sf_dir), "user_id", "inserted without expiring"),
    )


@query("check_scd2_contiguous")
def q_check_scd2_contiguous(spark, sf_dir):
    from ..operators import checks as K
    from .layers import scd2_customer_states
    from .verify import crash_state

    return _checks(
        K.scd2_contiguous(scd2_customer_states(spark, sf_dir)[1], "user_id", "second load"),
        K.scd2_contiguous(crash_state(spark, sf_dir), "user_id", "inserted without expiring"),
    )


@query("check_scd2_inverted")
def q_check_scd2_inverted(spark, sf_dir):
    """The failing state replaces versions whose effective date is after the run date."""
    from datetime import date

    from ..operators import checks as K
    from ..operators.scd2 import CUSTOMER_SPEC, apply_scd2
    from ..sources import fixtures as fx
    from .layers import scd2_customer_states

    first, second = scd2_customer_states(spark, sf_dir)
    early = apply_scd2(fx.user_scd2_load(spark, sf_dir, 2), first, CUSTOMER_SPEC, date(1990, 6, 1))
    return _checks(K.scd2_inverted(second, "second load"), K.scd2_inverted(early, "effective after the run date"))


@query("check_conservation")
def q_check_conservation(spark, sf_dir):
    """FIXTURES §2: where every version begins before every transaction, the fact holds them all."""
    from .verify import conservation

    return conservation(spark, sf_dir)


@query("check_date_coverage")
def q_check_date_coverage(spark, sf_dir):
    """The failing calendar spans account opening dates only."""
    from ..operators import checks as K
    from ..operators.calendar import date_bounds, date_dim

    st = _star(spark, sf_dir)
    short = date_dim(date_bounds(st.silver.accounts.select("opened_date")))
    return _checks(
        K.date_coverage(st.fct_transaction, st.dim_date, name="dim_date covers fct_transaction"),
        K.date_coverage(st.fct_transaction, short, name="opening-date calendar covers fct_transaction"),
    )


@query("check_hub_complete")
def q_check_hub_complete(spark, sf_dir):
    from ..operators import checks as K
    from ..sources import fixtures as fx
    from .layers import Vault

    v = Vault(spark, sf_dir)
    src = fx.accounts(spark, sf_dir)
    return _checks(
        K.hub_complete(v.first_load("hub_account"), src, "account_id", "hub_account after a full load"),
        K.hub_complete(v.hub_link_loads("hub_account")[0], src, "account_id", "hub_account after load 1 only"),
    )


@query("check_hash_repeat")
def q_check_hash_repeat(spark, sf_dir):
    """The failing history appends load 2 without the change filter."""
    from ..operators import checks as K
    from ..operators import vault as V
    from ..session import reliable_checkpoint
    from ..sources import fixtures as fx
    from .layers import Vault

    v = Vault(spark, sf_dir)
    s1, d2, d3 = v.sat_loads()
    spec = V.SAT["sat_account_details"]
    blind = s1.unionByName(V.sat_rows(spec, v.latest(spec.source), fx.LOAD_DATES[1], None))
    return _checks(  # a check reads its history twice
        K.hash_repeat(s1.unionByName(d2).unionByName(reliable_checkpoint(d3)), "account_hk", "three-load history"),
        K.hash_repeat(blind, "account_hk", "unfiltered re-load"),
    )


@query("check_equal")
def q_check_equal(spark, sf_dir):
    from ..operators import checks as K
    from .layers import Vault
    from .verify import reconstruct_after_change

    s = Silver(spark, sf_dir, SHARED)
    v = Vault(spark, sf_dir, silver=s)
    cols = [(c, c) for c in ("user_id", "account_type_id", "account_number_masked", "opened_date")]
    return _checks(
        K.equal(v.rebuild("accounts"), s.accounts, "account_id", cols, "vault == silver accounts"),
        K.equal(reconstruct_after_change(spark, sf_dir, v), s.accounts, "account_id", cols, "vault after load 2 == silver"),
    )


@query("checks_e2e")
def q_checks_e2e(spark, sf_dir):
    """Every invariant of the catalogue (``plans/verify.py``) as a row."""
    from .verify import e2e_checks

    return _checks(*e2e_checks(spark, sf_dir))


# --- sources, sinks, streaming, previews ----------------------------------------
BRONZE_TRANSACTION_SCHEMA = (
    "transaction_id string, account_id string, transaction_type string, amount decimal(10,2), "
    "currency string, transaction_ts timestamp_ntz, _ingested_at timestamp_ntz, "
    "_src_partkey bigint, _src_suppkey bigint"
)
SPLIT_DATE = "1998-01-01"


def _schema(spark, ddl):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


@query("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    """A1 + B1: bronze users written as CSV and scanned back with an explicit schema."""
    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io

    path = scratch_path(spark, "csv-users")
    io.write_path(fx.users(spark, sf_dir), path, "overwrite", "csv")
    ddl = (
        "user_id string, full_name string, email string, date_of_birth date, address string, "
        "signup_date date, _ingested_at timestamp_ntz"
    )
    return io.read_csv(spark, path, _schema(spark, ddl))


@query("incremental_append")
def q_incremental_append(spark, sf_dir):
    """A3 + A4 + B2: full load of early transactions, append of the rest (as CSV
    landings), then F1 over the bronze table: equals dedupe over everything."""
    from pyspark.sql import functions as F

    from ..operators.clean import dedupe_latest
    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io

    bronze = fx.transactions(spark, sf_dir)
    land1, land2, table = (scratch_path(spark, n) for n in ("land-full", "land-incr", "bronze-txn"))
    early = F.col("transaction_ts") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    io.write_path(bronze.where(early), land1, "overwrite", "csv")
    io.write_path(bronze.where(~early), land2, "overwrite", "csv")
    schema = _schema(spark, BRONZE_TRANSACTION_SCHEMA)
    io.write_path(io.read_csv(spark, land1, schema), table, "overwrite")
    io.write_path(io.read_csv(spark, land2, schema), table, "append")
    return dedupe_latest(io.read_path(spark, table), ["transaction_id"], ["_ingested_at"], fx.TRANSACTION_TIE_BREAK)


@query("quarantine_round_trip")
def q_quarantine_round_trip(spark, sf_dir):
    """Rejected transactions written to the quarantine sink and read back."""
    from ..session import scratch_path
    from ..sources import io

    path = scratch_path(spark, "quarantine-txn")
    io.write_quarantine(Silver(spark, sf_dir).transactions_split.rejected, path)
    return io.read_csv(spark, path, _schema(spark, BRONZE_TRANSACTION_SCHEMA + ", reason string"))


@query("stream_incremental_append")
def q_stream_incremental_append(spark, sf_dir):
    """A4 as a checkpointed stream: two landed batches, one availableNow run, F1 downstream."""
    from pyspark.sql import functions as F

    from ..operators.clean import dedupe_latest
    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io
    from ..streaming.incremental import ingest_stream, run_until_caught_up

    bronze = fx.transactions(spark, sf_dir)
    landing, target = scratch_path(spark, "stream-land"), scratch_path(spark, "stream-bronze")
    early = F.col("transaction_ts") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    io.write_path(bronze.where(early), f"{landing}/part=1")
    io.write_path(bronze.where(~early), f"{landing}/part=2")
    schema = _schema(spark, BRONZE_TRANSACTION_SCHEMA + ", part int")
    run_until_caught_up(ingest_stream(spark, landing, schema, target))
    landed = io.read_path(spark, target).drop("part", "batch_id")
    return dedupe_latest(landed, ["transaction_id"], ["_ingested_at"], fx.TRANSACTION_TIE_BREAK)


@query("preview_top_n")
def q_preview_top_n(spark, sf_dir):
    """G1: the 20 largest balances (a top-k report; the limit is the feature)."""
    from pyspark.sql import functions as F

    summary = Silver(spark, sf_dir).account_summary
    return summary.orderBy(F.col("balance").desc(), F.col("account_id").asc()).limit(20)


@query("pit_join_asof")
def q_pit_join_asof(spark, sf_dir):
    """D7, skew-proof form: the same point-in-time lookup as ``pit_join`` by sorted position."""
    from pyspark.sql import functions as F

    from ..operators.asof import asof_join
    from .layers import scd2_customer_states

    dim = scd2_customer_states(spark, sf_dir)[1]
    s = Silver(spark, sf_dir)
    accts = s.accounts.select("account_id", "user_id")
    txns = s.transactions.select("transaction_id", "account_id", F.to_date("transaction_ts").alias("txn_date"))
    facts = txns.join(accts, "account_id", "inner")
    return asof_join(
        facts, dim, "user_id", "user_id", "txn_date", ["transaction_id"],
        {"customer_key": "customer_key", "age_band": "age_band"},
    )


def _stream_vault(spark, sf_dir, spec):
    """J17 on a stream: early accounts land and are loaded; then all accounts land, with changed
    priorities and a later ingest time, and a second run loads them against what is stored."""
    from pyspark.sql import functions as F

    from ..functions.scalars import ts_ntz
    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io
    from ..streaming.incremental import run_until_caught_up, stream_vault_deltas

    landing, target = scratch_path(spark, "vault-land"), {spec.name: scratch_path(spark, spec.name)}
    early = fx.accounts(spark, sf_dir).where(F.col("opened_date") < F.lit(fx.HUB_LOAD1_BEFORE))
    later = fx.accounts(spark, sf_dir, fx.changed_priority()).withColumn("_ingested_at", ts_ntz(fx.LOAD_DATES[1]))
    for part, rows in enumerate((early, later)):
        io.write_path(rows, f"{landing}/part={part}")
        run_until_caught_up(stream_vault_deltas(spark, landing, rows.schema.add("part", "integer"), target, [spec], "account_id"))
    return io.read_path(spark, target[spec.name])


@query("stream_hub")
def q_stream_hub(spark, sf_dir):
    from ..operators import vault as V

    return _stream_vault(spark, sf_dir, V.HUB["hub_account"])


@query("stream_link")
def q_stream_link(spark, sf_dir):
    from ..operators import vault as V

    return _stream_vault(spark, sf_dir, V.LINK["link_account_user"])


@query("stream_sat")
def q_stream_sat(spark, sf_dir):
    from ..operators import vault as V

    return _stream_vault(spark, sf_dir, V.SAT["sat_account_details"])


def _state_stream(spark, spec, batches):
    """Batches that land one after the other, loaded with keyed state; the second is tried twice, as its first try fails after its write."""
    from ..session import scratch_path
    from ..sources import io
    from ..streaming.incremental import batch_writer, run_until_caught_up
    from ..streaming.stateful import stream_vault_state

    landing, target, checkpoint = (scratch_path(spark, n) for n in ("state-land", spec.name, "state-checkpoint"))
    write, failed = batch_writer(target), []

    def fails_once(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the first try of batch 1 fails after its write")

    for part, rows in enumerate(batches):
        io.write_path(rows, f"{landing}/part={part}")
        for _ in range(2):
            query = stream_vault_state(spark, landing, rows.schema.add("part", "integer"), target, spec, checkpoint, writer=fails_once)
            try:
                run_until_caught_up(query)
                break
            except Exception as e:
                if "fails after its write" not in str(e):
                    raise
    return io.read_path(spark, target).drop("batch_id")


@query("stream_sat_state")
def q_stream_sat_state(spark, sf_dir):
    """J17b with keyed state: January, March (tried twice), then February, late; see ``vault_late_batch``."""
    from pyspark.sql import functions as F

    from ..functions.scalars import ts_ntz
    from ..operators import vault as V
    from ..sources import fixtures as fx

    first, second, third = (ts_ntz(d) for d in fx.LOAD_DATES)
    rows, changed = fx.accounts(spark, sf_dir), fx.accounts(spark, sf_dir, fx.changed_priority())
    fourth = F.regexp_extract("account_id", "[0-9]+", 0).cast("bigint") % 4 == 0
    late = changed.withColumn("account_type", F.when(fourth, F.lit("3-MEDIUM")).otherwise(F.col("account_type")))
    batches = [r.withColumn("_ingested_at", at) for r, at in ((rows, first), (changed, third), (late, second))]
    return _state_stream(spark, V.SAT["sat_account_details"], batches)


@query("stream_hub_state")
def q_stream_hub_state(spark, sf_dir):
    """J17a with keyed state: early accounts, then all of them (tried twice), then all again."""
    from pyspark.sql import functions as F

    from ..functions.scalars import ts_ntz
    from ..operators import vault as V
    from ..sources import fixtures as fx

    rows = fx.accounts(spark, sf_dir)
    early = rows.where(F.col("opened_date") < F.lit(fx.HUB_LOAD1_BEFORE))
    batches = [r.withColumn("_ingested_at", ts_ntz(at)) for r, at in zip((early, rows, rows), fx.LOAD_DATES)]
    return _state_stream(spark, V.HUB["hub_account"], batches)


# --- catalog tables ----------------------------------------------------------------
@contextmanager
def _scratch_schema(spark):
    """A catalog schema of the query's own; it and its tables are gone when the query returns a stored copy."""
    import uuid

    from ..sources import io

    name = f"ledgerloom_{uuid.uuid4().hex[:10]}"
    io.ensure_schema(spark, name)
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def _stored_table(spark, table):
    from ..session import reliable_checkpoint
    from ..sources import io

    return reliable_checkpoint(io.read_table(spark, table))


@query("catalog_ingest")
def q_catalog_ingest(spark, sf_dir):
    """A3 + A4 + A5: a CSV replaces a bronze table, another is appended, and the table is read by name."""
    from pyspark.sql import functions as F

    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io

    users = fx.users(spark, sf_dir).drop("_ingested_at")
    first = F.col("signup_date") < "1992-01-01"
    lands = [scratch_path(spark, "land") for _ in range(2)]
    for land, rows in zip(lands, (users.where(first), users.where(~first))):
        io.write_path(rows, land, "overwrite", "csv")
    schema = users.schema
    with _scratch_schema(spark) as layer:
        table = f"{layer}.users"
        io.ingest_full(spark, lands[1], table, fx.LOAD_DATES[2], schema)  # replaced by the next line
        io.ingest_full(spark, lands[0], table, fx.INGESTED_AT, schema)
        io.ingest_append(spark, lands[1], table, fx.INGESTED_AT, schema)
        return _stored_table(spark, table)


@query("csv_inferred")
def q_csv_inferred(spark, sf_dir):
    """A1 with an inferred schema: dates, integers and booleans come back typed."""
    from pyspark.sql import functions as F

    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io

    path = scratch_path(spark, "csv-inferred")
    n = F.regexp_extract("user_id", "[0-9]+", 0).cast("int")
    io.write_path(fx.users(spark, sf_dir).select("user_id", "signup_date", n.alias("n"), (n % 2 == 0).alias("even")), path, "overwrite", "csv")
    return io.read_csv(spark, path)


@query("scd2_table_load")
def q_scd2_table_load(spark, sf_dir):
    """Two loads of a dimension table; the second is read through the switched view."""
    from ..operators.scd2 import CUSTOMER_SPEC
    from ..sources import fixtures as fx
    from ..sources import io

    with _scratch_schema(spark) as layer:
        for load in (1, 2):
            io.load_scd2(spark, fx.user_scd2_load(spark, sf_dir, load), f"{layer}.dim_customer", CUSTOMER_SPEC, fx.SCD2_RUN_DATE)
        return _stored_table(spark, f"{layer}.dim_customer")


@query("scd2_open_partition_load")
def q_scd2_open_partition_load(spark, sf_dir):
    """B7 + J11: three loads of a dimension of which only open versions are read and written again."""
    from ..operators.scd2 import CUSTOMER_SPEC
    from ..sources import fixtures as fx
    from ..sources.history import load_open

    with _scratch_schema(spark) as layer:
        for load, run_date in ((1, fx.SCD2_RUN_DATE), (2, fx.SCD2_RUN_DATE), (1, fx.SCD2_THIRD_RUN_DATE)):
            load_open(spark, fx.user_scd2_load(spark, sf_dir, load), f"{layer}.dim_customer", CUSTOMER_SPEC, run_date)
        return _stored_table(spark, f"{layer}.dim_customer")


@query("vault_rerun")
def q_vault_rerun(spark, sf_dir):
    """A satellite table after a load and a repeated load, which appends nothing."""
    from ..operators import vault as V
    from ..sources import fixtures as fx
    from ..sources import io

    spec = V.SAT["sat_account_details"]
    with _scratch_schema(spark) as layer:
        table = f"{layer}.{spec.name}"
        for load_date in fx.LOAD_DATES[:2]:
            stored = io.optional_table(spark, table)
            delta = V.load_sat(spec, fx.accounts(spark, sf_dir), stored, load_date)
            io.write_insert_only(delta, table, stored is None)
        return _stored_table(spark, table)


def _pruned_loads(spark, spec, batches):
    """Batches ``(rows, load date)`` appended to a store partitioned by hash-key prefix and bucketed by hash key."""
    from ..operators import vault as V
    from ..session import reliable_checkpoint
    from ..sources import io

    key = spec.link_key if isinstance(spec, V.LinkSpec) else spec.hash_key
    with _scratch_schema(spark) as layer:
        table = f"{layer}.{spec.name}"
        # a bucket is one task's in every load, so their number follows from the largest batch
        buckets = io.buckets_for(max(rows.count() for rows, _ in batches), row_bytes=320, target_bytes=128 << 20, least=4)
        for rows, load_date in batches:
            stored = io.optional_table(spark, table)
            delta = V.load_pruned(spec, reliable_checkpoint(rows), stored, load_date, digits=1)
            mode = "overwrite" if stored is None else "append"
            io.write_table(delta, table, mode, partition_by=[V.PREFIX], bucket_by=(buckets, [key]))
        return _stored_table(spark, table).drop(V.PREFIX)


@query("load_hub_pruned")
def q_load_hub_pruned(spark, sf_dir):
    """J17a + B6: two loads of hub_account; the second probes the partitions of its keys' prefixes."""
    from pyspark.sql import functions as F

    from ..operators import vault as V
    from ..sources import fixtures as fx

    rows = fx.accounts(spark, sf_dir)
    early = rows.where(F.col("opened_date") < F.lit(fx.HUB_LOAD1_BEFORE))
    return _pruned_loads(spark, V.HUB["hub_account"], [(early, fx.LOAD_DATES[0]), (rows, fx.LOAD_DATES[1])])


@query("load_sat_pruned")
def q_load_sat_pruned(spark, sf_dir):
    """J17b + B6: three loads of the account satellite, priorities changed and changed back."""
    from ..operators import vault as V
    from ..sources import fixtures as fx

    rows, changed = fx.accounts(spark, sf_dir), fx.accounts(spark, sf_dir, fx.changed_priority())
    return _pruned_loads(spark, V.SAT["sat_account_details"], list(zip((rows, changed, rows), fx.LOAD_DATES)))


# --- padded keys and late rows in the vault ---------------------------------------------
@query("vault_padded_keys")
def q_vault_padded_keys(spark, sf_dir):
    """A hub and a satellite of accounts, some of which come again under a padded key: one row per hash key."""
    from pyspark.sql import functions as F

    from ..operators import vault as V
    from ..sources import fixtures as fx

    latest = V.latest_rows(fx.padded_accounts(spark, sf_dir), "account_id")
    hub = V.load_hub(V.HUB["hub_account"], latest, None, fx.LOAD_DATES[0], None)
    sat = V.load_sat(V.SAT["sat_account_details"], latest, None, fx.LOAD_DATES[0], None)
    return hub.join(sat.select("account_hk", "hash_diff", "account_type"), "account_hk", "full_outer").select(
        "account_hk", F.col("account_id"), "hash_diff", "account_type"
    )


@query("vault_late_batch")
def q_vault_late_batch(spark, sf_dir):
    """Loads of January and March, then the late one of February, which says what March says or January said."""
    from pyspark.sql import functions as F

    from ..operators import vault as V
    from ..session import reliable_checkpoint
    from ..sources import fixtures as fx

    spec, (first, second, third) = V.SAT["sat_account_details"], fx.LOAD_DATES
    rows, changed = fx.accounts(spark, sf_dir), fx.accounts(spark, sf_dir, fx.changed_priority())
    january = reliable_checkpoint(V.load_sat(spec, rows, None, first))
    march = V.load_sat(spec, changed, january, third)
    stored = reliable_checkpoint(january.unionByName(march))
    # February knows what March says, but has another type for every fourth account
    fourth = F.regexp_extract("account_id", "[0-9]+", 0).cast("bigint") % 4 == 0
    other = F.when(fourth, F.lit("3-MEDIUM")).otherwise(F.col("account_type"))
    february = V.load_sat(spec, changed.withColumn("account_type", other), stored, second)
    return stored.unionByName(february)


# --- tables kept by increments -----------------------------------------------------------
LATE_BATCH = "transaction_ts >= '1998-06-01' OR (transaction_ts >= '1997-03-01' AND crc32(cast(transaction_id AS binary)) % 50 = 0)"


@query("dim_bridge")
def q_dim_bridge(spark, sf_dir):
    """Account versions (two loads) with their owners' versions (two loads), by one sweep."""
    from ..operators.facts import dimension_bridge
    from .layers import versioned_dimensions

    return dimension_bridge(*versioned_dimensions(spark, sf_dir))


@query("fct_transaction_versions")
def q_fct_transaction_versions(spark, sf_dir):
    """J12 through the bridge, with dimensions that changed between the transactions."""
    from ..operators.facts import facts_of, resolve_transactions
    from .layers import versioned_dimensions

    accounts, customers = versioned_dimensions(spark, sf_dir)
    s = Silver(spark, sf_dir, ("users",))
    return facts_of(resolve_transactions(s.transactions, s.transaction_types, customers, accounts))


@query("snapshot_increment")
def q_snapshot_increment(spark, sf_dir):
    """J14 + F8: the snapshot after a first load and a late batch, of which only the months it changes were built."""
    from pyspark.sql import functions as F

    from ..operators.increments import SnapshotStore
    from ..session import scratch_path

    st = _star(spark, sf_dir, (*SHARED, "transactions", "dim_customer", "dim_account"))
    s, late = st.silver, F.expr(LATE_BATCH)
    store = SnapshotStore(spark, scratch_path(spark, "snapshot"))
    for batch, rows in ((1, s.transactions.where(~late)), (2, s.transactions.where(late))):
        store.load(batch, rows, s.accounts, s.transaction_types, st.dim_customer, st.dim_account)
    return store.read("snapshot").drop("month")


@query("account_summary_increment")
def q_account_summary_increment(spark, sf_dir):
    """J6 + E1/E2: the mart after a first state and a batch of new and corrected transactions."""
    from pyspark.sql import functions as F

    from ..operators.increments import ledger_changes, ledger_state, merge_ledger
    from ..operators.marts import summary_of
    from ..session import reliable_checkpoint

    s = Silver(spark, sf_dir, (*SHARED, "transactions"))
    entries = s.transactions.join(s.transaction_types.select("transaction_type_id", "direction"), "transaction_type_id").select(
        "transaction_id", "account_id", "amount", "direction", "transaction_ts"
    )
    # what was known before: early transactions, every tenth with another amount and a time 40 days off
    wrong = F.crc32(F.col("transaction_id").cast("binary")) % 10 == 0
    shift = F.when(F.crc32(F.col("account_id").cast("binary")) % 2 == 0, F.expr("interval 40 days")).otherwise(F.expr("interval -40 days"))
    known = entries.where("transaction_ts < '1998-01-01'").select(
        "transaction_id", "account_id",
        F.when(wrong, (F.col("amount") + 1).cast("decimal(10,2)")).otherwise(F.col("amount")).alias("amount"), "direction",
        F.when(wrong, F.col("transaction_ts") + shift).otherwise(F.col("transaction_ts")).alias("transaction_ts"),
    )
    batch = entries.where((F.col("transaction_ts") >= "1998-01-01") | wrong)
    state = reliable_checkpoint(ledger_state(known))
    merged = merge_ledger(state, ledger_changes(known, batch, "transaction_id"), entries)
    return summary_of(s.accounts, s.account_types, merged)


@query("csv_rescued")
def q_csv_rescued(spark, sf_dir):
    """A1 + B5: a CSV with lines that don't fit the schema: good rows typed, broken lines whole with a reason."""
    from pyspark.sql import functions as F

    from ..session import scratch_path
    from ..sources import fixtures as fx
    from ..sources import io

    path = scratch_path(spark, "csv-broken")
    n = F.regexp_extract("user_id", "[0-9]+", 0).cast("int")
    date_ = F.when(n % 30 == 0, F.lit("soon")).otherwise(F.col("signup_date").cast("string"))
    extra = F.when(n % 45 == 0, F.lit(",more")).otherwise(F.lit(""))
    line = F.when(n % 77 == 0, F.col("user_id")).otherwise(F.concat(F.concat_ws(",", F.col("user_id"), date_, n.cast("string")), extra))
    fx.users(spark, sf_dir).select(line.alias("value")).write.text(path)
    read = io.read_csv_rescued(spark, path, _schema(spark, "user_id string, signup_date date, n int"), header=False)
    none = F.lit(None).cast("string")
    good = read.rows.withColumns({"line": none, "reason": none})
    return good.unionByName(read.broken, allowMissingColumns=True)


@query("check_equal_digest")
def q_check_equal_digest(spark, sf_dir):
    """K12 by digests, on the vault's accounts before and after priorities changed."""
    from ..operators import checks as K
    from .layers import Vault
    from .verify import reconstruct_after_change

    s = Silver(spark, sf_dir, SHARED)
    v = Vault(spark, sf_dir, silver=s)
    cols = ("user_id", "account_type_id", "account_number_masked", "opened_date")
    return _checks(
        K.equal_digest(v.rebuild("accounts"), s.accounts, "account_id", cols, "vault == silver accounts"),
        K.equal_digest(reconstruct_after_change(spark, sf_dir, v), s.accounts, "account_id", cols, "vault after load 2 == silver"),
    )


@query("vault_reference")
def q_vault_reference(spark, sf_dir):
    """J17f: the reference tables, stored and read by name, with the satellite rows that use each label."""
    from pyspark.sql import functions as F

    from ..sources import fixtures as fx
    from ..sources import io
    from .layers import Vault

    v = Vault(spark, sf_dir, False)
    uses = [("ref_account_type", fx.account_types(spark), "account_type_id", "sat_account_details", "account_type"),
            ("ref_transaction_type", fx.transaction_types(spark), "transaction_type_id", "sat_transaction_details", "transaction_type")]
    found = []
    with _scratch_schema(spark) as layer:
        for name, rows, id_, sat, attribute in uses:
            io.write_table(rows, f"{layer}.{name}")
            used = v.first_load(sat).groupBy(F.col(attribute).alias("type_name")).agg(F.count(F.lit(1)).alias("n_rows"))
            read = _stored_table(spark, f"{layer}.{name}").join(used, "type_name", "left")
            found.append(read.select(F.lit(name).alias("reference"), F.col(id_).alias("id"), "type_name", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")))
    return found[0].unionByName(found[1])


@query("check_gate")
def q_check_gate(spark, sf_dir):
    """The gate over checks of the silver layer, one of which fails; its report as rows."""
    from ..operators import checks as K
    from ..sources import fixtures as fx

    s = Silver(spark, sf_dir, SHARED)
    suite = [
        K.unique(s.accounts, ["account_id"], "accounts.account_id unique"),
        K.fk(s.accounts, s.users, "user_id", name="silver.accounts -> users"),
        K.fk(fx.accounts(spark, sf_dir), s.users, "user_id", name="bronze.accounts -> users"),
    ]
    try:
        report, passed = K.gate(suite), True
    except K.GateFailed as e:
        report, passed = e.report, False
    return spark.createDataFrame([(*row, passed) for row in report], "`check` string, ok boolean, failing bigint, gate boolean")


@query("ordered_transactions")
def q_ordered_transactions(spark, sf_dir):
    """All transactions in a total order, each with its place in it."""
    from ..operators.scd2 import assign_keys

    order = ["transaction_ts", "transaction_id"]
    rows = Silver(spark, sf_dir, False).transactions.select("transaction_id", "account_id", "transaction_ts")
    return assign_keys(rows, order, "place").orderBy(*order)


def _register_vault_loads():
    from ..operators import vault as V

    done = {"hub_account", "link_account_user", "sat_account_details", "sat_transaction_details"}  # queries above
    for spec in (*V.HUBS, *V.LINKS, *V.SATS):
        if spec.name not in done:
            QUERIES[f"load_{spec.name}"] = lambda spark, sf_dir, name=spec.name: _vault(spark, sf_dir).first_load(name)


_register_vault_loads()
