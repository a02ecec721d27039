"""Derived tables kept up to date by batches instead of full builds (inventory J6 J14 E1 E2 F8).

* :class:`SnapshotStore` keeps the monthly snapshot.  A batch of transactions
  changes balances from its earliest month on, so only those months are built
  and replaced, from the closing balances of the month before.
* :func:`merge_ledger` keeps the sums, counts and first and last times of the
  account mart.  Sums and counts take additions and retractions; a first or
  last time is computed anew only for accounts that may have lost it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import BALANCE, money_zero
from ..session import reliable_checkpoint
from .facts import balance_segments, clip_to_versions, explode_segments, month_activity


# --- the monthly snapshot -------------------------------------------------------
#: Partitions that a writing task keeps open side by side; a task that meets more sorts its rows by partition.
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
MONTHS_AT_ONCE = 512


@dataclass
class SnapshotStore:
    """The monthly snapshot (J14) below one folder, with the state that extends it.

    ``activity``: month activity by (batch, month); ``balances``: closing
    balances by batch, of an account's first month and of those in which it
    changes; ``snapshot``: the fact rows, partitioned by month, of which a load
    replaces whole months (dynamic partition overwrite).  A load that died is
    repeated under its batch number: it replaces its own activity and balances,
    and all else follows from what is stored.

    The rows of all accounts and months are neither moved nor sorted to be
    written: each task writes its accounts into every month.
    """

    spark: SparkSession
    path: str

    def _table(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def _write(self, df: DataFrame, name: str, *partitions: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partitions)
        before = self.spark.conf.get(OPEN_WRITERS)
        self.spark.conf.set(OPEN_WRITERS, str(MONTHS_AT_ONCE))
        try:
            writer.parquet(self._table(name))
        finally:
            self.spark.conf.set(OPEN_WRITERS, before)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._table(name))

    def load(
        self,
        batch: int,
        transactions: DataFrame,
        accounts: DataFrame,
        transaction_types: DataFrame,
        dim_customer: DataFrame,
        dim_account: DataFrame,
    ) -> "Change":
        """Add the transactions of batch ``batch`` (1, 2, ...), none of which an earlier batch had.

        ``accounts`` is the whole current table.  Dimension versions may change
        from the earliest month of the batch on; older months keep their keys.
        """
        news = month_activity(transactions, transaction_types).withColumnsRenamed({"_month": "month"})
        self._write(news.withColumn("batch", F.lit(batch)), "activity", "batch", "month")
        stored = self.read("activity").where(F.col("batch") <= batch)
        change = self._change(stored, batch)
        if change.since is not None and stored.where(F.col("batch") == batch).isEmpty():
            return change  # nothing new
        activity = stored if change.since is None else stored.where(F.col("month") >= F.lit(change.since))
        sums = [F.sum(c).cast(BALANCE).alias(c) for c in ("month_inflow", "month_outflow", "_net")]
        activity = activity.groupBy("account_id", F.col("month").alias("_month")).agg(*sums, F.sum("transaction_count").alias("transaction_count"))
        through = stored.agg(F.max("month").alias("through"))
        entities = accounts.select("account_id", "user_id", "opened_date")
        if change.since is None:
            segments = balance_segments(entities, "opened_date", activity, through)
        else:
            segments = balance_segments(
                entities, "opened_date", activity, through, since=F.lit(change.since), opening=self._opening(stored, entities, change, batch)
            )
        segments = reliable_checkpoint(segments)  # read for the balances and for the snapshot
        balances = segments.select("account_id", F.col("_s.f").alias("month"), F.col("_s.b").cast(BALANCE).alias("closing_balance"))
        self._write(balances.withColumn("batch", F.lit(batch)), "balances", "batch")
        keyed = clip_to_versions(segments, dim_account, "account_id", "account_id", {"account_key": "account_key"})
        keyed = clip_to_versions(keyed, dim_customer, "user_id", "user_id", {"customer_key": "customer_key"})
        rows = explode_segments(keyed, ["account_key", "customer_key"]).select(
            F.col("_month").alias("month"), "date_key", "customer_key", "account_key", "month_inflow", "month_outflow",
            "month_net", "closing_balance", "transaction_count",
        )
        self._write(rows, "snapshot", "month")
        return change

    def _change(self, stored: DataFrame, batch: int) -> "Change":
        """The first month that batch ``batch`` changes; months after the last stored one are new for every account."""
        is_new = F.col("batch") == batch
        row = stored.agg(F.min(F.when(is_new, F.col("month"))).alias("first"), F.max(F.when(~is_new, F.col("month"))).alias("last")).first()
        if row["last"] is None:
            return Change(None, None)
        since = min(row["first"] or date.max, _month(row["last"], 1))
        return Change(since, _month(since, -1))

    def _opening(self, stored: DataFrame, entities: DataFrame, change: "Change", batch: int) -> DataFrame:
        """Balances at the start of the first changed month.

        They are the closing balances of the month before: of what is stored up
        to that month, an account's last balance by its last batch, which holds
        all its months from the first that it changed.
        Accounts that open later have none there; theirs is the sum of what
        was booked before they opened, if anything.
        """
        upto = self.read("balances").where((F.col("batch") < batch) & (F.col("month") <= F.lit(change.before)))
        at = F.col("batch").cast("bigint") * 1_000_000 + F.year("month") * 12 + F.month("month")
        closed = upto.groupBy("account_id").agg(F.max_by("closing_balance", at).alias("balance"))
        late = entities.where(F.trunc("opened_date", "month") >= F.lit(change.since)).select("account_id")
        early = stored.where(F.col("month") < F.lit(change.since)).join(late, "account_id", "left_semi")
        return closed.unionByName(early.groupBy("account_id").agg(F.sum("_net").cast(BALANCE).alias("balance")))


def _month(day: date, later: int) -> date:
    """The first of the month so many months later."""
    year, month = divmod(day.year * 12 + day.month - 1 + later, 12)
    return date(year, month + 1, 1)


@dataclass(frozen=True)
class Change:
    """``since``: the first month that a load replaces, None for all; ``before``: the month that it starts from."""

    since: date | None
    before: date | None


# --- the account mart -------------------------------------------------------------
FLOWS = ("inflow", "outflow")


def ledger_changes(before: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` to add (``sign`` 1) and the rows of ``before`` that they correct (``sign`` -1)."""
    replaced = before.join(batch.select(key), key, "left_semi").select(*batch.columns)
    return batch.withColumn("sign", F.lit(1)).unionByName(replaced.withColumn("sign", F.lit(-1)))


def ledger_state(entries: DataFrame, account: str = "account_id", time: str = "transaction_ts") -> DataFrame:
    """State of each account with entries ``(account, amount, direction, time)``, built from all of them."""
    return merge_ledger(None, entries.withColumn("sign", F.lit(1)), entries, account, time)


def merge_ledger(state: DataFrame | None, changes: DataFrame, entries: DataFrame, account: str = "account_id", time: str = "transaction_ts") -> DataFrame:
    """The state after ``changes`` (see :func:`ledger_changes`, with ``direction``).

    Columns: the account, total_<flow>, transaction_count, first_ and last_<time>.
    ``entries``: all entries after the changes, read only for the accounts
    whose first or last time was retracted.  Accounts without entries go.
    """
    first, last = f"first_{time}", f"last_{time}"
    added, gone = F.col("sign") > 0, F.col("sign") < 0
    sums = {f"total_{d}": F.sum(F.when(F.col("direction") == d, F.col("amount") * F.col("sign"))) for d in FLOWS}
    delta = changes.groupBy(account).agg(
        *[c.cast(BALANCE).alias(f"_{n}") for n, c in sums.items()],
        F.sum("sign").cast("bigint").alias("_count"),
        F.min(F.when(added, F.col(time))).alias("_first"), F.max(F.when(added, F.col(time))).alias("_last"),
        F.min(F.when(gone, F.col(time))).alias("_first_gone"), F.max(F.when(gone, F.col(time))).alias("_last_gone"),
    )
    if state is None:
        empty = [F.lit(None).cast(t).alias(n) for n, t in [*((n, BALANCE) for n in sums), ("transaction_count", "bigint"), (first, "timestamp_ntz"), (last, "timestamp_ntz")]]
        merged, lost = delta.select("*", *empty), None
    else:
        merged = state.join(delta, account, "full_outer")
        lost = (F.col("_first_gone") <= F.col(first)) | (F.col("_last_gone") >= F.col(last))
        # the accounts that lose a time are found on the stored state before their entries are read
        merged = reliable_checkpoint(merged.withColumn("_lost", F.coalesce(lost, F.lit(False))))
    zero = money_zero(BALANCE)

    def total(name: str) -> Column:
        return (F.coalesce(name, zero) + F.coalesce(f"_{name}", zero)).cast(BALANCE).alias(name)

    count = F.coalesce("transaction_count", F.lit(0)) + F.coalesce("_count", F.lit(0))
    begins, ends = F.least(first, "_first"), F.greatest(last, "_last")  # both skip nulls
    if lost is not None:
        asked = merged.where("_lost").select(account)
        times = entries.join(asked, account, "left_semi").groupBy(account).agg(F.min(time).alias("_new_first"), F.max(time).alias("_new_last"))
        merged = merged.join(times, account, "left")
        begins = F.when(F.col("_lost"), F.col("_new_first")).otherwise(begins)
        ends = F.when(F.col("_lost"), F.col("_new_last")).otherwise(ends)
    out = merged.select(account, *[total(n) for n in sums], count.cast("bigint").alias("transaction_count"), begins.alias(first), ends.alias(last))
    return out.where(F.col("transaction_count") > 0)
