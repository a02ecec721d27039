"""Type-2 slowly changing dimensions (inventory J9 J9b J10 J11 F3 F4 D10 B3 B4 B7).

``assign_keys`` replaces ``row_number() over (order by bk)`` (which plans an
``Exchange SinglePartition``) with a distributed scheme:

1. range-partition by the ordering columns and sort inside each partition;
2. tag rows with ``monotonically_increasing_id`` (partition id in the high
   bits, position in the low 33 bits) and *checkpoint* to the shared
   checkpoint folder, so sampled range boundaries and positions cannot change
   if a task is recomputed after an executor loss;
3. count rows per partition (a tiny aggregate), turn counts into offsets over
   at most ``num_partitions`` rows, and broadcast that bounded table back.

Keys come out dense and in the same order as the global ``row_number``.

``plan_scd2`` tags every changed key with its action and stores that frame
once; new versions and closed ones both come from it.  ``apply_scd2`` gives the
whole next state (no MERGE, so no half-applied state between an expire commit
and an insert commit, H3).  ``apply_open`` gives only what a load writes where
closed versions are stored apart: it reads the open versions, and of the closed
ones just the keys that no open version explains.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import OPEN_END, open_end, row_hash
from ..session import ensure_checkpoint_dir, reliable_checkpoint

_POS_BITS = 33


def assign_keys(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    offset: DataFrame | int = 0,
    num_partitions: int | None = None,
    key_type: str = "bigint",
) -> DataFrame:
    """Dense keys ``offset + 1 ..`` in ``order_by`` order, without a single partition.

    ``offset`` is an int or a one-row, one-column frame (e.g. the current
    maximum key), read as a scalar subquery.  ``order_by`` must be a total order for stable keys.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # without an explicit count AQE may merge adjacent range partitions (order is
    # kept); positions are taken after that read, inside the checkpointed stage
    by_range = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    ranged = reliable_checkpoint(
        by_range.sortWithinPartitions(*order_by).withColumn("_mid", F.monotonically_increasing_id())
    )
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # a row per range partition, as many as spark.sql.shuffle.partitions at most: safe in one task
    # and safe to broadcast
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    if isinstance(offset, DataFrame):
        off = offset.select(F.col(offset.columns[0]).cast("bigint")).scalar()
        offsets = offsets.select("_pid", (F.col("_base") + off).alias("_base"))
    elif offset:
        offsets = offsets.select("_pid", (F.col("_base") + F.lit(int(offset))).alias("_base"))
    keyed = ranged.join(F.broadcast(offsets), pid == F.col("_pid"), "inner")
    out = keyed.withColumn(key, (F.col("_base") + pos + F.lit(1)).cast(key_type))
    return out.select(key, *df.columns)


@dataclass(frozen=True)
class Scd2Spec:
    business_key: str
    tracked: tuple[str, ...]
    effective_from: str
    surrogate_key: str


CUSTOMER_SPEC = Scd2Spec("user_id", ("age_band", "signup_date"), "signup_date", "customer_key")
ACCOUNT_SPEC = Scd2Spec(
    "account_id",
    ("account_number_masked", "opened_date", "account_type", "account_type_category"),
    "opened_date",
    "account_key",
)


def _empty_dimension(incoming: DataFrame, spec: Scd2Spec) -> DataFrame:
    """A dimension of ``incoming``'s columns without a version."""
    none = incoming.select(
        F.lit(0).cast("bigint").alias(spec.surrogate_key),
        "*",
        F.lit("").alias("row_hash"),
        F.lit(OPEN_END).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return none.where(F.lit(False))


def plan_scd2(incoming: DataFrame, current: DataFrame | None, spec: Scd2Spec, run_date: date | Column) -> DataFrame:
    """What one load does, a stored row per business key that changes.

    Columns: those of ``incoming``, ``row_hash``, ``valid_from`` and ``action``:

    * ``add``: a key never stored, valid from its own effective date;
    * ``replace``: the open version has another hash and gives way on ``run_date``;
    * ``reopen``: the key is stored but has no open version (H2); valid from ``run_date``.

    Keys that are unchanged or missing from ``incoming`` do not appear (no
    delete detection, H19).  Runs one job, and raises if ``incoming`` has a
    business key twice, changed or not, since no order between its rows is known.
    """
    bk = spec.business_key
    stored = _empty_dimension(incoming, spec) if current is None else current
    versions = stored.groupBy(bk).agg(F.max(F.when(F.col("is_current"), F.col("row_hash"))).alias("_open"), F.lit(True).alias("_known"))
    compared = _compared(incoming, spec).join(versions, bk, "left")
    return _planned(reliable_checkpoint(compared.where(_differs())), incoming, spec, run_date)


def plan_open(incoming: DataFrame, open_rows: DataFrame, closed_keys: DataFrame, spec: Scd2Spec, run_date: date | Column) -> DataFrame:
    """:func:`plan_scd2` from the open versions, without a join of all closed ones.

    Only keys without an open version are looked up in ``closed_keys``, after
    what differs has been stored, so that side of the lookup is as small as the change.
    """
    bk = spec.business_key
    versions = open_rows.groupBy(bk).agg(F.max("row_hash").alias("_open"))
    differs = reliable_checkpoint(_compared(incoming, spec).join(versions, bk, "left").where(_differs()))
    asked = differs.where(F.col("_open").isNull()).select(bk)
    known = closed_keys.select(bk).join(asked, bk, "left_semi").distinct().withColumn("_known", F.lit(True))
    return _planned(differs.join(known, bk, "left"), incoming, spec, run_date)


def _compared(incoming: DataFrame, spec: Scd2Spec) -> DataFrame:
    """``incoming`` with its hash and how often it has each key; the sort by key serves the join that follows."""
    times = F.count(F.lit(1)).over(Window.partitionBy(spec.business_key))
    return incoming.withColumns({"row_hash": row_hash(spec.tracked), "_times": times})


def _differs() -> Column:
    return F.col("_open").isNull() | (F.col("_open") != F.col("row_hash")) | (F.col("_times") > 1)


def _planned(differs: DataFrame, incoming: DataFrame, spec: Scd2Spec, run_date: date | Column) -> DataFrame:
    """The actions of stored rows that differ; raises for keys that come twice."""
    bk = spec.business_key
    twice = differs.where(F.col("_times") > 1).select(bk).distinct().orderBy(bk).limit(21).collect()
    if twice:
        names = ", ".join(repr(r[0]) for r in twice[:20]) + (", ..." if len(twice) > 20 else "")
        raise ValueError(f"{bk} in the load more than once: {names}")
    action = F.when(F.col("_open").isNotNull(), "replace").when(F.col("_known"), "reopen").otherwise("add")
    since = F.when(F.col("action") == "add", F.col(spec.effective_from).cast("date")).otherwise(F.lit(run_date))
    return differs.withColumn("action", action).select(*incoming.columns, "row_hash", since.alias("valid_from"), "action")


def new_versions(changes: DataFrame, current: DataFrame | int | None, spec: Scd2Spec) -> DataFrame:
    """Open versions of all changes, with the next surrogate keys in the order of the business keys.

    ``current``: the stored versions, or the last surrogate key that was given.
    """
    last = current or 0
    if isinstance(current, DataFrame):
        last = current.agg(F.coalesce(F.max(spec.surrogate_key), F.lit(0)))
    keyed = assign_keys(changes.drop("action"), [spec.business_key, "valid_from"], spec.surrogate_key, offset=last)
    return keyed.withColumns({"valid_to": open_end(), "is_current": F.lit(True)})


def close_replaced(versions: DataFrame, changes: DataFrame, spec: Scd2Spec, run_date: date | Column) -> DataFrame:
    """``versions`` with the open ones of replaced keys closed at ``run_date``."""
    replaced = changes.where(F.col("action") == "replace").select(spec.business_key, F.lit(True).alias("_replaced"))
    closes = F.col("is_current") & F.col("_replaced").isNotNull()
    out = versions.join(replaced, spec.business_key, "left").withColumns(
        {"valid_to": F.when(closes, F.lit(run_date)).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~closes}
    )
    return out.select(*versions.columns)


def apply_scd2(incoming: DataFrame, current: DataFrame | None, spec: Scd2Spec, run_date: date | Column) -> DataFrame:
    """The full next state: stored versions, open ones of replaced keys
    closed at ``run_date``, and the new versions."""
    changes = plan_scd2(incoming, current, spec, run_date)
    added = new_versions(changes, current, spec)
    return added if current is None else close_replaced(current, changes, spec, run_date).unionByName(added)


def apply_open(
    incoming: DataFrame, open_rows: DataFrame, closed_keys: DataFrame, spec: Scd2Spec, run_date: date | Column, last_key: int
) -> tuple[DataFrame, int]:
    """J11 on the open versions alone: the next open versions together with those that close now, and the last key given.

    Versions that were closed before are neither read (but for some keys) nor part of the result.
    """
    changes = reliable_checkpoint(plan_open(incoming, open_rows, closed_keys, spec, run_date))
    added = new_versions(changes, last_key, spec)
    return close_replaced(open_rows, changes, spec, run_date).unionByName(added), last_key + changes.count()


def current_rows(dim: DataFrame) -> DataFrame:
    """The open versions."""
    return dim.where(F.col("is_current"))


def account_dim_input(accounts: DataFrame, account_types: DataFrame) -> DataFrame:
    """Accounts with the type label and category denormalised (star, not snowflake)."""
    types = account_types.select(
        "account_type_id",
        F.col("type_name").alias("account_type"),
        F.col("category").alias("account_type_category"),
    )
    return accounts.join(types, "account_type_id", "inner").select(
        "account_id", "user_id", "account_number_masked", "opened_date", "account_type", "account_type_category"
    )
