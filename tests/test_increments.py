"""Loads that touch only what changes: SCD2 open parts, pruned vault probes, the dimension bridge, snapshot and mart increments."""

import os
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks as K
from ledgerloom.operators import facts, scd2
from ledgerloom.operators import vault as V
from ledgerloom.operators.increments import SnapshotStore, ledger_changes, ledger_state, merge_ledger
from ledgerloom.sources import io
from ledgerloom.sources.history import load_open

FOREVER = date(9999, 12, 31)
SPEC = scd2.Scd2Spec("item", ("colour",), "since", "item_key")


@pytest.fixture
def layer(spark):
    name = f"inc_{random.randrange(10**9)}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def files(spark, table):
    location = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), location): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(location) for f in fs if f.endswith(".parquet")}


# --- SCD2 by open partition
def items(spark, rows):
    return spark.createDataFrame([(k, c, date(2020, 1, 1)) for k, c in rows], "item string, colour string, since date")


def test_open_loads_equal_full_ones(spark, layer):
    r, full, table = random.Random(2), None, f"{layer}.dim"
    for load in range(5):
        rows = items(spark, [(f"i{k:02}", r.choice("rgb")) for k in range(30) if r.random() < 0.8])
        run_date = date(2021, 1, 1) + timedelta(days=load)
        full = scd2.apply_scd2(rows, full, SPEC, run_date)
        full = spark.createDataFrame(full.collect(), full.schema)
        load_open(spark, rows, table, SPEC, run_date)
        got = spark.table(table)
        assert got.columns == full.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))


def test_closed_versions_stay_where_they_are(spark, layer):
    table = f"{layer}.dim"
    load_open(spark, items(spark, [("a", "r"), ("b", "r"), ("c", "r")]), table, SPEC, date(2021, 1, 1))
    load_open(spark, items(spark, [("a", "g"), ("b", "r")]), table, SPEC, date(2021, 2, 1))
    before = {f: t for f, t in files(spark, f"{table}__parts").items() if f.startswith("is_current=false")}
    load_open(spark, items(spark, [("b", "g"), ("d", "r")]), table, SPEC, date(2021, 3, 1))
    after = files(spark, f"{table}__parts")
    assert before and before.items() <= after.items()
    assert {f.split("/")[1] for f in after if f.startswith("is_current=true")} == {"load=2", "load=3"}  # the state before stays for its readers
    closed = spark.table(table).where("NOT is_current").select("item", "valid_to").collect()
    assert {tuple(x) for x in closed} == {("a", date(2021, 2, 1)), ("b", date(2021, 3, 1))}
    plan = spark.table(table).where("is_current")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "load" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_load_that_died_is_not_seen_and_is_replaced(spark, layer):
    table = f"{layer}.dim"
    load_open(spark, items(spark, [("a", "r"), ("b", "r")]), table, SPEC, date(2021, 1, 1))
    state = sorted(map(tuple, spark.table(table).collect()))
    half = spark.table(f"{table}__parts").withColumn("load", F.lit(2)).withColumn("colour", F.lit("half"))
    half.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(f"{table}__parts")
    assert sorted(map(tuple, spark.table(table).collect())) == state
    load_open(spark, items(spark, [("a", "g"), ("z", "r")]), table, SPEC, date(2021, 2, 1))
    rows = {(x.item, x.colour, x.is_current, x.item_key) for x in spark.table(table).collect()}
    assert rows == {("a", "r", False, 1), ("b", "r", True, 2), ("a", "g", True, 3), ("z", "r", True, 4)}


def test_keys_without_an_open_version_and_repeated_keys(spark, layer):
    table = f"{layer}.dim"
    load_open(spark, items(spark, [("a", "r")]), table, SPEC, date(2021, 1, 1))
    spark.sql(f"INSERT INTO {table}__parts SELECT 9, 'old', 'r', DATE '2020-01-01', 'h', DATE '2020-01-01', DATE '2020-06-01', false, 1")
    load_open(spark, items(spark, [("old", "g"), ("new", "g")]), table, SPEC, date(2021, 2, 1))
    since = {x.item: x.valid_from for x in spark.table(table).where("is_current").collect()}
    assert since == {"a": date(2020, 1, 1), "old": date(2021, 2, 1), "new": date(2020, 1, 1)}
    for rows in ([("a", "r"), ("a", "r"), ("x", "g")], [("a", "g"), ("a", "r")]):  # unchanged repeats are told, too
        with pytest.raises(ValueError, match="'a'"):
            scd2.plan_scd2(items(spark, rows), spark.table(table), SPEC, date(2021, 3, 1))
        with pytest.raises(ValueError, match="'a'"):
            load_open(spark, items(spark, rows), table, SPEC, date(2021, 3, 1))


# --- vault stores by prefix
def test_a_batch_reads_its_partitions_and_moves_no_stored_row(spark, layer):
    spec = V.HubSpec("hub", "things", "thing", "thing_hk")
    table = f"{layer}.hub"
    raw = lambda names: spark.createDataFrame([(n, datetime(2024, 1, 1)) for n in names], "thing string, _ingested_at timestamp_ntz")
    first = V.load_pruned(spec, raw([f"t{k}" for k in range(300)]), None, "2024-01-01 00:00:00", digits=1)
    io.write_table(first, table, partition_by=[V.PREFIX], bucket_by=(4, ["thing_hk"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = V.load_pruned(spec, raw(["t1", "new"]), spark.table(table), "2024-02-01 00:00:00", digits=1)
        plan = delta._jdf.queryExecution().executedPlan().toString()
        assert [r.thing for r in delta.collect()] == ["new"]
        scan = delta._jdf.queryExecution().executedPlan().toString().split("FileScan parquet spark_catalog")[1]
        assert "dynamicpruning" in scan and "Bucketed: true" in plan
        stored_side = plan.split("LeftAnti")[1].split("BroadcastHashJoin")[1].split("FileScan")[0]
        assert "Exchange hashpartitioning" not in stored_side, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [V.partitions_for(n) for n in (0, 10**9, 10**10, 10**13)] == [1, 2, 2, 4]


# --- the bridge of two histories
def histories(spark, r, accounts=12, owners=4):
    def versions(n, start):
        at, out = date(2020, 1, 1) + timedelta(days=start), []
        for _ in range(n):
            to = at + timedelta(days=r.choice([0, 3, 10, 40]))
            out.append((at, to if r.random() < 0.85 else FOREVER))
            if out[-1][1] == FOREVER:
                break
            at = to + timedelta(days=r.choice([0, 0, 5]))
        return out

    keys, a, c = iter(range(10**6)), [], []
    for k in range(owners):
        c += [(next(keys), f"o{k}", *v) for v in versions(r.randint(0, 6), r.randint(0, 30))]
    for k in range(accounts):
        a += [(next(keys), f"a{k}", f"o{r.randrange(owners)}", *v) for v in versions(r.randint(1, 6), r.randint(0, 30))]
    return a, c


def frames(spark, a, c):
    return (
        spark.createDataFrame(a, "account_key long, account_id string, user_id string, valid_from date, valid_to date"),
        spark.createDataFrame(c, "customer_key long, user_id string, valid_from date, valid_to date"),
    )


@pytest.mark.parametrize("seed", range(4))
def test_bridge_holds_on_every_day_what_the_histories_hold(spark, seed):
    a, c = histories(spark, random.Random(seed))
    bridge = facts.dimension_bridge(*frames(spark, a, c)).collect()
    for day in (date(2020, 1, 1) + timedelta(days=k) for k in range(0, 250)):
        want = defaultdict(set)
        for key, account, user, f, t in a:
            if f <= day < t:
                owner = [k for k, u, cf, ct in c if u == user and cf <= day < ct]
                want[account].add((key, user, owner[0] if owner else None))
        got = defaultdict(set)
        for r in bridge:
            if r.valid_from <= day < r.valid_to:
                assert (r.account_key, r.user_id, r.customer_key) not in got[r.account_id]
                got[r.account_id].add((r.account_key, r.user_id, r.customer_key))
        assert got == want, day


def test_facts_are_joined_once(spark):
    a, c = frames(spark, *histories(spark, random.Random(1)))
    types = spark.createDataFrame([(1, "inflow")], "transaction_type_id int, direction string")
    txns = spark.createDataFrame([("t", "a0", 1, Decimal(1), "GBP", datetime(2020, 2, 1))], "transaction_id string, account_id string, transaction_type_id int, amount decimal(10,2), currency string, transaction_ts timestamp_ntz")
    plan = facts.resolve_transactions(txns, types, c, a)._jdf.queryExecution().optimizedPlan().toString()
    above = [line for line in plan.split("\n") if "Join" in line]
    # the type (an enumeration) and the bridge; the third join builds the bridge from the dimensions
    assert len(above) == 3 and sum("LeftOuter" in line for line in above) == 1


# --- the snapshot
TYPES = [(1, "inflow"), (2, "outflow")]
TXN = "transaction_id string, account_id string, transaction_type_id int, amount decimal(10,2), currency string, transaction_ts timestamp_ntz"


def ledger(r, n=60, accounts=8):
    opened = [(f"a{k}", f"o{k % 3}", date(2020, r.randint(1, 12), r.randint(1, 28)) if k else date(2022, 5, 1)) for k in range(accounts)] + [("undated", "o0", None)]
    txns = [(f"t{k}", f"a{r.randrange(accounts)}", r.choice([1, 2]), Decimal(r.randint(1, 500)), "GBP", datetime(2020, 1, 1) + timedelta(days=r.randint(0, 600))) for k in range(n)]
    return opened, txns


def state_of(store):
    return sorted(map(tuple, store.read("snapshot").drop("month").collect()))


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_by_batches_equals_a_full_build(spark, tmp_path, seed):
    r = random.Random(seed)
    opened, txns = ledger(r)
    accounts = spark.createDataFrame(opened, "account_id string, user_id string, opened_date date")
    types = spark.createDataFrame(TYPES, "transaction_type_id int, direction string")
    dims = frames(spark, [(k, a, u, date(2020, 3, 1), FOREVER) for k, (a, u, _) in enumerate(opened)], [(k, f"o{k}", date(2019, 1, 1), date(2021, 2, 10) if k else FOREVER) for k in range(3)])
    # late rows: everything after May 2021 and some from November 2020 on; a third batch has one row of a known month
    late = [t for t in txns if t[5] >= datetime(2021, 5, 1) or (t[5] >= datetime(2020, 11, 1) and r.random() < 0.3)]
    early = [t for t in txns if t not in late]
    batches = [early, late, [("last", "a1", 1, Decimal(7), "GBP", datetime(2021, 3, 3))], []]
    store = SnapshotStore(spark, str(tmp_path / "kept"))
    seen = []
    for number, batch in enumerate(batches, 1):
        old = {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "kept").rglob("*.parquet")} if number > 1 else {}
        change = store.load(number, spark.createDataFrame(batch, TXN), accounts, types, dims[1], dims[0])
        seen += batch
        full = facts.monthly_snapshot(spark.createDataFrame(seen, TXN), accounts, types, dims[1], dims[0])
        assert state_of(store) == sorted(map(tuple, full.collect()))
        if number in (2, 3):
            assert change.since == (min(t[5] for t in batch).date().replace(day=1))
            kept = {f: t for f, t in old.items() if "month=" in f and f.split("month=")[1][:10] < str(change.since) and "/activity/" not in f}
            now = {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "kept").rglob("*.parquet")}
            assert kept and kept.items() <= now.items()
        before = state_of(store)
        store.load(number, spark.createDataFrame(batch, TXN), accounts, types, dims[1], dims[0])  # tried again
        assert state_of(store) == before


def test_a_snapshot_load_that_died_is_repeated(spark, tmp_path):
    opened, txns = ledger(random.Random(5))
    accounts = spark.createDataFrame(opened, "account_id string, user_id string, opened_date date")
    types = spark.createDataFrame(TYPES, "transaction_type_id int, direction string")
    dims = frames(spark, [(k, a, u, date(2020, 1, 1), FOREVER) for k, (a, u, _) in enumerate(opened)], [(k, f"o{k}", date(2019, 1, 1), FOREVER) for k in range(3)])
    store = SnapshotStore(spark, str(tmp_path / "kept"))
    args = (accounts, types, dims[1], dims[0])
    store.load(1, spark.createDataFrame(txns[:30], TXN), *args)
    news = facts.month_activity(spark.createDataFrame(txns[30:], TXN), types).withColumnsRenamed({"_month": "month"})
    store._write(news.withColumn("batch", F.lit(2)), "activity", "batch", "month")  # the load ended here
    store.load(2, spark.createDataFrame(txns[30:], TXN), *args)
    full = facts.monthly_snapshot(spark.createDataFrame(txns, TXN), accounts, types, dims[1], dims[0])
    assert state_of(store) == sorted(map(tuple, full.collect()))


# --- the account mart
ENTRY = "transaction_id string, account_id string, amount decimal(10,2), direction string, transaction_ts timestamp_ntz"


@pytest.mark.parametrize("seed", range(3))
def test_mart_state_takes_corrections(spark, seed):
    r = random.Random(seed)

    def entry(k):
        return (f"t{k}", f"a{r.randrange(6)}", Decimal(r.randint(1, 99)), r.choice(["inflow", "outflow", "other"]), datetime(2020, 1, 1) + timedelta(days=r.randint(0, 30)))

    now = {k: entry(k) for k in range(40)}
    state = ledger_state(spark.createDataFrame(list(now.values()), ENTRY))
    for step in range(3):
        before = spark.createDataFrame(list(now.values()), ENTRY)
        news = {k: entry(k) for k in [*r.sample(range(40), 12), *range(100 + 10 * step, 104 + 10 * step)]}  # some move to other accounts
        now |= news
        entries = spark.createDataFrame(list(now.values()), ENTRY)
        changes = ledger_changes(before, spark.createDataFrame(list(news.values()), ENTRY), "transaction_id")
        state = merge_ledger(state, changes, entries)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert sorted(map(tuple, state.collect())) == sorted(map(tuple, ledger_state(entries).collect()))
    # an account that loses all its entries has no state
    gone = spark.createDataFrame([e for e in now.values() if e[1] == "a0"], ENTRY)
    left = spark.createDataFrame([e for e in now.values() if e[1] != "a0"], ENTRY)
    after = merge_ledger(state, gone.withColumn("sign", F.lit(-1)), left)
    assert "a0" not in {x.account_id for x in after.collect()} and after.count() == ledger_state(left).count()


# --- rescued lines and digests
def test_broken_lines_are_kept_whole(spark, tmp_path):
    lines = ["name,n,day", "a,1,2020-01-01", "b,oops,2020-01-01", "c,3,2020-01-01,extra", "d", '"e, f",4,2020-01-02', ",,", "g,5,soon", "h,99999999999,2020-01-01"]
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    from pyspark.sql.types import StructType

    read = io.read_csv_rescued(spark, str(path), StructType.fromDDL("name string, n int, day date"))
    assert sorted(map(tuple, read.rows.collect()), key=str) == sorted([("a", 1, date(2020, 1, 1)), ("e, f", 4, date(2020, 1, 2)), (None, None, None)], key=str)
    broken = {r.line: r.reason for r in read.broken.collect()}
    assert broken == {lines[2]: "bad_value", lines[3]: "bad_fields", lines[4]: "bad_fields", lines[7]: "bad_value", lines[8]: "bad_value"}
    assert read.rows.count() + read.broken.count() == len(lines) - 1


def test_digests_agree_with_a_full_comparison(spark):
    r = random.Random(6)
    rows = [(k, r.choice([None, "x", "y"]), r.choice([None, "x"])) for k in range(200)]
    swapped = [(k, b, a) if k == 7 else (k, a, b) for k, a, b in rows]
    variants = {
        "same": r.sample(rows, 200),
        "nulls moved": [(7, None, "x") if k == 7 else (k, a, b) for k, a, b in rows],
        "swapped": swapped,
        "missing": rows[1:],
        "more": [*rows, (500, "x", None), (None, "x", None)],
        "empty": [],
    }
    make = lambda data: spark.createDataFrame(data, "k long, a string, b string")
    base = make([(7, "x", None) if k == 7 else (k, a, b) for k, a, b in rows])
    for name, data in variants.items():
        want = K.equal(base, make(data), "k", [("a", "a"), ("b", "b")], name).first()
        for buckets in (1, 16, 4096):
            assert K.equal_digest(base, make(data), "k", ["a", "b"], name, buckets).first() == want, name
    plan = K.equal_digest(base, base, "k", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    with pytest.raises(ValueError):
        K.equal_digest(base, base, "k", ["a"], buckets=1 << 20)


# --- one row per hash key, no repeated version
def test_padded_keys_are_one_entity_on_every_path(spark, tmp_path):
    from ledgerloom.streaming.incremental import run_until_caught_up, stream_vault_deltas

    schema = "thing string, colour string, _ingested_at timestamp_ntz"
    hub, sat = V.HubSpec("hub", "things", "thing", "thing_hk"), V.SatSpec("sat", "things", "thing", "thing_hk", ("colour",))
    batches = [
        [("A1", "r", datetime(2024, 1, 1)), ("A1 ", "g", datetime(2024, 1, 2)), (" A1", "b", datetime(2024, 1, 1)), ("B", "r", datetime(2024, 1, 1))],
        [("A1  ", "g", datetime(2024, 2, 1)), ("B", "g", datetime(2024, 2, 1)), (None, "r", datetime(2024, 2, 1))],
        [("B", "g", datetime(2024, 1, 15)), (" A1", "y", datetime(2024, 1, 15))],  # late: what February says, and something else
    ]
    targets = {s.name: str(tmp_path / s.name) for s in (hub, sat)}
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).write.parquet(str(tmp_path / "land" / f"part={number}"))
        run_until_caught_up(stream_vault_deltas(spark, str(tmp_path / "land"), spark.createDataFrame([], schema).schema.add("part", "integer"), targets, [hub, sat], "thing"))
    hubs, sats = (spark.read.parquet(targets[s.name]) for s in (hub, sat))
    assert hubs.count() == hubs.select("thing_hk").distinct().count() == 2
    assert K.hash_repeat(sats, "thing_hk").first()["ok"]
    history = defaultdict(list)
    for x in sats.orderBy("load_date").collect():
        history[x.thing_hk].append(x.colour)
    assert sorted(history.values()) == [["g", "y"], ["r", "g"]]
    both = spark.createDataFrame(batches[0], schema)
    assert V.load_hub(hub, V.latest_rows(both, "thing"), None, "2024-01-01 00:00:00", None).count() == V.load_hub(hub, both, None, "2024-01-01 00:00:00").count() == 2


def test_snapshot_rows_are_written_without_moving_them(spark, tmp_path):
    """Two loads give the full build; balances are stored where they change, not for every month."""
    from ledgerloom.operators.increments import OPEN_WRITERS, SnapshotStore

    before = spark.conf.get(OPEN_WRITERS)
    store = SnapshotStore(spark, str(tmp_path))
    store._write(spark.range(10).selectExpr("id", "id % 3 AS month"), "t", "month")
    assert spark.conf.get(OPEN_WRITERS) == before and store.read("t").count() == 10
    plans = []
    store._write = lambda df, name, *by: (plans.append((name, by, df._jdf.queryExecution().executedPlan().toString())), SnapshotStore._write(store, df, name, *by))
    types = spark.createDataFrame([(1, "in", "inflow")], "transaction_type_id int, type_name string, direction string")
    accounts = spark.createDataFrame([("a", "u", date(2024, 1, 5)), ("b", "u", date(2024, 2, 1))], "account_id string, user_id string, opened_date date")
    dims = [
        spark.createDataFrame([(1, k, date(2000, 1, 1), date(9999, 12, 31)) for k in keys], f"{n}_key int, {i} string, valid_from date, valid_to date")
        for n, i, keys in (("customer", "user_id", "u"), ("account", "account_id", "ab"))
    ]
    txn = "transaction_id string, account_id string, transaction_type_id int, amount decimal(10,2), transaction_ts timestamp_ntz"
    for batch, day in ((1, datetime(2024, 1, 9)), (2, datetime(2024, 12, 9))):
        store.load(batch, spark.createDataFrame([(f"t{batch}", "a", 1, Decimal(5), day)], txn), accounts, types, *dims)
    assert store.read("snapshot").count() == 12 + 11
    assert store.read("snapshot").agg({"closing_balance": "max"}).first()[0] == 10
    assert store.read("balances").count() < 10
    assert all("rebalance" not in p.lower() for name, _, p in plans if name == "snapshot") and len(plans) == 6
