"""Sources and sinks (A1-A7, B1-B7) and the checkpointed incremental stream."""

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.scd2 import Scd2Spec, apply_scd2
from ledgerloom.sources import io
from ledgerloom.streaming.incremental import ingest_stream, run_until_caught_up


def _tmp():
    return tempfile.mkdtemp(prefix="ledgerloom-io-", dir="/tmp")


def test_csv_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        io.read_csv(spark, os.path.join(_tmp(), "nope.csv"))


def test_ingest_full_and_append(spark):
    d = _tmp()
    spark.createDataFrame([("t1", "5.00")], "transaction_id string, amount string").write.option("header", "true").csv(f"{d}/full")
    spark.createDataFrame([("t2", "6.00")], "transaction_id string, amount string").write.option("header", "true").csv(f"{d}/incr")
    io.ensure_schema(spark, "bronze_t")
    r1 = io.ingest_full(spark, f"{d}/full", "bronze_t.transactions", "2026-01-01 00:00:00")
    r2 = io.ingest_append(spark, f"{d}/incr", "bronze_t.transactions", "2026-01-02 00:00:00")
    assert (r1.rows, r2.rows) == (1, 1)
    t = io.read_table(spark, "bronze_t.transactions")
    assert sorted(r["transaction_id"] for r in t.collect()) == ["t1", "t2"]
    assert dict(t.dtypes)["_ingested_at"] == "timestamp_ntz"
    assert io.optional_table(spark, "bronze_t.never_written") is None


def test_quarantine_always_overwritten(spark):
    d = _tmp()
    bad = spark.createDataFrame([("a1", "orphan")], "account_id string, reason string")
    assert io.write_quarantine(bad, f"{d}/q") == 1
    assert io.write_quarantine(bad.where("false"), f"{d}/q") == 0  # H8: a clean run clears it
    assert io.read_csv(spark, f"{d}/q", bad.schema).count() == 0


def test_replace_table_state_swaps_scd2(spark):
    spec = Scd2Spec("user_id", ("age_band",), "signup_date", "customer_key")
    io.ensure_schema(spark, "gold_t")
    inc1 = spark.createDataFrame([("u1", "20-29", date(2020, 1, 1))], "user_id string, age_band string, signup_date date")
    io.replace_table_state(spark, apply_scd2(inc1, None, spec, date(2026, 1, 1)), "gold_t.dim_customer")
    inc2 = spark.createDataFrame([("u1", "30-39", date(2020, 1, 1))], "user_id string, age_band string, signup_date date")
    current = io.read_table(spark, "gold_t.dim_customer")
    res = io.replace_table_state(spark, apply_scd2(inc2, current, spec, date(2026, 2, 1)), "gold_t.dim_customer")
    assert res.rows == 2
    rows = io.read_table(spark, "gold_t.dim_customer").orderBy("customer_key").collect()
    assert [(r["customer_key"], r["is_current"]) for r in rows] == [(1, False), (2, True)]


def test_stream_ingest_is_idempotent_across_runs(spark):
    d = _tmp()
    landing, target, ckpt = f"{d}/landing", f"{d}/bronze", f"{d}/ckpt"
    schema = "transaction_id string, amount decimal(10,2)"
    spark.createDataFrame([("t1", 1), ("t2", 2)], "transaction_id string, amount int").select(
        "transaction_id", F.col("amount").cast("decimal(10,2)")
    ).write.mode("append").parquet(landing)
    from pyspark.sql.types import StructType

    st = StructType.fromDDL(schema)
    run_until_caught_up(ingest_stream(spark, landing, st, target, ckpt))
    assert spark.read.parquet(target).count() == 2
    run_until_caught_up(ingest_stream(spark, landing, st, target, ckpt))  # same files again: nothing new (H7)
    assert spark.read.parquet(target).count() == 2
    spark.createDataFrame([("t3", 3)], "transaction_id string, amount int").select(
        "transaction_id", F.col("amount").cast("decimal(10,2)")
    ).write.mode("append").parquet(landing)
    run_until_caught_up(ingest_stream(spark, landing, st, target, ckpt))
    assert sorted(r[0] for r in spark.read.parquet(target).select("transaction_id").collect()) == ["t1", "t2", "t3"]


def test_bucketed_tables_join_without_shuffle(spark):
    io.ensure_schema(spark, "silver_b")
    accts = spark.range(0, 2000).select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("account_id"))
    txns = spark.range(0, 6000).select(
        F.concat(F.lit("A"), (F.col("id") % 2000).cast("string")).alias("account_id"), F.col("id").alias("amount")
    )
    io.write_table(accts, "silver_b.accounts", bucket_by=(8, ["account_id"]))
    io.write_table(txns, "silver_b.transactions", bucket_by=(8, ["account_id"]))
    a, t = io.read_table(spark, "silver_b.accounts"), io.read_table(spark, "silver_b.transactions")
    joined = a.join(t.groupBy("account_id").agg(F.sum("amount").alias("s")), "account_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_write_prunes(spark):
    io.ensure_schema(spark, "gold_p")
    df = spark.range(0, 100).select(F.col("id"), (F.col("id") % 4).alias("month"))
    io.write_table(df, "gold_p.fact", partition_by=["month"])
    q = io.read_table(spark, "gold_p.fact").where(F.col("month") == 2)
    assert "PartitionFilters: [isnotnull(month" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == 25


def test_state_switch_is_one_step(spark):
    """Readers see the old state until the view is switched; a dead writer's table is never shown."""
    io.ensure_schema(spark, "gold_r")

    def state(n):
        return spark.range(n).select(F.col("id").alias("k"))

    for n in (1, 2, 3):
        io.replace_table_state(spark, state(n), "gold_r.dim")
    assert io.read_table(spark, "gold_r.dim").count() == 3 and io._versions(spark, "gold_r.dim") == [2, 3]
    io.write_table(state(9), "gold_r.dim__v4")  # as if a writer stopped before the switch
    assert io.optional_table(spark, "gold_r.dim").count() == 3
    assert io.replace_table_state(spark, state(5), "gold_r.dim").rows == 5
    assert io.read_table(spark, "gold_r.dim").count() == 5
    io.write_table(state(1), "gold_r.plain")
    with pytest.raises(ValueError, match="plain table"):
        io.replace_table_state(spark, state(1), "gold_r.plain")


def test_a_time_limit_raises(spark):
    from pyspark.sql.types import StructType

    d = _tmp()
    for k in range(30):
        spark.range(50).write.mode("append").parquet(f"{d}/landing/part={k}")
    query = ingest_stream(spark, f"{d}/landing", StructType.fromDDL("id long, part int"), f"{d}/out", f"{d}/ckpt", max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        run_until_caught_up(query, timeout_s=0.2)
    assert not query.isActive
    run_until_caught_up(ingest_stream(spark, f"{d}/landing", StructType.fromDDL("id long, part int"), f"{d}/out", f"{d}/ckpt"))
    assert spark.read.parquet(f"{d}/out").count() == spark.read.parquet(f"{d}/landing").count()


def test_a_retried_batch_appends_nothing(spark):
    from datetime import datetime

    from ledgerloom.operators import vault as V
    from ledgerloom.streaming.incremental import create_vault_targets, vault_batch_loader

    d = _tmp()
    ddl = "account_id string, user_id string, account_type string, account_number string, opened_date date, _ingested_at timestamp_ntz"
    specs = [V.HUB["hub_account"], V.LINK["link_account_user"], V.SAT["sat_account_details"]]
    targets = {s.name: f"{d}/{s.name}" for s in specs}

    def batch(day, kind):
        return spark.createDataFrame([("a", "u", kind, "N1", date(2024, 2, 29), datetime(2026, 1, day))], ddl)

    create_vault_targets(spark, batch(1, "x").schema, targets, specs)
    load = vault_batch_loader(targets, specs, "account_id")
    for n, (rows, versions) in enumerate([(batch(10, "x"), 1), (batch(20, "y"), 2), (batch(15, "z"), 3)]):  # the last is late
        for _ in range(2):
            load(rows, n)
            assert [spark.read.parquet(p).count() for p in targets.values()] == [1, 1, versions]


def test_stream_vault_deltas_appends_only_changes(spark):
    from datetime import datetime

    from pyspark.sql.types import StructType

    from ledgerloom.operators import vault as V
    from ledgerloom.streaming.incremental import stream_vault_deltas

    d = _tmp()
    landing, ckpt = f"{d}/landing", f"{d}/ckpt"
    ddl = ("account_id string, user_id string, account_type string, account_number string, "
           "opened_date date, _ingested_at timestamp_ntz")
    schema = StructType.fromDDL(ddl)
    rows = [(f"a{i}", "u1", "savings", f"GB{i:04d}", date(2024, 1, 1), datetime(2026, 1, 1)) for i in range(5)]
    spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
    specs = [V.HUB["hub_account"], V.LINK["link_account_user"], V.SAT["sat_account_details"]]
    targets = {s.name: f"{d}/{s.name}" for s in specs}

    def run():
        run_until_caught_up(stream_vault_deltas(spark, landing, schema, targets, specs, "account_id", checkpoint=ckpt))
        return {n: spark.read.parquet(p).count() for n, p in targets.items()}

    assert run() == {"hub_account": 5, "link_account_user": 5, "sat_account_details": 5}
    assert run() == {"hub_account": 5, "link_account_user": 5, "sat_account_details": 5}  # nothing new
    fix = [("a1", "u1", "investment", "GB0001", date(2024, 1, 1), datetime(2026, 2, 1))]
    spark.createDataFrame(fix, schema).write.mode("append").parquet(landing)
    assert run() == {"hub_account": 5, "link_account_user": 5, "sat_account_details": 6}
    sat = spark.read.parquet(targets["sat_account_details"])
    assert sat.where("account_type = 'investment'").select("load_date").first()[0] == datetime(2026, 2, 1)
