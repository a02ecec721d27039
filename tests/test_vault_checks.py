"""Vault hashing, deltas and current view (J15-J18) against a plain history, and the check operators."""

import hashlib
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import hash_diff, hash_key, row_hash, unambiguous_hash
from ledgerloom.operators import checks as K
from ledgerloom.operators import vault as V

T0 = datetime(2024, 3, 30, 6)


def sha(*parts):
    return hashlib.sha256("||".join("∅" if p is None else p for p in parts).encode()).hexdigest()


def test_hashes_byte_for_byte(spark):
    df = spark.createDataFrame([(" Zoë ", None, 5), ("", "x||y", -1)], "c string, a string, b int")
    for r, (c, a, b) in zip(df.select(hash_key(["c", "a"]), hash_diff(["c", "a", "b"]), row_hash(["b", "c"])).collect(), [(" Zoë ", None, "5"), ("", "x||y", "-1")]):
        assert tuple(r) == (sha(c.strip(), a and a.strip()), sha(a, b, c), sha(b, c))
    tricky = spark.createDataFrame([("p||q", "r"), ("p", "q||r"), (None, "∅"), ("∅", None)], "a string, b string")
    assert len({x[0] for x in tricky.select(row_hash(["a", "b"])).collect()}) == 2
    assert len({x[0] for x in tricky.select(unambiguous_hash(["a", "b"])).collect()}) == 4


def versions(spark, rows):
    return spark.createDataFrame(rows, "item_hk string, load_date timestamp_ntz, hash_diff string, colour string")


def test_satellite_history_against_a_plain_one(spark):
    r, history, stored = random.Random(9), {}, None
    for load in range(6):
        when = T0 + timedelta(days=load)
        rows = [(f"h{k}", when, f"d-{c}", c) for k in range(15) if r.random() < 0.7 for c in [r.choice("rgb")]]
        delta = V.without_unchanged(versions(spark, rows), stored, "item_hk")
        want = []
        for hk, at, hd, c in rows:
            if not history.get(hk) or history[hk][-1][1] != hd:
                history.setdefault(hk, []).append((at, hd, c))
                want.append((hk, at, hd, c))
        assert sorted(tuple(x) for x in delta.select("item_hk", "load_date", "hash_diff", "colour").collect()) == sorted(want)
        delta = versions(spark, want)
        stored = delta if stored is None else stored.unionByName(delta)
        assert V.without_unchanged(versions(spark, rows), stored, "item_hk").count() == 0  # the same load again
    assert {x.item_hk: x.colour for x in V.current(stored, "item_hk").collect()} == {k: v[-1][2] for k, v in history.items()}


def test_late_rows_meet_what_was_in_force_then(spark):
    stored = versions(spark, [("h", T0, "d1", "r"), ("h", T0 + timedelta(days=9), "d2", "g")])
    late = versions(spark, [("h", T0 + timedelta(days=4), "d3", "b"), ("early", T0 - timedelta(days=1), "d1", "r")])
    first = V.without_unchanged(late, stored, "item_hk").collect()
    assert sorted(x.hash_diff for x in first) == ["d1", "d3"]
    after = stored.unionByName(late.select(*stored.columns))
    assert V.without_unchanged(late, after, "item_hk").count() == 0
    same = versions(spark, [("h", T0 + timedelta(days=5), "d1", "r")])
    assert V.without_unchanged(same, stored, "item_hk").count() == 0 and V.without_unchanged(same, after, "item_hk").count() == 1


def test_keys_are_hashed_trimmed_and_kept_once(spark):
    spec = V.HubSpec("hub_item", "items", "item", "item_hk")
    rows = [("i1", T0), (" i1 ", T0 + timedelta(days=1)), ("i2", T0), (None, T0), ("i2", T0)]
    bronze = spark.createDataFrame(rows, "item string, _ingested_at timestamp_ntz")
    hub = V.load_hub(spec, bronze, None, "2024-04-01 00:00:00")
    assert sorted((x.item_hk, x.item) for x in hub.collect()) == sorted([(sha("i1"), " i1 "), (sha("i2"), "i2")])
    more = bronze.unionByName(spark.createDataFrame([("i3", T0)], bronze.schema))
    assert [x.item for x in V.load_hub(spec, more, hub, "2024-05-01 00:00:00").collect()] == ["i3"]


def test_moved_child_has_one_parent(spark):
    rows = [(f"l{k}", f"c{k % 4}", f"p{k}", T0 + timedelta(days=k)) for k in range(11)] + [("l99", "c0", "p99", T0 + timedelta(days=8))]
    link = spark.createDataFrame(rows, "pair_hk string, child_hk string, parent_hk string, load_date timestamp_ntz")
    assert {x.child_hk: x.parent_hk for x in V.newest_link(link, "child_hk", "pair_hk").collect()} == {"c0": "p99", "c1": "p9", "c2": "p10", "c3": "p7"}


def test_personal_data_is_not_stored(spark):
    import os

    from ledgerloom.plans.layers import Vault

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables not present")
    v = Vault(spark, "/root/testdata/sf0.001")
    stored = [v.latest("users"), v.first_load("hub_user"), v.first_load("sat_user_details"), v._silver.users, v._silver.users_split.rejected]
    assert not {"full_name", "email", "address"} & {c for f in stored for c in f.columns}


def value(check):
    r = check.first()
    assert tuple(check.columns) == K.CHECK_COLUMNS and r["ok"] == (r["failing"] == 0)
    return r["failing"]


def test_keys_and_references(spark):
    t = spark.createDataFrame([("a", "x", 4), ("a", "y", 4), ("b", "x", None), (None, "q", 0), (None, None, 1)], "k string, ref string, v int")
    parents = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3)], "ref string, w int")
    assert [value(K.unique(t, c)) for c in (["k"], ["k", "ref"], ["v"])] == [2, 0, 1]
    assert value(K.fk(t, parents, "ref")) == 2 and value(K.fk(t.where("v = 4"), parents, "ref")) == 0
    assert value(K.fk_fanout(t, parents, "ref")) == 3  # y twice, q and NULL never
    assert value(K.hub_complete(parents, t, "ref")) == 2 and value(K.date_coverage(parents.select("w"), t.select(F.col("v").alias("w")), "w")) == 2
    assert value(K.counts(t, parents)) == 2 and value(K.nonempty(t)) == 0 and value(K.nonempty(t.limit(0))) == 1


def test_sums_and_equality_see_nulls(spark):
    left = spark.createDataFrame([("a", 8), ("b", 0), ("c", None), ("d", 1)], "k string, total int")
    right = spark.createDataFrame([("a", 3), ("a", 5), ("c", None), ("zz", 9)], "k string, v int")
    assert value(K.measure(left, "k", "total", right, "v")) == 2  # c is NULL, d has nothing
    a = spark.createDataFrame([("a", 1, None), (None, 2, "s"), ("b", 3, "t"), ("c", 4, "u")], "k string, n int, s string")
    b = spark.createDataFrame([("a", 1, None), (None, 2, None), ("b", 3, "t"), ("d", 4, "u")], "k string, n int, s string")
    assert value(K.equal(a, b, "k", [("n", "n"), ("s", "s")])) == 3 and value(K.equal(a, a, "k", [("n", "n"), ("s", "s")])) == 0


def test_history_checks(spark):
    end = date(9999, 12, 31)
    rows = [
        ("m1", date(2023, 7, 9), date(2023, 9, 1), False), ("m1", date(2023, 9, 1), end, True),
        ("m2", date(2023, 7, 9), date(2023, 9, 1), False), ("m2", date(2023, 9, 2), end, True),  # a day is missing
        ("m3", date(2023, 7, 9), end, True), ("m3", date(2023, 8, 9), end, True),  # two are open, and they overlap
        ("m4", date(2023, 7, 9), date(2023, 7, 1), False), ("m5", date(2023, 7, 9), date(2023, 7, 9), False),  # upside down; empty
    ]
    dim = spark.createDataFrame(rows, "m string, valid_from date, valid_to date, is_current boolean")
    assert [value(c) for c in (K.scd2_current(dim, "m"), K.scd2_contiguous(dim, "m"), K.scd2_inverted(dim))] == [1, 2, 1]
    sat = versions(spark, [("h", T0 + timedelta(days=k), d, "r") for k, d in enumerate(["d1", "d1", "d2", "d1", "d1", "d1"])] + [("g", T0, "d1", "r")])
    assert value(K.hash_repeat(sat, "item_hk")) == 3


def test_gate(spark):
    t = spark.createDataFrame([(1,)], "x int")
    assert K.gate([K.nonempty(t, "one"), K.counts(t, t, "two")]) == [("one", True, 0), ("two", True, 0)]
    with pytest.raises(K.GateFailed, match="three: 1 failing"):
        K.gate([K.nonempty(t, "one"), K.nonempty(t.limit(0), "three")])


def test_catalogue_names_known_tables_once():
    from ledgerloom.plans.verify import CATALOGUE

    assert len({f.label for f in CATALOGUE}) == len(CATALOGUE) >= 57


def test_seed_sql_renders_null():
    from ledgerloom.sources.seeds import seed_values_sql

    assert "NULL" in seed_values_sql([(1, "x", None)], ["a", "b", "c"])


def test_packed_digests_keep_values_and_order(spark):
    from ledgerloom.functions.scalars import packed, unpacked

    digest = "0a" * 32
    texts = [digest, digest.upper(), "ff" * 32, "zz" * 32, "h1", "h10", "", digest[:63], None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("p"), unpacked(packed("t")).alias("u")).collect()
    assert all(r.t == r.u for r in rows) and len({None if r.p is None else bytes(r.p) for r in rows}) == len(texts)
    assert len(rows[0].p) == 32


def test_latest_balance_breaks_ties_without_sorting(spark):
    from ledgerloom.plans.verify import latest_snapshot_per_account

    snapshot = spark.createDataFrame(
        [(1, 20240131, "9.00"), (2, 20240229, "-3.00"), (2, 20240229, None), (2, 20240229, "-4.00"), (3, 20240131, None), (4, 20240131, "1.00")],
        "account_key int, date_key int, closing_balance string",
    ).selectExpr("account_key", "date_key", "cast(closing_balance AS decimal(20,2)) AS closing_balance")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "account_key int, account_id string")
    got = latest_snapshot_per_account(snapshot, dim)
    assert sorted((r.account_id, r.date_key, r.closing_balance and float(r.closing_balance)) for r in got.collect()) == [("a", 20240229, -3.0), ("b", 20240131, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan


def test_rebuild_joins_its_rows_where_they_are_kept(spark):
    """Rows kept by key were moved again for each join; versions, ties, moved children and rows without a key as before."""
    later = T0 + timedelta(days=1)
    hub = lambda kind, ids: spark.createDataFrame([(sha(i), i) for i in ids], f"{kind}_hk string, {kind}_id string")
    sat = [(sha("A1"), T0, sha("x"), "old", "1", date(2020, 1, 1)), (sha("A1"), later, sha("y"), "new", "GB001234", date(2020, 1, 2)), (None, T0, sha("z"), "new", "2", None)]
    sat += [(sha("A2"), T0, d, "new", n, date(2021, 1, 1)) for d, n in ((sha("p"), "GB000001"), (sha("q"), "GB000002"))]
    link = [(sha("A1", "U1"), sha("A1"), sha("U1"), T0), (sha("A1", "U2"), sha("A1"), sha("U2"), later), (sha("A2", "U1"), sha("A2"), sha("U1"), T0), (None, None, sha("U1"), T0)]
    found = {
        "sat_account_details": spark.createDataFrame(sat, "account_hk string, load_date timestamp_ntz, hash_diff string, account_type string, account_number string, opened_date date"),
        "link_account_user": spark.createDataFrame(link, "account_user_hk string, account_hk string, user_hk string, load_date timestamp_ntz"),
        "hub_account": hub("account", ["A1", "A2", "A3"]), "hub_user": hub("user", ["U1", "U2"]),
        "account_types": spark.createDataFrame([("new", 1), ("old", 2)], "type_name string, account_type_id int"),
    }
    kept = spark.createDataFrame([("U1",), ("U2",)], "user_id string")
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in was:
            spark.conf.set(k, "-1")
        got = V.rebuild("accounts", found.__getitem__, lambda _: kept)
        tied = max((sha("p"), "****0001"), (sha("q"), "****0002"))[1]
        want = [("A1", "U2", 1, "****1234", date(2020, 1, 2)), ("A2", "U1", 1, tied, date(2021, 1, 1))]
        assert sorted(map(tuple, got.collect())) == want
        # satellite, hub and link by the entity's key; parents by id, kept ids, parents and rows by the parent's key; rows and labels
        plan = V.rebuild("accounts", found.__getitem__, lambda _: kept)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 9 and "_alone" not in plan
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_vault_tables_are_rebuilt_where_their_latest_rows_lie(spark, tmp_path):
    """Hub, link and satellite of an entity, made of the same rows, were moved by their digests one by one, and the latest rows' shuffle files stayed."""
    from ledgerloom.plans.layers import Vault

    at = lambda d: T0 + timedelta(days=d)
    lines = [(k % 23 + 1 if k % 10 else None, k % 4, k % 7, k % 3, float(k), "ANR"[k % 3], "FO"[k % 2], at(k % 50) if k % 9 else None) for k in range(150)]
    for name, rows, ddl in [
        ("customer", [(k, f"C{k}", 1, "A", None if k == 3 else 5.0) for k in (1, 2, 3, 3, 4)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        ("orders", [(k, k % 6, at(k), "5-LOW" if k % 4 else "9-NONE") for k in (*range(1, 20), 7)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    ]:
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    try:
        for k in was:
            spark.conf.set(k, "-1")
        v, plain = Vault(spark, str(tmp_path)), Vault(spark, str(tmp_path), store_tables=True)
        before = blocks.getAllFiles().size()
        v.latest("transactions")
        assert blocks.getAllFiles().size() <= before
        for entity, key in (("users", "user_hk"), ("accounts", "account_hk"), ("transactions", "transaction_hk"), ("savings_goals", "savings_goal_hk")):
            got = v.rebuild(entity)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert f"hashpartitioning({key}#" not in plan and "REPARTITION_BY_COL" in plan
            rows = sorted(map(str, got.collect()))
            assert rows and rows == sorted(map(str, plain.rebuild(entity).collect()))
    finally:
        for k, x in was.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)
