"""Checks compiled into one pass, neighbours with and without hot keys, vault streams with keyed state."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import checks as K
from ledgerloom.operators.sequence import with_neighbour


def tables(spark, r):
    key = lambda n, nulls=0.1: None if r.random() < nulls else r.randrange(n)
    parents = [(key(8, 0.15), bool(r.getrandbits(1)), r.choice([None, Decimal(r.randint(0, 3))])) for _ in range(r.randint(0, 12))]
    children = [(key(10), r.choice([None, Decimal(r.randint(0, 3))])) for _ in range(r.randint(0, 30))]
    return {
        "parent": spark.createDataFrame(parents, "k long, is_current boolean, total decimal(10,2)"),
        "child": spark.createDataFrame(children, "k int, amount decimal(12,2)"),
        "empty": spark.createDataFrame([], "k long"),
    }


@pytest.mark.parametrize("seed", range(6))
def test_one_pass_gives_what_the_checks_give(spark, seed):
    t = tables(spark, random.Random(seed))
    p, c, e = t["parent"], t["child"], t["empty"]
    pairs = [
        (K.unique_rule("unique", "parent", "k"), K.unique(p, ["k"])),
        (K.unique_rule("unique child", "child", "k"), K.unique(c, ["k"])),
        (K.points_rule("points", "child", "k", "parent"), K.fk(c, p, "k")),
        (K.points_rule("points to none", "child", "k", "empty"), K.fk(c, e, "k")),
        (K.one_match_rule("one match", "child", "k", "parent"), K.fk_fanout(c, p, "k")),
        (K.covers_rule("covers", "parent", "k", "child"), K.hub_complete(p, c, "k")),
        (K.covers_rule("covers back", "child", "k", "parent"), K.hub_complete(c, p, "k")),
        (K.one_open_rule("one open", "parent", "k"), K.scd2_current(p, "k")),
        (K.no_row_rule("no row", "child", "amount > 1"), K._result("x", c.where("amount > 1").agg(F.count("*").alias("failing")))),
        (K.filled_rule("filled", "child"), K.nonempty(c)),
        (K.filled_rule("not filled", "empty"), K.nonempty(e)),
        (K.same_rows_rule("rows", "parent", "child"), K.counts(p, c)),
        (K.same_rows_rule("rows back", "child", "parent"), K.counts(c, p)),
    ]
    rules, want = [r for r, _ in pairs], {r.name: tuple(f.first())[1:] for r, f in pairs}
    got = {x["check"]: (x.ok, x.failing) for x in K.compile_rules(rules, t).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_sums_in_one_pass(spark, seed):
    t = tables(spark, random.Random(100 + seed))
    t["parent"] = t["parent"].dropDuplicates(["k"])
    got = K.compile_rules([K.same_sum_rule("sum", "parent", "k", "total", "child", "amount")], t).first()
    assert (got.ok, got.failing) == tuple(K.measure(t["parent"], "k", "total", t["child"], "amount").first())[1:]


def test_each_table_is_read_once(spark, tmp_path):
    t = {}
    for name, frame in tables(spark, random.Random(1)).items():
        frame.write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    rules = [K.unique_rule("a", "parent", "k"), K.points_rule("b", "child", "k", "parent"), K.covers_rule("c", "parent", "k", "child"), K.filled_rule("d", "child"), K.one_open_rule("e", "parent", "k")]
    plan = K.compile_rules(rules, t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "total" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_only_tables_with_values_are_summed(spark, tmp_path):
    """Every counted key carried decimals for all slots and moved whole numbers as text, most of the catalogue's time."""
    t = tables(spark, random.Random(7))
    t["parent"] = t["parent"].dropDuplicates(["k"])
    t |= {"fact": spark.createDataFrame([(1,), (2,), (2,), (99,), (None,)], "k int"), "dim": spark.createDataFrame([(1,), (2,), (3,)], "k long"), "names": spark.createDataFrame([("1",), ("2",)], "k string")}
    for name, frame in t.items():
        frame.write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    pairs = [
        (K.same_sum_rule("sum", "parent", "k", "total", "child", "amount"), K.measure(t["parent"], "k", "total", t["child"], "amount")),
        (K.filled_rule("filled", "parent"), K.nonempty(t["parent"])),
        (K.same_rows_rule("rows", "fact", "parent"), K.counts(t["fact"], t["parent"])),
        (K.points_rule("points", "fact", "k", "dim"), K.fk(t["fact"], t["dim"], "k")),
        (K.unique_rule("key", "fact", "k"), K.unique(t["fact"], ["k"])),
        (K.points_rule("points to text", "dim", "k", "names"), K.fk(t["dim"].withColumn("k", F.col("k").cast("string")), t["names"], "k")),
    ]
    compiled = K.compile_rules([r for r, _ in pairs], t)
    got = {x["check"]: (x.ok, x.failing) for x in compiled.collect()}
    assert got == {r.name: tuple(f.first())[1:] for r, f in pairs}
    few = K.compile_rules([r for r, _ in pairs[:2] + pairs[3:5]], t)._jdf.queryExecution().executedPlan().toString()
    assert few.count("FileScan") == 4 and "unhex" not in few
    counted = [line for line in few.split("\n") if "HashAggregate(keys=[space" in line and "partial_count" in line]
    assert sorted("partial_sum" in line for line in counted) == [False, True]


def test_catalogue_reads_each_stored_table_at_most_twice(spark):
    """The compiled rules read each stored table once; what compares orders or whole rows reads it once more."""
    import os

    from ledgerloom.plans import verify

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    s = verify.Silver(spark, sf)
    st, v = verify.Star(s), verify.Vault(spark, sf, True, s, store_tables=True)
    verify.build_layers(s, st, v)
    t = verify.tables(s, st, v)
    compiled = K.compile_rules([r for r in map(verify.rule, verify.CATALOGUE) if r], t)
    scans = defaultdict(int)
    for line in compiled._jdf.queryExecution().executedPlan().toString().split("\n"):
        if "FileScan" in line and "/stored-" in line:
            scans[line.split("/stored-")[1].split(",")[0].split("]")[0]] += 1
    # tables under their own name are read once; the derived ones (facts by account, last balances) read theirs again
    assert len(scans) > 15 and max(scans.values()) <= 4
    own = sum(1 for n in scans.values() if n == 1)
    assert own >= len(scans) - 4


def test_keys_are_moved_as_bytes_that_tell_them_apart(spark):
    """A digest takes 32 bytes instead of 64, and no text is taken for another one."""
    from ledgerloom.functions.scalars import key_bytes

    digest = "41" * 32
    texts = ["", "a", "a\0", "A" * 31, "A" * 32, "A" * 33, "A" * 65, "A" * 32 + "\0" * 33, "é" * 16, "\0" * 32, "\0" * 65, digest, digest.replace("41", "4A"), digest.replace("41", "4a"), digest[:-1], digest + "4", None]
    got = [bytes(x[0]) if x[0] is not None else None for x in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(key_bytes("t")).collect()]
    assert len(set(got)) == len(texts) and got[-1] is None
    assert got[texts.index(digest)] == b"A" * 32 and got[1] == b"a"


def test_rules_on_digests(spark):
    """Digests, the texts that their bytes spell, and keys of another case are different keys."""
    digest = "41" * 32
    keys = {"hub": [digest, "ab" * 32, "x"], "sat": [digest, "A" * 32, "AB" * 32, "ab" * 32, None]}
    t = {n: spark.createDataFrame([(k,) for k in ks], "hk string") for n, ks in keys.items()}
    rules = [K.points_rule("points", "sat", "hk", "hub"), K.unique_rule("key", "hub", "hk"), K.unique_rule("sat key", "sat", "hk"), K.covers_rule("covers", "hub", "hk", "sat")]
    want = [K.fk(t["sat"], t["hub"], "hk"), K.unique(t["hub"], ["hk"]), K.unique(t["sat"], ["hk"]), K.hub_complete(t["hub"], t["sat"], "hk")]
    compiled = K.compile_rules(rules, t)
    got = {x["check"]: x.failing for x in compiled.collect()}
    assert [got[r.name] for r in rules] == [w.first()["failing"] for w in want] == [3, 0, 0, 3]


def test_the_catalogue_leaves_no_shuffle_files_and_no_stored_digests(spark, tmp_path, monkeypatch):
    """They filled the disks: every layer's and check's shuffle files stayed, and each digest was stored up to three times."""
    from ledgerloom.plans import layers, verify

    r, day = random.Random(4), datetime(1995, 3, 1)
    customers = [(k, f"Customer#{k}", k % 25, r.choice(["A", "B"]), round(r.uniform(-900, 900), 2)) for k in range(1, 25)]
    orders = [(k, r.randrange(1, 25), day + timedelta(days=r.randrange(900)), r.choice(["1-URGENT", "5-LOW"])) for k in range(1, 60)]
    lines = [(r.randrange(1, 60), r.randrange(1, 8), r.randrange(9), r.randrange(5), round(r.uniform(1, 900), 2), r.choice("ANR"), r.choice("FO"), day + timedelta(days=r.randrange(1500))) for _ in range(200)]
    for name, rows, ddl in [
        ("customer", customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    ]:
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, stored, keep = blocks.getAllFiles().size(), [], layers.reliable_checkpoint
    monkeypatch.setattr(layers, "reliable_checkpoint", lambda df: stored.append(df.columns) or keep(df))
    checks = verify.e2e_checks(spark, str(tmp_path))
    monkeypatch.undo()
    assert blocks.getAllFiles().size() <= before
    assert len(stored) > 10 and not [c for columns in stored for c in columns if c.endswith("_hk") or c == "hash_diff"]
    assert all("Exchange" not in c._jdf.queryExecution().executedPlan().toString() for c in checks)
    got = {x["check"]: (x.ok, x.failing) for c in checks for x in c.collect()}
    assert len(got) == len(verify.CATALOGUE)
    # what the same checks give over layers that aren't stored and vault tables that are
    s = verify.Silver(spark, str(tmp_path), False)
    t = verify.tables(s, verify.Star(s), verify.Vault(spark, str(tmp_path), True, s, store_tables=True))
    assert got == {x["check"]: (x.ok, x.failing) for f in verify.frames(t) for x in f.collect()}


@pytest.mark.parametrize("offset", [-1, 1])
def test_neighbours_of_hot_and_other_keys(spark, offset):
    r = random.Random(3)
    rows = [(r.choice(["hot"] * 5 + ["a", "b", None]), i, r.randrange(4)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    w = Window.partitionBy("k").orderBy("at")
    want = sorted(map(tuple, df.select("k", "at", "v", (F.lag("v") if offset < 0 else F.lead("v")).over(w)).collect()), key=str)
    for hot_rows in (10, 150, 10_000):  # all keys hot, one hot, none
        got = with_neighbour(df, "k", ["at"], ["v"], "_n_", offset, hot_rows)
        assert sorted(map(tuple, got.select("k", "at", "v", "_n_v").collect()), key=str) == want
    plan = with_neighbour(df, "k", ["at"], ["v"], "_n_", offset)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "FileScan" not in plan


# --- streams with keyed state
def plain_history(batches):
    stored = defaultdict(list)
    for batch in batches:
        for key in sorted({b[0] for b in batch if b[0] is not None}):
            for at in sorted({b[2] for b in batch if b[0] == key}):
                colours = [b[1] for b in batch if b[0] == key and b[2] == at]
                history = sorted(stored[key])
                before = [c for d, c in history if d <= at][-1:]
                after = [c for d, c in history if d > at][:1]
                if colours[0] not in before + after:
                    stored[key].append((at, colours[0]))
    return {k: sorted(v) for k, v in stored.items()}


def test_satellite_state_over_batches(spark, tmp_path):
    from ledgerloom.operators import vault as V
    from ledgerloom.streaming.incremental import batch_writer, run_until_caught_up
    from ledgerloom.streaming.stateful import stream_vault_state

    r = random.Random(4)
    spec = V.SatSpec("sat", "things", "thing", "thing_hk", ("colour",))
    hub = V.HubSpec("hub", "things", "thing", "thing_hk")
    t0, batches = datetime(2024, 1, 1), []
    for _ in range(4):
        keys = [r.choice(["a", "b", "c", "d", None]) for _ in range(12)]
        at = {(k, n): t0 + timedelta(days=r.randrange(30)) for n, k in enumerate(keys)}
        unique = {(k, at[k, n]): r.choice("rgb") for n, k in enumerate(keys)}
        batches.append([(k, c, d) for (k, d), c in unique.items()])
    schema = "thing string, colour string, _ingested_at timestamp_ntz"
    tried, paths = [], {s.name: str(tmp_path / s.name) for s in (spec, hub)}
    write = batch_writer(paths["sat"])

    def fails_first(batch, batch_id):
        write(batch, batch_id)
        if batch_id not in tried:
            tried.append(batch_id)
            raise RuntimeError("try again")

    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).write.parquet(str(tmp_path / "land" / f"part={number}"))
        landed = spark.createDataFrame([], schema).schema.add("part", "integer")
        with pytest.raises(Exception, match="try again"):
            run_until_caught_up(stream_vault_state(spark, str(tmp_path / "land"), landed, paths["sat"], spec, str(tmp_path / "c1"), writer=fails_first))
        run_until_caught_up(stream_vault_state(spark, str(tmp_path / "land"), landed, paths["sat"], spec, str(tmp_path / "c1"), writer=fails_first))
        run_until_caught_up(stream_vault_state(spark, str(tmp_path / "land"), landed, paths["hub"], hub, str(tmp_path / "c2")))
    assert tried == [0, 1, 2, 3]
    stored = spark.read.parquet(paths["sat"])
    names = {x.thing_hk: x.thing for x in spark.read.parquet(paths["hub"]).collect()}
    got = defaultdict(list)
    for x in stored.collect():
        got[names[x.thing_hk]].append((x.load_date, x.colour))
    assert {k: sorted(v) for k, v in got.items()} == plain_history(batches)
    assert sorted(names.values()) == sorted(plain_history(batches))


def test_satellite_state_is_kept_for_many_keys_at_once(spark, tmp_path, monkeypatch):
    """A Python call for each key ended the job by time; keys of one state keep their own histories."""
    from ledgerloom.streaming.stateful import changed_versions

    grouped = []
    schema = "thing_hk string, load_date timestamp_ntz, hash_diff string, colour string"
    frame = spark.createDataFrame([], schema)
    monkeypatch.setattr("pyspark.sql.group.GroupedData.applyInPandasWithState", lambda self, f, *a: grouped.append(f) or frame)
    changed_versions(frame, "thing_hk")
    pandas = pytest.importorskip("pandas")

    class State:
        exists, get = False, ()

        def update(self, value):
            self.exists, self.get = True, value

    state, at = State(), datetime(2024, 1, 1)
    key = ["abc" + f"{n:061x}" for n in range(3)]
    diff = [f"{n:064x}" for n in range(3)]

    def load(*rows):
        found = pandas.DataFrame([(key[k], at + timedelta(days=d), diff[v], f"{v}") for k, d, v in rows], columns=frame.columns)
        return [tuple(x) for out in grouped[0](("abc",), iter([found]), state) for x in out[["thing_hk", "colour"]].itertuples(index=False)]

    assert sorted(load((0, 0, 1), (1, 0, 1), (1, 5, 2))) == [(key[0], "1"), (key[1], "1"), (key[1], "2")]
    assert load((0, 1, 1), (1, 1, 1), (1, 4, 2), (2, 1, 1)) == [(key[2], "1")]  # known before, or said by the next version
    assert load((0, 2, 2), (1, 6, 1)) == [(key[0], "2"), (key[1], "1")]
