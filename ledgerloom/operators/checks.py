"""Data-quality and reconciliation checks (inventory K1-K13, C6 E11 E12 F5 F6).

Every check returns a one-row DataFrame ``(check string, ok boolean,
failing bigint)`` computed on the executors; only :func:`gate` brings rows to
the driver, and it brings one row per check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.scalars import key_bytes, packed
from ..session import reliable_checkpoint
from .sequence import with_neighbour

CHECK_COLUMNS = ("check", "ok", "failing")


def _result(name: str, failing: DataFrame) -> DataFrame:
    """``failing`` is a one-row frame with a ``failing`` column."""
    f = F.coalesce(F.col("failing").cast("bigint"), F.lit(0).cast("bigint"))
    return failing.select(F.lit(name).alias("check"), (f == 0).alias("ok"), f.alias("failing"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failing"))


def unique(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Surplus rows over distinct key values (NULL is a value here)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _result(name or f"unique {','.join(keys)}", per_key.agg(F.sum(F.col("_n") - 1).alias("failing")))


def fk(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None, name: str | None = None) -> DataFrame:
    """K2: child rows whose key has no parent (NULL keys count as orphans)."""
    p = parent.select(F.col(parent_col or child_col).alias("_pk")).distinct()
    orphans = child.join(p, child[child_col] == p["_pk"], "left_anti")
    return _result(name or f"fk {child_col}", _count(orphans))


def fk_fanout(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, name: str | None = None) -> DataFrame:
    """K3: fact rows that do not match exactly one dimension row (orphans or fan-out)."""
    dk = dim_key or key
    per_key = dim.groupBy(F.col(dk).alias("_dk")).agg(F.count(F.lit(1)).alias("_m"))
    joined = fact.select(F.col(key).alias("_fk")).join(per_key, F.col("_fk") == F.col("_dk"), "left")
    bad = joined.where(F.col("_m").isNull() | (F.col("_m") != 1))
    return _result(name or f"fk no fan-out {key}", _count(bad))


def counts(a: DataFrame, b: DataFrame, name: str = "row counts equal") -> DataFrame:
    """K4: |count(a) - count(b)|."""
    cb = b.agg(F.count(F.lit(1))).scalar()
    return _result(name, a.agg(F.abs(F.count(F.lit(1)) - cb).alias("failing")))


def nonempty(df: DataFrame, name: str = "non-empty") -> DataFrame:
    """K5: fails (1) when the frame has no row; reads at most one row."""
    return _result(name, df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("failing")))


def measure(
    left: DataFrame,
    key: str,
    left_measure: str | Column,
    right: DataFrame,
    right_measure: str | Column,
    name: str = "measures agree",
) -> DataFrame:
    """K6: per ``key`` of ``left``: ``left_measure`` is not ``coalesce(sum(right_measure), 0)``.

    ``right`` is aggregated to one row per key before the join.
    """
    lm = F.col(left_measure) if isinstance(left_measure, str) else left_measure
    rm = F.col(right_measure) if isinstance(right_measure, str) else right_measure
    r = right.groupBy(key).agg(F.sum(rm).alias("_r"))
    diff = left.select(key, lm.alias("_l")).join(r, key, "left")
    # null-safe: a NULL measure on the left is a mismatch, not silently skipped
    bad = diff.where(~F.col("_l").eqNullSafe(F.coalesce(F.col("_r"), F.lit(0))))
    return _result(name, _count(bad))


def scd2_current(dim: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Business keys with more than one open version."""
    multi = dim.where(F.col("is_current")).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return _result(name or f"scd2 one current per {key}", _count(multi))


def scd2_contiguous(dim: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Versions whose ``valid_to`` is not the next version's ``valid_from``.

    The next version comes from :func:`~ledgerloom.operators.sequence.with_neighbour`
    (a key with very many versions is not one task).
    """
    nxt = with_neighbour(dim, key, ["valid_from", "valid_to"], ["valid_from"], "_next_", offset=1)
    bad = nxt.where(F.col("_next_valid_from").isNotNull() & (F.col("valid_to") != F.col("_next_valid_from")))
    return _result(name or f"scd2 contiguous per {key}", _count(bad))


def scd2_inverted(dim: DataFrame, name: str = "scd2 no inverted version") -> DataFrame:
    """H4: versions with ``valid_to < valid_from`` (a version with a future
    effective date expired at an earlier run date).  Empty versions
    ``[d, d)`` from two changes on one run date are allowed."""
    return _result(name, _count(dim.where(F.col("valid_to") < F.col("valid_from"))))


def date_coverage(fact: DataFrame, calendar: DataFrame, col: str = "date_key", name: str | None = None) -> DataFrame:
    """K9: distinct fact date keys missing from the calendar."""
    missing = fact.select(col).distinct().join(calendar.select(col), col, "left_anti")
    return _result(name or f"calendar covers {col}", _count(missing))


def hub_complete(hub: DataFrame, source: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """K10 (H18 fix): distinct source keys missing from the hub (source ⊆ hub)."""
    missing = source.select(key).distinct().join(hub.select(key), key, "left_anti")
    return _result(name or f"hub holds every {key}", _count(missing))


def hash_repeat(sat: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Consecutive versions of a key with the same ``hash_diff`` (skew-safe neighbour)."""
    digests = [packed(c).alias(c) for c in (key, "hash_diff")]
    prev = with_neighbour(sat.select(*digests, "load_date"), key, ["load_date", "hash_diff"], ["hash_diff"], "_prev_", offset=-1)
    rep = prev.where(F.col("_prev_hash_diff") == F.col("hash_diff"))
    return _result(name or f"no repeated hash_diff per {key}", _count(rep))


def equal(
    a: DataFrame,
    b: DataFrame,
    key: str,
    pairs: Sequence[tuple[str, str]],
    name: str = "datasets equal",
) -> DataFrame:
    """Rows present on one side only, plus joined rows where any column
    pair differs (NULL-safe), in one full outer join."""
    left = a.select(F.col(key).alias("_k"), F.lit(True).alias("_in_a"), *[F.col(x).alias(f"_a{i}") for i, (x, _) in enumerate(pairs)])
    right = b.select(F.col(key).alias("_k"), F.lit(True).alias("_in_b"), *[F.col(y).alias(f"_b{i}") for i, (_, y) in enumerate(pairs)])
    j = left.join(right, left["_k"].eqNullSafe(right["_k"]), "full_outer")
    mismatch = F.lit(False)
    for i in range(len(pairs)):
        mismatch = mismatch | ~F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}"))
    bad = j.where(F.col("_in_a").isNull() | F.col("_in_b").isNull() | mismatch)
    return _result(name, _count(bad))


def digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """``(bucket, n, x, s)``: per bucket of keys the rows, and order-free digests of them (sums are mergeable, so one small shuffle)."""
    null = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in (key, *columns)])  # hashes skip nulls
    row = F.xxhash64(null, key, *columns)
    return df.groupBy(key_bucket(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("s")
    )


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(buckets)).cast("int")


def equal_digest(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], name: str = "datasets equal", buckets: int = 4096) -> DataFrame:
    """K12 by digests: :func:`equal`, but only rows in buckets whose digests differ are joined.

    ``a`` and ``b`` have the same columns with the same types.  Each is read
    once for ``buckets`` digests; these are compared and stored, so that equal
    inputs end there.  ``a``, as a rule the dear side, is stored before, as it is read again if they differ.  What differs in few keys joins few buckets (the list of
    buckets is bounded, hence broadcast).  Rows of two 64-bit digests and a
    count that agree are taken for equal.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be from 1 to 65536, as their list is broadcast")
    a = reliable_checkpoint(a.select(key, *columns))
    mine, theirs = (digests(d, key, columns, buckets) for d in (a, b))
    both = mine.join(theirs.withColumnsRenamed({"n": "n2", "x": "x2", "s": "s2"}), "bucket", "full_outer")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("x").eqNullSafe(F.col("x2")) & F.col("s").eqNullSafe(F.col("s2"))
    differing = reliable_checkpoint(both.where(~same).select("bucket"))
    if differing.isEmpty():
        return _result(name, differing.agg(F.count("bucket").alias("failing")))
    some = [d.withColumn("_bucket", key_bucket(key, buckets)) for d in (a, b)]
    listed = F.broadcast(differing.select(F.col("bucket").alias("_bucket")))
    a, b = (d.join(listed, "_bucket", "left_semi").drop("_bucket") for d in some)
    return equal(a, b, key, [(c, c) for c in columns], name)


# --- many checks in one pass ---------------------------------------------------------
@dataclass(frozen=True)
class Role:
    """Rows of ``table`` under the key ``column`` (None: all under one), where ``only`` holds (SQL), with a ``value`` to add up."""

    table: str
    column: str | None
    only: str | None = None
    value: str | None = None


@dataclass(frozen=True)
class Rule:
    """A check as arithmetic on the counts that roles have under each key of a key space.

    ``roles`` name the rows that are counted; ``failing`` gets, in their order,
    the number of rows of each (and the sums of their values) under one key,
    and whether the key is NULL, and returns how much fails there.  Failures
    of all keys are added up; ``total`` turns the sum into the result.
    """

    name: str
    roles: tuple[Role, ...]
    failing: Callable[..., Column]
    space: str = ""
    total: Callable[[Column], Column] | None = None


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def unique_rule(name: str, table: str, key: str) -> Rule:
    """K1: surplus rows over distinct keys."""
    return Rule(name, (Role(table, key),), lambda n, null: F.greatest(n[0] - 1, _zero()))


def points_rule(name: str, child: str, column: str, parent: str, key: str | None = None) -> Rule:
    """K2: child rows without a parent; NULL keys have none."""
    return Rule(name, (Role(child, column), Role(parent, key or column)), lambda n, null: F.when((n[1] == 0) | null, n[0]).otherwise(_zero()))


def one_match_rule(name: str, fact: str, column: str, dim: str, key: str | None = None) -> Rule:
    """K3: fact rows that don't match exactly one dimension row."""
    return Rule(name, (Role(fact, column), Role(dim, key or column)), lambda n, null: F.when((n[1] != 1) | null, n[0]).otherwise(_zero()))


def covers_rule(name: str, table: str, column: str, source: str) -> Rule:
    """Distinct source keys that the table lacks."""
    lacks = lambda n, null: ((n[1] > 0) & ((n[0] == 0) | null)).cast("bigint")
    return Rule(name, (Role(table, column), Role(source, column)), lacks)


def one_open_rule(name: str, table: str, key: str) -> Rule:
    """K7: keys with more than one open version."""
    return Rule(name, (Role(table, key, "is_current"),), lambda n, null: (n[0] > 1).cast("bigint"))


def no_row_rule(name: str, table: str, where: str) -> Rule:
    """Rows for which ``where`` (SQL) holds."""
    return Rule(name, (Role(table, None, where),), lambda n, null: n[0])


def filled_rule(name: str, table: str) -> Rule:
    """K5: fails (1) if the table has no row."""
    return Rule(name, (Role(table, None),), lambda n, null: n[0], total=lambda rows: (rows == 0).cast("bigint"))


def same_rows_rule(name: str, table: str, other: str) -> Rule:
    """K4: how much the row counts differ."""
    return Rule(name, (Role(table, None), Role(other, None)), lambda n, null: n[0] - n[1], total=F.abs)


def same_sum_rule(name: str, left: str, key: str, left_value: str, right: str, right_value: str) -> Rule:
    """K6: rows of ``left``, which has a row per key, whose value isn't the sum of ``right``'s; rows of a repeated key fail."""

    def failing(n, null, v, missing):
        differs = (v[0] != F.when(null, F.lit(0)).otherwise(v[1])) | (missing[0] > 0) | (n[0] > 1)
        return F.when(differs, n[0]).otherwise(_zero())

    roles = (Role(left, key, value=left_value), Role(right, key, value=right_value))
    return Rule(name, roles, failing, space=f"sum {name}")


def compile_rules(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Result rows (check, ok, failing) of all rules, from one pass over the tables.

    Rules that look at the same keys share a key space (that of the last role).
    Each table is read once: a row becomes one small row for each role that it
    has, ``(space, number, key, slot)``; keys that are whole numbers in all
    their tables stay numbers, others move as bytes.  One aggregate over the keys, combined
    map-side, then counts the rows of each slot, and a second one, without
    keys, adds up the failures of all rules.  Values are decimals, which are
    dear to add up, so the tables that have them get an aggregate of their own.
    """
    spaces: dict[str, list[Role]] = {}
    for rule in rules:
        own = spaces.setdefault(_space(rule), [])
        own += [r for r in rule.roles if r not in own]
    valued = {r.table for roles in spaces.values() for r in roles if r.value}
    summed = {n for n, roles in spaces.items() if any(r.value for r in roles) or all(r.table in valued for r in roles)}
    found = []
    for names in (spaces.keys() - summed, summed):
        if names:
            found.append(_failures(rules, {n: roles for n, roles in spaces.items() if n in names}, tables))
    sums = run_all(found).groupBy().agg(*[F.sum(f"r{k}").alias(f"r{k}") for k in range(len(rules))]) if len(found) > 1 else found[0]
    totals = [F.coalesce(F.col(f"r{k}"), _zero()) for k in range(len(rules))]
    named = [F.struct(F.lit(r.name).alias("check"), (r.total(t) if r.total else t).cast("bigint").alias("failing")) for r, t in zip(rules, totals)]
    results = sums.select(F.explode(F.array(*named)).alias("r"))
    return results.select("r.check", (F.col("r.failing") == 0).alias("ok"), "r.failing")


def _failures(rules: Sequence[Rule], spaces: Mapping[str, list[Role]], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: what fails of each rule in ``spaces`` (``r0``, ``r1``, ...), NULL for the rules of other spaces."""
    number = {name: k for k, name in enumerate(spaces)}
    whole = {name for name, roles in spaces.items() if all(_is_whole(r, tables) for r in roles)}
    slots = max(len(roles) for roles in spaces.values())
    summed = sorted({spaces[_space(x)].index(r) for x in rules if _space(x) in spaces and any(r.value for r in x.roles) for r in x.roles})
    uses: dict[str, list[tuple[str, int, Role]]] = {}
    for name, roles in spaces.items():
        for slot, role in enumerate(roles):
            uses.setdefault(role.table, []).append((name, slot, role))
    parts = []
    for name, used in uses.items():
        entries = []
        for space, slot, role in used:
            key = F.lit(0) if role.column is None else F.col(role.column)
            as_number = key.cast("bigint") if space in whole else F.lit(None).cast("bigint")
            as_bytes = F.lit(None).cast("binary") if space in whole else key_bytes(key.cast("string"))
            columns = {"space": F.lit(number[space]), "number": as_number, "key": as_bytes, "slot": F.lit(slot)}
            if summed:
                columns["value"] = F.lit(None).cast("decimal(38,2)") if role.value is None else F.col(role.value).cast("decimal(38,2)")
            entry = F.struct(*[c.alias(n) for n, c in columns.items()])
            entries.append(entry if role.only is None else F.when(F.expr(role.only), entry))
        each = F.array_compact(F.array(*entries)) if any(r.only for *_, r in used) else F.array(*entries)
        parts.append(tables[name].select(F.explode(each).alias("e")).select("e.*"))
    of = [F.col("slot") == k for k in range(slots)]
    found = [F.count(F.when(of[k], F.lit(1))).alias(f"n{k}") for k in range(slots)]
    for k in summed:
        found.append(F.coalesce(F.sum(F.when(of[k], F.col("value"))), F.lit(0)).alias(f"v{k}"))
        found.append(F.count(F.when(of[k] & F.col("value").isNull(), F.lit(1))).alias(f"m{k}"))
    keys = run_all(parts).groupBy("space", "number", "key").agg(*found)
    sums = []
    for k, rule in enumerate(rules):
        if (own := spaces.get(_space(rule))) is None:
            sums.append(F.lit(None).cast("bigint").alias(f"r{k}"))
            continue
        at = [own.index(r) for r in rule.roles]
        args = [[F.col(f"n{i}") for i in at], F.col("number").isNull() & F.col("key").isNull()]
        if any(r.value for r in rule.roles):
            args += [[F.col(f"v{i}") for i in at], [F.col(f"m{i}") for i in at]]
        sums.append(F.sum(F.when(F.col("space") == number[_space(rule)], rule.failing(*args))).alias(f"r{k}"))
    return keys.agg(*sums)


def _is_whole(role: Role, tables: Mapping[str, DataFrame]) -> bool:
    """Whether a role's key is a whole number, of any size; rows that are counted together have the number 0."""
    return role.column is None or isinstance(tables[role.table].schema[role.column].dataType, IntegralType)


def _space(rule: Rule) -> str:
    """Rules on the same keys share a space: the parent's, which is the last role of a reference and the first of a cover."""
    if rule.space:
        return rule.space
    keyed = [r for r in rule.roles if r.column is not None]
    return f"{keyed[-1].table}.{keyed[-1].column}" if keyed else " ".join(["rows", *[r.table for r in rule.roles]])


def run_all(checks: Sequence[DataFrame]) -> DataFrame:
    """All check rows as one frame."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class GateFailed(AssertionError):
    """``report``: every check of the gate as (name, ok, failing)."""

    def __init__(self, report: list[tuple[str, bool, int]]):
        super().__init__("; ".join(f"{n}: {f} failing" for n, ok, f in report if not ok))
        self.report = report


def gate(checks: Sequence[DataFrame]) -> list[tuple[str, bool, int]]:
    """Evaluate the checks (one row each to the driver) and raise if any fails."""
    rows = [(r["check"], bool(r["ok"]), int(r["failing"])) for r in run_all(checks).collect()]
    if not all(ok for _, ok, _ in rows):
        raise GateFailed(rows)
    return rows
