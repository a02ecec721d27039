"""Keep-latest, top-1-per-key and validate-and-split (inventory F1 F2 F7 E10 J5 C7-C9).

Scale notes
-----------
* ``dedupe_latest`` is ``row_number() = 1`` over the key; Catalyst turns it
  into a partial ``WindowGroupLimit`` *before* the shuffle, so a hot key that
  holds a third of all rows is cut to one row per map partition before it
  moves.
* ``latest_by`` has the same plan; a grouped ``max(struct(...))`` over strings
  would be a sort aggregate without that early cut.
* ``validate`` adds one left join per rule and a single ``reason`` column;
  valid and rejected rows are two filters over the same plan, so callers that
  write both should persist or checkpoint ``Split.tagged`` once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASON = "reason"


def _order(c: str | Column, descending: bool) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def has_key(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = ("_ingested_at",),
    tie_break: Sequence[str | Column] = (),
    complete: bool = True,
    null_keys: str = "keep",
) -> DataFrame:
    """one row per ``keys``, the latest by ``order_by`` (descending).

    ``tie_break`` columns (also descending) decide ties first; with
    ``complete`` rows still tied are ordered by all remaining columns (by
    name), so the survivor depends only on row content, never on shuffle
    order (H1).  A caller that keeps only some columns passes exactly those
    as ``tie_break`` with ``complete=False``: the output is then just as
    deterministic, and the other columns (e.g. PII) are never read.

    A row with a NULL key is no version of any other: such rows are all kept,
    each as a group of its own, or with ``null_keys="drop"`` left to the caller
    (see :class:`Split`).
    """
    named = {c for c in (*keys, *order_by, *tie_break) if isinstance(c, str)}
    rest = sorted(c for c in df.columns if c not in named) if complete else []
    if null_keys == "drop":
        rows, alone = df.where(has_key(keys)), []
    else:
        rows, alone = df.withColumn("_alone", F.when(~has_key(keys), F.monotonically_increasing_id())), ["_alone"]
    w = Window.partitionBy(*keys, *alone).orderBy(*[_order(c, True) for c in (*order_by, *tie_break, *rest)])
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", *alone)


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], null_keys: str = "keep") -> DataFrame:
    """newest row per key by ``order_by`` descending; remaining columns break exact ties."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return dedupe_latest(df, keys, order_by, rest, complete=False, null_keys=null_keys)


@dataclass(frozen=True)
class LookupRule:
    """Resolve ``column`` against ``lookup[label]``; adds ``lookup[id]``.

    Unknown or NULL labels are rejected with ``reason``.  The join strategy is
    Catalyst's: a literal enumeration has exact size statistics and is
    broadcast by the size-checked auto-broadcast.
    """

    column: str
    lookup: DataFrame
    label: str
    id: str
    reason: str | None = None


@dataclass(frozen=True)
class ParentRule:
    """``column`` must exist as ``parent[key]``; NULL keys are orphans."""

    column: str
    parent: DataFrame
    key: str | None = None
    reason: str | None = None


@dataclass(frozen=True)
class CastRule:
    """``column`` becomes ``type``; a non-NULL value that does not cast is rejected (H9)."""

    column: str
    type: str
    reason: str | None = None


@dataclass
class Split:
    """Both outputs of :func:`validate`, from one tagged plan.

    ``keyless``: rows without a key, which no other row can replace; they are
    rejected as ``null_key`` next to the rows that fail a rule.
    """

    tagged: DataFrame
    columns: list[str]
    raw: dict[str, str] = field(default_factory=dict)
    projection: list | None = None
    keyless: DataFrame | None = None

    @property
    def valid(self) -> DataFrame:
        out = self.tagged.where(F.col(REASON).isNull()).drop(REASON, *self.raw.values())
        return out.select(*self.projection) if self.projection else out

    def project(self, columns) -> "Split":
        """The same split with a final projection on the valid side."""
        return replace(self, projection=list(columns))

    def with_keyless(self, rows: DataFrame) -> "Split":
        return replace(self, keyless=rows.select(*self.columns))

    def stored(self) -> "Split":
        """The same split over a tagged frame that is evaluated and stored once for both sides."""
        from ..session import reliable_checkpoint

        return replace(self, tagged=reliable_checkpoint(self.tagged))

    @property
    def rejected(self) -> DataFrame:
        cols = [F.col(self.raw[c]).alias(c) for c in self.columns]
        failed = self.tagged.where(F.col(REASON).isNotNull()).select(*cols, F.col(REASON))
        if self.keyless is None:
            return failed
        return failed.unionByName(self.keyless.withColumn(REASON, F.lit("null_key")))


def validate(df: DataFrame, rules: Sequence[LookupRule | ParentRule | CastRule]) -> Split:
    """Tag every row with the first failing rule, in rule order.

    ``Split.valid`` has the input columns with casts applied and lookup ids
    added; ``Split.rejected`` has the raw input columns plus ``reason``.
    NULL labels and NULL keys fail their rule (H10).
    """
    original = list(df.columns)
    raw = {c: f"_raw_{c}" for c in original}
    tagged = df.select(*[F.col(c) for c in original], *[F.col(c).alias(raw[c]) for c in original])
    reasons: list[Column] = []
    flags: list[str] = []
    for i, rule in enumerate(rules):
        if isinstance(rule, LookupRule):
            lk = rule.lookup.select(F.col(rule.label).alias(f"_lk{i}"), F.col(rule.id))
            tagged = tagged.join(lk, tagged[rule.column] == lk[f"_lk{i}"], "left").drop(f"_lk{i}")
            reasons.append(F.when(F.col(rule.id).isNull(), F.lit(rule.reason or f"unknown_{rule.column}")))
        elif isinstance(rule, ParentRule):
            key = rule.key or rule.column
            parent = rule.parent.select(F.col(key).alias(f"_pk{i}")).distinct().withColumn(f"_ok{i}", F.lit(True))
            tagged = tagged.join(parent, tagged[rule.column] == parent[f"_pk{i}"], "left").drop(f"_pk{i}")
            reasons.append(F.when(F.col(f"_ok{i}").isNull(), F.lit(rule.reason or f"orphan_{rule.column}")))
            flags.append(f"_ok{i}")
        elif isinstance(rule, CastRule):
            tagged = tagged.withColumn(rule.column, F.col(raw[rule.column]).try_cast(rule.type))
            reasons.append(
                F.when(
                    F.col(rule.column).isNull() & F.col(raw[rule.column]).isNotNull(),
                    F.lit(rule.reason or f"bad_{rule.column}"),
                )
            )
        else:  # pragma: no cover
            raise TypeError(f"unknown rule {rule!r}")
    reason = F.coalesce(*reasons) if reasons else F.lit(None)
    tagged = tagged.withColumn(REASON, reason.cast("string")).drop(*flags)
    return Split(tagged, original, raw)
