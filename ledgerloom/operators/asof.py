"""Point-in-time join without pair enumeration (inventory D7, skew-proof variant).

``facts.pit_join`` joins on the business key and filters the validity range,
which compares every fact of a key with every version of that key.  That is
linear when a key has a few versions, but a key holding a large share of
both facts and versions would make it quadratic and put it in one task.

This variant is a merge by sorted position built from dense numberings
(:func:`~ledgerloom.operators.scd2.assign_keys`, range-partitioned, so a hot
key is spread over many tasks):

* facts are numbered ``i_f`` in (key, at, tie-break) order;
* versions are numbered ``i_d`` in (key, valid_from, tie-break) order;
* their union is numbered ``n`` in (key, at, kind, index) order, versions
  before facts at the same instant (``valid_from <= at``).

For a fact, ``n - i_f`` counts the versions sorted before it, i.e. it is the
``i_d`` of the latest version that starts at or before ``at``.  Facts and
versions are then joined on that unique integer, never on the key, and the
match is kept when the keys agree and ``at < valid_to``.  Versions of one key
must not overlap (check K8), the same requirement as the range form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scd2 import assign_keys


def asof_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    at: str,
    fact_order: Sequence[str],
    take: dict[str, str],
    how: str = "inner",
    dim_order: Sequence[str] = ("valid_to",),
) -> DataFrame:
    """Attach the dimension version valid at ``at`` (``valid_from <= at < valid_to``).

    ``fact_order`` must make facts with equal (key, at) totally ordered (e.g.
    a fact id).  The dimension key must order like the fact key (same type, or
    a type whose cast to it preserves order).  ``take`` maps dimension columns to output names.  ``how`` is
    ``inner`` or ``left`` (unmatched facts keep NULLs).
    """
    f = assign_keys(facts, [fact_key, at, *fact_order], "_fi")
    d = assign_keys(
        dim.select(
            F.col(dim_key).alias("_dk"),
            F.col("valid_from").alias("_vf"),
            F.col("valid_to").alias("_vt"),
            *[F.col(c).alias(f"_do_{c}") for c in dim_order],
            *[F.col(src).alias(dst) for src, dst in take.items()],
        ),
        ["_dk", "_vf", *[f"_do_{c}" for c in dim_order]],
        "_di",
    )
    # the merged order must agree with both numberings, so keys keep the fact
    # key's type (never a string rendering, which would sort 10 before 9) and
    # times are only widened when the two sides differ
    key_type = facts.schema[fact_key].dataType
    time_type = facts.schema[at].dataType
    if time_type != dim.schema["valid_from"].dataType:
        time_type = "timestamp_ntz"
    events = f.select(
        F.col(fact_key).cast(key_type).alias("_k"), F.col(at).cast(time_type).alias("_t"),
        F.lit(1).alias("_kind"), F.col("_fi").alias("_i"),
    ).unionByName(
        d.select(
            F.col("_dk").cast(key_type).alias("_k"), F.col("_vf").cast(time_type).alias("_t"),
            F.lit(0).alias("_kind"), F.col("_di").alias("_i"),
        )
    )
    numbered = assign_keys(events, ["_k", "_t", "_kind", "_i"], "_n")
    owner = numbered.where(F.col("_kind") == 1).select(
        F.col("_i").alias("_fi"), (F.col("_n") - F.col("_i")).alias("_di")
    )
    matched = (
        f.join(owner, "_fi", "inner")
        .join(d, "_di", "left")
        .where(
            (F.col("_dk") == F.col(fact_key)) & (F.col(at) >= F.col("_vf")) & (F.col(at) < F.col("_vt"))
        )
        .select("_fi", *take.values())
    )
    out = f.join(matched, "_fi", "left" if how == "left" else "inner")
    return out.drop("_fi")
