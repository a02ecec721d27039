"""SCD2 dimension tables whose loads touch open versions only (inventory B3 B4 B7 J11).

A dimension ``t`` is a view on the table ``t__parts``, which is partitioned by
(``is_current``, ``load``).  Load *n* writes two partitions in one job, with
dynamic partition overwrite: all open versions, (true, n), and the versions that
it closes, (false, n).  Then one ``CREATE OR REPLACE VIEW`` shows
(true, n) and every (false, <= n).

* Files of versions closed by earlier loads are neither read (but for the keys
  that :func:`~ledgerloom.operators.scd2.plan_open` asks for) nor written again.
* A load that dies before its view is shown leaves partitions that no reader
  sees and that the next load, which has the same number, overwrites (H3).
* The last surrogate key is a property of the view, so no load scans for it.

One writer at a time loads a dimension, as with any insert-only table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import WriteResult, _observed, _rows, view_properties

PARTITIONS = ("is_current", "load")


def _columns(parts: DataFrame) -> list[str]:
    """The dimension's columns in their own order: ``is_current`` is a partition column, so it comes last."""
    return [c for c in parts.columns if c != "load"]


def load_open(spark: SparkSession, incoming: DataFrame, table: str, spec, run_date: date | Column, fmt: str = "parquet") -> WriteResult:
    """Create or update the dimension ``table`` with one load of ``incoming``."""
    from ..operators.scd2 import apply_open, apply_scd2

    parts = f"{table}__parts"
    shown = view_properties(spark, table)
    if shown is None and spark.catalog.tableExists(table):
        raise ValueError(f"{table} is a plain table; rename it before a history is kept behind that name")
    if shown is None:
        load, rows = 1, apply_scd2(incoming, None, spec, run_date)
        last = None
    else:
        load, stored = int(shown["load"]) + 1, spark.table(parts)
        was_open = stored.where(F.col("is_current") & (F.col("load") == load - 1)).select(*_columns(stored))
        closed = stored.where(~F.col("is_current") & (F.col("load") < load))
        rows, last = apply_open(incoming, was_open, closed, spec, run_date, int(shown["last_key"]))
    observed, seen = _observed(rows.withColumn("load", F.lit(load)), f"load:{table}")
    names = [c for c in observed.columns if c not in PARTITIONS]
    writer = observed.select(*names, *PARTITIONS).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if not spark.catalog.tableExists(parts):
        writer.partitionBy(*PARTITIONS).saveAsTable(parts)
    else:
        writer.insertInto(parts)
    written = _rows(seen)
    last = written if last is None else last  # a first load gives the keys 1 to its number of rows
    shows = f"(is_current AND load = {load}) OR (NOT is_current AND load <= {load})"
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('load' = '{load}', 'last_key' = '{last}') AS "
        f"SELECT {', '.join(_columns(spark.table(parts)))} FROM {parts} WHERE {shows}"
    )
    # open versions of the load before stay for readers that began on them; older ones go
    for row in spark.sql(f"SHOW PARTITIONS {parts}").collect():
        spec_of = dict(p.split("=") for p in row[0].split("/"))
        if spec_of["is_current"] == "true" and int(spec_of["load"]) < load - 1:
            spark.sql(f"ALTER TABLE {parts} DROP IF EXISTS PARTITION (is_current = true, load = {spec_of['load']})")
    return WriteResult(table, written, "open part")
