"""Scans and sinks (inventory A1-A7, B1-B7).

Row counts come from :class:`pyspark.sql.Observation` during the write (one
pass), not from a second ``count()`` job.  The table format is a parameter
(``parquet`` by default; ``delta`` works where it is installed).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ts_ntz


# --- scans ------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A1: CSV with a header; explicit schema when given, else inferred (an extra read)."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    try:
        df = reader.csv(path)
        df.schema  # resolve now so a missing path fails here
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise
    return df


@dataclass
class Rescued:
    """Both sides of :func:`read_csv_rescued`: typed rows, and the lines that aren't rows with a reason."""

    rows: DataFrame
    broken: DataFrame


def read_csv_rescued(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> Rescued:
    """A1 + B5: CSV of which no value is lost.

    A line with a field too many or too few, or with a value that isn't of its
    column's type, goes whole to ``broken`` (``line``, ``reason``) instead of
    losing fields or turning values into NULL.  Lines are parsed once, with all
    columns, and stored: the reader finds broken lines only among the columns that it is asked for.
    """
    from ..session import reliable_checkpoint

    line = "_line"
    while line in schema.fieldNames():
        line = f"_{line}"
    full = T.StructType([*schema.fields, T.StructField(line, T.StringType())])
    reader = spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
    parsed = reliable_checkpoint(reader.csv(path))
    fields = F.from_csv(F.col(line), ", ".join(f"c{k} string" for k in range(len(schema.fields) + 1)))
    filled = F.size(F.filter(F.array(*[fields[f"c{k}"] for k in range(len(schema.fields) + 1)]), lambda c: c.isNotNull()))
    typed = F.size(F.filter(F.array(*[F.col(f"`{n}`").isNotNull() for n in schema.fieldNames()]), lambda c: c))
    # a line of the right number of fields keeps those that have the right type; each of the others is one that is filled but not typed
    reason = F.when(fields[f"c{len(schema.fields)}"].isNotNull() | (filled <= typed), "bad_fields").otherwise("bad_value")
    broken = parsed.where(F.col(line).isNotNull()).select(F.col(line).alias("line"), reason.alias("reason"))
    return Rescued(parsed.where(F.col(line).isNull()).drop(line), broken)


def stamp_ingest(df: DataFrame, ingested_at: str | Column) -> DataFrame:
    """A2: one ``_ingested_at`` value for the whole load (an argument, not the clock)."""
    ts = ts_ntz(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return df.withColumn("_ingested_at", ts)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A5: catalog table by name (``schema.table``)."""
    return spark.table(name)


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table (or view), or None if it was never written.  Only reads."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by location."""
    return spark.read.format(fmt).load(path)


# --- sinks ------------------------------------------------------------------
@dataclass
class WriteResult:
    table: str
    rows: int
    mode: str


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs: Observation) -> int:
    return int(obs.get.get("rows", 0) or 0)


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, list[str]] | None = None,
) -> WriteResult:
    """B1/B2: overwrite (schema replaced) or append (schema enforced) a catalog table.

    ``partition_by`` (e.g. a transaction month) enables partition pruning on
    read; ``bucket_by=(n, keys)`` stores rows hashed into ``n`` buckets sorted by
    ``keys``, so later joins and aggregations on ``keys`` between tables
    bucketed the same way need no shuffle.
    """
    observed, obs = _observed(df, f"write:{table}")
    if bucket_by:  # a task per bucket, so that each writes one file
        observed = observed.repartition(bucket_by[0], *bucket_by[1])
    w = observed.write.mode(mode).format(fmt)
    if mode == "overwrite":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    w.saveAsTable(table)
    return WriteResult(table, _rows(obs), mode)


def buckets_for(rows: int, row_bytes: int = 64, target_bytes: int = 256 << 20, least: int = 16) -> int:
    """Buckets (a power of two) that keep each at ``target_bytes`` or less for about ``rows`` rows.

    Tables that are joined need the same number, so take it from the largest of them.
    """
    n = least
    while n * target_bytes < rows * row_bytes:
        n *= 2
    return n


def write_path(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> WriteResult:
    """B1/B2 by location instead of catalog name."""
    observed, obs = _observed(df, f"write:{path}")
    w = observed.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    return WriteResult(path, _rows(obs), mode)


def ensure_schema(spark: SparkSession, *schemas: str) -> None:
    """Namespaces per layer (bronze, silver, gold, vault)."""
    for s in schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {s}")


def write_quarantine(rejected: DataFrame, path: str, fmt: str = "csv") -> int:
    """Always (over)write the current rejected rows, even when there are
    none, so an old quarantine cannot survive a clean run (H8); returns the count."""
    observed, obs = _observed(rejected, f"quarantine:{path}")
    w = observed.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    return _rows(obs)


def write_insert_only(delta: DataFrame, table: str, first_load: bool, fmt: str = "parquet") -> WriteResult:
    """Overwrite on the first load, append afterwards; an empty delta appends nothing."""
    return write_table(delta, table, "overwrite" if first_load else "append", fmt)


def ingest_full(spark: SparkSession, csv_path: str, table: str, ingested_at: str, schema=None, fmt="parquet") -> WriteResult:
    """A3: CSV -> bronze table, replacing it."""
    return write_table(stamp_ingest(read_csv(spark, csv_path, schema), ingested_at), table, "overwrite", fmt)


def ingest_append(spark: SparkSession, csv_path: str, table: str, ingested_at: str, schema=None, fmt="parquet") -> WriteResult:
    """A4: CSV batch appended to an existing bronze table (repeating it appends
    again, H7; the checkpointed stream in :mod:`ledgerloom.streaming` does not)."""
    return write_table(stamp_ingest(read_csv(spark, csv_path, schema), ingested_at), table, "append", fmt)


def _versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the stored versions of a state, ascending."""
    schema, _, name = table.rpartition(".")
    tables = spark.catalog.listTables(schema or None, f"{name}__v*")
    found = [t.name[len(name) + 3 :] for t in tables]
    return sorted(int(v) for v in found if v.isdigit())


def replace_table_state(spark: SparkSession, next_state: DataFrame, table: str, fmt: str = "parquet") -> WriteResult:
    """Persist a full next state (e.g. :func:`~ledgerloom.operators.scd2.apply_scd2`).

    ``table`` is a view on the newest of the tables ``<table>__v<n>``.  The next
    state becomes a table of its own first; then one ``CREATE OR REPLACE VIEW``
    switches readers over, who see the old state or the new one and nothing
    else.  A writer that dies before leaves a table that no view names and that
    the next load replaces.  The state before the last one is dropped then, so
    readers that began on it can end.
    """
    known = _versions(spark, table)
    shown = _shown_version(spark, table)
    new = (shown or 0) + 1
    if spark.catalog.tableExists(table) and shown is None:
        raise ValueError(f"{table} is a plain table; rename it before a state is kept behind that name")
    result = write_table(next_state, f"{table}__v{new}", "overwrite", fmt)
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('version' = '{new}') AS SELECT * FROM {table}__v{new}")
    for old in known:
        if old < new - 1:
            spark.sql(f"DROP TABLE IF EXISTS {table}__v{old}")
    return WriteResult(table, result.rows, "replace")


def view_properties(spark: SparkSession, table: str) -> dict[str, str] | None:
    """Properties of the view ``table``; None without a view of that name."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return None
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _shown_version(spark: SparkSession, table: str) -> int | None:
    """The version that the view shows; None without a view."""
    properties = view_properties(spark, table)
    return None if properties is None else int(properties["version"])


def load_scd2(spark: SparkSession, incoming: DataFrame, table: str, spec, run_date, fmt: str = "parquet") -> WriteResult:
    """Create-or-update an SCD2 dimension table.

    First load (no table): every incoming row becomes an open version.  Later
    loads: the full next state from :func:`~ledgerloom.operators.scd2.apply_scd2`
    takes its place in one switch (no expire-then-insert commits, H3).
    """
    from ..operators.scd2 import apply_scd2

    current = optional_table(spark, table)
    return replace_table_state(spark, apply_scd2(incoming, current, spec, run_date), table, fmt)
