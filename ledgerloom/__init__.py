"""ledgerloom: Spark-native operators for a ledger-style lakehouse.

Layers: ``sources`` (scans, sinks, seed relations, test-table mapping),
``functions`` (Column -> Column helpers), ``operators`` (DataFrame -> DataFrame
transforms: clean, conform, marts, calendar, SCD2, facts, vault, checks),
``plans`` (layer builds and the named query registry) and ``streaming``
(checkpointed incremental ingest).

Every operator is a pure DataFrame function over built-in Spark expressions.
Dates, run dates and load timestamps are arguments, never the clock.
"""

__all__ = ["session"]
