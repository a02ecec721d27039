"""Calendar operators (inventory E7 S1 A10 J8 J8b J13, I7-I13 I16 I20 I22).

The date dimension is bounded by the calendar span, not by data volume, so it
is generated from a one-row frame.  The month spine is an ``explode`` per
account (narrow, no shuffle); the through-month is a one-row aggregate read
as a scalar subquery instead of being pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_key, iso_dow


def date_bounds(*dates: DataFrame) -> DataFrame:
    """E7 + S1: one row ``(start, end)`` = first of the earliest month, last day of the latest.

    Each input is a one-column frame of dates; they are unioned positionally.
    """
    if not dates:
        raise ValueError("date_bounds needs at least one date column")
    first, *rest = [d.select(F.col(d.columns[0]).cast("date").alias("d")) for d in dates]
    for d in rest:
        first = first.union(d)
    return first.agg(F.trunc(F.min("d"), "month").alias("start"), F.last_day(F.max("d")).alias("end"))


def date_dim(bounds: DataFrame) -> DataFrame:
    """One row per day in ``[start, end]`` with the calendar attributes."""
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    dow = iso_dow(d)
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        (dow >= 6).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
    )


def type_dim(transaction_types: DataFrame) -> DataFrame:
    """Transaction-type dimension (id renamed to key)."""
    return transaction_types.select(
        F.col("transaction_type_id").alias("transaction_type_key"), "type_name", "direction", "description"
    )


def month_spine(entities: DataFrame, open_col: str, through: DataFrame, through_col: str = "through") -> DataFrame:
    """One row per entity and month from its opening month to ``through``.

    ``through`` is a one-row frame, read as a scalar subquery (evaluated once,
    no join); an entity opened after it gets a single
    row for its own opening month (and so does every entity when ``through``
    is NULL, H23).  Adds ``_month``, ``_month_end`` and ``date_key``.
    """
    start = F.trunc(F.col(open_col), "month")
    last = F.greatest(start, through.select(through_col).scalar())  # skips a NULL through
    span = F.months_between(last, start).cast("int")
    # an entity without an opening month keeps one undated row
    return (
        entities.withColumn("_k", F.explode(F.sequence(F.lit(0), F.coalesce(span, F.lit(0)))))
        .withColumn("_month", F.add_months(start, F.col("_k")))
        .drop("_k")
        .withColumn("_month_end", F.last_day("_month"))
        .withColumn("date_key", date_key("_month_end"))
    )


def through_month(dates: DataFrame, col: str | Column, name: str = "through") -> DataFrame:
    """One-row frame: first day of the month of the latest date (NULL if none)."""
    c = F.col(col) if isinstance(col, str) else col
    return dates.agg(F.trunc(F.max(c), "month").alias(name))
