"""Operator 6: boilerplate lines by site-relative frequency, with DataFrame functions only.

Within a host, the share of its pages that hold a line is that line's ratio;
lines whose ratio exceeds the limit, on at least ``min_pages`` pages, go.  A
page counts a line once, and pages of equal text count as one: a page that was
copied a thousand times has no boilerplate for that.  Lines shorter than ``min_chars`` are too ordinary to
tell ("Yes.") and stay.  Counts are combined map-side, keyed by host and a
128-bit digest of the trimmed line, so neither a hot host nor a hot line meets
in one task; the pages of lines that come often are then told apart the same way.  Each page then looks up its own lines' digests and is filtered in
place.

Defined results: a null host is no site, so its pages keep every line; null
text stays null; blank lines are never counted or dropped; a page whose lines
all go has empty text.  Rows with equal (host, id, text) get the same result;
null and any text are told apart in each of the three.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored


def line_digest(line: Column, min_chars: int = 1) -> Column:
    """Digest of a line without surrounding spaces; null for a blank or short line."""
    trimmed = F.trim(line)
    return F.when(F.length(trimmed) >= max(1, min_chars), F.md5(trimmed))


def _marked(value: Column) -> Column:
    """A string that tells null from any text, and where it ends."""
    return F.when(value.isNull(), "-").otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = 0.1, min_pages: int = 3, min_chars: int = 1) -> DataFrame:
    """``(host, line, pages, ratio)`` of lines above the limit; line is a digest, one row each."""
    seen = F.array_compact(F.array_distinct(F.transform(lines_of(text), lambda x: line_digest(x, min_chars))))
    page = F.when(text.isNotNull(), F.xxhash64(text))
    each = pages.select(host.alias("host"), page.alias("page"), seen.alias("lines")).where("host IS NOT NULL")
    rows = each.select("host", "page", F.explode("lines").alias("line"))
    # rows with a line are as many as pages with it, or more: few lines come so often, and only their pages are told apart
    often = stored(rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).select("host", "line"), "line-counts")
    held = rows.join(often, ["host", "line"]).groupBy("host", "line").agg(F.count_distinct("page").alias("pages"))
    totals = each.groupBy("host").agg(F.count_distinct("page").alias("total"))
    shares = held.where(F.col("pages") >= min_pages).join(totals, "host").withColumn("ratio", F.col("pages") / F.col("total"))
    return shares.where(F.col("ratio") > ratio).select("host", "line", "pages", "ratio")


def drop_boilerplate(
    pages: DataFrame, host: Column, id: str = "doc_id", text: str = "text", ratio: float = 0.1, min_pages: int = 3, min_chars: int = 1, dropped: str | None = None
) -> DataFrame:
    """``pages`` with boilerplate lines cut from ``text``; ``dropped``: optional column for their number.

    A row is found again by a digest of (host, id, text), under which equal rows share one set of lines.
    """
    row, at, known, lines, hits = (fresh(n, pages) for n in ("_row", "_host", "_known", "_lines", "_hits"))
    common = stored(boilerplate(pages, host, F.col(text), ratio, min_pages, min_chars), "boilerplate")
    key = F.md5(F.concat(_marked(host.cast("string")), _marked(F.col(id).cast("string")), _marked(F.md5(text))))
    tagged = pages.withColumn(row, key)
    digests = F.array_compact(F.array_distinct(F.transform(lines_of(F.col(text)), lambda x: line_digest(x, min_chars))))
    own = pages.select(key.alias(row), host.alias(at), F.explode(digests).alias(known))
    found = own.join(common.select(F.col("host").alias(at), F.col("line").alias(known)), [at, known])
    found = found.groupBy(row).agg(F.collect_set(known).alias(hits))  # at most the page's own lines
    none = F.array().cast("array<string>")
    out = tagged.join(found, row, "left").withColumn(lines, lines_of(F.col(text)))
    keep = F.filter(F.col(lines), lambda x: ~F.coalesce(F.array_contains(F.coalesce(hits, none), line_digest(x, min_chars)), F.lit(False)))
    cleaned = F.when(F.col(hits).isNull(), F.col(text)).otherwise(F.array_join(keep, "\n"))
    extra = [(F.size(lines_of(F.col(text))) - F.size(keep)).cast("bigint").alias(dropped)] if dropped else []
    return out.select(*[cleaned.alias(c) if c.lower() == text.lower() else F.col(c) for c in pages.columns], *extra)
