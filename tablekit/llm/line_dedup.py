"""Line dedup by site-relative frequency (DataFrame functions only).

A line is boilerplate of its host when the share of the host's pages that
contain it exceeds ``max_ratio`` and at least ``min_pages`` pages contain it.
Lines compare after trimming blanks (a carriage return or tab tells two
lines apart); blank lines are never boilerplate.

Counts are taken over all rows: every page sends each of its distinct lines
once, as a 128-bit hash, summed map-side before the shuffle, so a hot host or
a line on a third of all pages costs one row per map task.  Per host the
boilerplate list is short by construction (the shares of a page's lines sum
to its line count, so a host has at most mean lines per page / max_ratio
boilerplate lines).  The lists are written to the shared scratch folder, so
the planner knows their size: small lists are broadcast, others meet the
documents in a join whose hot host AQE splits.

Defined results: null text stays null; an empty text stays empty; a null host
is no site, its rows pass unchanged; rows are pages, so repeated rows count
as often as they occur; a page whose lines all go keeps an empty text; extra
columns pass through, but for those named like a report column; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import col, fresh
from tablekit.session import materialize

MAX_RATIO = 0.1
MIN_PAGES = 5


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate_lines(pages: DataFrame, host: str = "source", text: str = "text",
                      max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines array<struct<a,b>>): the hashes of each host's boilerplate lines."""
    rows = pages.select(col(host).alias("host"), col(text).alias("text")).where(F.col("host").isNotNull())
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = rows.select("host", F.explode(F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)))).alias("line"))
    counts = (lines.where(F.col("line") != "")
              .groupBy("host", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))
              .agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_pages))
    over = counts.join(totals, "host").where(F.col("n") / F.col("pages") > F.lit(max_ratio))
    return over.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("lines"))


def drop_boilerplate_lines(pages: DataFrame, host: str = "source", text: str = "text",
                           max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                           report: tuple[str, str] | None = None) -> DataFrame:
    """``pages`` with boilerplate lines cut out of ``text``.  ``report`` names
    two more columns: the number of lines, and of those removed; input columns
    of those names are replaced."""
    host_key, bad, split = fresh(pages, "host", "bad", "split")
    listed = materialize(boilerplate_lines(pages, host, text, max_ratio, min_pages), "boilerplate")
    listed = listed.select(F.col("host").alias(host_key), F.col("lines").alias(bad))
    lines = F.split(col(text), "\n", -1)
    joined = (pages.join(listed, col(host) == F.col(host_key), "left")
              .withColumn(split, F.when(F.col(bad).isNotNull(), F.filter(
                  lines, lambda x: ~F.array_contains(F.col(bad), _key(F.trim(x)))))))
    kept = F.when(F.col(bad).isNull(), col(text)).otherwise(F.array_join(F.col(split), "\n"))
    named = {x.lower() for x in report or ()} - {text.lower()}
    out = [kept.alias(text) if c == text else col(c) for c in pages.columns if c.lower() not in named]
    if report:
        total = F.coalesce(F.size(lines), F.lit(0))
        total = F.when(col(text).isNull(), 0).otherwise(total)
        left = F.when(F.col(bad).isNull() | col(text).isNull(), total).otherwise(F.size(F.col(split)))
        out += [total.cast("long").alias(report[0]), (total - left).cast("long").alias(report[1])]
    return joined.select(*out)
