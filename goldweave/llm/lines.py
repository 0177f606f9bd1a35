"""Line deduplication by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.session import Scratch


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """Hash of a line without the blanks around it; null for a blank line, which is never boilerplate."""
    trimmed = F.trim(line)
    return F.when(trimmed != "", F.xxhash64(trimmed))


def _frequent(counts: DataFrame, totals: DataFrame, ratio: float) -> DataFrame:
    """(host, line, pages, host_pages) of the lines on more than ``ratio`` of a host's pages, and on two of them at least."""
    repeated = counts.filter("pages > 1")
    joined = repeated.join(totals, repeated["host"].eqNullSafe(totals["host"]))
    return joined.filter(F.col("pages") > ratio * F.col("host_pages")).select(repeated["host"], "line", "pages", "host_pages")


def _by_host(lines: DataFrame, name: str) -> DataFrame:
    return lines.groupBy(F.col("host").alias("__host")).agg(F.collect_set("line").alias(name))


def boilerplate_lines(
    docs: DataFrame, scratch: Scratch, *, ratio: float = 0.02, copied: float = 0.5, text_column: str = "text", host_column: str = "source",
) -> DataFrame:
    """(host, line, pages, host_pages): hashes of the lines on more than ``ratio`` of a host's pages.

    A page is a distinct text of the host and counts once for a line it
    repeats; a line on one page only is no repeated line. Where lines above
    the ratio hold more than a share ``copied`` of a page's characters, the
    page is not one under a menu but a copy of others with an edit or two: it
    and its lines do not count, neither as a page with the line nor as a page
    of the host. Null hosts are one host. A host has at most (its lines a page
    / ratio) such lines, whatever its size.
    """
    work = Scratch(scratch.spark, "boilerplate")
    line = lambda text: F.struct(_key(text).alias("line"), F.char_length(F.trim(text)).alias("size"))
    found = F.array_distinct(F.filter(F.transform(_lines(F.col(text_column)), line), lambda c: c["line"].isNotNull()))
    # One row for each distinct text, without the text; partial aggregation joins most copies where they are read.
    pages = work.save(docs.filter(F.col(text_column).isNotNull()).select(
        F.col(host_column).alias("host"), F.xxhash64(text_column).alias("page"), found.alias("lines")).groupBy("host", "page").agg(F.first("lines").alias("lines")), "pages")
    count = lambda rows: rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    total = lambda rows: rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    often = work.save(_frequent(count(pages.select("host", F.explode("lines.line").alias("line"))), total(pages), ratio), "often")

    joined = pages.join(_by_host(often, "__often"), F.col("host").eqNullSafe(F.col("__host")), "left")
    framed = F.filter("lines", lambda c: F.coalesce(F.array_contains(F.col("__often"), c["line"]), F.lit(False)))
    size = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda n, c: n + c["size"])
    own = work.save(joined.withColumn("framed", framed).filter(size(F.col("framed")) <= copied * size(F.col("lines"))).select(
        "host", F.col("framed.line").alias("lines")), "own")
    kept = scratch.save(_frequent(count(own.select("host", F.explode("lines").alias("line"))), total(own), ratio), "boilerplate")
    work.close()
    return kept


def drop_boilerplate(
    docs: DataFrame, scratch: Scratch, *, ratio: float = 0.02, copied: float = 0.5, text_column: str = "text", host_column: str = "source",
) -> DataFrame:
    """``docs`` with boilerplate lines cut out of their text, and two columns: n_lines and n_dropped.

    Which lines those are says ``boilerplate_lines``: copies of a document,
    exact or edited, do not make its lines boilerplate. Lines are parts of the
    text between newlines and are compared without blanks around them, by
    64-bit hash. Other lines stay as they are and in order. A null text stays
    null and counts no lines; an empty text is one blank line; a text of any
    length is read whole. Repeated rows are one page and are cut alike. Empty
    input gives an empty result. Columns of the input named n_lines or
    n_dropped are replaced; names that begin with two underscores are taken.
    """
    # Written, so that its true size decides how it is joined and the counting runs once.
    found = boilerplate_lines(docs, scratch, ratio=ratio, copied=copied, text_column=text_column, host_column=host_column)
    drop = F.coalesce(F.col("__drop"), F.array().cast("array<bigint>"))
    lines = _lines(F.col(text_column))
    kept = F.filter(lines, lambda line: ~F.coalesce(F.array_contains(F.col("__drop"), _key(line)), F.lit(False)))
    joined = docs.drop("n_lines", "n_dropped").join(_by_host(found, "__drop"), F.col(host_column).eqNullSafe(F.col("__host")), "left")
    cut = joined.withColumns({
        "__kept": F.when(F.size(drop) > 0, kept).otherwise(lines),
        "n_lines": F.when(F.col(text_column).isNotNull(), F.size(lines)).otherwise(0).cast("long"),
    })
    return cut.withColumns({
        text_column: F.array_join("__kept", "\n"),
        "n_dropped": F.when(F.col(text_column).isNotNull(), F.col("n_lines") - F.size("__kept")).otherwise(0).cast("long"),
    }).drop("__host", "__drop", "__kept")
