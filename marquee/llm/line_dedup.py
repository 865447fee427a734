"""Removal of a site's boilerplate lines by their frequency on the site's pages. DataFrame functions only.

A line's share is the number of the host's pages that contain it, divided by
the host's pages. Lines over the share are dropped from all pages of that
host. Pages' distinct lines are counted as 64-bit hashes with partial
aggregation; a host's boilerplate hashes number at most (lines per page) /
(share), so they are kept as one small array per host and joined to the pages: texts
are shuffled only when those written arrays are too large to broadcast, and
then a hot host is split by Spark's skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.plans.materialize import materialize

BOILERPLATE_SHARE = 0.02
LEAST_PAGES = 5


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def is_blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\x0b\x0c\r", "    ")) == ""


def boilerplate(pages: DataFrame, host: str, text: str, share: float = BOILERPLATE_SHARE,
                least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(host, hashes)``: the hashes of each host's lines on more than ``share`` of its pages.

    Lines on fewer than ``least_pages`` pages and blank lines are never boilerplate.
    """
    own = pages.select(F.col(host).alias("host"), F.col(text).alias("text"))
    total = own.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    full = F.filter(lines(F.col("text")), lambda x: ~is_blank(x))
    hashes = own.select("host", F.explode(F.array_distinct(F.transform(full, lambda x: F.xxhash64(x)))).alias("h"))
    counts = (hashes.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= least_pages))
    total = materialize(total.withColumnRenamed("host", "t_host"), "host_pages")
    over = counts.join(total, F.col("host").eqNullSafe(F.col("t_host"))).filter(
        F.col("n") > F.lit(share) * F.col("pages"))
    return over.groupBy("host").agg(F.collect_list("h").alias("hashes"))


def line_dedup(pages: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
               share: float = BOILERPLATE_SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(id, host, text, n_lines, n_dropped)`` of every page, its boilerplate lines dropped.

    Lines end at line feeds and are compared whole. A null text counts as
    empty (one empty line); pages of null host are one host; a null id stays null;
    repeated rows are pages of their own; an empty table gives no rows; other columns are ignored.
    """
    found = materialize(boilerplate(pages, host, text, share, least_pages)
                        .select(F.col("host").alias("b_host"), "hashes"), "boilerplate")
    own = pages.select(F.col(id).alias("id"), F.col(host).alias("host"), lines(F.col(text)).alias("ls"))
    marked = own.join(found, F.col("host").eqNullSafe(F.col("b_host")), "left")
    # Null hashes: the host has no boilerplate.
    kept = F.when(F.col("hashes").isNull(), F.col("ls")).otherwise(
        F.filter("ls", lambda x: is_blank(x) | ~F.array_contains(F.col("hashes"), F.xxhash64(x))))
    out = marked.select("id", "host", F.size("ls").cast("bigint").alias("n_lines"), kept.alias("kept"))
    return out.select("id", "host", F.array_join("kept", "\n").alias("text"), "n_lines",
                      (F.col("n_lines") - F.size("kept")).alias("n_dropped"))
