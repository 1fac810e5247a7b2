"""Line dedup by site-relative frequency.

Lines of a page's text are counted per host (once a page); a line's count
divided by the host's pages is its share, and lines whose share is over
``ratio`` are boilerplate and dropped from that host's pages. A line that
stands on one page alone is no boilerplate, whatever its share; beyond that the
ratio decides for hosts of every size.

What is counted is (host, MD5 of the line), summed before it is shuffled. A
host's boilerplate has at most (its lines per page / ratio) entries, so it
is kept as one array a host, and pages are joined with it by host: one row
on the right for each host, both sides read from written tables, so adaptive
execution can split a host that holds a third of all pages. DataFrame
functions only.

Defined results: a null html has no lines and an empty text; a null url, or
one without a host, counts as the host ''; lines are trimmed of ASCII white
space, blank ones are left out; a line is counted once a page however often
the page repeats it, and dropped everywhere on it; repeated rows count as
pages of their own; an empty table gives an empty table; columns other than
the three named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import WHITE, stage

#: Removed with their content; ends of these start a new line; other tags vanish.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>"
BREAKS = r"(?i)</?(?:p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|article|section|header|footer|nav|main|aside|title|body|html)\b[^>]*>"
TAGS = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def page_lines(html: Column) -> Column:
    """The trimmed lines of a page's visible text, blank ones left out."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)))
    return F.filter(lines, lambda x: x != "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def drop_boilerplate(
    pages: DataFrame,
    ratio: float = 0.3,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row a page: ``page_id, host, host_pages, n_lines, n_dropped, text`` (what is left, lines joined)."""
    cut = stage(
        pages.select(
            F.col(id_col).cast("long").alias("page_id"),
            host_of(F.col(url_col)).alias("host"),
            page_lines(F.col(html_col)).alias("lines"),
        )
    )
    hosts = stage(cut.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")))
    seen = cut.select("host", F.explode(F.transform(F.array_distinct("lines"), lambda x: F.md5(x))).alias("line"))
    # Most lines stand on one page and go here, before the join.
    counts = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = counts.join(hosts, "host")
    often = often.where(F.col("n") > F.lit(ratio) * F.col("host_pages"))
    by_host = often.groupBy("host").agg(F.collect_list("line").alias("often"))
    right = stage(hosts.join(by_host, "host", "left"))
    found = cut.join(right, "host").withColumn("bad", F.coalesce("often", F.array().cast("array<string>")))
    # Only the page's own boilerplate is looked for line by line.
    found = found.withColumn("bad", F.array_intersect(F.transform("lines", lambda x: F.md5(x)), F.col("bad")))
    left = F.filter("lines", lambda x: ~F.array_contains(F.col("bad"), F.md5(x)))
    found = found.withColumn("left", F.when(F.size("bad") == 0, F.col("lines")).otherwise(left))
    return found.select(
        "page_id",
        "host",
        "host_pages",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"),
        F.array_join("left", "\n").alias("text"),
    )
