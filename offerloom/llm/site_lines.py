"""Line dedup by site-relative frequency.

Pages are grouped by host. A line's ratio is the number of the host's pages that
contain it, divided by the number of the host's pages. Lines over `ratio` that at least
`LEAST_HOLDERS` pages contain are boilerplate; what a single page says never is. A host has at most (its mean number of lines per page) / ratio of them,
so its list is small whatever its number of pages, and pages meet that list, not
each other. Counts combine before the shuffle, and hosts and lists are written
tables, so Spark splits the join at a host with very many pages.

Defined results: a null or empty html has no lines and stays an empty text; a null
url, or one without a host, belongs to the empty host; hosts of fewer than
`least_pages` pages lose nothing; a line counts once per page and goes at all its
places; repeated rows are pages of their own; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.urls import host_of
from offerloom.session import staged

RATIO = 0.1
LEAST_PAGES = 5
LEAST_HOLDERS = 2
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BLOCK = (
    r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|td|th|table|article|aside|nav|footer|header|section|main|title|head|body|html)\b[^>]*>"
)
ANY_TAG = r"<[^>]*>"
BLANKS = r"[ \t\r\f]+"
# Character references, the ampersand last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def lines_of(html: Column) -> Column:
    """The visible lines of a page: block elements break lines, other tags vanish."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    out = F.regexp_replace(F.regexp_replace(out, BLOCK, "\n"), ANY_TAG, "")
    for reference, char in REFERENCES:
        out = F.replace(out, F.lit(reference), F.lit(char))
    out = F.regexp_replace(out, BLANKS, " ")
    return F.filter(F.transform(F.split(out, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): each host's lines over the ratio, from a frame (host, lines) of pages."""
    totals = staged(pages.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages), "hosts")
    # pages learn their host's size before they are cut into lines, so the counts need no join of their own
    sized = pages.join(totals, "host").select("host", "pages", F.explode(F.array_distinct("lines")).alias("line"))
    frequent = (F.col("count") >= LEAST_HOLDERS) & (F.col("count") > ratio * F.col("pages"))
    over = sized.groupBy("host", "pages", "line").count().filter(frequent)
    return staged(over.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("common")), "boilerplate")


def site_dedup(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, host, n_lines, n_dropped, text) of each page (page_id, url, html)."""
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"))
    cut = staged(cut, "page-lines")
    common = boilerplate(cut.select("host", "lines"), ratio, least_pages)
    # the page's own boilerplate first, by a hash set of the host's list: lines meet that short list only
    own = F.coalesce(F.array_intersect("lines", "common"), F.array().cast("array<string>"))
    return (
        cut.join(common, "host", "left")
        .withColumn("own", own)
        .withColumn("kept", F.filter("lines", lambda line: ~F.array_contains("own", line)))
        .select(
            "page_id",
            "host",
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
            F.array_join("kept", "\n").alias("text"),
        )
    )


def report(found: DataFrame) -> DataFrame:
    """`site_dedup` with the kept text's SHA-256 in place of the text."""
    return found.withColumn("text_sha256", F.sha2("text", 256)).drop("text")
