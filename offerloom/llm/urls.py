"""URL filters with redirect equivalence.

Rules name a host and a path; a rule fits its host and all subdomains if the url's
path starts with the rule's, and the longest fitting rule decides. Urls without a
rule take the decision of their aliases: canonical links and refreshes found in the
pages, and any further redirects, are edges of a graph of urls, and a component in
which a url is blocked blocks the others. A page's own rule comes first, so an
explicit allow holds against a blocked alias, and is not handed on.

Defined results: a null url, or one without "://", has an empty host and path, no
rule and no alias; pages of the same url share their verdict; null html has no
links; equally long rules: the longer host, then allow; rows that repeat get a row
each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.components import components
from offerloom.llm.frames import ascii_lower
from offerloom.session import staged

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TAG = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = r"(?i)\brel\s*=\s*[\"']?canonical\b"
REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def after_scheme(url: Column) -> Column:
    """What follows the first "://"; empty if there is none."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def key_of_rest(rest: Column) -> Column:
    return F.concat(ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


def key_of(url: Column) -> Column:
    """A url as a node: without scheme and fragment, its host in lower case."""
    return key_of_rest(after_scheme(url))


def rule_frame(like: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return like.sparkSession.createDataFrame(list(rules), "verdict string, rule_host string, rule_path string")


def ruled(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct hosts and paths that a rule fits.

    `rules` is a frame (verdict, rule_host, rule_path), looked up by each suffix of a host.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    each = sites.filter("host <> ''").select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
    rule = F.concat("rule_host", F.substring("rule_path", 1, 1_000_000))
    best = F.struct(
        F.length(rule).alias("size"),
        F.length("rule_host").alias("host_size"),
        (F.col("verdict") == "allow").alias("allow"),
        rule.alias("rule"),
        "verdict",
    )
    found = each.join(rules, "rule_host").filter(F.startswith(F.col("path"), F.col("rule_path")))
    return found.groupBy("host", "path").agg(F.max(best).alias("best")).select("host", "path", "best.rule", "best.verdict")


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): url keys that canonical links and refreshes of (url, html) make equal."""
    tags = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(TAG), F.lit(0))
    links = pages.select("url", F.explode(tags).alias("tag"))
    to = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(
        F.col("tag").rlike(REFRESH), F.regexp_extract("tag", TARGET, 1)
    )
    links = links.select("url", to.alias("to")).filter("to <> ''").withColumn("rest", after_scheme(F.col("url")))
    to, rest = F.col("to"), F.col("rest")
    scheme = F.concat(F.substring_index("url", "://", 1), F.lit(":"))
    links = links.withColumn("site", F.concat(scheme, F.lit("//"), F.regexp_extract(rest, r"^[^/?#]*", 0)))
    folder = F.regexp_extract(rest, r"^[^/?#]*(/(?:[^?#]*/)?)", 1)
    whole = (
        F.when(to.contains("://"), to)
        .when(F.startswith(to, F.lit("//")), F.concat(scheme, to))
        .when(F.startswith(to, F.lit("/")), F.concat("site", to))
        .otherwise(F.concat("site", F.when(folder == "", "/").otherwise(folder), to))
    )
    # written, as tags are read by costly patterns that would else be repeated in each expression below
    links = staged(links.filter("rest <> ''").select("rest", "site", "to", whole.alias("whole")), "links")
    links = staged(links.select(key_of_rest(rest).alias("a"), key_of(F.col("whole")).alias("b")), "url-keys")
    return links.filter("a <> '' and b <> ''")


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page; `redirects` is a frame (url, to_url)."""
    rules = rules if isinstance(rules, DataFrame) else rule_frame(pages, rules)
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(key_of(F.col("url")).alias("a"), key_of(F.col("to_url")).alias("b")))
    nodes = staged(components(edges), "aliases")
    # a node is judged by its own host and path, whether or not it was crawled
    as_url = F.concat(F.lit("any://"), F.col("id"))
    nodes = nodes.select("id", "component", host_of(as_url).alias("host"), path_of(as_url).alias("path"))
    blocked = (
        nodes.join(staged(ruled(nodes, rules), "node-rules").filter("verdict = 'block'"), ["host", "path"])
        .select("component")
        .distinct()
    )
    tainted = staged(nodes.join(blocked, "component").select(F.col("id").alias("key")), "blocked-aliases")

    url = F.col("url")
    sites = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key"))
    verdicts = staged(ruled(sites, rules), "rules")
    return (
        sites.join(verdicts, ["host", "path"], "left")
        .join(tainted.withColumn("by_alias", F.lit("block")), "key", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("verdict", "by_alias", F.lit("allow")).alias("verdict"))
    )
