"""URL rules, and their spread to other addresses of the same page."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentflow.llm.components import connected_components
from patentflow.storage import stage

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Host: after the first "://" to one of /?# or the end; path: from there to one of ?# or the end.
HOST_AND_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*(\?[^#]*)"
IS_ALIASED = r"(?is)<(?:link|meta)\b[^>]*(?:canonical|refresh)"
TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?is)\brel\s*=\s*["']?canonical\b"""
REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_URL = r"""(?is)\bcontent\s*=.*?\burl\s*=\s*["']?([^"'\s>]+)"""


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, and paths with a prefix that starts with a slash."""

    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is NULL or has no "://"."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, HOST_AND_PATH, 1), UPPER, LOWER)
    return host, F.regexp_extract(url, HOST_AND_PATH, 2)


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (length, allows, rule, verdict) of the longest fitting rule, else NULL.

    Of equally long rules an allowing one wins. The rules are a list of the caller, small enough to be
    part of the plan, and are tried on each row without a join.
    """
    fitting = []
    for rule in rules:
        fits = (host == rule.host) | host.endswith(f".{rule.host}")
        found = F.struct(
            F.lit(len(rule.host) + len(rule.path)).alias("length"),
            F.lit(rule.verdict == ALLOW).alias("allows"),
            F.lit(rule.host + rule.path).alias("rule"),
            F.lit(rule.verdict).alias("verdict"),
        )
        fitting.append(F.when(fits & path.startswith(rule.path), found))
    return F.array_max(F.array(*fitting))


def address(url: Column) -> Column:
    """What tells pages apart: host, path and query. Scheme and fragment do not; an empty path is "/"."""
    host, path = host_and_path(url)
    path = F.when(path == "", "/").otherwise(path)
    return F.when(host != "", F.concat(host, path, F.regexp_extract(F.coalesce(url, F.lit("")), QUERY, 1)))


def resolved(link: Column, url: Column) -> Column:
    """A link as an absolute url, seen from the page's own url. Dot segments stay as they are."""
    host, path = host_and_path(url)
    site = F.concat(F.lit("http://"), host)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (
        F.when(F.regexp_like(link, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?") | link.startswith("#"), F.concat(site, path, link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(address, alias): canonical links and refresh redirects stated in the html of `pages(url, html)`."""
    tags = F.filter(
        F.regexp_extract_all("html", F.lit(TAGS), F.lit(0)), lambda tag: tag.rlike(CANONICAL) | tag.rlike(REFRESH)
    )
    stated = pages.where(F.col("html").rlike(IS_ALIASED)).select("url", F.explode(tags).alias("tag"))
    link = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).otherwise(
        F.regexp_extract("tag", REFRESH_URL, 1)
    )
    links = stated.select("url", F.replace(link, F.lit("&amp;"), F.lit("&")).alias("link")).where("link <> ''")
    return links.select(
        address(F.col("url")).alias("address"), address(resolved(F.col("link"), F.col("url"))).alias("alias")
    )


def blocked_addresses(links: DataFrame, rules: list[Rule]) -> DataFrame:
    """Distinct addresses that are linked, over any number of links, with one that a rule blocks.

    Links join addresses in both directions. An address with a rule of its own may be among them; its
    own rule takes precedence later.
    """
    known = links.where("address IS NOT NULL AND alias IS NOT NULL AND address <> alias")
    groups = stage(connected_components(known))
    host, path = host_and_path(F.concat(F.lit("http://"), F.col("id")))
    ruled = groups.withColumn("rule", best_rule(host, path, rules))
    bad = ruled.where(F.col("rule.verdict") == BLOCK).select("component").distinct()
    return groups.join(bad, "component", "left_semi").select(F.col("id").alias("address"))


def url_verdicts(
    pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None, id_col: str = "page_id"
) -> DataFrame:
    """id, host, path, rule, verdict of each row of `pages(id, url, html)`.

    The longest fitting rule decides. A page that no rule fits is blocked if redirects or canonical links
    connect it with an address that a rule blocks, and else allowed; so an explicit allow always holds for
    its own pages. `redirects(address, alias)` adds redirects known from a crawl, as urls. NULL urls, urls
    without "://" and NULL html are allowed rows without links. Repeated rows and ids are each judged; an
    empty table gives no rows.
    """
    links = page_links(pages)
    if redirects is not None:
        source, target = (address(F.col(name)).alias(name) for name in ("address", "alias"))
        links = links.unionByName(redirects.select(source, target))
    bad = blocked_addresses(links, rules).withColumn("is_blocked", F.lit(True))
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), address(F.col("url")).alias("address"))
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("best.verdict", F.when(F.col("is_blocked"), BLOCK), F.lit(ALLOW))
    joined = rows.join(bad, "address", "left")
    return joined.select(id_col, "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
