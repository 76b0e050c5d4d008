"""URL filters that hold for redirect aliases.

Rules name a host and the start of a path and fit the host and its subdomains.
Canonical links, refresh tags and given redirects join urls into classes of
aliases (connected components).  A url without a rule of its own is blocked when
a url of its class is blocked by a rule and none is allowed by one.

Two urls are the same when host, path and query are, whatever the scheme, the
letter case of the host, and the fragment.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule and no alias, and is allowed; a null page has no links; links to null
or to other schemes are ignored; repeated rows are each judged; an empty table
gives an empty result; columns other than the three named ones are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stage, take_columns
from .components import components

BIG, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: ``canonical`` as any token of the rel attribute.
CANONICAL = (r"(?i)\srel\s*=\s*(?:\"(?:[^\">]*\s)?canonical[\s\">]|'(?:[^'>]*\s)?canonical[\s'>]|canonical[\s/>])")


class Rule(NamedTuple):
    """``text``: host and start of the path, as ``example.com/de/``."""

    text: str
    verdict: str


#: Fixed values of the contract.
RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, BIG, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(url: Column) -> Column:
    """Host, path and query; null without a host."""

    def joined(u: Column) -> Column:
        query = F.regexp_extract(u, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
        return bind(F.array(host_of(u), path_of(u)), lambda p: F.when(
            p[0] != "", F.concat(p[0], p[1], query)))

    return bind(url, joined)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as its text; of equal texts an allowing one."""
    found = None
    for rule in sorted(set(rules), key=lambda r: (-len(r.text), r.verdict)):
        name, slash, start = rule.text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        found = F.when(fits, rule.text) if found is None else found.when(fits, rule.text)
    return F.lit(None).cast("string") if found is None else found


def verdict_of(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    first: dict[str, str] = {}
    for r in sorted(set(rules), key=lambda r: r.verdict):
        first.setdefault(r.text, r.verdict)
    found = F.lit(None).cast("string")
    for text, verdict in first.items():
        found = F.when(rule == text, verdict).otherwise(found)
    return found


def absolute(link: Column, url: Column) -> Column:
    """A link as an absolute url, seen from the page at ``url``."""

    def resolved(x: Column) -> Column:
        scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
        site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
        folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
        return (F.when(F.coalesce(x, F.lit("")) == "", None)
                .when(x.rlike(r"(?i)^https?://"), x)
                .when(x.startswith("//"), F.concat(scheme, F.lit(":"), x))
                .when(x.startswith("/"), F.concat(site, x))
                .when(x.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|#)"), None)
                .when(x.startswith("?"), F.concat(site, path_of(url), x))
                .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), x)))

    return bind(F.regexp_replace(F.trim(link), "&amp;", "&"), resolved)


def links_of(pages: DataFrame) -> DataFrame:
    """url, link: canonical and refresh targets in the pages' head tags."""
    tags = F.transform(F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0)),
                       lambda t: F.regexp_replace(t, r"(=\s*(?:\"[^\"]*\"|'[^']*'))", "$1 "))  # no space need follow a closing quote
    tags = F.filter(tags, lambda t: t.rlike(CANONICAL)
                    | t.rlike(r"(?i)\shttp-equiv\s*=\s*[\"']?\s*refresh\b"))
    rows = pages.where(F.col("url").isNotNull() & F.col("html").isNotNull()).select("url", F.explode(tags).alias("tag"))
    href = F.regexp_extract("tag", r"(?i)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", 0)
    href = F.regexp_replace(href, r"(?i)^\s*href\s*=\s*|[\"']", "")
    refresh = F.regexp_extract("tag", r"(?i)\burl\s*=\s*[\"']?([^\"'>]+)", 1)
    is_link = F.col("tag").rlike(r"(?i)^<link\s")
    return rows.select("url", F.when(is_link, href).otherwise(refresh).alias("link"))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """u, v: keys of urls that stand for each other.  ``redirects``: from_url, to_url."""
    seen = links_of(pages).select(F.col("url").alias("a"), absolute(F.col("link"), F.col("url")).alias("b"))
    if redirects is not None:
        seen = seen.unionByName(redirects.select(F.col("from_url").alias("a"), absolute(F.col("to_url"), F.col("from_url")).alias("b")))
    edges = seen.select(key_of(F.col("a")).alias("u"), key_of(F.col("b")).alias("v")).distinct()
    return edges.where(F.col("u") != F.col("v"))


def blocked_aliases(edges: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key``: the urls whose class is blocked by a rule and not allowed by one."""
    nodes = components(edges)
    url = F.concat(F.lit("any://"), F.col("node"))
    nodes = stage(nodes.withColumn("verdict", verdict_of(rule_of(host_of(url), path_of(url), rules), rules)), "alias-nodes")
    bad = nodes.groupBy("root").agg(F.max((F.col("verdict") == "block").cast("int")).alias("block"),
                                    F.max((F.col("verdict") == "allow").cast("int")).alias("allow"))
    bad = bad.where((F.col("block") == 1) & (F.coalesce("allow", F.lit(0)) == 0)).select("root")
    return nodes.where(F.col("verdict").isNull()).join(bad, "root", "left_semi").select(F.col("node").alias("key"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict per row."""
    own = take_columns(pages, page_id=id_col, url=url_col, html=html_col)
    bad = stage(blocked_aliases(stage(alias_edges(own, redirects), "alias-edges"), rules), "blocked-aliases")
    rows = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                      key_of(F.col("url")).alias("key"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.join(bad.withColumn("aliased", F.lit(True)), "key", "left")
    by_class = F.when(F.col("aliased"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule",
                       F.coalesce(verdict_of(F.col("rule"), rules), by_class).alias("verdict"))
