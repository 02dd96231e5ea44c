"""URL filters with redirect equivalence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import lower_ascii
from basketry.llm.components import connected_components
from basketry.materialize import stored

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'>]+)"""
#: Query parameters that name a visit, not a page.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical_url(url: Column) -> Column:
    """The address without scheme, fragment, tracking parameters and ``www.``; null without ``://``."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)^.*?://", ""), r"(?s)#.*$", "")
    bare = F.regexp_replace(bare, rf"(?<=[?&]){TRACKING}=[^&]*(?:&|$)", "")
    bare = F.regexp_replace(bare, r"[?&]$", "")
    cut = F.regexp_extract(bare, r"(?s)^([^/?]*)(.*)$", 1)
    host = F.regexp_replace(lower_ascii(cut), r"^www\.", "")
    rest = F.regexp_extract(bare, r"(?s)^([^/?]*)(.*)$", 2)
    return F.when(url.contains("://"), F.concat(F.lit("//"), host, rest))


def page_edges(pages: DataFrame) -> DataFrame:
    """``a, b``: addresses that lead to the same page. A page leads to its canonical form, to its
    canonical link and to its meta refresh target; relative targets are completed from the page."""
    url = F.col("url")

    def target(tag: str, value: str) -> Column:
        found = F.trim(F.regexp_extract(F.regexp_extract("html", tag, 0), value, 1))
        site = F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit("://"), host_of(url))
        scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
        full = (
            F.when(found.contains("://"), found)
            .when(found.startswith("//"), F.concat(scheme, found))
            .when(found.startswith("/"), F.concat(site, found))
        )
        return canonical_url(full)

    ends = F.array_compact(F.array(canonical_url(url), target(_CANONICAL, _HREF), target(_REFRESH, _REFRESH_URL)))
    return pages.where(url.contains("://")).select(url.alias("a"), F.explode(ends).alias("b"))


def match_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict`` for the distinct ``host, path`` that fit a rule.

    A rule (``rule_host, rule_path, rule_verdict``) fits its host and all subdomains if the path
    starts with the rule's; the longest wins. A host meets the rules through its own suffixes, an
    equi-join with as many rows as the host has labels.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    rule = F.concat("rule_host", "rule_path")
    return (
        addresses.select("host", "path").where("host != ''").distinct()
        .select("host", "path", F.explode(F.array_distinct(suffixes)).alias("rule_host"))
        .join(rules, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), "rule_verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.rule_verdict")
    )


def filter_pages(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for every row of ``pages``.

    A page with a rule has that rule's verdict. Any other page follows its aliases: the connected
    component of its address over canonical links, refreshes and ``redirects`` (``a, b``, addresses
    as in ``url``). It is blocked if some address there is blocked by a rule and none is
    explicitly allowed; an explicit allow takes precedence. Without a decision it is allowed.

    A null address or one without ``://`` has empty host and path, no aliases, and is allowed. Repeated
    rows each get the same verdict. Empty input gives an empty result.
    """
    full = pages.withColumn("url", F.col("url").cast("string"))
    if "html" not in full.columns:
        full = full.withColumn("html", F.lit(None).cast("string"))
    edges = page_edges(full.select("url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")))
    if redirects is not None:
        edges = edges.union(
            redirects.select(
                F.explode(F.array(F.struct("a", canonical_url(F.col("b")).alias("b")), F.struct("a", canonical_url(F.col("a")).alias("b")))).alias("e")
            ).select("e.a", "e.b")
        )
    members = stored(connected_components(stored(edges.distinct(), "edges")), "members")
    judged = members.select(
        "node", "component", host_of(_rooted("node")).alias("host"), path_of(_rooted("node")).alias("path")
    )
    mine = full.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fits = stored(match_rules(judged.select("host", "path").union(mine.select("host", "path")), rules), "fits")
    decided = (
        judged.join(fits, ["host", "path"])
        .groupBy("component")
        .agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"))
        .where("not allowed")
        .select("component", F.lit(True).alias("blocked"))
    )
    aliases = members.join(decided, "component").select(F.col("node").alias("alias"), "blocked")
    return (
        mine.join(fits, ["host", "path"], "left")
        .join(aliases, F.col("url") == F.col("alias"), "left")
        .select(
            "page_id", "url", "host", "path", "rule",
            F.coalesce("rule_verdict", F.when(F.col("blocked"), F.lit("block")), F.lit("allow")).alias("verdict"),
        )
    )


def _rooted(node: str) -> Column:
    """An address whose scheme was cut off has one again."""
    return F.when(F.col(node).startswith("//"), F.concat(F.lit("http:"), F.col(node))).otherwise(F.col(node))
