"""URL filters with redirect equivalence (operator 8).

A page whose own url fits a rule gets that rule's verdict (the longest rule;
allow before block among equals).  Other pages ask their aliases: redirects
(``<meta http-equiv=refresh>``) and canonical links are edges between urls,
and distributed connected components over them give classes of equivalent
urls.  If a url of the class is blocked by a rule, so are the members without
a rule of their own, unless some member is explicitly allowed: an explicit
allow takes precedence.  Urls that differ only in scheme, fragment or the case
of the host are one node.

Rules are a configuration list (at most MAX_RULES); pages, links, nodes and
components stay distributed.  Tags may be of any length; a link is canonical if
``canonical`` is one of the words of its ``rel``.  Targets are resolved against
the page's first ``<base href>``, else its url; ``./`` and ``../`` are taken out of
their paths.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and has no aliases (allow).  Null html has no links.
Repeated rows get equal verdicts.  An empty table gives an empty table."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import materialise
from tracewise.llm.components import connected_components

MAX_RULES = 1000
DEFAULT = "allow"

Rule = tuple[str, str, str]  # verdict, host, path


def parse_rule(line: str) -> Rule:
    """``"block example.com/en/"`` -> ("block", "example.com", "/en/")."""
    verdict, _, url = line.partition(" ")
    host, slash, path = url.partition("/")
    return verdict, host.lower(), slash + path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Node of a url: host, path and query; null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), rest))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are supported")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    listed = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
                       for v, h, p in rules])
    fits = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.char_length(F.concat(r["host"], r["path"])).alias("size"), (r["verdict"] == "allow").alias("allow"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"))))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)|'([^']*))", 0)
    bare = F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*([^\"'\s>]+)", 1)
    return F.when(quoted != "", F.regexp_replace(quoted, rf"(?is)^.{name}\s*=\s*[\"']", "")).otherwise(bare)


def _tidy(url: Column) -> Column:
    """``url`` without ``.`` and ``..`` in its path (``..`` takes the segment
    before it away, at the root nothing)."""
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(.*)$", 1)
    parts = F.split(path, "/")
    # the last segment of a path that ends in a dot segment is a folder
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    kept = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
                       lambda acc, p: F.when(p == ".", acc).when(
                           p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
                           F.concat(acc, F.array(p))))
    tidy = F.concat(site, F.lit("/"), F.array_join(F.concat(kept, closed), "/"), rest)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), tidy).otherwise(url)


def _absolute(href: Column, url: Column) -> Column:
    """The link target, resolved against ``url``; null if it is no web address."""
    href = F.trim(F.regexp_replace(href, "&amp;", "&"))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*((?:/[^?#]*)?/)", 1)
    full = F.when(href == "", F.lit(None)).when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href) \
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href)) \
        .when(F.startswith(href, F.lit("/")), F.concat(site, href)) \
        .when(href.rlike(r"^[#?]|^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None)) \
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), href))
    return _tidy(full)


_LINK = r"(?is)<link\b[^>]*+>"
_META = r"(?is)<meta\b[^>]*+>"
_BASE = r"(?is)<base\b[^>]*+>"


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, target) of canonical links and redirects in the pages."""
    rows = pages.where(F.col(url_col).contains("://") & F.col(html_col).rlike("(?i)canonical|http-equiv"))

    def tags(pattern, name, value):
        found = F.regexp_extract_all(html_col, F.lit(pattern), F.lit(0))
        return F.filter(found, lambda t: _attribute(t, name).rlike(value))

    rows = rows.select(
        F.col(url_col).alias("url"), _attribute(F.regexp_extract(html_col, _BASE, 0), "href").alias("base"),
        F.transform(tags(_LINK, "rel", r"(?i)(?:^|\s)canonical(?:\s|$)"), lambda t: _attribute(t, "href")).alias("c"),
        F.transform(tags(_META, "http-equiv", r"(?i)^\s*refresh\s*$"),
                    lambda t: F.regexp_replace(F.regexp_extract(
                        _attribute(t, "content"), r"(?is)\burl\s*=\s*(.*)$", 1), r"^[\s\"']+|[\s\"']+$", "")).alias("r"))
    base = F.coalesce(F.when(F.col("base") != "", _absolute(F.col("base"), F.col("url"))), F.col("url"))
    rows = rows.select("url", base.alias("base"), F.explode(F.concat("c", "r")).alias("href"))
    return rows.select("url", _absolute(F.col("href"), F.col("base")).alias("target")) \
        .where("target IS NOT NULL").distinct()


def alias_verdicts(edges: DataFrame, rules: list[Rule]) -> DataFrame:
    """(node, class_verdict) for the nodes of classes that hold a ruled url."""
    found = materialise(edges)
    ends = found.select("url").unionByName(found.select(F.col("target").alias("url")))
    ruled = ends.select(node_of(F.col("url")).alias("node"),
                        best_rule(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"].alias("v")) \
        .where("v IS NOT NULL").distinct()
    classes = materialise(connected_components(
        found.select(node_of(F.col("url")).alias("src"), node_of(F.col("target")).alias("dst"))))
    verdict = classes.join(ruled, "node").groupBy("component").agg(
        F.when(F.max(F.col("v") == "allow"), F.lit("allow")).otherwise(F.lit("block")).alias("class_verdict"))
    return classes.join(verdict, "component").select("node", "class_verdict")


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` plus host, path, rule and verdict."""
    rows = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    rows = rows.withColumn("__tw_best", best_rule(F.col("host"), F.col("path"), rules)) \
        .withColumn("__tw_node", node_of(F.col(url_col)))
    classes = alias_verdicts(links(pages, url_col, html_col), rules) \
        .select(F.col("node").alias("__tw_n"), F.col("class_verdict").alias("__tw_class"))
    rows = rows.join(classes, F.col("__tw_node") == F.col("__tw_n"), "left")
    return rows.withColumn("rule", F.col("__tw_best")["rule"]) \
        .withColumn("verdict", F.coalesce(F.col("__tw_best")["verdict"], F.col("__tw_class"), F.lit(DEFAULT))) \
        .drop("__tw_best", "__tw_node", "__tw_n", "__tw_class")
