"""URL filters with redirect equivalence.

Block and allow rules name a host (with its subdomains) and a path prefix; the
longest rule that fits decides a url. Urls that redirect to each other or name each
other as canonical are aliases: the connected components over those links. A block
decision spreads to every alias that no rule of its own decides, unless an alias is
explicitly allowed: then the component's undecided members are allowed.

Links come from the pages themselves (``<link rel=canonical>``, ``<meta http-equiv=refresh>``)
and, if given, from a table of logged redirects. Two urls are one node if they differ in
scheme or fragment alone.

Scale: the rules are a short list in code and run as one expression in the scan. Only
linked urls enter the component search, which never gathers a component in one place; a
canonical target of a third of all pages is a hub, see ``components``.

Defined cases: a null url or one without ``://`` has an empty host and path, no node, and
the default verdict; null or broken html has no links; relative targets are resolved against
the page's own url (a query on its path, ``.`` and ``..`` segments taken out); repeated pages share their node.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import ascii_lower, materialize, settle
from changeflow.llm.components import connected_components


class Rule(NamedTuple):
    verdict: str     # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"))
DEFAULT = "allow"

_LINK_TAG = "(?is)<(?:link|meta)\\b[^>]*>"
_CANONICAL = "(?is)\\brel\\s*=\\s*[\"']?[^\"'>]*\\bcanonical\\b"
_HREF = "(?is)\\bhref\\s*=\\s*[\"']?\\s*([^\"'\\s>]+)"
_REFRESH = "(?is)\\bhttp-equiv\\s*=\\s*[\"']?\\s*refresh\\b"
_REFRESH_URL = "(?is)\\bcontent\\s*=\\s*[\"'][^\"'>]*?\\burl\\s*=\\s*['\"]?([^\"'\\s>]+)"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(rest: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def node_of(rest: Column) -> Column:
    """Host, path and query: the identity of a url without scheme and fragment; null if there is no host."""
    tail = F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    return F.when(host_of(rest) != "", F.concat(host_of(rest), tail))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null; the first listed wins a tie."""
    found = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.name)):          # the longest ends up outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _resolved(target: Column, url: Column) -> Column:
    """A link target as an absolute url."""
    scheme = F.regexp_extract(url, "^(.*?)://", 1)
    rest = after_scheme(url)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(rest, "^[^/?#]*", 0))
    folder = F.regexp_extract(F.concat(path_of(rest), F.lit("")), "^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    target = F.regexp_replace(target, "(?i)&amp;", "&")
    return (F.when(F.rlike(target, F.lit("(?i)^[a-z][a-z0-9+.-]*://")), target)
            .when(target.startswith("?"), F.concat(site, path_of(rest), target))
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target))
            .when(F.rlike(target, F.lit("(?i)^[a-z][a-z0-9+.-]*:")), F.lit(None))       # mailto: and the like
            .when(target.startswith("#"), F.lit(None))
            .otherwise(F.concat(site, folder, target)))


def _without_dots(url: Column) -> Column:
    """An absolute url whose path has no ``.`` and ``..`` segments."""
    head, path, tail = (F.regexp_extract(url, "^([^:/?#]*://[^/?#]*)([^?#]*)(.*)$", k) for k in (1, 2, 3))
    segments = F.split(path, "/")
    left = F.aggregate(
        F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept).otherwise(F.concat(kept, F.array(s))),
        lambda kept: F.concat(F.lit("/"), F.array_join(kept, "/"),
                              F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")))
    return F.when(F.rlike(path, F.lit("/\\.\\.?(/|$)")), F.concat(head, left, tail)).otherwise(url)


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Alias links (u, v) between nodes, from canonical and refresh tags."""
    tags = F.explode(F.regexp_extract_all(F.col(f"`{html_col}`"), F.lit(_LINK_TAG), F.lit(0)))
    found = pages.select(F.col(f"`{url_col}`").alias("url"), tags.alias("tag"))
    target = (F.when(F.rlike("tag", F.lit(_CANONICAL)), F.regexp_extract("tag", _HREF, 1))
              .when(F.rlike("tag", F.lit(_REFRESH)), F.regexp_extract("tag", _REFRESH_URL, 1)))
    return _edges(settle(found, target=target).where("target <> ''"))


def _edges(links: DataFrame) -> DataFrame:
    """(url, target) -> (u, v), the nodes of a link. Each step is settled: nested, the expressions would multiply."""
    steps = settle(links.select("url", "target"), full=_resolved(F.col("target"), F.col("url")))
    steps = settle(steps, goal=after_scheme(_without_dots(F.col("full"))), start=after_scheme(F.col("url")))
    steps = settle(steps.select("start", "goal"), u=node_of(F.col("start")), v=node_of(F.col("goal")))
    return steps.select("u", "v").where("u <> v")


def filter_urls(pages: DataFrame, *, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                default: str = DEFAULT) -> DataFrame:
    """One row per page: ``id_col``, ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` and ``by`` (what
    decided it: rule, alias or default). ``redirects`` has the columns ``url`` and ``target``."""
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(_edges(redirects))
    members = connected_components(links.distinct(), "url-alias")
    parts = settle(members, host=host_of(F.col("node")), path=path_of(F.col("node")))
    decided = settle(parts, own=matching_rule(F.col("host"), F.col("path"), rules)["verdict"]).groupBy("component").agg(
        F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    decided = materialize(decided.where("allowed or blocked").select(
        "component", F.when(F.col("allowed"), "allow").otherwise("block").alias("alias_verdict")), "url-decided")
    spread = materialize(members.join(decided, "component").select("node", "alias_verdict"), "url-spread")

    rows = settle(pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`").alias("page_url")),
                  rest=F.coalesce(after_scheme(F.col("page_url")), F.lit("")))
    rows = settle(rows, host=host_of(F.col("rest")), path=path_of(F.col("rest")), page_node=node_of(F.col("rest")))
    rows = settle(rows, m=matching_rule(F.col("host"), F.col("path"), rules))
    rows = rows.join(spread, rows["page_node"] == spread["node"], "left")
    verdict = F.coalesce(F.col("m.verdict"), F.col("alias_verdict"), F.lit(default))
    by = F.when(F.col("m").isNotNull(), "rule").when(F.col("alias_verdict").isNotNull(), "alias").otherwise("default")
    return rows.select(id_col, "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"), by.alias("by"))
