"""URL filters with redirect equivalence: a block decision reaches the aliases of a blocked URL.

Redirects, meta refreshes and canonical links are edges between URLs. Connected components of these edges are
found by DataFrame operations; a URL without a rule of its own is blocked if its component holds a blocked URL and no
allowed one. A URL's own rule always holds, and an allow rule anywhere among the aliases outweighs block rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower
from tidewatch.llm.components import components
from tidewatch.session import stored

#: (verdict, rule): a rule is a host and a path; it fits the host and its subdomains where the path starts with its own.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
#: Tags are read once each, up to their end or the end of the page; possessive, so that blanks are not tried over.
_LINK = r"(?i)<link\b[^>]*+"
_META = r"(?i)<meta\b[^>]*+"
_CANONICAL = r"(?i)\brel\s*+=\s*+[\"']?\s*+canonical\b"
_HREF = r"(?i)\bhref\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]+))"
_REFRESH = r"(?i)\bhttp-equiv\s*+=\s*+[\"']?\s*+refresh\b"
_TARGET = r"(?i)\burl\s*+=\s*+['\"]?([^'\"\s>;]+)"


def host(url: Column) -> Column:
    """What stands after the first "://" up to /, ?, # or the end, A-Z lowered; empty without "://"."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def best_rule(h: Column, p: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null; of equally long ones an allow, then the first by
    name. Rules are settings: each becomes a literal of the plan."""
    found = []
    for verdict, rule in rules:
        name, _, tail = rule.partition("/")
        fits = ((h == name) | h.endswith("." + name)) & p.startswith("/" + tail)
        rank = F.struct(F.lit(len(rule)).alias("n"), F.lit(verdict == "allow").alias("allow"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found.append(F.when(fits, rank))
    # array_max leaves nulls out
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<n:int,allow:boolean,rule:string,verdict:string>")


def url_key(url: Column) -> Column:
    """A URL as a node: host, path (at least "/") and query, without scheme and fragment; null without "://"."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    p = path(url)
    return F.when(F.instr(url, "://") > 0, F.concat(host(url), F.when(p == "", "/").otherwise(p), query))


def _resolved(base: Column, link: Column) -> Column:
    """A link of a page as a URL with a scheme."""
    folder = F.regexp_extract(path(base), r"^(.*/)?", 1)
    return (
        F.when(F.instr(link, "://") > 0, link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(F.lit("http://"), host(base), link))
        .otherwise(F.concat(F.lit("http://"), host(base), F.when(folder == "", "/").otherwise(folder), link))
    )


def _first(tags: Column, kind: str) -> Column:
    return F.get(F.filter(tags, lambda t: t.rlike(kind)), F.lit(0))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) URLs of the pages' first canonical link and first meta refresh."""
    u, body = F.col(f"`{url}`").alias("u"), F.col(f"`{html}`").alias("h")
    body_to_last_tag = F.left(F.col("h"), F.char_length("h") - F.char_length(F.substring_index("h", ">", -1)))
    linked = pages.select(u, body).filter(F.col("h").rlike("(?i)canonical|refresh") & F.col("u").isNotNull()).withColumn("h", body_to_last_tag)
    canonical = _first(F.regexp_extract_all("h", F.lit(_LINK), F.lit(0)), _CANONICAL)
    refresh = _first(F.regexp_extract_all("h", F.lit(_META), F.lit(0)), _REFRESH)
    href = F.concat(*[F.regexp_extract(canonical, _HREF, i) for i in (1, 2, 3)])
    found = linked.select("u", F.explode(F.array(href, F.regexp_extract(refresh, _TARGET, 1))).alias("t"))
    found = found.withColumn("t", F.replace(F.trim("t"), F.lit("&amp;"), F.lit("&"))).filter("t <> ''")
    return found.select(F.col("u").alias("source"), _resolved(F.col("u"), F.col("t")).alias("target"))


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, redirects: DataFrame | None = None, url: str = "url", html: str = "html",
) -> DataFrame:
    """``pages`` with ``judgement`` (replaced if there is one): host, path, rule and verdict (allow or block).

    ``redirects`` (source, target) adds URLs that a crawler saw redirect. A null URL or one without "://" has an empty
    host and path, fits no rule and has no alias: it is allowed. Pages without html have no links; repeated rows are
    judged alike; an empty table gives no row. One URL may be the target of any share of the pages.
    """
    edges = alias_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    ends = stored(edges.filter("source IS NOT NULL AND target IS NOT NULL"), "aliases")
    best = lambda u: best_rule(host(u), path(u), rules)["verdict"]
    u = F.col(f"`{url}`")
    out = pages.withColumns({"__rule": best_rule(host(u), path(u), rules), "__key": url_key(u)})
    spread = F.lit(None).cast("string")
    if not ends.isEmpty():
        keyed = ends.select(url_key(F.col("source")).alias("a"), url_key(F.col("target")).alias("b"))
        of = components(keyed)
        urls = ends.select(F.explode(F.array("source", "target")).alias("u"))
        ruled = urls.select(url_key(F.col("u")).alias("node"), best(F.col("u")).alias("verdict")).filter("verdict IS NOT NULL").distinct()
        # allow sorts before block
        spread_to = of.join(ruled, "node").groupBy("component").agg(F.min("verdict").alias("__spread"))
        named = of.join(spread_to, "component").select(F.col("node").alias("__key"), "__spread")
        out = out.join(named, "__key", "left")
        spread = F.col("__spread")
    judgement = F.struct(
        host(u).alias("host"), path(u).alias("path"), F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", spread, F.lit("allow")).alias("verdict"),
    )
    return out.withColumn("judgement", judgement).drop("__rule", "__key", "__spread")
