"""URL filter with redirect equivalence: block decisions reach all aliases of a blocked URL.

Two URLs are aliases when a redirect or a canonical link leads from one to the other, over any number of steps, in
either direction: the connected components of those edges, computed with DataFrame operations only.  A URL's own
rule always decides (so an explicit allow holds in a blocked component); a URL without a rule is blocked if any
alias is blocked by a rule, else allowed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored
from .components import connected_components

ALLOW, BLOCK = "allow", "block"

# a tag ends at the first > outside a quoted value
_REST = r"""(?:[^>=]++|=(?:\s*+(?:"[^"]*+"|'[^']*+'))?+)*+>"""
_LINK = r"(?i)<link\s" + _REST
_META = r"(?i)<meta\s" + _REST
_CANONICAL = r"(?i)\brel\s*=\s*[\"']?canonical\b"
_REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
#: The value is in the group of its quotes, or in the last one.
_HREF = r"""(?i)(?<![\w-])href\s*=\s*(?:"([^"]*)"|'([^']*)'|["']?([^"'\s>][^\s>]*))"""
_CONTENT = r"""(?i)(?<![\w-])content\s*=\s*(?:"([^"]*)"|'([^']*)')"""
#: In a quoted content the URL goes to its own quote or the end; else to the next space or the end of the tag.
_URL = r"""(?is)\burl\s*=\s*(?:"([^"]*)|'([^']*)|([^"'].*))"""
_BARE_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>][^\s>]*)"""


def _group(text: Column, pattern: str, groups: int) -> Column:
    """What the one group of ``pattern`` that took part holds; empty if none."""
    return F.concat(*[F.regexp_extract(text, pattern, k + 1) for k in range(groups)])


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or none: empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null.

    ``rules``: (verdict, host, path).  They become one literal map by host, looked up for each of the URL's parent
    domains; so a list suits some thousand rules, more go into a table (:func:`match_rule_table`).  Of two rules of the
    same length the one whose text is greater decides, of one rule with both verdicts the block."""
    kind = "array<struct<size:int,rule:string,verdict:string,path:string>>"
    by_host: dict[str, list] = {}
    for verdict, h, p in rules:
        by_host.setdefault(h, []).append(F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"),
                                                  F.lit(verdict).alias("verdict"), F.lit(p).alias("path")))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    table = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*own).cast(kind))])
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fits = F.flatten(F.transform(parents, lambda h: F.filter(F.coalesce(F.element_at(table, h), F.array().cast(kind)),
                                                            lambda r: F.startswith(path, r["path"]))))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def match_rule_table(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, m) for the distinct (host, path) of ``sites``: :func:`match_rule` for rules in a table (verdict, host,
    path) of any size, joined on each of a host's parent domains (at most as many as it has labels).  Rows of ``rules``
    with a null are no rules."""
    own = sites.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    table = rules.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "verdict").dropna().distinct()
    best = own.select("host", "path", F.explode(parents).alias("_h")).join(table, "_h").where(F.startswith("path", "_p")) \
        .groupBy("host", "path").agg(F.max(F.struct(F.length(F.concat("_h", "_p")).alias("size"), F.concat("_h", "_p").alias("rule"), "verdict")).alias("b"))
    return best.select("host", "path", F.struct(F.col("b.rule").alias("rule"), F.col("b.verdict").alias("verdict")).alias("m"))


def with_rule(sites: DataFrame, rules) -> DataFrame:
    """``sites`` with ``m``, the rule that fits their host and path: from a list, or from a table of rules."""
    if not isinstance(rules, DataFrame):
        return sites.withColumn("m", match_rule(F.col("host"), F.col("path"), rules))
    return sites.join(stored(match_rule_table(sites, rules), "rules"), ["host", "path"], "left")


def node(url: Column) -> Column:
    """A URL in normal form: scheme and host in lower case, without the scheme's own port, an empty path as ``/``, and
    without its fragment, which no server sees.  Null without ``://``."""
    bare = F.regexp_extract(url, r"(?s)^[^#]*", 0)
    scheme, site = lower_ascii(F.substring_index(bare, "://", 1)), host(bare)
    site = F.when(scheme == "http", F.regexp_replace(site, ":80$", "")).when(scheme == "https", F.regexp_replace(site, ":443$", "")).otherwise(site)
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.contains(bare, F.lit("://")), F.concat(scheme, F.lit("://"), site, rest))


def node_id(url: Column) -> Column:
    """128 bits of hash over the normal form: what the components carry, however long URLs are."""
    return F.unhex(F.md5(node(url)))


def _resolved(link: Column, base: Column) -> Column:
    """``link`` as the page at ``base`` means it: absolute, for any host, from the root, or beside the page."""
    site = F.concat(F.regexp_extract(base, r"(?s)^(.*?://)", 1), host(base))
    folder = F.regexp_extract(path(base), r"(?s)^(.*/)", 1)
    link = F.replace(F.trim(link), F.lit("&amp;"), F.lit("&"))
    return F.when(link == "", None).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link) \
        .when(link.startswith("//"), F.concat(F.substring_index(base, "://", 1), F.lit(":"), link)) \
        .when(link.startswith("/"), F.concat(site, link)) \
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): all canonical links and redirects that pages state in their HTML, as absolute URLs; a URL goes to the end of
    its attribute."""
    p = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    tags = lambda tag, kind: F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: t.rlike(kind))

    def target(tag):
        own = _group(_group(tag, _CONTENT, 2), _URL, 3)
        return F.when(own != "", own).otherwise(F.regexp_extract(tag, _BARE_URL, 1))

    links = F.concat(F.transform(tags(_LINK, _CANONICAL), lambda t: _group(t, _HREF, 3)), F.transform(tags(_META, _REFRESH), target))
    # line ends and tabs are no part of a URL, nor are spaces around it
    links = F.transform(links, lambda x: F.trim(F.translate(x, "\t\n\r", "")))
    found = p.select("url", F.explode(F.filter(links, lambda x: x != "")).alias("link"))
    return found.select(F.col("url").alias("a"), _resolved(F.col("link"), F.col("url")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")


def filter_urls(pages: DataFrame, rules, id_col: str = "page_id", url_col: str = "url",
                html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, decided_by) for each row of ``pages``.

    ``rules``: a list of (verdict, host, path), or a table with these columns.  ``redirects``: further edges (src, dst)
    between URLs, as of a crawl log.  ``decided_by``: rule, alias or default.  Aliases are compared in normal form (see
    :func:`node`), hosts and paths are the URL's own.  A null URL, or one without ``://``, has an empty host and path
    and no aliases; null HTML states no links.  Repeated rows and URLs are judged each; an empty table gives an empty
    result."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    judged = with_rule(p.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url"))), rules)

    edges = redirects.select(F.col("src").alias("a"), F.col("dst").alias("b")) if redirects is not None else None
    if html_col:
        own = page_edges(pages, url_col, html_col)
        edges = own if edges is None else edges.union(own)
    if edges is None:
        judged = judged.withColumn("alias", F.lit(None).cast("boolean"))
    else:
        edges = stored(edges.withColumn("ia", node_id(F.col("a"))).withColumn("ib", node_id(F.col("b")))
                       .where("ia IS NOT NULL AND ib IS NOT NULL AND ia <> ib"), "links")
        comp = connected_components(edges, "ia", "ib")
        ends = edges.select(F.col("ia").alias("node"), node(F.col("a")).alias("url")).union(edges.select("ib", node(F.col("b")))).distinct()
        ends = with_rule(ends.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url"))), rules)
        bad = ends.where(F.col("m.verdict") == BLOCK).select("node").join(comp, "node").select("component").distinct()
        blocked = stored(comp.join(bad, "component", "left_semi").select("node", F.lit(True).alias("alias")), "blocked")
        # a page without a URL matches nothing: it gets an id of its own (16 bytes and more), not one task with all others
        none = F.concat(F.unhex(F.md5(F.concat_ws("|", "page_id", "url"))), F.lit(b"-"))
        judged = judged.withColumn("node", F.coalesce(node_id(F.col("url")), none)).join(blocked, "node", "left")
    verdict = F.coalesce(F.col("m.verdict"), F.when(F.col("alias"), BLOCK), F.lit(ALLOW))
    by = F.when(F.col("m").isNotNull(), "rule").when(F.col("alias"), "alias").otherwise("default")
    return judged.select("page_id", "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"), by.alias("decided_by"))
