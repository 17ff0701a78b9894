"""URL filter with redirect equivalence.

A rule names a host and a path; it fits the urls of that host and its
subdomains whose path starts with the rule's path, and the longest rule wins.
Urls without a rule take the verdict of their aliases: connected components
over redirect and canonical-link edges carry explicit decisions along, where
an explicit allow takes precedence over a block, and the default is allow.

Work is on distinct urls.  A url's rule is found by an equi-join on the
suffixes of its host (at label borders), so the list of rules may be large.
Nodes are urls without scheme, fragment, tracking parameters and the slash at
the end of a path longer than ``/``: forms that lead to one page.  Edges come
from the pages' canonical links and refreshes to a url (all of a page, after any
delay) outside comments, scripts and styles, and from a table of redirects if
one is given.  The ends of an edge are judged by their host and path as written.

A null url, or one without ``://``, has an empty host and path, is no alias of
anything and is allowed, as no rule fits.  Repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_GOTO = r"""(?is)\bcontent\s*=\s*["']?\s*[0-9.]+(?:\s*[;,]\s*|\s+)url\s*=\s*["']?([^"'\s>]+)"""
#: Markup whose content is no tag of the page; an unclosed one reaches to the end.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
_TRACKING = r"(^|&)(?:utm_[^=&]*|fbclid|gclid)(?:=[^&]*)?(?=&|$)"


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """Name of the page that a url leads to; null without a host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, _TRACKING, ""), "^&", "")
    name = F.concat(host(url), F.regexp_replace(path(url), r"(?s)(?<=.)/\z", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host(url) != "", name)


def _resolved(base: Column, link: Column) -> Column:
    """A link as an absolute url."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    folder = F.regexp_extract(path(base), r"(?s)^(.*/)", 1)
    return (F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(scheme, F.lit("://"), host(base), link))
            .otherwise(F.concat(scheme, F.lit("://"), host(base), F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def _ends(a: Column, b: Column) -> list[Column]:
    """Both ends of an edge: node name, host and path."""
    return [f(c).alias(f"{side}{part}") for side, c in (("a", a), ("b", b))
            for part, f in (("", node), ("_host", host), ("_path", path))]


def edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): node names that a page's canonical links or refreshes make aliases, with the host and path of each."""
    def found(tag: str, part: str) -> Column:
        return F.transform(F.regexp_extract_all("__seen", F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, part, 1))

    low = F.lower(html)
    seen = pages.where(low.contains("canonical") | low.contains("http-equiv")).select(
        F.col(url).alias("__url"), F.regexp_replace(html, _HIDDEN, "").alias("__seen"))
    links = seen.select("__url", F.explode(F.array_distinct(F.concat(found(_CANONICAL, _HREF), found(_REFRESH, _GOTO))))
                        .alias("__link")).where("__link <> ''")
    return links.select(*_ends(F.col("__url"), _resolved(F.col("__url"), F.regexp_replace("__link", "&amp;", "&"))))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict): the longest fitting rule of each distinct (host, path) that has one."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.where("host <> ''").select("host", "path", F.explode(F.array_distinct(suffixes)).alias("__suffix"))
    r = rules.select(F.col("host").alias("__suffix"), F.col("path").alias("__start"), "verdict")
    fit = each.join(r, "__suffix").where(F.col("path").startswith(F.col("__start")))
    name = F.concat("__suffix", "__start")
    best = F.max(F.struct(F.length(name), name, "verdict")).alias("__best")
    return fit.groupBy("host", "path").agg(best).select("host", "path", F.col("__best.col2").alias("rule"),
                                                        F.col("__best.verdict").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", html: str = "html", id_col: str = "page_id",
          redirects: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict): one row for each row of ``pages``; ``redirects`` has (from_url, to_url)."""
    u = F.col(url)
    rows = stored(pages.select(id_col, host(u).alias("host"), path(u).alias("path"), node(u).alias("__node")), "urls")
    own = stored(ruled(rows.select("host", "path").distinct(), rules), "ruled")
    links = edges(pages, url, html)
    if redirects is not None:
        links = links.union(redirects.select(*_ends(F.col("from_url"), F.col("to_url"))))
    links = stored(links.where("a is not null and b is not null and a <> b").distinct(), "links")
    comps = stored(components(links.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))), "components")
    # Decisions of every url known: pages, and the ends of edges that are no page themselves.
    ends = links.selectExpr("a as __node", "a_host as host", "a_path as path").union(
        links.selectExpr("b", "b_host", "b_path"))
    known = stored(rows.select("__node", "host", "path").where("__node is not null").union(ends).distinct(), "known")
    known = known.join(ruled(known.select("host", "path").distinct(), rules), ["host", "path"])
    said = known.join(comps.withColumnRenamed("node", "__id"), F.xxhash64("__node") == F.col("__id"), "left")
    said = said.select(F.coalesce("component", F.xxhash64("__node")).alias("__comp"), "verdict")
    said = said.groupBy("__comp").agg(F.max(F.col("verdict") == "allow").alias("__allow"))
    j = rows.join(own.withColumnsRenamed({"host": "__h", "path": "__p"}),
                  (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left")
    j = j.join(comps.withColumnRenamed("node", "__id"), F.xxhash64("__node") == F.col("__id"), "left")
    j = j.withColumn("__c", F.when(F.col("__node").isNotNull(), F.coalesce("component", F.xxhash64("__node"))))
    j = j.join(said, F.col("__c") == F.col("__comp"), "left")
    method = F.when(F.col("__allow").isNull() | F.col("__allow"), "allow").otherwise("block")
    return j.select(id_col, "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"))
