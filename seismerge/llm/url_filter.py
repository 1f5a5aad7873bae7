"""URL filter: host and path rules, and block decisions that follow redirects.

Rules decide urls directly: a rule fits its host and all subdomains when the
url's path starts with the rule's path, and the longest fitting rule wins
(more host labels first, then the longer path). Urls joined by redirect or
canonical-link edges are aliases: connected components over these edges carry
a block to every alias without a rule of its own. An explicit allow takes
precedence: it is never overturned by a propagated block, and it does not
spread. Everything here is DataFrame or SQL functions.

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule and the verdict allow, and no aliases. Equal urls (without
fragment) are one node. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import written
from seismerge.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_TARGET = r"""(?is)\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*['"]?\s*([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? # or end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null without one."""
    ordered = sorted(rules, key=lambda r: (r[1].count("."), len(r[1]), len(r[2])), reverse=True)
    hit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(hit)
    return hit


def node_of(url: Column) -> Column:
    """A url as a node of the alias graph: no fragment, host in lower case;
    null without ``://``."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    scheme = F.regexp_extract(bare, r"(?s)^(.*?)://", 1)
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?]*(.*)$", 1)
    return F.when(url.contains("://"), F.concat(F.lower(scheme), F.lit("://"), host_of(bare),
                                                F.when(rest == "", "/").otherwise(rest)))


def folded(path: Column) -> Column:
    """A link's path from the root on, without ``.`` and ``..`` steps (further ones
    than there are folders stop at the root); query and fragment as they are."""
    steps = F.split(F.regexp_extract(path, r"(?s)^/([^?#]*)", 1), "/")
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(
        s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    # A last step within the folder names the folder itself.
    kept = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.regexp_extract(path, r"(?s)^[^?#]*(.*)$", 1))


def resolved(url: Column, link: Column) -> Column:
    """A page's link as an absolute url: absolute, from the scheme, the root, the
    page's folder or its query on; null for other schemes (``mailto:`` and the like)."""
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    own = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(own, r"(?s)^(.*/)", 1)
    return (F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), link))
            .when(link.startswith("/"), F.concat(origin, folded(link)))
            .when(link.startswith("#"), F.concat(F.regexp_extract(url, r"(?s)^([^#]*)", 1), link))
            .when(link.startswith("?"), F.concat(origin, own, link))
            .otherwise(F.concat(origin, folded(F.concat(F.when(folder == "", "/").otherwise(folder), link)))))


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b) from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>``
    tags; only pages that hold such a word are parsed."""
    url, html = F.col(url_col), F.col(html_col)
    tags = (pages.where(url.contains("://") & (html.rlike("(?i)canonical") | html.rlike("(?i)http-equiv")))
            .select(url.alias("url"), F.explode(F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))).alias("tag")))
    link = (F.when(F.col("tag").rlike(_CANONICAL), F.regexp_extract("tag", _HREF, 1))
            .when(F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _TARGET, 1)))
    return (tags.select("url", F.replace(link, F.lit("&amp;"), F.lit("&")).alias("link")).where("link <> ''")
            .select(node_of(F.col("url")).alias("a"), node_of(resolved(F.col("url"), F.col("link"))).alias("b"))
            .where("a is not null and b is not null and a <> b").distinct())


def url_filter(spark: SparkSession, pages: DataFrame, redirects: DataFrame | None = None,
               rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
               html_col: str | None = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, component (the alias class's smallest
    url, null without aliases). ``redirects(a, b)``: further edges between urls."""
    url = F.col(url_col)
    parts = [] if html_col is None else [declared_links(pages, url_col, html_col)]
    if redirects is not None:
        parts.append(redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    page = (pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                         node_of(url).alias("node"))
            .withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)))
    if not parts:
        return page.select("page_id", "host", "path", "hit.rule",
                           F.coalesce("hit.verdict", F.lit(ALLOW)).alias("verdict"),
                           F.lit(None).cast("string").alias("component"))
    alias = written(spark, connected_components(spark, reduce(DataFrame.union, parts)), "aliases")
    # A target that is no row of ``pages`` is judged as well: its block counts.
    blocked = (alias.where(rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"] == BLOCK)
               .select("component", F.lit(True).alias("blocked")).distinct())
    return (page.join(alias, "node", "left").join(blocked, "component", "left")
            .select("page_id", "host", "path", "hit.rule",
                    F.coalesce("hit.verdict", F.when(F.col("blocked"), F.lit(BLOCK)), F.lit(ALLOW)).alias("verdict"),
                    "component"))
