"""URL rules with redirect equivalence.

A rule is a host and the start of a path; it fits its host and all subdomains.  The
longest fitting rule decides.  Urls joined by canonical links or redirects are aliases;
connected components over those links find them.  A url without a rule of its own is
blocked when an alias is blocked by a rule, unless another alias is allowed by a rule:
explicit allows win over propagated blocks.  All other urls are allowed.

A null url has an empty host and path and no rule.  Equal urls are one alias.  Of rules of
one length the longer host wins, then the later text of rule and action.  Repeated pages are judged one by
one.  An empty table gives no rows; pages of any length are searched whole, and other columns
play no part.  Nothing is compared but urls with a link.  The package must be known to the
executors (``shared.shipped``).
"""

from __future__ import annotations

import html
import re
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.llm.components import components
from censa.llm.shared import kept

SALTS = 32
REFERENCE = re.compile(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
#: An attribute begins after white space, a quote or a slash; ``rel`` holds a list of words.
BEFORE = r"(?<=[\s\"'/])"
WORDS = r"(?:\"(?:[^\">]*\s)?canonical(?:\s[^\">]*)?\"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s/>]))"
CANONICAL = rf"(?is)<link\b(?=[^>]*{BEFORE}rel\s*=\s*{WORDS})[^>]*{BEFORE}href\s*=\s*[\"']?\s*([^\"'\s>]+)"
REFRESH = rf"(?is)<meta\b(?=[^>]*{BEFORE}http-equiv\s*=\s*[\"']?refresh\b)[^>]*{BEFORE}content\s*=\s*[\"']?\s*\d+(?:\.\d*)?\s*[;,]\s*url\s*=\s*['\"]?\s*([^\"'\s>]+)"
#: Scheme, authority with its slashes, path, and query with its mark of a url or link.
REFERENCE_PARTS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def alias(url: Column) -> Column:
    """A url without its fragment, scheme and host in lower case."""
    whole = F.regexp_replace(url, r"(?s)#.*$", "")
    start = r"(?s)^([^:/?#]*://)([^/?#]*@)?([^/?#]*)"
    scheme, user, name = (F.regexp_extract(whole, start, k) for k in (1, 2, 3))
    return F.concat(F.translate(scheme, UPPER, LOWER), user, F.translate(name, UPPER, LOWER), F.regexp_replace(whole, start, ""))


def unescaped(link: Column) -> Column:
    """A link from an attribute with its character references resolved."""
    return F.udf(_unescaped, "string", useArrow=True)(link)


def _unescaped(link: str) -> str:
    # Only with a semicolon: a lone ``&copy=`` starts a parameter.
    return REFERENCE.sub(lambda m: html.unescape(m[0]) if m[1][0] == "#" or f"{m[1]};" in html5 else m[0], link)


def resolved(link: Column, base: Column) -> Column:
    """A link as a full url without fragment, seen from the page ``base`` (RFC 3986, section 5)."""
    scheme, authority, path_, query = (F.regexp_extract(link, REFERENCE_PARTS, k) for k in (1, 2, 3, 4))
    of_scheme, of_authority, of_path, of_query = (F.regexp_extract(base, REFERENCE_PARTS, k) for k in (1, 2, 3, 4))
    site = F.concat(of_scheme, of_authority)
    folder = F.regexp_extract(of_path, r"(?s)^(.*/)", 1)
    merged = F.when(path_.startswith("/"), path_).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path_))
    return (
        F.when(scheme != "", F.concat(scheme, authority, path_, query))
        .when(authority != "", F.concat(of_scheme, authority, path_, query))
        .when(path_ != "", F.concat(site, without_dots(merged), query))
        .otherwise(F.concat(site, of_path, F.when(query != "", query).otherwise(of_query)))
    )


def without_dots(path_: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    segments = F.split(path_, "/")
    kept_ = lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    rest = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array(F.lit("")), kept_)  # the first is empty: it is before the first slash
    ends = F.element_at(segments, -1).isin(".", "..")
    return F.array_join(F.when(ends, F.concat(rest, F.array(F.lit("")))).otherwise(rest), "/")


def links(pages: DataFrame) -> DataFrame:
    """``a`` and ``b``: aliases that a page's canonical links and refreshes join."""
    page = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), COMMENT, "")
    found = F.concat(F.regexp_extract_all(page, F.lit(CANONICAL), 1), F.regexp_extract_all(page, F.lit(REFRESH), 1))
    out = pages.filter("url IS NOT NULL").select("url", F.explode(found).alias("link")).select("url", unescaped(F.col("link")).alias("link"))
    return out.select(alias(F.col("url")).alias("a"), alias(resolved(F.col("link"), F.col("url"))).alias("b"))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with host and path) with ``rule`` and ``action`` of the longest fitting rule, or nulls.

    ``rules``: host, path, action.  Rules find their hosts by equality with the host's
    suffixes, once for each distinct host; the paths of one host's rules are then
    compared in its rows.
    """
    labels = F.split("host", r"\.")
    hosts = urls.select("host").distinct().filter("host <> ''")
    suffixes = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix"))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "action")
    each = F.struct(F.length(F.concat("suffix", "start")).alias("n"), F.length("suffix").alias("m"), F.concat("suffix", "start").alias("rule"), "start", "action")
    by_host = suffixes.join(named, "suffix").groupBy("host").agg(F.collect_set(each).alias("_rules"))
    # A host may have a third of all urls, so each host's urls are dealt to SALTS parts.
    by_host = by_host.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    best = F.array_max(F.filter("_rules", lambda r: F.col("path").startswith(r["start"])))
    salted = urls.withColumn("_salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    return salted.join(by_host, ["host", "_salt"], "left").withColumn("_best", best).select(*urls.columns, F.col("_best.rule").alias("rule"), F.col("_best.action").alias("action"))


def judged(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``redirects``: further pairs (a, b) of urls that are aliases.
    """
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(alias(F.col("a")).alias("a"), alias(F.col("b")).alias("b")))
    edges = kept(edges, "url-edges")
    url = F.col("url")
    own = ruled(pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path")), rules)
    if not edges.isEmpty():
        members = components(edges)
        urls = ruled(members.select("node", "component", host(F.col("node")).alias("host"), path(F.col("node")).alias("path")), rules)
        votes = urls.groupBy("component").agg(F.bool_or(F.col("action") == "block").alias("blocks"), F.bool_or(F.col("action") == "allow").alias("allows"))
        blocked = members.join(votes.filter("blocks AND NOT coalesce(allows, false)"), "component").select(F.col("node").alias("_alias"), F.lit("block").alias("spread"))
        own = own.withColumn("_alias", alias(url)).join(blocked, "_alias", "left")
    else:
        own = own.withColumn("spread", F.lit(None).cast("string"))
    return own.select("page_id", "host", "path", "rule", F.coalesce("action", "spread", F.lit("allow")).alias("verdict"))
