"""URL filters whose block decisions reach the aliases of an address.

Rules name a host (with all its subdomains) and the beginning of a path; the longest rule that fits decides. Addresses
that redirect to each other or name each other as canonical are aliases: connected components over

* spellings of one address: scheme, default port, a leading ``www.``, a closing slash, the fragment and parameters that
  only track (``utm_…``, ``ref`` and the like) make no difference;
* ``<link rel="canonical" href>``, ``<meta property="og:url" content>`` and ``<meta http-equiv="refresh">`` of a page;
* any further edges the caller has, such as a crawl's redirect log.

An address without a rule is blocked if a rule blocks any of its aliases, and allowed otherwise. A rule that allows the
address itself takes precedence over whatever its aliases are.

Defined results: a NULL url, or one without ``://``, has an empty host and path, no rule and no alias, and is allowed.
Of equally long rules one that allows wins, then the first by name. Rows are judged one by one, repeated ones alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.components import components

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^[^?#]*\?([^#]*)"
_TRACKING = r"(?i)^(utm_[^=]*|ref|fbclid|gclid|msclkid|mc_[ce]id)(=|$)"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tags that name another address of the page, and the attribute that holds it.
_TAGS = [
    (r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"),
    (r"(?is)<meta\b[^>]*\bog:url\b[^>]*>", r"(?is)\bcontent\s*=\s*[\"']?([^\"'\s>]+)"),
    (r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"),
]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _ADDRESS, 1), _CAPITALS, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def address_key(url: Column) -> Column:
    """One name for all spellings of an address; NULL where the url has no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/$", "")
    kept = F.filter(F.split(F.regexp_extract(url, _QUERY, 1), "&"), lambda p: (p != "") & ~p.rlike(_TRACKING))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.when(host_of(url) != "", F.concat(host, path, query))


def resolved(link: Column, url: Column) -> Column:
    """A link as a whole url, read on the page at ``url``."""
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*/)?", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
    )


def declared_links(pages: DataFrame) -> DataFrame:
    """``source, target`` urls of redirects and canonical links in the ``html`` of ``pages``."""
    links = [F.regexp_extract(F.regexp_extract("html", tag, 0), value, 1) for tag, value in _TAGS]
    found = pages.where(F.col("html").rlike(r"(?i)canonical|og:url|http-equiv")).where(host_of(F.col("url")) != "")
    found = found.select(F.col("url").alias("source"), F.explode(F.array(*links)).alias("link")).where("link != ''")
    return found.select("source", resolved(F.col("link"), F.col("source")).alias("target"))


def ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict`` for each pair of ``host, path`` that a rule fits."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"),
        F.concat("host", "path").alias("rule"),
    )
    fits = addresses.select("host", "path").distinct().withColumn("rule_host", F.explode(parents)).join(named, "rule_host")
    best = F.struct(-F.length("rule"), F.col("rule_verdict") != "allow", "rule", "rule_verdict")
    return (
        fits.where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path").agg(F.min(best).alias("best")).select("host", "path", "best.rule", "best.rule_verdict")
    )


def judged(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Each row of ``pages`` as ``page_id, url, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (allow or block); ``links`` may add edges ``source, target`` of urls.
    """
    edges = declared_links(pages)
    edges = edges.unionByName(links.select("source", "target")) if links else edges
    keyed = edges.select(address_key(F.col("source")).alias("a"), address_key(F.col("target")).alias("b"), "target")
    groups = components(keyed.select("a", "b").where("a is not null and b is not null"))
    rows = pages.select("page_id", "url").withColumns({
        "host": host_of(F.col("url")), "path": path_of(F.col("url")), "key": address_key(F.col("url")),
    })
    # Pages, and linked addresses that no page was fetched from.
    places = rows.select("host", "path", "key").unionByName(
        keyed.select(host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"), F.col("b").alias("key"))
    )
    decided = ruled(places, rules)
    group = F.coalesce("component", "key")
    blocked = places.join(decided.where("rule_verdict = 'block'"), ["host", "path"], "left_semi").select("key").distinct()
    blocked = blocked.join(groups, blocked.key == groups.node, "left").select(group.alias("alias_group")).distinct()
    mine = rows.join(decided, ["host", "path"], "left")
    mine = mine.join(groups, mine.key == groups.node, "left").withColumn("alias_group", group)
    out = mine.join(blocked.withColumn("alias_blocked", F.lit(True)), "alias_group", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("alias_blocked"), "block").otherwise("allow"))
    return out.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"))
