"""URL decisions by rules, carried over redirects and canonical links, in DataFrame functions only.

A rule (host, path, verdict) fits the urls of its host and all subdomains whose path starts with the rule's; the
longest rule wins. Redirects and canonical links join urls into classes of aliases (connected components). A url that
no rule fits is blocked if an alias is blocked by a rule; a rule of its own always stands, so an allowed url
stays allowed among blocked aliases. Everything else is allowed.

Defined cases: a null url or one without ``://`` has empty host and path and no aliases, and is allowed; of rules
that fit with equal length the one with the longer host wins, and of equal rules allow; repeated rows are judged
alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.components import components
from hourloom.llm.storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"^(?s)(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
TARGET = r"(?is)\bcontent\s*=\s*[\"']?\s*[\d.]+\s*[;,]\s*url\s*=\s*['\"]?([^\"'>]+)"


def part_of(url: str | Column, number: int) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, PARTS, number), F.lit(""))


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(part_of(url, 2), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return part_of(url, 3)


def address_of(url: str | Column) -> Column:
    """The url as a vertex: without scheme and fragment; null without ``://``."""
    whole = F.concat(host_of(url), path_of(url), part_of(url, 4))
    return F.when(F.contains(F.col(url) if isinstance(url, str) else url, F.lit("://")), whole)


def resolved(base: str, link: str) -> Column:
    """The absolute form of a link on the page at ``base``; null for links that are no page."""
    to = F.trim(F.replace(F.col(link), F.lit("&amp;"), F.lit("&")))
    scheme, host = part_of(base, 1), part_of(base, 2)
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (to == "") | to.startswith("#"), F.lit(None))
        .when(to.startswith("/"), F.concat(scheme, F.lit("://"), host, to))
        .when(to.startswith("?"), F.concat(scheme, F.lit("://"), host, path_of(base), to))
        .otherwise(F.concat(scheme, F.lit("://"), host, folder, to))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target) of every canonical link and refresh in the html of pages (url, html)."""
    first = lambda tag, pattern, groups: F.coalesce(
        *(F.when(F.regexp_extract(tag, pattern, g) != "", F.regexp_extract(tag, pattern, g)) for g in groups)
    )
    canonical = F.transform(F.regexp_extract_all("html", F.lit(CANONICAL), 0), lambda t: first(t, HREF, (1, 2, 3)))
    refresh = F.transform(F.regexp_extract_all("html", F.lit(REFRESH), 0), lambda t: first(t, TARGET, (1,)))
    links = pages.where("html is not null").select("url", F.explode(F.concat(canonical, refresh)).alias("link"))
    return links.select(F.col("url").alias("source"), resolved("url", "link").alias("target")).where("target is not null")


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) that a rule fits. Equality joins only: on each domain
    a host belongs to, and then on path prefixes of the lengths that the rules of the domain have."""
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))  # allow sorts before block
    labels = F.split("host", r"\.")
    places = F.sequence(F.lit(1), F.size(labels))
    domains = F.transform(places, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rows = urls.select("host", "path").distinct().where("host <> ''").withColumn("domain", F.explode(domains))
    lengths = rules.select(F.col("host").alias("domain"), F.length("path").alias("size")).distinct()
    rows = rows.join(lengths, "domain").where(F.length("path") >= F.col("size"))
    rows = rows.withColumn("prefix", F.expr("substring(path, 1, size)"))
    rows = rows.join(rules.select(F.col("host").alias("domain"), F.col("path").alias("prefix"), "verdict"), ["domain", "prefix"])
    name = F.concat("domain", "prefix")
    order = F.struct(F.length(name), F.length("domain"), name)
    return rows.groupBy("host", "path").agg(F.max_by(F.struct(name.alias("rule"), "verdict"), order).alias("best")).select(
        "host", "path", "best.rule", "best.verdict"
    )


def judged(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url, html).

    rules: host, path, verdict (allow or block). redirects: more (source, target) urls.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    links = links.withColumns({"a": address_of("source"), "b": address_of("target")})
    links = stored(links.where("a is not null and b is not null and a <> b").distinct(), "links")
    aliases = components(links)
    # rules decide on every url of the classes, be it a page or not
    members = links.select(F.col("source").alias("url"), F.col("a").alias("id"))
    members = members.union(links.select("target", "b")).dropDuplicates(["id"])
    members = members.select("id", host_of("url").alias("host"), path_of("url").alias("path"))
    blocked = members.join(best_rules(members, rules).where("verdict = 'block'"), ["host", "path"]).select("id")
    classes = aliases.join(blocked, "id").select("component").distinct()
    spoiled = stored(aliases.join(classes, "component").select(F.col("id").alias("address")).distinct(), "spoiled")

    rows = pages.select(
        "page_id", host_of("url").alias("host"), path_of("url").alias("path"), address_of("url").alias("address")
    )
    rows = rows.join(stored(best_rules(rows, rules), "rules"), ["host", "path"], "left")
    rows = rows.join(spoiled.withColumn("spoiled", F.lit(True)), "address", "left")
    verdict = F.coalesce("verdict", F.when(F.col("spoiled"), "block"), F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
