"""URL filters: rules on hosts and paths, and redirect equivalence through connected components.

Pages of one component of the redirect and canonical-link graph are aliases:
a block of one is a block of all, unless an explicit allow says otherwise.
DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import materialize
from feedlens.llm.components import connected_components

#: Rules are compiled into the plan as a literal, so their number is bounded.
MAX_RULES = 10_000
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
LINK_TAG, META_TAG = r"(?is)(<link\b[^>]*>)", r"(?is)(<meta\b[^>]*>)"
CANONICAL, REFRESH = r"(?is)\brel\s*=\s*[\"']?canonical\b", r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\bcontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"'\s>]+)"


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty if null or without '://'."""
    return _lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end; empty if null or without '://'."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def url_node(url: Column) -> Column:
    """Host, path and query: a url without scheme and fragment; null without a host."""
    host = url_host(url)
    return F.when(host != "", F.concat(host, url_path(url), F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))))


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule (verdict, host, path) that fits, or null.

    A rule fits its host and all subdomains if the path starts with the
    rule's. Equal lengths: allow before block, then by code point. Hosts are
    looked up by suffix, so the cost follows the host's labels."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are compiled into a plan")
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule_host, rule_path in sorted(set(rules), key=lambda r: (-len(r[1] + r[2]), r[0], r[1] + r[2])):
        by_host.setdefault(rule_host.lower(), []).append((rule_path, rule_host + rule_path, verdict))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    entry = lambda r: F.struct(F.lit(r[0]).alias("path"), F.lit(r[1]).alias("rule"), F.lit(r[2]).alias("verdict"))
    table = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*map(entry, own)))])
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fits = F.filter(F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull())),
                    lambda r: F.startswith(path, r["path"]))
    best = F.array_sort(fits, lambda a, b: F.when(F.length(a["rule"]) != F.length(b["rule"]), F.length(b["rule"]) - F.length(a["rule"]))
                        .when(a["verdict"] != b["verdict"], F.when(a["verdict"] < b["verdict"], -1).otherwise(1))
                        .otherwise(F.when(a["rule"] < b["rule"], -1).when(a["rule"] > b["rule"], 1).otherwise(0)))
    first = F.try_element_at(best, F.lit(1))
    return F.when(first.isNotNull(), F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


def _without_dots(path: Column) -> Column:
    """A path that starts with '/' less its '.' and '..' segments; what would climb above the root stays there."""
    parts = F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1)
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda out, x: F.when(x == ".", out)
                       .when(x == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))).otherwise(F.array_append(out, x)))
    whole = F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(whole, "/"))).otherwise(path)


def _absolute(target: Column, url: Column) -> Column:
    """The url that a reference on the page ``url`` means. Null for empty and fragment-only ones and for
    schemes without '://' (mailto:, javascript:), which name no page."""
    t = F.nullif(F.trim(target), F.lit(""))
    own = url_path(url)
    path, query = F.regexp_extract(t, r"(?s)^([^?#]*)", 1), F.regexp_extract(t, r"(?s)^[^?#]*(\?[^#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(own, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    full = F.when(path.startswith("/"), _without_dots(path)).when(path != "", _without_dots(F.concat(folder, path))).otherwise(own)
    return (F.when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), t).when(t.startswith("//"), F.concat(F.lit("http:"), t))
            .when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*:") | t.startswith("#"), F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("http://"), url_host(url), full, query)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) url nodes: all canonical links and meta redirects of the pages' html, relative ones resolved against the page's url."""
    html, url = F.col("html"), F.col("url")
    found = lambda tags, kind, target: F.transform(F.filter(F.regexp_extract_all(html, F.lit(tags), F.lit(1)), lambda x: x.rlike(kind)),
                                                   lambda x: F.regexp_extract(x, target, 1))
    linked = pages.where(html.rlike(r"(?i)canonical|http-equiv")).select(
        url, F.explode(F.concat(found(LINK_TAG, CANONICAL, HREF), found(META_TAG, REFRESH, REFRESH_URL))).alias("target"))
    return (linked.select(url_node(url).alias("src"), url_node(_absolute(F.col("target"), url)).alias("dst"))
            .where("src is not null and dst is not null"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None,
          default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url, html).

    A page that a rule fits has that rule's verdict. Any other takes its
    component's: allow if a member is explicitly allowed, else block if one is
    blocked, else ``default``. Members are the pages' urls and the urls that any of their
    canonical links and refreshes mean (relative ones resolved, dot segments removed), and the pairs of ``redirects`` (src,
    dst urls). Null urls and urls without '://' have empty host and path,
    no rule and the default. Repeated rows are judged alike; null page_ids
    and null html are kept; an empty table gives an empty result; other columns are ignored.
    Only urls with an edge enter the component search."""
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(url_node(F.col("src")).alias("src"), url_node(F.col("dst")).alias("dst")))
    parts = connected_components(edges.distinct(), "src", "dst")
    node_url = F.concat(F.lit("http://"), F.col("node"))
    decided = parts.withColumn("said", match_rule(url_host(node_url), url_path(node_url), rules)["verdict"])
    of_part = decided.groupBy("component").agg(F.min("said").alias("decision"))  # allow sorts before block
    verdicts = materialize(decided.join(of_part.where("decision is not null"), "component").select("node", "decision"), "url-verdicts")
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                        url_node(F.col("url")).alias("node"))
    rows = rows.withColumn("hit", match_rule(F.col("host"), F.col("path"), rules)).join(verdicts, "node", "left")
    return rows.select("page_id", "host", "path", F.col("hit")["rule"].alias("rule"),
                       F.coalesce(F.col("hit")["verdict"], "decision", F.lit(default)).alias("verdict"))


def oracle(rules: list[tuple[str, str, str]], default: str = "allow") -> str:
    """The same judgements in SQL; aliases by a recursive closure."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    host = lambda u: f"translate(coalesce(regexp_extract({u}, '^.*?://([^/?#]*)', 1, 's'), ''), '{upper}', '{lower}')"
    path = lambda u: f"coalesce(regexp_extract({u}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"
    query = lambda u: f"coalesce(regexp_extract({u}, '^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1, 's'), '')"
    fit = "(x.host = r.rhost OR x.host LIKE '%.' || r.rhost) AND starts_with(x.path, r.rpath)"
    best = "row_number() OVER (PARTITION BY x.k ORDER BY length(r.rhost || r.rpath) DESC, r.verdict, r.rhost || r.rpath)"
    return f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {values}),
p AS (SELECT row_number() OVER () AS k, page_id, url, html, {host('url')} AS host, {path('url')} AS path, {query('url')} AS query FROM pages),
l AS (
  SELECT host, path, query, trim(unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(<link\\b[^>]*>)', 1, 'is'), lambda x: regexp_matches(x, '\\brel\\s*=\\s*["'']?canonical\\b', 'is')),
      lambda x: regexp_extract(x, '\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is')),
    list_transform(list_filter(regexp_extract_all(html, '(<meta\\b[^>]*>)', 1, 'is'), lambda x: regexp_matches(x, '\\bhttp-equiv\\s*=\\s*["'']?refresh\\b', 'is')),
      lambda x: regexp_extract(x, '\\bcontent\\s*=\\s*["'']?\\s*[0-9.]*\\s*[;,]\\s*url\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is'))))) AS target FROM p),
r0 AS (SELECT *, regexp_extract(target, '^([^?#]*)', 1, 's') AS rel, regexp_extract(target, '^[^?#]*(\\?[^#]*)', 1, 's') AS asked,
         coalesce(nullif(regexp_extract(path, '^(.*/)', 1, 's'), ''), '/') AS folder FROM l WHERE target <> ''),
r1 AS (SELECT *, CASE WHEN starts_with(rel, '/') THEN rel WHEN rel <> '' THEN folder || rel ELSE path END AS raw FROM r0),
r2 AS (SELECT *, string_split(substr(raw, 2), '/') AS parts FROM r1),
t AS (SELECT *, CASE WHEN rel = '' OR NOT regexp_matches(raw, '/\\.\\.?(/|$)') THEN raw ELSE '/' || array_to_string(
    list_reduce(list_transform(parts, lambda x: [x]), lambda out, x: CASE WHEN x[1] = '.' THEN out WHEN x[1] = '..' THEN out[1:len(out) - 1] ELSE list_concat(out, x) END,
      CAST([] AS VARCHAR[])), '/')
    || CASE WHEN parts[-1] IN ('.', '..') AND len(list_reduce(list_transform(parts, lambda x: [x]), lambda out, x: CASE WHEN x[1] = '.' THEN out
      WHEN x[1] = '..' THEN out[1:len(out) - 1] ELSE list_concat(out, x) END, CAST([] AS VARCHAR[]))) > 0 THEN '/' ELSE '' END END AS resolved FROM r2),
a AS (
  SELECT host || path || query AS src, CASE WHEN regexp_matches(target, '^[a-z][a-z0-9+.-]*://', 'i') THEN target
           WHEN starts_with(target, '//') THEN 'http:' || target WHEN regexp_matches(target, '^[a-z][a-z0-9+.-]*:', 'i') OR starts_with(target, '#') THEN NULL
           ELSE 'http://' || host || resolved || asked END AS u
  FROM t WHERE host <> ''),
e AS (SELECT src, {host('u')} || {path('u')} || {query('u')} AS dst FROM a WHERE {host('u')} <> ''),
b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
reach(node, other) AS (SELECT src, src FROM b UNION SELECT reach.node, b.dst FROM reach JOIN b ON b.src = reach.other),
n AS (SELECT DISTINCT other AS k, {host("'http://' || other")} AS host, {path("'http://' || other")} AS path FROM reach),
d AS (SELECT k, verdict FROM (SELECT x.k, r.verdict, {best} AS nth FROM n x JOIN rules r ON {fit}) WHERE nth = 1),
c AS (SELECT reach.node, min(d.verdict) AS decision FROM reach JOIN d ON d.k = reach.other GROUP BY reach.node),
h AS (SELECT k, verdict, rule FROM (SELECT x.k, r.verdict, r.rhost || r.rpath AS rule, {best} AS nth FROM p x JOIN rules r ON {fit}) WHERE nth = 1)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, c.decision, '{default}') AS verdict
FROM p LEFT JOIN h USING (k) LEFT JOIN c ON c.node = p.host || p.path || p.query
"""
