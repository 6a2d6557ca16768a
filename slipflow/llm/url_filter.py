"""URL filters with redirect equivalence.

Rules (host, path) give every URL the verdict of the longest rule that fits. A URL that no rule
fits takes the decision of its aliases: URLs that differ only in scheme, query, fragment, a
``www.`` or ``m.`` before the host, a closing ``/`` or ``.html`` are one address, and
``<link rel="canonical">`` and ``<meta http-equiv="refresh">`` in a page link its address to
another, also by relative targets. Connected components over these edges (``components``) carry the decisions: an explicit
allow of any alias wins, then a block, else the URL is allowed.

Scale: the rules are a short list of literals, folded into one expression that needs no join. Only
addresses with an edge to another address enter the component rounds; decisions meet by one
aggregation on the address with map-side combine, so a common address is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, table
from .components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Name of the longest rule whose host is the URL's host or a parent of it and whose path
    begins the URL's path (of equally long ones the first by name); null if none fits."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(r.name))
            for r in sorted(rules, key=lambda r: (-len(r.name), r.name))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def rule_verdict(rule: Column, rules=RULES) -> Column:
    return reduce(lambda c, r: c.when(rule == r.name, F.lit(r.verdict)), rules, F.when(F.lit(False), F.lit(""))) \
        if rules else F.lit(None).cast("string")


def address(host: Column, path: Column) -> Column:
    """The canonical spelling of a URL: host without www. or m., path without closing / or .html."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.lit("/"),
                    F.regexp_replace(F.regexp_replace(path, r"(\.html|/+)$", ""), "^/", ""))


def without_dots(path: Column) -> Column:
    """A path that begins with / without its segments "." and ".."."""
    parts = F.split(path, "/", -1)
    return F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.lit(""), lambda seen, s: (
        F.when(s == "..", F.regexp_replace(seen, "/[^/]*$", "")).when(s == ".", seen)
        .otherwise(F.concat(seen, F.lit("/"), s))))


def _linked(html: Column, url: Column) -> Column:
    """URLs that a page names as its canonical or refresh target. What has no scheme is taken relative
    to the page: ``//host/x`` to its scheme, ``/x`` to its host, ``x`` and ``../x`` to the folder of its
    path; ``?x`` and ``#x`` are the page itself."""
    text = F.coalesce(html, F.lit(""))
    tags = F.concat(
        F.regexp_extract_all(text, F.lit(r"(?is)(<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>)"), 1),
        F.regexp_extract_all(text, F.lit(r"(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>)"), 1))
    target = F.transform(tags, lambda t: F.regexp_extract(
        t, r"(?is)\b(?:href\s*=\s*|url\s*=\s*)[\"']?([^\"'>\s;]+)", 1))
    origin = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(url_path(url), "[^/]*$", ""), "^/", ""))
    own = lambda u: F.regexp_extract(u, r"(?s)^[^?#]*", 0)
    whole = F.transform(target, lambda u: (
        F.when(u.startswith("//"), F.concat(F.lit("http:"), u))
        .when(u.startswith("/"), F.concat(origin, without_dots(own(u))))
        .when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), u)
        .when(own(u) == "", F.lit(""))
        .otherwise(F.concat(origin, without_dots(F.concat(folder, own(u)))))))
    return F.filter(whole, lambda u: url_host(u) != "")


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` as (page_id, host, path, rule, verdict, component).

    ``component`` is the smallest address among the aliases of the row's address. Null URLs and
    URLs without :// have an empty host and path, fit no rule, have no alias and get ``default``;
    their component is null. Null pages name no target. Repeated rows are judged alike; a null
    page_id stays null; an empty table gives an empty result; other columns are ignored.
    """
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"))
            .withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
            .withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
            .withColumn("address", F.when(F.col("host") != "", address(F.col("host"), F.col("path"))))
            .withColumn("targets", _linked(F.col("html"), F.col("url")))
            .select("page_id", "host", "path", "rule", "address", "targets"))
    rows = staged(rows, "urls")  # the pages themselves are read once
    edges = (rows.filter("address IS NOT NULL").select("address", F.explode("targets").alias("to"))
             .select(F.col("address").alias("u"), address(url_host(F.col("to")), url_path(F.col("to"))).alias("v"))
             .filter("u <> v"))
    edges = staged(edges.distinct(), "url-edges")
    placed = rows.withColumn("component", F.col("address"))
    if not edges.isEmpty():
        found = staged(components(edges), "url-components").select(F.col("node").alias("address"), F.col("component"))
        placed = rows.join(found, "address", "left").withColumn("component", F.coalesce("component", "address"))
    decided = rule_verdict(F.col("rule"), rules)
    known = (placed.filter("rule IS NOT NULL").groupBy("component")
             .agg(F.max((decided == "allow").cast("int")).alias("allowed")))
    known = staged(known, "url-decisions")
    return (placed.join(known, "component", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(decided, F.when(F.col("allowed") == 1, F.lit("allow"))
                               .when(F.col("allowed") == 0, F.lit("block")), F.lit(default)).alias("verdict"),
                    "component"))


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict for the URL of every page."""
    return judge_urls(table(spark, sf_dir, "pages"))


OP7_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, html, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '^(?:.|\n)*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?:.|\n)*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rhost, rpath, rverdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT p.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(rverdict, length(rhost || rpath)) AS rverdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY p.page_id),
a AS (
  SELECT p.page_id, p.host, p.path, fit.rule, fit.rverdict, p.html, p.url,
         CASE WHEN p.host <> '' THEN regexp_replace(p.host, '^(www|m)\.', '') || '/' ||
           regexp_replace(regexp_replace(p.path, '(\.html|/+)$', ''), '^/', '') END AS address
  FROM p LEFT JOIN fit USING (page_id)),
t AS (
  SELECT address, url, path, regexp_extract(unnest(
      regexp_extract_all(coalesce(html, ''), '(?is)(<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>)', 1) ||
      regexp_extract_all(coalesce(html, ''), '(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>)', 1)),
    '(?is)\b(?:href\s*=\s*|url\s*=\s*)["'']?([^"''>\s;]+)', 1) AS target FROM a WHERE address IS NOT NULL),
s AS (  -- what stands before a relative target, and its path up to ? or #
  SELECT *, regexp_extract(url, '^((?:.|\n)*?://[^/?#]*)', 1) AS origin, regexp_extract(target, '^[^?#]*', 0) AS own,
    '/' || regexp_replace(regexp_replace(path, '[^/]*$', ''), '^/', '') AS folder FROM t),
m AS (
  SELECT address, CASE
      WHEN starts_with(target, '//') THEN 'http:' || target
      WHEN starts_with(target, '/') THEN origin || list_reduce(string_split(own, '/')[2:], lambda seen, s: CASE s
        WHEN '..' THEN regexp_replace(seen, '/[^/]*$', '') WHEN '.' THEN seen ELSE seen || '/' || s END, '')
      WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN target
      WHEN own = '' THEN ''
      ELSE origin || list_reduce(string_split(folder || own, '/')[2:], lambda seen, s: CASE s
        WHEN '..' THEN regexp_replace(seen, '/[^/]*$', '') WHEN '.' THEN seen ELSE seen || '/' || s END, '')
    END AS target FROM s),
h AS (
  SELECT address, translate(regexp_extract(target, '^(?:.|\n)*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS thost, regexp_extract(target, '^(?:.|\n)*?://[^/?#]*([^?#]*)', 1) AS tpath FROM m),
e AS (
  SELECT DISTINCT address AS u, regexp_replace(thost, '^(www|m)\.', '') || '/' ||
    regexp_replace(regexp_replace(tpath, '(\.html|/+)$', ''), '^/', '') AS v
  FROM h WHERE thost <> ''),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach(u, v) AS (
  SELECT DISTINCT address, address FROM a WHERE address IS NOT NULL
  UNION SELECT reach.u, b.v FROM reach JOIN b ON reach.v = b.u),
c AS (SELECT u AS address, min(v) AS component FROM reach GROUP BY u),
k AS (
  SELECT component, max(CASE rverdict WHEN 'allow' THEN 1 ELSE 0 END) AS allowed
  FROM a JOIN c USING (address) WHERE rule IS NOT NULL GROUP BY component)
SELECT page_id, host, path, rule,
       coalesce(rverdict, CASE allowed WHEN 1 THEN 'allow' WHEN 0 THEN 'block' END, 'allow') AS verdict,
       c.component
FROM a LEFT JOIN c USING (address) LEFT JOIN k USING (component)
"""
