"""URL filter with redirect equivalence.

A page's verdict is that of the longest rule that fits its URL. Pages that no
rule fits take part in an equivalence: redirects, declared canonical links and
URL forms that stand for the same address link URLs, and the connected
components of those links are aliases of one another. A component that holds
a URL blocked by a rule blocks its members, except members that a rule allows
explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import connected_components, cut, read

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))

#: Host prefixes of a site's mirrors, query keys that only track,
#: names of default files, by which URLs differ that lead to the same page.
MIRROR_HOSTS = r"^(www|m)\."
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"
ENDINGS = r"(/|/index\.html?|\.html?)$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """struct(length, allow, rule, verdict) of the longest fitting rule, else null. Rules
    are literals of the plan; of equally long ones an allow rule wins, then the text."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("length"),
                            F.lit(int(v == "allow")).alias("allow"),
                            F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast(
        "struct<length:int,allow:int,rule:string,verdict:string>")


def same_page_form(url: Column) -> Column:
    """The form shared by URLs that lead to the same page: no scheme, mirror host prefix,
    fragment, tracking query key, default file ending; null for null or no host."""
    host = F.regexp_replace(host_of(url), MIRROR_HOSTS, "")
    path = F.regexp_replace(path_of(url), ENDINGS, "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"),
                                 lambda q: (q != "") & ~q.rlike("^" + TRACKING + "(=|$)")))
    form = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(
        F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(host != "", form)


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    none = F.array().cast("array<string>")
    done = F.aggregate(F.slice(parts, 2, F.size(parts)), none, lambda acc, x: F.when(
        x == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(none))
        .when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(done, F.array(F.lit(""))))
                                             .otherwise(done), "/"))


def resolved(target: Column, url: Column) -> Column:
    """The absolute URL of a target on the page ``url``; null for one on the page itself, one
    with a scheme but no host, and a relative one on a page without host."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return F.when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target) \
        .when((target == "") | target.startswith("#") | target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:")
              | (host_of(url) == ""), None) \
        .when(target.startswith("//"), F.concat(scheme, target)) \
        .when(target.startswith("?"), F.concat(site, path_of(url), target)) \
        .when(target.startswith("/"), F.concat(site, without_dots(path), rest)) \
        .otherwise(F.concat(site, without_dots(F.concat(folder, path)), rest))


def declared_targets(html: Column, url: Column) -> Column:
    """Absolute URLs that the page ``url`` declares as its canonical address or redirects to;
    relative ones are resolved against the page's URL (a ``<base>`` tag isn't read)."""
    tags = F.regexp_extract_all(html, F.lit(
        r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), 0)
    refresh = F.regexp_extract_all(html, F.lit(
        r"(?is)<meta\b[^>]*http-equiv\s*=\s*[\"']?refresh\b[^>]*>"), 0)
    links = F.transform(tags, lambda t: F.regexp_extract(
        t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    moves = F.transform(refresh, lambda t: F.regexp_extract(
        t, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1))
    return F.filter(F.transform(F.concat(links, moves), lambda u: resolved(u, url)), F.isnotnull)


def judge(pages: DataFrame, rules=RULES, *, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html"
          ) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, alias (the component's
    smallest URL form, null without host).

    ``redirects`` (source, target) may add redirect edges between URLs. A null url,
    or one without ``://``, has empty host and path, no alias and is allowed, as is
    every page that neither a rule nor its aliases block. Repeated rows each get
    their row. An empty table gives an empty result. Other columns are ignored.

    Components run over URL forms, not rows. Forms that no edge joins to another
    form are their own component without entering the graph, so only linked
    forms are shuffled by the graph steps; their blocks are grouped per form
    before the join.
    """
    url = F.col(url_col)
    p = pages.select(F.col(id_col), url.alias("__url"),
                     (F.col(html_col) if html_col else F.lit(None).cast("string")).alias("__html"))
    host, path = host_of(F.col("__url")), path_of(F.col("__url"))
    p = p.select(id_col, "__url", host.alias("host"), path.alias("path"),
                 rule_of(host, path, rules).alias("r"),
                 same_page_form(F.col("__url")).alias("form"),
                 declared_targets(F.col("__html"), F.col("__url")).alias("to"))
    p, _ = cut(p.drop("__url").withColumn("links", F.col("to")).drop("to"), "url_pages")
    # every URL in sight: pages, their declared targets, both ends of given redirects
    ends = p.select("form", F.explode("links").alias("target"))
    if redirects is not None:
        given = redirects.select(F.col("source").alias("s"), F.col("target").alias("target"))
        ends = ends.unionByName(given.select(same_page_form(F.col("s")).alias("form"), "target"))
        sources = given.select(F.col("s").alias("target"))
    others = ends.select("target") if redirects is None else ends.select("target").union(sources)
    blocked = p.filter("r.verdict = 'block'").select("form").union(
        others.filter(rule_of(host_of(F.col("target")), path_of(F.col("target")), rules)["verdict"]
                      == "block").select(same_page_form(F.col("target"))))
    edges = ends.select(F.col("form").alias("u"), same_page_form(F.col("target")).alias("v"))
    comp, _ = cut(connected_components(edges), "url_components")
    blocked = blocked.filter("form is not null").distinct() \
        .join(comp, F.col("form") == F.col("node"), "left") \
        .select(F.coalesce("component", "form").alias("alias"), F.lit(True).alias("bad")).distinct()
    # a table of its own, so the join with a hot alias can be dealt anew by adaptive execution
    blocked, _ = cut(blocked, "url_blocked")
    placed = p.join(comp, F.col("form") == F.col("node"), "left") \
        .withColumn("alias", F.coalesce("component", "form"))
    return placed.join(blocked, "alias", "left").select(
        id_col, "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(F.col("bad"), "block").otherwise("allow"))
        .alias("verdict"), "alias")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


SQL = r"""
WITH RECURSIVE p0 AS (
  SELECT page_id, row_number() OVER () AS r,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '') AS query,
         list_filter(list_concat(
           list_transform(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                          lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
           list_transform(regexp_extract_all(coalesce(html, ''), '(?is)<meta\b[^>]*http-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                          lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1))),
           lambda u: contains(u, '://')) AS links
  FROM pages),
t0 AS (SELECT r, unnest(links) AS url FROM p0),
t1 AS (
  SELECT r, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1) AS query FROM t0),
u AS (SELECT r, NULL AS target, host, path, query FROM p0
      UNION ALL SELECT r, row_number() OVER (), host, path, query FROM t1),
f AS (
  SELECT *, CASE WHEN regexp_replace(host, '^(www|m)\.', '') <> '' THEN
      regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|/index\.html?|\.html?)$', '')
      || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS form,
    CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM (SELECT *, list_sort(list_filter(string_split(query, '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS q FROM u)),
e AS (
  SELECT DISTINCT a.form AS u, b.form AS v FROM f a JOIN f b ON a.r = b.r
  WHERE a.target IS NULL AND b.target IS NOT NULL AND a.form <> b.form),
e2 AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (SELECT u AS node, u AS other FROM e2 UNION SELECT reach.node, e2.v FROM reach JOIN e2 ON reach.other = e2.u),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
placed AS (SELECT f.*, coalesce(component, form) AS alias FROM f LEFT JOIN comp ON f.form = comp.node),
bad AS (SELECT DISTINCT alias FROM placed WHERE rule IN ('example.com/en/', 'net/es/', 'net/fr/') AND alias IS NOT NULL)
SELECT p0.page_id, placed.host, placed.path, placed.rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN bad.alias IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       placed.alias
FROM placed JOIN p0 ON p0.r = placed.r AND placed.target IS NULL LEFT JOIN bad ON bad.alias = placed.alias
"""
