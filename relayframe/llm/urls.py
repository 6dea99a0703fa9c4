"""URL filter with redirect equivalence.

Rules name a host and the start of a path. A rule fits its host and every subdomain; the longest
rule that fits decides. Pages that redirect to each other or name one canonical address are one
component, found over the whole link graph, and a component carries the decision of its members
to the aliases that no rule fits: an explicit allow anywhere in it wins over a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm.components import components
from relayframe.llm.tables import ascii_lower, read

ALLOW, BLOCK = "allow", "block"
#: The rules of the registered query.
RULES = [("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW),
         ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK)]

_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """A path that starts with ``/`` with its ``.`` and ``..`` carried out."""
    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), lambda done, part: (
        F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .when(part == ".", done).otherwise(F.concat(done, F.array(part)))))
    return F.concat(F.array_join(kept, "/"), F.when(path.rlike(r"/\.\.?\z"), "/").otherwise(""))


def url_node(url: Column) -> Column:
    """The address as a node of the link graph: host lower-cased, ``.`` and ``..`` carried out, fragment left out."""
    scheme = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*([^#]*)", 1)
    rest = F.when(url_path(url).rlike(r"/\.\.?(/|\z)"), F.concat(_without_dots(url_path(url)), query)).otherwise(rest)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), url_host(url), rest))


def _absolute(base: Column, target: Column) -> Column:
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), url_host(base))
    folder = F.regexp_extract(url_path(base), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    own = F.when(url_path(base) == "", F.lit("/")).otherwise(url_path(base))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(root, target))
            .when(target.startswith("?"), F.concat(root, own, target))
            .when(target.startswith("#"), base)
            .otherwise(F.concat(root, folder, target)))


def link_edges(pages: DataFrame) -> DataFrame:
    """``(u, v)`` node pairs from canonical links and refresh redirects in the html of ``pages``.

    Written as ``&amp;``, ``&#38;`` or ``&#x26;``, an ampersand of an address is one. A page without html, without such an element or without ``://`` in its url gives none.
    """
    canonical = F.filter(F.regexp_extract_all("html", F.lit(_LINK), 0),
                         lambda tag: tag.rlike(r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""))
    refresh = F.filter(F.regexp_extract_all("html", F.lit(_META), 0),
                       lambda tag: tag.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""))
    targets = F.concat(
        F.transform(canonical, lambda tag: F.regexp_extract(tag, _HREF, 1)),
        F.transform(refresh, lambda tag: F.regexp_extract(tag, _REFRESH, 1)))
    found = (pages.select("url", "html").where(F.col("html").rlike(r"(?i)canonical|http-equiv"))
             .select("url", F.explode(F.filter(targets, lambda t: t != "")).alias("target"))
             .withColumn("target", F.regexp_replace("target", r"(?i)&(amp|#0*38|#x0*26);", "&")))
    return found.select(url_node(F.col("url")).alias("u"),
                        url_node(_absolute(F.col("url"), F.col("target"))).alias("v"))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` values with ``rule`` and ``action`` of the longest rule that fits.

    Urls without a rule are left out. Rules are looked up by equality: every host suffix of a url
    meets the lengths of the paths listed for that host, then the path start of each length. No
    url is compared with all rules. Of rules of one length an allow goes first, then the smaller
    text. Null urls fit nothing.
    """
    rules = (rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"),
                          "action").dropna().groupBy("rule_host", "rule_path")
             .agg(F.min("action").alias("action")))
    lengths = (rules.groupBy("rule_host")
               .agg(F.collect_set(F.length("rule_path")).alias("lengths")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    seen = (urls.select("url").where(F.instr("url", "://") > 0).distinct()
            .select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")))
    near = (seen.select("url", "path", F.explode(suffixes).alias("rule_host"))
            .join(lengths, "rule_host")
            .select("url", "path", "rule_host", F.explode("lengths").alias("k"))
            .where(F.length("path") >= F.col("k"))
            .select("url", "rule_host", F.expr("substring(path, 1, k)").alias("rule_path")))
    fits = near.join(rules, ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    order = F.struct((-F.length(rule)).alias("n"), F.col("action"), rule.alias("rule"))
    best = fits.groupBy("url").agg(F.min(order).alias("best"))
    return best.select("url", "best.rule", "best.action")


def judge_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule``, ``component`` and ``verdict``.

    ``rules`` has ``host, path, action``; ``edges`` has ``u, v`` in the form of ``url_node``.
    A rule that fits decides. Otherwise the component of the page decides, over all its members,
    also those that are no page: allow if an allow rule fits one, else block if a block rule fits
    one. Without either the page is allowed. Null urls and urls without ``://`` have an empty host
    and path and are allowed. Repeated pages keep their rows; page_id may be null.
    """
    own = match_rules(pages, rules)
    groups = components(edges)
    members = match_rules(groups.select(F.col("node").alias("url")), rules)
    carried = (groups.join(members.withColumnRenamed("url", "node"), "node")
               .groupBy("component").agg(F.min("action").alias("carried")))
    aliases = groups.join(carried, "component", "left").select(
        F.col("node"), F.col("component"), "carried")
    rows = pages.select("page_id", "url", url_node(F.col("url")).alias("node"))
    judged = rows.join(own, "url", "left").join(aliases, "node", "left")
    return judged.select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        "rule", "component", F.coalesce("action", "carried", F.lit(ALLOW)).alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by ``RULES`` and by the links in the pages' own html."""
    pages = read(spark, sf_dir, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    judged = judge_urls(pages, rules, link_edges(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _sql_host(url: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}')"


def _sql_path(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _sql_node(url: str) -> str:
    scheme = f"lower(regexp_extract({url}, '(?s)^(.*?)://', 1))"
    return f"{scheme} || '://' || {_sql_host(url)} || regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"


def _sql_fits(source: str) -> str:
    return f"""SELECT url, rule, action FROM (SELECT DISTINCT url FROM {source} WHERE contains(url, '://')) u
      JOIN rules r ON ({_sql_host('url')} = r.host OR ends_with({_sql_host('url')}, '.' || r.host))
        AND starts_with({_sql_path('url')}, r.path)
      QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(rule) DESC, action, rule) = 1"""


#: What the query returns, with the closure of the links spelled out node by node.
SQL_OP1 = rf"""
WITH RECURSIVE rules AS (
  SELECT *, host || path AS rule FROM (VALUES {', '.join(map(str, RULES))}) t(host, path, action)
), targets AS (
  SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1) AS target
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS tag FROM pages)
  WHERE regexp_matches(tag, '(?is)\brel\s*=\s*["'']?\s*canonical\b')
  UNION ALL
  SELECT url, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS tag FROM pages)
  WHERE regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
), absolute AS (
  SELECT url, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, {_sql_host('url')} AS host,
    coalesce(nullif(regexp_extract({_sql_path('url')}, '(?s)^(.*/)', 1), ''), '/') AS folder, target FROM targets
  WHERE target <> '' AND contains(url, '://')
), links AS (
  SELECT {_sql_node('url')} AS u, {_sql_node("full_url")} AS v FROM (SELECT *, CASE
      WHEN contains(target, '://') THEN target WHEN starts_with(target, '//') THEN scheme || ':' || target
      WHEN starts_with(target, '/') THEN scheme || '://' || host || target
      ELSE scheme || '://' || host || folder || target END AS full_url FROM absolute)
), both_ways AS (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reached AS (
  SELECT u AS node, u AS other FROM both_ways UNION SELECT r.node, b.v FROM reached r JOIN both_ways b ON b.u = r.other
), member_rules AS ({_sql_fits('(SELECT other AS url FROM reached)')}
), carried AS (
  SELECT node, min(action) AS action FROM reached JOIN member_rules ON url = other GROUP BY node
), own AS ({_sql_fits('pages')})
SELECT page_id, coalesce({_sql_host('p.url')}, '') AS host, coalesce({_sql_path('p.url')}, '') AS path, own.rule,
  coalesce(own.action, carried.action, 'allow') AS verdict
FROM pages p LEFT JOIN own ON own.url = p.url
LEFT JOIN carried ON contains(p.url, '://') AND carried.node = {_sql_node('p.url')}
"""
