"""URL filter: host and path rules, and blocks that spread over redirects and canonical links.

A page that redirects to another (``<meta http-equiv=refresh>``), or that names another as its canonical form
(``<link rel=canonical>``), is an alias of it. The components of these links are classes of aliases; a class
with a blocked member blocks every member that no rule of its own judges. A page's own rule always comes first,
so an explicit allow is not overruled by a blocked alias.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and links to
nothing: its verdict is ``allow``. Null html has no links. Repeated rows are judged alike, each in its own row.
An empty table gives an empty result. Of two rules of one length that fit, ``allow`` wins, then the lesser text.
Only page_id, url and html are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import Scratch, read

# (action, host, path) of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _parts(url: Column) -> dict[str, Column]:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return {
        "host": F.coalesce(host, F.lit("")),
        "path": F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")),
        "tail": F.coalesce(F.regexp_extract(rest, "^[^/?#]*[^?#]*([^#]*)", 1), F.lit("")),
    }


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """host, path, and node: the address without scheme and fragment, null where there is no host."""
    parts = df.withColumns(_parts(F.col(url)))
    path = F.when(F.col("path") == "", "/").otherwise(F.col("path"))
    return parts.withColumn("node", F.when(F.col("host") != "", F.concat("host", path, "tail"))).drop("tail")


def with_rule(df: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """rule and action of the longest rule that fits host and path, else null.

    Addresses meet rules by equal host suffixes, each distinct address once.
    """
    spark = df.sparkSession
    table = spark.createDataFrame([(h, p, a) for a, h, p in rules], "r_host string, r_path string, action string")
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    places = df.select("host", "path").where("host <> ''").distinct()
    fitting = places.withColumn("r_host", F.explode(suffixes)).join(table, "r_host").where("startswith(path, r_path)")
    rule = F.concat("r_host", "r_path")
    best = fitting.groupBy("host", "path").agg(
        F.min(F.struct((-F.length(rule)).alias("n"), "action", rule.alias("rule"))).alias("best")
    )
    return df.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.rule"), "action": F.col("best.action")}).drop("best")


def alias_links(pages: DataFrame) -> DataFrame:
    """(a, b): addresses that a redirect or a canonical link makes one. ``pages``: html, host, path, node.

    A tag may go over several lines. Tags inside comments count like others.
    """
    tags = F.regexp_extract_all("html", F.lit("(?i)<(?:link|meta)\\s[^>]*>"), F.lit(0))
    tag = pages.where("node is not null").select("host", "path", "node", F.explode(tags).alias("tag"))
    refresh = F.col("tag").rlike("(?is)^<meta\\s.*http-equiv\\s*=\\s*[\"']?refresh")
    canonical = F.col("tag").rlike("(?is)^<link\\s.*rel\\s*=\\s*[\"']?canonical")
    target = F.when(
        canonical, F.regexp_extract("tag", "(?i)href\\s*=\\s*[\"']?\\s*([^\"'\\s>]*)", 1)
    ).when(refresh, F.regexp_extract("tag", "(?i)url\\s*=\\s*[\"']?\\s*([^\"'\\s>]*)", 1))
    # One element arrays keep the filters below from computing the whole expression again.
    found = tag.select("*", F.explode(F.array(F.replace(target, F.lit("&amp;"), F.lit("&")))).alias("to")).where("to <> ''")
    to = F.col("to")
    folder = F.when(F.col("path") == "", "/").otherwise(F.regexp_replace("path", "[^/]*$", ""))
    whole = (
        F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | to.startswith("#"), None)
        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.startswith("/"), F.concat(F.lit("http://"), "host", to))
        .when(to.startswith("?"), F.concat(F.lit("http://"), "host", "path", to))
        .otherwise(F.concat(F.lit("http://"), "host", folder, to))
    )
    ends = with_parts(found.select(F.col("node").alias("a"), F.explode(F.array(whole)).alias("url")), "url")
    return ends.where("node is not null and node <> a").select("a", F.col("node").alias("b")).distinct()


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, alias_class of every row of ``pages`` (page_id, url, html)."""
    scratch = Scratch(pages.sparkSession)
    parted = with_parts(pages.select("page_id", "url", "html"), "url")
    links = scratch.keep(alias_links(parted), "aliases")
    classes = components(links, scratch)
    # An address that only a link names counts too: its rule may block the class.
    members = with_rule(classes.select("id", "label", F.concat(F.lit("://"), "id").alias("url")).transform(with_parts, "url"), rules)
    blocked = members.groupBy("label").agg(F.max(F.expr("action <=> 'block'")).alias("blocked"))
    alias = classes.join(blocked, "label").select(F.col("id").alias("node"), F.col("label").alias("alias_class"), "blocked")
    whole = with_rule(parted.select("page_id", "host", "path", "node"), rules).join(alias, "node", "left")
    verdict = F.coalesce("action", F.when(F.col("blocked"), "block"), F.lit("allow"))
    return whole.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "alias_class")


def op1_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page under the five rules and the blocks of its aliases."""
    return judged(read(spark, sf_dir, "pages"), RULES)


# The same over DuckDB: blocks spread from blocked addresses along links in either direction.
SQL = r"""
WITH RECURSIVE rules(action, r_host, r_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rested AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parted AS (SELECT page_id, html,
  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
  coalesce(regexp_extract(rest, '^[^/?#]*[^?#]*([^#]*)', 1), '') AS tail FROM rested),
noded AS (SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || tail END AS node FROM parted),
tags AS (SELECT host, path, node, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\s[^>]*>')) AS tag FROM noded WHERE node IS NOT NULL),
targets AS (SELECT host, path, node, replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link\s.*rel\s*=\s*["'']?canonical') THEN regexp_extract(tag, '(?i)href\s*=\s*["'']?\s*([^"''\s>]*)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\s.*http-equiv\s*=\s*["'']?refresh') THEN regexp_extract(tag, '(?i)url\s*=\s*["'']?\s*([^"''\s>]*)', 1) END, '&amp;', '&') AS t FROM tags),
whole AS (SELECT node AS a, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR t[1] = '#' THEN NULL
    WHEN t[1:2] = '//' THEN 'http:' || t WHEN t[1] = '/' THEN 'http://' || host || t
    WHEN t[1] = '?' THEN 'http://' || host || path || t
    ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || t END AS url FROM targets WHERE t <> ''),
ends AS (SELECT a, substr(url, strpos(url, '://') + 3) AS rest FROM whole WHERE url IS NOT NULL),
aliases AS (SELECT a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  || CASE WHEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END
  || regexp_extract(rest, '^[^/?#]*[^?#]*([^#]*)', 1) AS b FROM ends WHERE regexp_extract(rest, '^[^/?#]*') <> ''),
links AS (SELECT a, b FROM aliases UNION SELECT b, a FROM aliases),
places AS (SELECT DISTINCT host, path FROM noded UNION SELECT DISTINCT regexp_extract(a, '^[^/?#]*'), regexp_extract(a, '^[^/?#]*([^?#]*)', 1) FROM links),
fitting AS (SELECT host, path, r_host || r_path AS rule, action, row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC, action, r_host || r_path) AS k
  FROM places JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
best AS (SELECT * FROM fitting WHERE k = 1),
blocked(node) AS (
  SELECT DISTINCT a FROM links JOIN best ON host = regexp_extract(a, '^[^/?#]*') AND path = regexp_extract(a, '^[^/?#]*([^?#]*)', 1) WHERE action = 'block'
  UNION SELECT b FROM blocked JOIN links ON a = node),
classes(node, m) AS (SELECT a, a FROM links UNION SELECT c.node, l.b FROM classes c JOIN links l ON l.a = c.m),
labels AS (SELECT node, min(m) AS alias_class FROM classes GROUP BY node)
SELECT n.page_id, n.host, n.path, best.rule, coalesce(best.action, CASE WHEN blocked.node IS NOT NULL THEN 'block' END, 'allow') AS verdict, labels.alias_class
FROM noded n LEFT JOIN best ON best.host = n.host AND best.path = n.path LEFT JOIN blocked ON blocked.node = n.node LEFT JOIN labels ON labels.node = n.node
"""
