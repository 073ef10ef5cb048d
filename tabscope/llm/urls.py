"""URL filters: host and path rules, carried to aliases over redirects and canonical links; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.functions.aggregates import small
from tabscope.llm.frames import stored
from tabscope.llm.graph import components

# The rules of the registered query, as host, path and verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Patterns that Java and RE2 read alike. A tag ends at the next angle bracket, so that scans stay linear.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_TAG = r"(?i)<(?:link|meta)\s[^<>]*>"
_CANONICAL = r"(?i)\srel\s*=\s*[\"']?canonical[\"'\s/>]"
_HREF = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?i)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"
_TO = r"(?i)\scontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"'\s>]+)"


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """``host``, ``path``, ``verdict`` rows from a list."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    if not rows:
        return spark.range(0).selectExpr("'' AS host", "'' AS path", "'' AS verdict")
    return spark.range(1).select(F.inline(F.array(*rows)))


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical_form(url: Column) -> Column:
    """The form that trivially equal addresses share; null without a host.

    Scheme, a leading ``www.``, slashes at the end of the path, the fragment and ``utm_`` parameters are left out.
    """
    fields = F.filter(
        F.split(F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit("")), "&", -1),
        lambda f: (f != "") & ~f.startswith("utm_"),
    )
    query = F.array_join(fields, "&")
    name = F.regexp_replace(host(url), r"^www\.", "")
    form = F.concat(name, F.regexp_replace(path(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host(url) != "", form)


def resolved(url: Column, target: Column) -> Column:
    """``target`` as seen from the page ``url``: absolute, without a scheme, from the root or beside the page."""
    scheme, base = F.substring_index(url, "://", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(path(url), "[^/]*$", "")
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``from_url``, ``to_url`` of each canonical link and each refresh that a page declares in its text.

    Pages without a host or text have none. ``&amp;`` in a target stands for ``&``.
    """
    tags = F.regexp_extract_all(F.col("html"), F.lit(_TAG), F.lit(0))
    target = lambda t: (
        F.when(t.rlike(_CANONICAL), F.regexp_extract(t, _HREF, 1)).when(t.rlike(_REFRESH), F.regexp_extract(t, _TO, 1))
    )
    rows = pages.select(F.col(url_col).alias("from_url"), F.col(html_col).alias("html")).where(host(F.col("from_url")) != "")
    rows = rows.select("from_url", F.explode(F.transform(tags, target)).alias("target")).where("target <> ''")
    return rows.select("from_url", resolved(F.col("from_url"), F.replace("target", F.lit("&amp;"), F.lit("&"))).alias("to_url"))


def _with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (column ``url``) with ``host``, ``path``, ``rule`` and ``rule_verdict`` of the longest fitting rule.

    Each distinct host looks up as many suffixes as the rules' hosts have different numbers of labels, so the work
    does not grow with the rules times the urls; only those numbers are collected. Of rules of one length (repeated ones) an allow wins.
    """
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')").select(
        F.translate("host", UPPER, LOWER).alias("suffix"), F.col("path").alias("start"), "verdict"
    )
    labels = F.size(F.split("suffix", r"\."))
    counts = sorted(r[0] for r in rules.select(labels.alias("n")).distinct().collect())
    urls = urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in counts]).cast("array<string>"))
    hosts = urls.select("host").where("host <> ''").distinct().select("host", F.explode(suffixes).alias("suffix"))
    found = hosts.join(small(rules), "suffix").groupBy("host").agg(
        F.collect_set(F.struct(F.length(F.concat("suffix", "start")).alias("n"), (F.col("verdict") == "allow").alias("allow"), F.concat("suffix", "start").alias("rule"), "start", "verdict")).alias("rules")
    )
    found = small(stored(found, "host_rules")).withColumnRenamed("host", "rule_host")
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["start"])))
    rows = urls.join(found, F.col("host") == F.col("rule_host"), "left").withColumn("best", best)
    return rows.withColumns({"rule": F.col("best.rule"), "rule_verdict": F.col("best.verdict")}).drop("best", "rules", "rule_host")


def judge_urls(
    pages: DataFrame, rules: DataFrame, links: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Columns id, ``host``, ``path``, ``rule``, ``verdict``: one row per page.

    ``links`` (``from_url``, ``to_url``) are redirects and canonical links; with addresses of one canonical form they
    make aliases. A page with a fitting rule follows the longest. Any other is blocked if one of its aliases, in the
    table or only the end of a link, is blocked by a rule, and allowed otherwise. So a rule that allows a page stands
    against blocked aliases, but does not free the other aliases.

    Urls that are null or without ``://`` have an empty host and path, no rule and no aliases and are allowed.
    Repeated rows and ids are judged row by row; further columns are ignored; empty tables give no rows. A url of
    very many rows is met by one row of the blocked forms, which Spark splits when the join is skewed.
    """
    # Read three times below, so pages are searched for links once.
    links = stored(links.select("from_url", "to_url"), "links")
    ends = links.select(F.explode(F.array("from_url", "to_url")).alias("url")).where("url IS NOT NULL").distinct()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = _with_rules(rows, rules).withColumn("form", canonical_form(F.col("url")))
    ruled_ends = _with_rules(ends, rules).select(canonical_form(F.col("url")).alias("form"), "rule_verdict")
    blocked = rows.select("form", "rule_verdict").unionAll(ruled_ends)
    blocked = stored(blocked.where("rule_verdict = 'block' AND form IS NOT NULL").select("form").distinct(), "blocked")
    edges = links.select(canonical_form(F.col("from_url")).alias("a"), canonical_form(F.col("to_url")).alias("b"))
    groups = components(edges.where("a IS NOT NULL AND b IS NOT NULL"))
    guilty = groups.join(blocked.withColumnRenamed("form", "node"), "node").select("label").distinct()
    aliases = groups.join(guilty, "label").select(F.col("node").alias("form"))
    shut = small(stored(blocked.unionAll(aliases).distinct(), "shut")).withColumnRenamed("form", "shut")
    judged = rows.join(shut, F.col("form") == F.col("shut"), "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("shut").isNotNull(), "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))


def _sql_host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '{_PARTS}', 1), ''), '{UPPER}', '{LOWER}')"


def _sql_path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '{_PARTS}', 2), '')"


def _sql_form(url: str) -> str:
    fields = f"list_filter(string_split(coalesce(regexp_extract({url}, '{_PARTS}', 3), ''), '&'), lambda f: f <> '' AND NOT starts_with(f, 'utm_'))"
    return (
        f"CASE WHEN {_sql_host(url)} <> '' THEN regexp_replace({_sql_host(url)}, '^www\\.', '') || regexp_replace({_sql_path(url)}, '/+$', '')"
        f" || CASE WHEN len({fields}) > 0 THEN '?' || array_to_string({fields}, '&') ELSE '' END END"
    )


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


SQL = f"""
WITH RECURSIVE rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
tags AS (
  SELECT url AS from_url, unnest(regexp_extract_all(html, '{_TAG}')) AS tag FROM pages WHERE {_sql_host("url")} <> ''
), targets AS (
  SELECT from_url, replace(CASE WHEN regexp_matches(tag, '{_quoted(_CANONICAL)}') THEN regexp_extract(tag, '{_quoted(_HREF)}', 1)
    WHEN regexp_matches(tag, '{_quoted(_REFRESH)}') THEN regexp_extract(tag, '{_quoted(_TO)}', 1) END, '&amp;', '&') AS target FROM tags
), links AS (
  SELECT from_url, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN split_part(from_url, '://', 1) || ':' || target
    WHEN starts_with(target, '/') THEN regexp_extract(from_url, '(?s)^(.*?://[^/?#]*)', 1) || target
    ELSE regexp_extract(from_url, '(?s)^(.*?://[^/?#]*)', 1) ||
      coalesce(nullif(regexp_replace({_sql_path("from_url")}, '[^/]*$', ''), ''), '/') || target END AS to_url
  FROM targets WHERE target <> ''
), urls AS (
  SELECT url FROM pages UNION SELECT from_url FROM links UNION SELECT to_url FROM links
), parts AS (
  SELECT url, {_sql_host("url")} AS host, {_sql_path("url")} AS path, {_sql_form("url")} AS form FROM urls
), ruled AS (
  SELECT parts.*, (SELECT arg_max(h || p, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule
  FROM parts
), decided AS (
  SELECT ruled.*, v FROM ruled LEFT JOIN rules ON rule = h || p
), edges AS (
  SELECT f.form AS a, t.form AS b FROM links JOIN parts f ON f.url = from_url JOIN parts t ON t.url = to_url
  WHERE f.form IS NOT NULL AND t.form IS NOT NULL
), shut AS (
  SELECT form FROM decided WHERE v = 'block' AND form IS NOT NULL
  UNION
  SELECT CASE WHEN a = form THEN b ELSE a END FROM shut JOIN edges ON a = form OR b = form
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN form IN (SELECT form FROM shut) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN decided ON pages.url IS NOT DISTINCT FROM decided.url
"""
