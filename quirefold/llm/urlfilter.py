"""URL rules with redirect equivalence.

A rule is a host, a path and a verdict. It fits the host and all its subdomains where the url's path starts
with the rule's path; of several, the longest wins. Urls that redirect to one another, or name one
another as canonical, are aliases: the components of the graph of these edges. A url that no rule fits
takes the verdict of its component: allowed if a rule allows a member of it, else blocked if a rule blocks
one, else the default.

Rules are joined by host suffix, once per distinct host, so that a long list is a join and not a loop.
Edges come from the pages themselves (canonical links, refresh redirects), or as a table.

Column expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import stored, table

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; of a null or other text, nothing."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"\A([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """A url without scheme and fragment: what names the resource. Null if there is no host."""
    rest = F.regexp_extract(after_scheme(url), r"\A[^/?#]*([^#]*)", 1)
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.when(rest == "", "/").otherwise(rest)))


def declared_links(html: Column, url: Column) -> Column:
    """Absolute targets of the page's canonical links and refresh redirects."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = F.filter(tags, lambda t: t.rlike(r"(?is)^<link\b[^>]*\brel\s*=\s*[\"']?canonical\b"))
    refresh = F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    hrefs = F.transform(canonical, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    moved = F.transform(refresh, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'>\s]+)", 1))
    scheme = F.regexp_extract(url, r"\A([^:/?#]*)://", 1)

    def absolute(target: Column) -> Column:
        target = F.regexp_replace(target, "&amp;", "&")
        folder = F.regexp_extract(path_of(url), r"\A(.*/)", 1)
        return (
            F.when(target.contains("://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(scheme, F.lit("://"), host_of(url), target))
            .otherwise(F.concat(scheme, F.lit("://"), host_of(url), F.when(folder == "", "/").otherwise(folder), target))
        )

    return F.transform(F.filter(F.concat(hrefs, moved), lambda t: t != F.lit("")), absolute)


def page_edges(pages: DataFrame) -> DataFrame:
    """``source, target`` urls of the redirects and canonical links that the pages declare."""
    return pages.select(F.col("url").alias("source"), F.explode(declared_links(F.col("html"), F.col("url"))).alias("target"))


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` with the rules of its suffixes: array of struct(length, path, rule, verdict)."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda at: F.array_join(F.slice(parts, at, F.size(parts)), ".")
    )
    named = rules.select(
        F.col("host").alias("suffix"),
        F.struct(
            F.length(F.concat("host", "path")).alias("length"), "path", F.concat("host", "path").alias("rule"), "verdict"
        ).alias("r"),
    )
    return (
        hosts.select("host", F.explode(suffixes).alias("suffix")).join(named, "suffix").groupBy("host").agg(F.collect_list("r").alias("rules"))
    )


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each row with ``host, path, rule, own`` by the rules alone. ``rule`` and ``own`` are null without a rule."""
    split = stored(urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}), "split-urls")
    known = stored(fitting_rules(split.select("host").distinct(), rules), "host-rules")
    best = F.array_max(F.filter(F.coalesce("rules", F.array()), lambda r: F.startswith(F.col("path"), r["path"])))
    return (
        split.join(known, "host", "left")
        .withColumn("best", best)
        .select(*split.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own"))
    )


def judge_pages(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], edges: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, component`` of each page.

    edges: further ``source, target`` urls. ``component`` is the smallest alias, null where a page has none. A
    null url, or one without a host, has no alias; repeated pages are judged alike.
    """
    spark = pages.sparkSession
    ruled = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    links = page_edges(pages)
    if edges is not None:
        links = links.unionByName(edges.select("source", "target"))
    ends = stored(
        links.select("source", "target", node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b")).filter(
            "a is not null and b is not null and a <> b"
        ),
        "alias-edges",
    )
    member = components(ends, "a", "b")
    judged = stored(judge(pages.select("page_id", "url"), ruled).withColumn("node", node_of(F.col("url"))), "judged")
    nodes = ends.select(F.col("a").alias("node"), F.col("source").alias("url")).unionAll(
        ends.select(F.col("b").alias("node"), F.col("target").alias("url"))
    )
    decided = judge(nodes.distinct(), ruled).filter("own is not null").select("node", "own").distinct()
    verdicts = (
        member.join(decided, "node")
        .groupBy("component")
        .agg(F.bool_or(F.col("own") == "allow").alias("allowed"), F.bool_or(F.col("own") == "block").alias("blocked"))
        .select("component", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("shared"))
    )
    known = stored(member.join(stored(verdicts, "component-verdicts"), "component", "left"), "alias-verdicts")
    return (
        judged.join(known, "node", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("own", "shared", F.lit(default)).alias("verdict"),
            "component",
        )
    )


def op1_redirect_equivalence(spark, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"), RULES).drop("component")


OP1_SQL = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), split AS (
  SELECT page_id, url,
         translate(CASE WHEN contains(url, '://')
                        THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1) ELSE '' END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN contains(url, '://')
              THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), fits AS (
  SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM split AS s JOIN rules AS r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY page_id
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN fits USING (page_id)
"""
