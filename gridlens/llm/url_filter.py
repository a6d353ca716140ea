"""URL filters by redirect equivalence.

Rules (host, path) block or allow urls. A page's own rule decides its verdict. Pages that no
rule fits take it from their aliases: canonical links and refreshes in the html, and any
redirect log given, are edges between urls, and connected components of these are the
aliases. In a component an explicit allow goes before a block; without either, and for
pages without links, the verdict is allow.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule and
no alias; null html has no links; every canonical link and refresh of a page counts; relative
links are resolved against the page's host, folder or query, those of other schemes
(``mailto:x``) are none; repeated rows stay; longest rule first, at equal length allow first; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import BROADCAST_ROWS, Scratch, ascii_lower, components, small

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Rules up to which they are tested in one expression; more are joined.
INLINE_RULES = 500

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINKS = (
    r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*([^"'\s>]+)""",
)


def host_of(url):
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _ranked(rules: Sequence[tuple[str, str, str]]):
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "allow", r))


def rule_index(host, path, rules):
    """Place in ``_ranked(rules)`` of the rule that fits, or null."""
    out = None
    for k, (h, p, _) in enumerate(_ranked(rules)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, k) if out is None else out.when(fits, k)
    return F.lit(None).cast("int") if out is None else out


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds rule (host and path of the longest that fits) and ruled (its verdict).

    Beyond INLINE_RULES the distinct (host, path) are joined to the rules by the endings of
    the host, of as many labels as any rule has.
    """
    spark, ranked = pages.sparkSession, _ranked(rules)
    if len(ranked) <= INLINE_RULES:
        at = pages.withColumn("_at", rule_index(F.col("host"), F.col("path"), rules))
        names = F.array(*[F.lit(h + p) for h, p, _ in ranked]) if ranked else F.array().cast("array<string>")
        verdicts = F.array(*[F.lit(v) for *_, v in ranked]) if ranked else F.array().cast("array<string>")
        return at.withColumns({"rule": F.get(names, F.col("_at")), "ruled": F.get(verdicts, F.col("_at"))}).drop("_at")
    table = spark.createDataFrame([(h, p, v, k) for k, (h, p, v) in enumerate(ranked)], "rule_host string, rule_path string, ruled string, _at int")
    labels = max(h.count(".") + 1 for h, *_ in ranked)
    urls = pages.select("host", "path").distinct()
    ends = urls.withColumn("rule_host", F.explode(F.expr(f"transform(sequence(1, least({labels}, size(split(host, '[.]')))), n -> substring_index(host, '.', -n))")))
    found = ends.join(small(table, len(ranked), BROADCAST_ROWS), "rule_host").where("startswith(path, rule_path)")
    best = found.groupBy("host", "path").agg(F.min_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "ruled"), "_at").alias("r"))
    return pages.join(best, ["host", "path"], "left").withColumns({"rule": F.col("r.rule"), "ruled": F.col("r.ruled")}).drop("r")


def alias_key(url):
    """What makes two urls the same node: host and path without a closing slash, and the query."""
    asked = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.regexp_replace(path_of(url), "/$", ""), asked))


def without_dots(path):
    """A path with its ``.`` and ``..`` parts walked; it never leaves the root."""
    parts = F.filter(F.split(path, "/", -1), lambda x, i: (i > 0) & (x != "."))
    up = F.aggregate(parts, F.array().cast("array<string>"), lambda out, x: F.when(x == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).otherwise(F.concat(out, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(up, "/"))


def resolved(to, host, path):
    """The url that a link ``to`` on a page (host, path) names: whole, without a scheme, from the host's root, of the page's own query or part, or from its folder."""
    to = F.regexp_replace(F.trim(to), "(?i)&amp;", "&")
    asked = F.regexp_extract(to, r"(?s)^[^?#]*([?#].*)$", 1)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    from_folder = F.concat(without_dots(F.concat(folder, F.regexp_extract(to, r"(?s)^([^?#]*)", 1))), asked)
    return (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), to)
        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.rlike("^[?#]"), F.concat(F.lit("http://"), host, path, to))
        .when(to.startswith("/"), F.concat(F.lit("http://"), host, without_dots(F.regexp_extract(to, r"(?s)^([^?#]*)", 1)), asked))
        .when(~to.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.concat(F.lit("http://"), host, from_folder))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): keys of each page's url and of every url that its html names as its own."""
    found = F.flatten(F.array(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in _LINKS]))
    rows = pages.where("host <> '' and html is not null and (contains(lower(html), 'canonical') or contains(lower(html), 'refresh'))")
    rows = rows.select("url", "host", "path", F.explode(F.array_distinct(found)).alias("to"))
    to = resolved(F.col("to"), F.col("host"), F.col("path"))
    return rows.select(alias_key(F.col("url")).alias("a"), alias_key(to).alias("b")).where("a is not null and b is not null and a <> b")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, by (``rule``, ``alias`` or ``default``) of every page.

    ``redirects`` may hold further edges (src_url, dst_url).
    """
    scratch = Scratch(pages.sparkSession, "urls")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    edges = link_edges(rows)
    if redirects is not None:
        edges = edges.union(redirects.select(alias_key(F.col("src_url")).alias("a"), alias_key(F.col("dst_url")).alias("b")).where("a is not null and b is not null and a <> b"))
    edges = scratch.save(edges.distinct(), "links")
    ruled = with_rule(rows.select("page_id", "url", "host", "path"), rules)
    if edges.isEmpty():
        told = ruled.withColumn("passed", F.lit(None).cast("string"))
    else:
        member = scratch.save(components(edges, scratch), "members")
        keyed = ruled.withColumn("node", alias_key(F.col("url")))
        decided = keyed.where("ruled is not null").select("node", "ruled").distinct().join(member, "node")
        passed = decided.groupBy("component").agg(F.min("ruled").alias("passed"))  # allow goes before block
        told = keyed.join(member.join(passed, "component").select("node", "passed"), "node", "left")
    return told.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "passed", F.lit("allow")).alias("verdict"),
        F.when(F.col("ruled").isNotNull(), "rule").when(F.col("passed").isNotNull(), "alias").otherwise("default").alias("by"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


#: Decisions by rules; pages without links, as all of the tables have, are else allowed.
ORACLE = r"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN 'default' ELSE 'rule' END AS by
FROM parts LEFT JOIN best USING (host, path)
"""
