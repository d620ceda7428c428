"""URL filters with redirect equivalence.

A rule names a host and a path prefix; it fits the host and its subdomains,
the longest fitting rule decides (explicit allow or block). Redirects (meta
refresh, or a given table of redirects) and canonical links make URLs aliases;
connected components over these edges, computed with distributed stars, carry
a block to every alias that no rule decides. Allow takes precedence: a URL
with an explicit allow stays allowed, and so do the undecided aliases of a
component that holds an explicit allow. What nothing decides is allowed.

Defined results: a null url, or one without ``://``, has empty host and path,
no aliases, and is allowed; null html has no links; repeated rows are judged
alike; nodes are URLs with scheme and host lower-cased and without fragment;
empty inputs give empty results; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, UPPER, Scratch
from ledgerline.llm.components import components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
HOST, PATH, REST = "^.*?://([^/?#]*)", "^.*?://[^/?#]*([^?#]*)", "^.*?://[^/?#]*([^#]*)"
SCHEME = "^(.*?)://"
LINKS = "(?is)<(?:link|meta)\\b[^>]*>"
CANONICAL = "(?is)\\brel\\s*=\\s*[\"']?canonical\\b"
HREF = "(?is)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"
REFRESH = "(?is)\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b"
TARGET = "(?is)\\burl\\s*=\\s*[\"']?([^\"'\\s>;]+)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)" + HOST, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)" + PATH, 1), F.lit(""))


def node_of(url: Column) -> Column:
    scheme = F.translate(F.regexp_extract(url, "(?s)" + SCHEME, 1), UPPER, LOWER)
    return F.when(F.contains(url, F.lit("://")), F.concat(
        scheme, F.lit("://"), host_of(url), F.regexp_extract(url, "(?s)" + REST, 1)))


def deciding(host: Column, path: Column, rules: tuple[Rule, ...], part: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits; null if none does."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = (F.when if out is None else out.when)(fits, F.lit(getattr(r, part)))
    return F.lit(None).cast("string") if out is None else out


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): from each page's node to the target of its canonical link and of its refresh."""
    p = pages.where(F.lower(html_col).rlike("canonical|refresh")).select(F.col(url_col).alias("url"), F.explode(
        F.regexp_extract_all(F.col(html_col), F.lit(LINKS), F.lit(0))).alias("tag"))
    to = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(
        F.col("tag").rlike(REFRESH), F.regexp_extract("tag", TARGET, 1))
    p = p.select("url", to.alias("to")).where("to != ''")
    scheme = F.concat(F.regexp_extract("url", "(?s)" + SCHEME, 1), F.lit(":"))
    site = F.concat(scheme, F.lit("//"), host_of(F.col("url")))
    folder = F.regexp_extract(path_of(F.col("url")), "^(.*/)", 1)
    full = (F.when(F.col("to").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
            .when(F.startswith("to", F.lit("//")), F.concat(scheme, "to"))
            .when(F.startswith("to", F.lit("/")), F.concat(site, "to"))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), "to")))
    return p.select(node_of(F.col("url")).alias("a"), node_of(full).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict) per row. ``redirects``: optional (a, b) URLs."""
    scratch = Scratch(pages.sparkSession, "urls")
    edges = page_links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("a")), node_of(F.col("b"))))
    nodes = components(edges)
    own = deciding(host_of(F.col("node")), path_of(F.col("node")), rules, "verdict")
    nodes = scratch.table(nodes.withColumn("own", own), "nodes")
    roots = nodes.groupBy("root").agg(F.max((F.col("own") == "block").cast("int")).alias("block"),
                                      F.max((F.col("own") == "allow").cast("int")).alias("allow"))
    roots = roots.where("block = 1 AND coalesce(allow, 0) = 0").select(F.col("root").alias("r"))
    blocked = scratch.table(nodes.where("own IS NULL").join(roots, F.col("root") == F.col("r")).select("node"), "blocked")
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    p = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), node_of(F.col(url_col)).alias("n"))
    p = p.select("*", deciding(F.col("host"), F.col("path"), rules, "text").alias("rule"),
                 deciding(F.col("host"), F.col("path"), rules, "verdict").alias("said"))
    p = p.join(blocked, F.col("n") == F.col("node"), "left")
    return p.select("id", "host", "path", "rule", F.coalesce(
        "said", F.when(F.col("node").isNotNull(), F.lit("block"))).alias("said")).select(
        "id", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of judge() over ``pages``, with a recursive walk of the links."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    low = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    host = lambda u: low(f"regexp_extract({u}, {q('(?s)' + HOST)}, 1)")
    path = lambda u: f"regexp_extract({u}, {q('(?s)' + PATH)}, 1)"
    node = lambda u: (f"CASE WHEN contains({u}, '://') THEN {low(f'regexp_extract({u}, {q('(?s)' + SCHEME)}, 1)')} "  # noqa: E731
                      f"|| '://' || {host(u)} || regexp_extract({u}, {q('(?s)' + REST)}, 1) END")

    def rule(h: str, p: str, part: str) -> str:
        cases = " ".join(f"WHEN ({h} = {q(r.host)} OR ends_with({h}, {q('.' + r.host)})) AND starts_with({p}, {q(r.path)}) "
                         f"THEN {q(getattr(r, part))}" for r in sorted(rules, key=lambda r: (-len(r.text), r.text)))
        return f"CASE {cases} END"
    return f"""
WITH RECURSIVE tags AS (SELECT url, unnest(regexp_extract_all(coalesce(html, ''), {q(LINKS)})) AS tag FROM pages),
tos AS (SELECT url, CASE WHEN regexp_matches(tag, {q(CANONICAL)}) THEN regexp_extract(tag, {q(HREF)}, 1)
        WHEN regexp_matches(tag, {q(REFRESH)}) THEN regexp_extract(tag, {q(TARGET)}, 1) END AS t FROM tags),
fulls AS (SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN starts_with(t, '//') THEN regexp_extract(url, {q('(?s)' + SCHEME)}, 1) || ':' || t
        WHEN starts_with(t, '/') THEN regexp_extract(url, {q('(?s)' + SCHEME)}, 1) || '://' || {host('url')} || t
        ELSE regexp_extract(url, {q('(?s)' + SCHEME)}, 1) || '://' || {host('url')} ||
             coalesce(nullif(regexp_extract({path('url')}, '^(.*/)', 1), ''), '/') || t END AS t FROM tos WHERE t <> ''),
e AS (SELECT {node('url')} AS a, {node('t')} AS b FROM fulls),
s AS (SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL AND b IS NOT NULL),
reach(a, b) AS (SELECT a, b FROM s UNION SELECT r.a, s.b FROM reach r JOIN s ON r.b = s.a),
v AS (SELECT a, {rule(host('b'), path('b'), 'verdict')} AS x FROM reach),
c AS (SELECT a FROM v GROUP BY a HAVING bool_or(coalesce(x, '') = 'block') AND NOT bool_or(coalesce(x, '') = 'allow')),
p AS (SELECT page_id, coalesce({host('url')}, '') AS host, coalesce({path('url')}, '') AS path, {node('url')} AS n FROM pages)
SELECT page_id, host, path, {rule('host', 'path', 'text')} AS rule,
       coalesce({rule('host', 'path', 'verdict')}, CASE WHEN n IN (SELECT a FROM c) THEN 'block' END, 'allow') AS verdict
FROM p
"""
