"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are assigned values, access key ids, long hexadecimal strings (the
*base* kinds) and other long tokens that mix lower case, upper case and digits.
What tells a live-looking credential from an example is where else its value
occurs: candidates are hashed (the value itself is not kept), and each hash is
counted over all documents by distinct repositories and distinct owners. A
value of at most ``OWNERS`` owners and ``REPOS`` repositories is specific to
its owner; others are widely copied examples. Base spans are always reported;
a mixed token is reported (kind ``owned``) only if it is owner-specific.

The counts are nested aggregations with partial sums, (hash, owner, repository)
first, so a value in a third of all documents is no large group anywhere. The
verdicts go back to the occurrences by (hash, bucket of documents): one row per
hash and bucket meets the verdicts, and a bucket has a bounded share of the
occurrences of any hash.

Positions come from the lengths of the pieces between matches, summed in blocks,
in one projection of the text. Texts are read once; everything after works on
the narrow table of what was found.

Defined results: a null text is empty and holds nothing; a null id, owner or
repository is a value of its own; repeated rows get the same spans each and are
one repository; empty tables give no rows; extra columns are ignored. A
repository is counted under each of its owners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, let, upto

#: The base kinds, in the order in which spans of one start are listed, and the kind that the method adds.
KINDS = ("assign", "access", "hex", "owned")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in _KEYWORDS)
ASSIGN = f"({_EITHER})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS, HEX, TOKEN = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9_-]{20,}"
VALUE_LENGTH = 6
OWNERS, REPOS = 1, 8
#: Matches whose lengths are summed one by one; occurrences that a bucket of documents holds on average.
BLOCK, BUCKET = 256, 10_000
_SPAN = "array<struct<a:int,kind:int,b:int,h:string>>"


def matches(text: Column, pattern: str, kind: int, group: int = 0, starts: str | None = None) -> Column:
    """(a, kind, b, value) of the leftmost non-overlapping matches: code points
    [a, b), the value being that group. ``starts``: what to look for first, if
    that is quicker and finds every text with a match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    length = let(F.split(text, pattern, -1), lambda p: let(whole, lambda m: F.transform(m, lambda x, i: F.struct(
        F.length(F.get(p, i)).alias("gap"), F.length(x).alias("own")))))
    total = lambda part: F.aggregate(part, F.lit(0), lambda s, x: s + x["gap"] + x["own"])

    def spans(lens: Column, values: Column) -> Column:
        blocks = F.ceil(F.size(lens) / F.lit(BLOCK)).cast("int")
        sums = F.transform(upto(blocks), lambda k: total(F.slice(lens, k * BLOCK + 1, F.lit(BLOCK))))
        before = let(sums, lambda s: F.transform(upto(blocks), lambda k: F.aggregate(F.slice(s, F.lit(1), k), F.lit(0), lambda t, x: t + x)))

        def span(v: Column, i: Column, before: Column) -> Column:
            k = F.floor(i / F.lit(BLOCK)).cast("int")
            a = F.get(before, k) + total(F.slice(lens, k * BLOCK + 1, i - k * BLOCK)) + F.get(lens, i)["gap"]
            return let(a, lambda a: F.struct(a.alias("a"), F.lit(kind).alias("kind"), (a + F.get(lens, i)["own"]).alias("b"), v.alias("v")))

        return let(before, lambda o: F.transform(values, lambda v, i: span(v, i, o)))

    found = let(length, lambda lens: let(values, lambda v: spans(lens, v)))
    return F.when(text.rlike(starts or pattern), found).otherwise(F.array().cast("array<struct<a:int,kind:int,b:int,v:string>>"))


def candidates(text: Column) -> tuple[Column, Column]:
    """The base spans (a, kind, b, hash of the value) in order, and the mixed tokens outside of them."""
    hashed = lambda s: F.transform(s, lambda x: F.struct(x["a"], x["kind"], x["b"], F.sha2(x["v"], 256).alias("h")))
    assign = F.filter(matches(text, ASSIGN, 0, 2), lambda x: F.length(x["v"]) >= VALUE_LENGTH)
    base = F.concat(hashed(assign), hashed(matches(text, ACCESS, 1)), hashed(matches(text, HEX, 2)))
    mixed = F.filter(matches(text, TOKEN, 3, starts=f"(?<![A-Za-z0-9_-]){TOKEN}"),
                     lambda x: x["v"].rlike("[a-z]") & x["v"].rlike("[A-Z]") & x["v"].rlike("[0-9]"))
    return F.array_sort(base.cast(_SPAN)), hashed(mixed).cast(_SPAN)


def ownership(occurrences: DataFrame) -> DataFrame:
    """(h, n, n_repos, n_owners) of (h, owner, repo) rows, over the whole corpus."""
    each = occurrences.groupBy("h", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    each = each.groupBy("h", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_repos"))
    return each.groupBy("h").agg(F.sum("n").alias("n"), F.sum("n_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
                 owners: int = OWNERS, repos: int = REPOS) -> DataFrame:
    """Per row: id, base and spans (arrays of struct(a, kind, b): kind as in
    ``KINDS``), n_live and n_copied (base spans and added ones whose value is
    owner-specific; spans whose value is widely copied)."""
    scratch = Scratch(docs.sparkSession, "secrets")
    d = docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"),
                    F.col(repo_col).cast("string").alias("repo"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base, mixed = candidates(F.col("text"))
    found = d.select("id", "owner", "repo", base.alias("base"), mixed.alias("mixed")).withColumn(
        "mixed", F.filter("mixed", lambda x: ~F.exists("base", lambda y: (x["a"] < y["b"]) & (y["a"] < x["b"]))))
    found = scratch.table(found.withColumn("row", F.monotonically_increasing_id()), "found")
    held = found.where((F.size("base") > 0) | (F.size("mixed") > 0))
    buckets = 1 + (held.agg(F.sum(F.size("base") + F.size("mixed"))).first()[0] or 0) // BUCKET
    seen = held.select("row", "owner", "repo", F.explode(F.concat("base", "mixed")).alias("x")).select(
        "row", "owner", "repo", F.col("x.h").alias("h"), F.struct("x.a", "x.kind", "x.b").alias("span"),
        F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"))
    live = ownership(seen).where((F.col("n_owners") <= owners) & (F.col("n_repos") <= repos)).select(F.col("h").alias("of"))
    live = seen.select("h", "bucket").distinct().join(live, F.col("h") == F.col("of")).select("of", F.col("bucket").alias("part"))
    mine = seen.join(live, (F.col("h") == F.col("of")) & (F.col("bucket") == F.col("part"))).groupBy(F.col("row").alias("at")).agg(
        F.count(F.lit(1)).alias("n_live"), F.collect_list(F.when(F.col("span.kind") == 3, F.col("span"))).alias("added"))
    plain = F.transform("base", lambda x: F.struct(x["a"], x["kind"], x["b"]))
    n_live = F.coalesce("n_live", F.lit(0).cast("long"))
    some = held.join(mine, F.col("row") == F.col("at"), "left").select(
        "id", plain.alias("base"), F.array_sort(F.concat(plain, F.coalesce("added", F.array().cast("array<struct<a:int,kind:int,b:int>>")))).alias("spans"),
        n_live.alias("n_live"), (F.size("base") + F.size("mixed") - n_live).cast("long").alias("n_copied"))
    none = found.where((F.size("base") == 0) & (F.size("mixed") == 0)).select(
        "id", plain.alias("base"), plain.alias("spans"), F.lit(0).cast("long").alias("n_live"), F.lit(0).cast("long").alias("n_copied"))
    return none.unionByName(some)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["a"], x["b"])), ",")


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB SQL, owners being sources and repositories documents."""
    def kind(i: int, pattern: str, group: int, where: str) -> str:
        p = pattern.replace("'", "''")
        return f"""
SELECT rid, source, doc_id, {i} AS kind, v[i] AS v, a, a + length(m[i]) AS b FROM (
  SELECT *, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT rid, source, doc_id, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {group}) AS v, string_split_regex(t, '{p}') AS p FROM d)))
WHERE {where}"""
    name = "['" + "','".join(KINDS) + "'][kind + 1]"
    text = f"string_agg({name} || ':' || a || ':' || b, ',' ORDER BY a, kind)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
base AS ({kind(0, ASSIGN, 2, f"length(v[i]) >= {VALUE_LENGTH}")} UNION ALL {kind(1, ACCESS, 0, "true")} UNION ALL {kind(2, HEX, 0, "true")}),
mixed AS (SELECT * FROM ({kind(3, TOKEN, 0, "regexp_matches(v[i], '[a-z]') AND regexp_matches(v[i], '[A-Z]') AND regexp_matches(v[i], '[0-9]')")}) x
          WHERE NOT EXISTS (SELECT 1 FROM base y WHERE x.rid = y.rid AND x.a < y.b AND y.a < x.b)),
seen AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
live AS (SELECT v FROM seen GROUP BY v
         HAVING count(DISTINCT coalesce(source, '')) <= {OWNERS} AND count(DISTINCT coalesce(source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) <= {REPOS}),
n AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, {text} AS l
      FROM base GROUP BY rid),
s AS (SELECT rid, {text} FILTER (kind < 3 OR v IN (FROM live)) AS l, count(*) FILTER (v IN (FROM live)) AS n_live,
             count(*) FILTER (v NOT IN (FROM live)) AS n_copied FROM seen GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(n.l, '')) AS base_sha256, coalesce(s.l, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN n USING (rid) LEFT JOIN s USING (rid)
"""
