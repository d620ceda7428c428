"""The registered queries of the operators, with their DuckDB SQL where SQL can
say it. ``QUERIES``: name -> (spark, sf_dir) -> DataFrame; ``ORACLES``: name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_WORDS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark)),
iw AS (SELECT DISTINCT item_id, n, w[j + 1 : j + n] AS g
       FROM (SELECT item_id, n, w, unnest(range(0, len(w) - n + 1)) AS j FROM i WHERE n > 0)),
dw AS (SELECT rid, n, j, w[j + 1 : j + n] AS g
       FROM (SELECT rid, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) AS j
             FROM d, (SELECT DISTINCT n FROM i WHERE n > 0))),
h AS (SELECT rid, item_id, j, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(j, j + n)) AS p FROM h) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
       FROM h GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""


@query("op2_decontaminate", DECONTAMINATE_SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.decontaminate import decontaminate
    out = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.decision_list import judge
    out = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS hex FROM p),
bits AS (SELECT page_id, n, hex, list_reduce(list_prepend('', list_transform(string_split(hex, ''), lambda c:
           lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0'))), lambda a, c: a || c) AS bits FROM d),
e AS (SELECT page_id, n, hex, list_reduce(list_prepend('', list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(0, 5), lambda j:
        CAST(substr(bits, CAST(i * 5 + j + 1 AS BIGINT), 1) AS INT) * (16 >> CAST(j AS INT)))) AS BIGINT), 1))),
        lambda a, c: a || c) AS digest FROM bits),
m AS (SELECT hex, max(page_id) AS last FROM e GROUP BY hex)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN last IS NOT NULL AND (page_id IS NULL OR page_id < last) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS NOT NULL AND (page_id IS NULL OR page_id < last) THEN last END AS refers_to
FROM e JOIN m USING (hex)
"""


@query("op1_warc", WARC_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.common import Scratch
    from ledgerline.llm.warc import read_records, write_archives
    path = Scratch(spark, "warc").path("archive")
    write_archives(read(spark, sf_dir, "pages"), path)
    out = read_records(spark, path, payloads=False)
    number = lambda c: F.regexp_extract(c, "^<urn:page:([0-9-]+)[:>]", 1).try_cast("long")
    return out.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      number("refers_to").alias("refers_to"))


def _license_sql() -> str:
    from ledgerline.llm.licenses import oracle_sql
    return oracle_sql()


@query("op10_license_scan", _license_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.licenses import scan
    return scan(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _url_sql() -> str:
    from ledgerline.llm.url_filter import oracle_sql
    return oracle_sql()


@query("op8_url_filter", _url_sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.url_filter import judge
    return judge(read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.packing import added_tokens, pack
    return pack(read(spark, sf_dir, "documents"), added=added_tokens())


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.langid import held_out, predict
    out = predict(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.suffix_dedup import remove_repeats
    out = remove_repeats(read(spark, sf_dir, "documents"), keep_text=False)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.bagminhash import near_duplicates
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


@query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.passages import find_passages
    out = find_passages(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["b"] - x["a"]))
    return out.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_words", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), "spans")


SPELLING_SQL = """
WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
g AS (SELECT k, w, count(*) AS c FROM r WHERE length(w) >= 6 GROUP BY ALL),
b AS (SELECT w, c, flatten(list_transform(string_split(k || ':' || w, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)]
        ELSE [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)] END)) AS bytes FROM g),
-- the checksum bit by bit, as polynomial division by 0xEDB88320
h AS (SELECT w, c, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST(bytes AS BIGINT[])), lambda s, y:
        list_reduce(list_prepend(xor(s, y), CAST(range(8) AS BIGINT[])), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) AS h FROM b),
m AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM m WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
k AS (SELECT word, substr(word, 1, i) || chr(1) || substr(word, i + 2) AS skip, substr(word, 1, i) || substr(word, i + 2) AS short
      FROM (SELECT word, unnest(range(0, length(word))) AS i FROM v)),
pair AS (SELECT x.word, y.word AS other FROM k x JOIN k y ON x.skip = y.skip AND x.word <> y.word
         UNION SELECT k.word, v.word FROM k JOIN v ON k.short = v.word
         UNION SELECT v.word, k.word FROM k JOIN v ON k.short = v.word),
best AS (SELECT pair.word, other, o.n AS other_n, row_number() OVER (PARTITION BY pair.word ORDER BY o.n DESC, other) AS place,
                count(*) OVER (PARTITION BY pair.word) AS n_near FROM pair JOIN v o ON o.word = other),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
             CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best ON v.word = best.word AND place = 1),
up AS (SELECT word, word AS root, form AS onward FROM f
       UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.onward)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON up.word = f.word AND up.onward IS NULL
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.spelling import spelling_variants
    return spelling_variants(read(spark, sf_dir, "documents"))


def _secret_sql() -> str:
    from ledgerline.llm.secret_scan import oracle_sql
    return oracle_sql()


@query("op12_secret_scan", _secret_sql())
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.secret_scan import listed, of_kind, scan_secrets
    out = scan_secrets(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), *[of_kind(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(("assign", "access", "hex"))],
                      F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), "n_live", "n_copied")


SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
s AS (SELECT count(*) AS n_all, CAST(sum(len(w)) AS BIGINT) AS l_all FROM d WHERE len(w) > 0),
t AS (SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(w) AS w FROM d) GROUP BY ALL),
f AS (SELECT w, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM t, s GROUP BY w, n_all),
q AS (SELECT iid, item_id, w, count(*) AS times FROM (SELECT row_number() OVER () AS iid, item_id, unnest({_WORDS_SQL}) AS w FROM benchmark) GROUP BY ALL),
x AS (SELECT iid, item_id, rid, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * n_all) // l_all)))) AS BIGINT) AS score
      FROM q JOIN t USING (w) JOIN f USING (w) JOIN d USING (rid), s GROUP BY iid, item_id, rid),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
      FROM x JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@query("op13_ranked_search", SEARCH_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.lexical import search
    out = search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
