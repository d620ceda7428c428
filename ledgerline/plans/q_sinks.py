"""Registered queries for sources and sinks: each writes under the session's
checkpoint folder and returns what it reads back."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.config import PipelineConfig
from ledgerline.functions.keys import surrogate_key
from ledgerline.functions.materialize import table_path
from ledgerline.operators import forecast as FC
from ledgerline.operators import marts as M
from ledgerline.plans.oracle import with_chain
from ledgerline.plans.q_core import mart_of, raw_of, stg_of
from ledgerline.plans.q_forecast import FC_CTES, SMOOTH_CTES, _best_baselines, _prepared, _full
from ledgerline.plans.registry import query
from ledgerline.sources import raw as R
from ledgerline.sources import sinks as K
from ledgerline.sources.records import tree_digest

CFG = PipelineConfig()


@query("src_csv_roundtrip", with_chain("SELECT * FROM raw"))
def src_csv_roundtrip(spark, d):
    """SRC1 + SRC2: the raw lines exported as headered CSV, scanned back as all-string
    columns with missing-value tokens nulled, and schema-checked."""
    path = K.export_csv(raw_of(spark, d), table_path(raw_of(spark, d), "raw_csv"))
    df = R.read_raw_csv(spark, path, multi_line=True)
    R.validate_schema(df)
    return df


@query("snk_replace", with_chain("SELECT * FROM stg"), ("unit_price", "discount", "sales"))
def snk_replace(spark, d):
    """SNK1: full replace (an empty table, then all rows); a third replacement that
    fails half-way leaves the rows, which are then read back."""
    stg = stg_of(spark, d)
    path = table_path(stg, "stg_replace")
    K.load_local(stg.where(F.lit(False)), path)
    K.load_local(stg, path)
    try:
        K.load_local(stg.withColumn("quantity", F.when(F.col("category") == "Promo", F.raise_error(F.lit("broken")).cast("int")).otherwise(
            F.col("quantity"))), path)
    except PySparkException:
        pass
    return K.read_table(spark, path)


@query("snk_partitioned", with_chain(
    "SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM stg"),
       ("unit_price", "discount", "sales"))
def snk_partitioned(spark, d):
    """SNK4: month directories, clustered by category and region, read back."""
    stg = stg_of(spark, d)
    path = K.write_partitioned_sales(stg, table_path(stg, "sales_partitioned"))
    return K.read_partitioned_sales(spark, path)


@query("snk_fallback", with_chain("SELECT *, 'fallback' AS sink FROM daily"), ("total_revenue",))
def snk_fallback(spark, d):
    """SNK2/SNK3: an unusable target falls back to the local table."""
    daily = M.sales_daily(M.fact_measures(stg_of(spark, d)))
    fb = table_path(daily, "daily_fallback")
    used = K.write_with_fallback(daily, "unconfigured-scheme://warehouse/sales_daily", fb)
    return K.read_table(spark, fb).withColumn("sink", F.lit(used))


@query("snk_csv_export", with_chain("SELECT * FROM daily"), ("total_revenue",))
def snk_csv_export(spark, d):
    """SNK8: a mart exported as headered CSV and read back with its schema."""
    daily = M.sales_daily(M.fact_measures(stg_of(spark, d)))
    path = K.export_csv(daily, table_path(daily, "sales_daily_csv"))
    return spark.read.schema(daily.schema).option("header", True).csv(path)


@query("snk_forecast_files", with_chain("SELECT * FROM fc_band", FC_CTES))
def snk_forecast_files(spark, d):
    """SNK5 + SNK6: forecast saved as Parquet, CSV and a forecast_date-partitioned
    table; the partitioned table is read back."""
    prepared = FC.eligible(_prepared(spark, d))
    fc = FC.generate_forecast(prepared, _best_baselines(spark, d), CFG.horizon, CFG.ma_window, CFG.season_length,
                              CFG.band_z, with_smoothing=False)
    paths = K.save_forecast(fc, table_path(prepared, "forecast"))
    back = spark.read.parquet(paths["table"]).withColumn("forecast_date", F.col("forecast_date").cast("date"))
    return back.drop("generated_at")


@query("snk_model_comparison", with_chain("SELECT * FROM fc_comparison", SMOOTH_CTES))
def snk_model_comparison(spark, d):
    """SNK9: model comparison (all four models, best marked) as JSON, read back."""
    comp = _full(spark, d)["comparison"]
    path = K.write_model_comparison(comp, table_path(comp, "model_comparison"))
    return spark.read.json(path)


@query("snk_metadata", with_chain("""SELECT 'driver tables' AS source, CASE WHEN customer_id IS NULL THEN 'unknown' ELSE 'known' END AS folder,
    'sha256' AS digest_kind, count(*) AS row_count, CAST(14 AS BIGINT) AS column_count, true AS own_digests FROM raw GROUP BY ALL"""))
def snk_metadata(spark, d):
    """SRC4: ingest metadata of the exported raw files (one row per file, told by
    its path), summed over the files of two folders: the files' number and names
    depend on the cluster."""
    raw = raw_of(spark, d)
    path = table_path(raw, "raw_meta_csv")
    K.export_csv(raw.where("customer_id IS NULL"), f"{path}/unknown")
    K.export_csv(raw.where("customer_id IS NOT NULL"), f"{path}/known")
    meta = R.ingest_metadata(spark, f"{path}/*known", source="driver tables", multi_line=True).where("row_count > 0")
    return meta.groupBy("source", F.element_at(F.split("path", "/"), -2).alias("folder"), "digest_kind").agg(
        F.sum("row_count").alias("row_count"), F.max("column_count").alias("column_count"),
        (F.count_distinct("sha256") == F.count(F.lit(1))).alias("own_digests"))


@query("src_tree_digest", f"""WITH l AS (SELECT lang, sha256(text) AS digest, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS line FROM documents),
  n AS (SELECT lang, line // 65536 AS node, sha256(string_agg(digest, '' ORDER BY line)) AS digest FROM l GROUP BY ALL)
  SELECT lang, sha256(string_agg(digest, '' ORDER BY node)) AS digest FROM n GROUP BY lang""")
def src_tree_digest(spark, d):
    """SC20: the digest that merges, of each language's texts in the order of their ids."""
    docs = surrogate_key(spark.read.parquet(f"{d}/documents.parquet").select("lang", "doc_id", "text"), ["lang", "doc_id"], "place", computed=False)
    first = docs.groupBy(F.col("lang").alias("of")).agg(F.min("place").alias("first"))
    docs = docs.join(F.broadcast(first), F.col("lang").eqNullSafe(F.col("of")))
    lines = docs.select("lang", (F.col("place") - F.col("first")).alias("line"), F.col("text").cast("binary").alias("value"))
    return tree_digest(lines, ["lang"])


_TEXTS = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 = 0 THEN '"' || text || '", said' ELSE text END AS text, lang
    FROM documents"""


@query("src_csv_texts", _TEXTS)
def src_csv_texts(spark, d):
    """SRC1: texts with line breaks, commas and (by a fixed rule) quotes, exported
    as CSV and read back."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    quoted = F.concat(F.lit('"'), F.col("text"), F.lit('", said'))
    df = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                     F.when(F.col("doc_id") % 3 == 0, quoted).otherwise(F.col("text")).alias("text"), "lang")
    return R.read_raw_csv(spark, K.export_csv(df, table_path(df, "texts_csv")), multi_line=True)


@query("snk_target", with_chain("SELECT *, 'target' AS sink FROM monthly"), ("total_revenue",))
def snk_target(spark, d):
    """SNK2/SNK3: a target that can be written is used."""
    monthly = mart_of(spark, d, "sales_monthly")
    target = table_path(monthly, "monthly_target")
    used = K.write_with_fallback(monthly, target, table_path(monthly, "monthly_unused"))
    return K.read_table(spark, target).withColumn("sink", F.lit(used))


@query("hlt_counts", with_chain("""SELECT * FROM (VALUES ('sales_staging', (SELECT count(*) FROM clean), 'ok'),
    ('sales_daily', (SELECT count(*) FROM daily), 'ok'), ('sales_monthly', (SELECT count(*) FROM monthly), 'ok'),
    ('forecast_results', CAST(NULL AS BIGINT), 'not found')) t(table_name, row_count, status)"""))
def hlt_counts(spark, d):
    """HLT1: row counts of written tables; a table never written reports 'not found'."""
    stg = stg_of(spark, d)
    base = table_path(stg, "health")
    K.write_table(stg, f"{base}/sales_staging")
    K.write_table(M.sales_daily(M.fact_measures(stg)), f"{base}/sales_daily")
    K.write_table(M.sales_monthly(M.fact_measures(stg)), f"{base}/sales_monthly")
    names = ["sales_staging", "sales_daily", "sales_monthly", "forecast_results"]
    return K.health_counts(spark, {n: f"{base}/{n}" for n in names})
