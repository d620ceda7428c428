"""Registered queries: quality, profiling, cleaning steps and the star-schema models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.materialize import stage
from ledgerline.operators import clean as C
from ledgerline.operators import marts as M
from ledgerline.operators import profile as P
from ledgerline.operators import quality as Q
from ledgerline.operators.metrics import MONTH, daily_bitmaps
from ledgerline.plans.oracle import RAW14, num_sql, with_chain
from ledgerline.plans.registry import query
from ledgerline.sources.fixture import TABLES, raw_from_tables
from ledgerline.sources.sinks import write_partitioned_sales

MONEY_ROW = ("quantity", "unit_price", "sales", "discount")


def _stage(spark, d, name, build):
    return stage(spark, d, TABLES, name, build)


def raw_of(spark, d):
    """The dirty raw order lines derived from the driver tables, written once
    as a Parquet table (the raw file of the pipeline)."""
    return _stage(spark, d, "raw", lambda: raw_from_tables(spark, d))


def clean_of(spark, d):
    return C.clean(raw_of(spark, d))


def stg_of(spark, d):
    """The staging model on the loaded clean table (the load step's output)."""
    return M.stg_sales(_stage(spark, d, "sales_staging", lambda: clean_of(spark, d)))


def mart_of(spark, d, name):
    """A written model, built with the models that it reads and no other."""
    stg = lambda: stg_of(spark, d)
    build = {
        "int_customer_sales": lambda: M.int_customer_sales(stg()),
        "int_product_sales": lambda: M.int_product_sales(stg()),
        "dim_customer": lambda: M.dim_customer(stg()),
        "dim_product": lambda: M.dim_product(stg()),
        "dim_date": lambda: M.dim_date(stg()),
        "fact_sales": lambda: M.fact_sales(stg(), mart_of(spark, d, "dim_customer"), mart_of(spark, d, "dim_product")),
        "sales_daily": lambda: M.sales_daily(M.fact_measures(stg())),
        "sales_monthly": lambda: M.sales_monthly(M.fact_measures(stg())),
    }
    return stg() if name == "stg_sales" else _stage(spark, d, name, build[name])


def fact_by_month(spark, d):
    """The fact in folders by month, clustered by region and product."""
    write = lambda df, path: write_partitioned_sales(df, path, "date_key", ("region", "product_key"))
    out = stage(spark, d, TABLES, "fact_by_month", lambda: mart_of(spark, d, "fact_sales"), write)
    return out.withColumn(MONTH, F.col(MONTH).cast("date"))


def bitmaps_of(spark, d):
    return _stage(spark, d, "daily_bitmaps", lambda: daily_bitmaps(mart_of(spark, d, "fact_sales")))


# ---------------------------------------------------------------- quality
_DATE_OK = ("CASE WHEN regexp_full_match(trim(order_date), '[0-9]{4}-[0-9]{2}-[0-9]{2}') "
            "THEN CAST(try_strptime(trim(order_date), '%Y-%m-%d') AS DATE) END")
_QC_ROWS = f"""SELECT *,
    row_number() OVER (PARTITION BY {RAW14} ORDER BY order_id) AS rn_all,
    row_number() OVER (PARTITION BY order_id ORDER BY order_id) AS rn_oid,
    {num_sql('quantity')} AS q, {num_sql('unit_price')} AS p, {num_sql('sales')} AS s, {_DATE_OK} AS d
  FROM raw"""
_QC_BAD = "(rn_all > 1 OR customer_id IS NULL OR q IS NULL OR q <= 0 OR p IS NULL OR p < 0 OR d IS NULL)"
_QC_REPORT = f"""SELECT count(*) AS rows_processed,
    count(*) FILTER (WHERE rn_all > 1) AS duplicate_rows,
    count(*) FILTER (WHERE rn_oid > 1) AS duplicate_order_ids,
    count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer_id,
    count(*) FILTER (WHERE region IS NULL) AS missing_region,
    count(*) FILTER (WHERE category IS NULL) AS missing_category,
    count(*) FILTER (WHERE unit_price IS NULL) AS missing_unit_price,
    count(*) FILTER (WHERE q IS NULL OR q <= 0) AS invalid_quantities,
    count(*) FILTER (WHERE p IS NULL OR p < 0) AS invalid_unit_price,
    count(*) FILTER (WHERE s IS NULL OR s < 0) AS invalid_sales,
    count(*) FILTER (WHERE d IS NULL) AS invalid_dates,
    count(*) FILTER (WHERE {_QC_BAD}) AS rows_flagged_invalid,
    count(*) FILTER (WHERE NOT {_QC_BAD}) AS estimated_valid_rows
  FROM qc_rows"""


def _qc_sql(select_sql):
    return with_chain(select_sql, [("qc_rows", _QC_ROWS), ("qc_rep", _QC_REPORT)])


@query("qc_report", _qc_sql("SELECT * FROM qc_rep"))
def qc_report(spark, d):
    return Q.quality_report(raw_of(spark, d))


@query("qc_report_long", _qc_sql(" UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{k}' AS metric, {k} AS value FROM qc_rep" for i, k in enumerate(Q.REPORT_KEYS))))
def qc_report_long(spark, d):
    return Q.quality_report_long(Q.quality_report(raw_of(spark, d)))


@query("qc_flagged_rows", with_chain(f"""SELECT * FROM (
  SELECT {RAW14}, count(*) AS copies,
    CASE WHEN no_customer OR bad_quantity OR bad_unit_price OR bad_date THEN count(*) ELSE count(*) - 1 END
      AS flagged_copies,
    count(*) > 1 AS is_duplicate, no_customer, bad_quantity, bad_unit_price, bad_date
  FROM (SELECT *, customer_id IS NULL AS no_customer, (q IS NULL OR q <= 0) AS bad_quantity,
               (p IS NULL OR p < 0) AS bad_unit_price, dd IS NULL AS bad_date
        FROM (SELECT *, {num_sql('quantity')} AS q, {num_sql('unit_price')} AS p, {_DATE_OK} AS dd FROM raw))
  GROUP BY {RAW14}, no_customer, bad_quantity, bad_unit_price, bad_date) WHERE flagged_copies > 0"""))
def qc_flagged_rows(spark, d):
    return Q.flagged_rows(raw_of(spark, d))


@query("qc_gate", _qc_sql("""SELECT rows_processed, rows_flagged_invalid,
    rows_flagged_invalid / greatest(rows_processed, 1) AS invalid_rate, CAST(0.5 AS DOUBLE) AS threshold,
    rows_flagged_invalid / greatest(rows_processed, 1) <= 0.5 AS passed FROM qc_rep"""))
def qc_gate(spark, d):
    return Q.gate_row(Q.quality_report(raw_of(spark, d)), 0.5)


def _null_rows_sql(table: str, cols: list[str], warn: float | None):
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"SELECT {i + 1} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) "
                     f"AS null_count, count(*) AS n FROM {table}")
    body = " UNION ALL ".join(parts)
    if warn is None:
        return f"SELECT position, column_name, null_count FROM ({body})"
    return (f"SELECT position, column_name, null_count, null_count / greatest(n, 1) AS null_rate, "
            f"null_count / greatest(n, 1) > {warn} AS warn FROM ({body})")


@query("qc_null_rate_warn", with_chain(_null_rows_sql("raw", RAW14.split(", "), 0.05)))
def qc_null_rate_warn(spark, d):
    return Q.null_rate_warnings(raw_of(spark, d), 0.05)


# ---------------------------------------------------------------- profiling
@query("prf_shape", with_chain("SELECT count(*) AS rows, CAST(14 AS BIGINT) AS columns FROM raw"))
def prf_shape(spark, d):
    return P.shape(raw_of(spark, d))


@query("prf_head", with_chain(
    f"SELECT * FROM raw ORDER BY {', '.join(c + ' NULLS FIRST' for c in RAW14.split(', '))} LIMIT 5"))
def prf_head(spark, d):
    return P.head(raw_of(spark, d), RAW14.split(", "), 5)


@query("prf_null_counts", with_chain(_null_rows_sql("raw", RAW14.split(", "), None)))
def prf_null_counts(spark, d):
    return P.null_counts(raw_of(spark, d))


@query("prf_value_counts", with_chain("SELECT category AS value, count(*) AS count FROM raw GROUP BY category"))
def prf_value_counts(spark, d):
    return P.value_counts(raw_of(spark, d), "category")


@query("prf_duplicates", with_chain("SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM dedup) AS duplicate_rows"))
def prf_duplicates(spark, d):
    return P.duplicate_count(raw_of(spark, d))


@query("prf_raw_vs_clean", with_chain("""SELECT (SELECT count(*) FROM raw) AS raw_rows,
    (SELECT count(*) FROM clean) AS clean_rows,
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS dropped_rows"""))
def prf_raw_vs_clean(spark, d):
    raw = raw_of(spark, d)
    return P.raw_vs_clean(raw, C.clean(raw))


# ---------------------------------------------------------------- cleaning steps
def _kept(spark, d):
    """The distinct rows, parsed and filtered (CL1-CL5), written once."""
    return _stage(spark, d, "kept", lambda: C.drop_unattributable(
        C.coerce_numbers(C.parse_dates(C.dedup(raw_of(spark, d))))))


@query("cl_dedup", with_chain("SELECT * FROM dedup"))
def cl_dedup(spark, d):
    return C.dedup(raw_of(spark, d))


@query("cl_dates", with_chain("SELECT * FROM kept"), MONEY_ROW)
def cl_dates(spark, d):
    return _kept(spark, d)


@query("cl_impute_price", with_chain("SELECT * FROM priced_ok"), MONEY_ROW)
def cl_impute_price(spark, d):
    return C.impute_price(_kept(spark, d))


@query("cl_discount", with_chain("SELECT * FROM discounted"), MONEY_ROW)
def cl_discount(spark, d):
    return C.fill_discount(C.impute_price(_kept(spark, d)))


@query("cl_text", with_chain("SELECT * FROM texted"), MONEY_ROW)
def cl_text(spark, d):
    return C.normalize_text(C.fill_discount(C.impute_price(_kept(spark, d))))


def _resold(spark, d):
    return C.recompute_sales(C.normalize_text(C.fill_discount(C.impute_price(_kept(spark, d)))))


@query("cl_sales", with_chain("SELECT * FROM resold"), MONEY_ROW)
def cl_sales(spark, d):
    return _resold(spark, d)


@query("cl_winsorize", with_chain("SELECT category, cap FROM caps"), ("cap",))
def cl_winsorize(spark, d):
    return C.category_caps(_resold(spark, d)).withColumnRenamed("_cap", "cap")


@query("cl_clean", with_chain("SELECT * FROM clean"), MONEY_ROW)
def cl_clean(spark, d):
    return clean_of(spark, d)


# ---------------------------------------------------------------- models
@query("stg_sales", with_chain("SELECT * FROM stg"), ("unit_price", "discount", "sales"))
def stg_sales(spark, d):
    return stg_of(spark, d)


@query("int_customer_sales", with_chain("SELECT * FROM int_cust"), ("total_revenue",))
def int_customer_sales(spark, d):
    return M.int_customer_sales(stg_of(spark, d))


@query("int_product_sales", with_chain("SELECT * FROM int_prod"), ("total_revenue",))
def int_product_sales(spark, d):
    return M.int_product_sales(stg_of(spark, d))


@query("dim_customer", with_chain("SELECT * FROM dim_cust"), ("total_revenue",))
def dim_customer(spark, d):
    return M.dim_customer(stg_of(spark, d))


@query("dim_product", with_chain("SELECT * FROM dim_prod"), ("total_revenue",))
def dim_product(spark, d):
    return M.dim_product(stg_of(spark, d))


@query("dim_date", with_chain("SELECT * FROM dim_date"))
def dim_date(spark, d):
    return M.dim_date(stg_of(spark, d))


@query("fact_sales", with_chain("SELECT * FROM fact"), ("unit_price", "discount", "revenue"))
def fact_sales(spark, d):
    return M.fact_sales(stg_of(spark, d), mart_of(spark, d, "dim_customer"), mart_of(spark, d, "dim_product"))


@query("sales_daily", with_chain("SELECT * FROM daily"), ("total_revenue",))
def sales_daily(spark, d):
    return M.sales_daily(M.fact_measures(stg_of(spark, d)))


@query("sales_monthly", with_chain("SELECT * FROM monthly"), ("total_revenue",))
def sales_monthly(spark, d):
    return M.sales_monthly(M.fact_measures(stg_of(spark, d)))
