"""Deterministic cleaning rules, applied in a fixed order.

The order matters: product medians see only rows that survived the first five
rules, and category caps see normalized categories.

Plan shape: the distinct rows are parsed, filtered and written once with typed
columns, as several branches read them. The imputation counts the prices of the
products that need a median, and only the rows with a bad price are joined to
the medians. The caps read
the few columns that the amounts depend on. Join strategies are left to AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import PipelineConfig
from ledgerline.functions.materialize import if_few, materialize
from ledgerline.functions.quantile import exact_group_quantile, histogram, quantile_of_histogram
from ledgerline.functions.text import np_round2, safe_date, safe_double, strip_ws, title_case
from ledgerline.schema import NUMERIC_COLUMNS, RAW_COLUMNS

CFG = PipelineConfig()


def dedup(raw: DataFrame) -> DataFrame:
    """CL1: drop exact full-row duplicates (nulls compare equal).

    A row whose hash occurs once has no duplicate and stays where it is: only
    the hashes are grouped, and only rows of equal hashes are compared. With
    more such hashes than an executor should hold, all rows are."""
    rows = raw.select(*RAW_COLUMNS)
    own = F.xxhash64(*RAW_COLUMNS)
    hashes = rows.select(own.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    shared = if_few(materialize(hashes.where(F.col("_n") > 1).select("_h"), "shared-hashes"))
    if shared is None:
        return rows.dropDuplicates()
    alike = rows.join(shared, own == F.col("_h"), "left_semi").dropDuplicates()
    return rows.join(shared, own == F.col("_h"), "left_anti").unionByName(alike)


def parse_dates(df: DataFrame) -> DataFrame:
    """CL2: order_date -> DATE, unparseable rows dropped."""
    return df.withColumn("order_date", safe_date("order_date")).where(F.col("order_date").isNotNull())


def coerce_numbers(df: DataFrame) -> DataFrame:
    """CL3: quantity, unit_price, sales, discount -> double; bad -> null."""
    return df.withColumns({c: safe_double(c) for c in NUMERIC_COLUMNS})


def drop_unattributable(df: DataFrame) -> DataFrame:
    """CL4 + CL5: customer_id present and quantity > 0."""
    return df.where(F.col("customer_id").isNotNull() & (F.col("quantity") > 0))


def impute_price(df: DataFrame, cfg: PipelineConfig = CFG) -> DataFrame:
    """CL6 + CL7: null/negative unit_price -> the product's median price
    (median over non-null prices, negatives included; a null product_id gets
    no median); rows still without a non-negative price are dropped."""
    bad = F.col("unit_price").isNull() | (F.col("unit_price") < 0)
    known, product = df.where(F.col("product_id").isNotNull()), F.xxhash64("product_id")
    # a product of an equal hash is counted with them, and its median not used
    need = materialize(known.where(bad).select(product.alias("_h")).distinct(), "imputed-products")
    need = if_few(need) or need
    counts = histogram(known.join(need, product == F.col("_h"), "left_semi"), ["product_id"], "unit_price")
    if cfg.median_method == "simple":
        medians = counts.groupBy("product_id").agg(F.percentile("_v", 0.5, F.col("_c")).alias("_median"))
    else:
        medians = quantile_of_histogram(counts, ["product_id"], 0.5, "_median", cfg.quantile_accuracy)
    medians = materialize(medians, "medians")   # one row per product with a bad price; several branches read it
    fixed = (df.where(bad).join(medians, "product_id", "left")
             .withColumn("unit_price", F.col("_median")).drop("_median"))
    return df.where(~bad).unionByName(fixed).where(F.col("unit_price") >= 0)


def fill_discount(df: DataFrame) -> DataFrame:
    """CL8: null discount -> 0, clipped to [0, 0.9]."""
    d = F.coalesce(F.col("discount"), F.lit(0.0))
    return df.withColumn("discount", F.least(F.greatest(d, F.lit(0.0)), F.lit(0.9)))


def normalize_text(df: DataFrame) -> DataFrame:
    """CL9-CL12: Unknown/Consumer defaults, whitespace strip, Title Case.

    customer_name and country keep null (the original turned null into the
    text 'Nan' by accident)."""
    df = df.withColumns({
        "category": strip_ws(F.coalesce(F.col("category"), F.lit("Unknown"))),
        "region": strip_ws(F.coalesce(F.col("region"), F.lit("Unknown"))),
        "customer_name": strip_ws("customer_name"),
        "product_name": strip_ws("product_name"),
        "country": strip_ws("country"),
        "segment": strip_ws(F.coalesce(F.col("segment"), F.lit("Consumer"))),
    })
    return df.withColumns({c: title_case(c) for c in ("category", "region", "customer_name", "country", "segment")})


def recompute_sales(df: DataFrame) -> DataFrame:
    """CL13: sales = round(quantity * unit_price * (1 - discount), 2), half-even."""
    return df.withColumn("sales", np_round2(F.col("quantity") * F.col("unit_price") * (1 - F.col("discount"))))


def category_caps(df: DataFrame, cfg: PipelineConfig = CFG) -> DataFrame:
    """Exact per-category percentile of sales (linear interpolation)."""
    return exact_group_quantile(df, ["category"], "sales", cfg.cap_percentile, out="_cap",
                                accuracy=cfg.quantile_accuracy, method=cfg.cap_method)


def winsorize(df: DataFrame, cfg: PipelineConfig = CFG) -> DataFrame:
    """CL14: sales capped at the per-category percentile; rows kept, not re-rounded.
    The caps are written: as a plan their size is not known, and all rows would be
    shuffled by category to meet them."""
    caps = materialize(category_caps(df, cfg), "caps")
    return (df.join(caps, "category", "left")
            .withColumn("sales", F.least(F.col("sales"), F.coalesce(F.col("_cap"), F.col("sales"))))
            .drop("_cap"))


def clean(raw: DataFrame, cfg: PipelineConfig = CFG, dedup_after: bool = False,
          deduplicated: bool = False) -> DataFrame:
    """All rules CL1-CL15; output keeps the 14 raw columns in their order,
    order_date as DATE and the four numeric columns as DOUBLE.

    ``dedup_after=True`` additionally removes rows that became identical after
    normalization (the original de-duplicates only before it).
    ``deduplicated=True``: ``raw`` is a written table of distinct rows (CL1 done)."""
    distinct = raw.select(*RAW_COLUMNS) if deduplicated else dedup(raw)
    df = materialize(drop_unattributable(coerce_numbers(parse_dates(distinct))), "typed")
    df = recompute_sales(normalize_text(fill_discount(impute_price(df, cfg))))
    if dedup_after:
        df = materialize(df.dropDuplicates(), "before-caps")
    return winsorize(df, cfg).select(*RAW_COLUMNS)
