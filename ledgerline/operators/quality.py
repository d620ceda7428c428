"""Data-quality report, row-level flags, quality gate and null-rate warnings.

The whole report is one job: the raw rows are pre-aggregated into full-row
groups (map-side combine, so a hot duplicate collapses before the shuffle),
every measure is a weighted sum over those groups, and distinct order ids are
counted in the same aggregation. No window over all
rows, nothing collected except the final one-row report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import PipelineConfig
from ledgerline.functions.text import safe_date, safe_double
from ledgerline.schema import RAW_COLUMNS

CFG = PipelineConfig()

# Fixed order of the report keys.
REPORT_KEYS = [
    "rows_processed", "duplicate_rows", "duplicate_order_ids",
    "missing_customer_id", "missing_region", "missing_category", "missing_unit_price",
    "invalid_quantities", "invalid_unit_price", "invalid_sales", "invalid_dates",
    "rows_flagged_invalid", "estimated_valid_rows",
]


class QualityGateError(Exception):
    pass


def row_groups(raw: DataFrame) -> DataFrame:
    """Distinct raw rows with their multiplicity ``n`` (one shuffle on the full row,
    combined map-side). The end-to-end job materializes this once and feeds both
    the quality report and the cleaning (whose first rule is exactly this
    de-duplication)."""
    return raw.groupBy(*RAW_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def _row_groups(raw: DataFrame, grouped: bool = False) -> DataFrame:
    """Distinct raw rows with their multiplicity ``n`` and validity flags."""
    g = raw if grouped else row_groups(raw)
    q, p, s = safe_double("quantity"), safe_double("unit_price"), safe_double("sales")
    return g.select(
        "*",
        (q.isNull() | (q <= 0)).alias("bad_quantity"),
        (p.isNull() | (p < 0)).alias("bad_unit_price"),
        (s.isNull() | (s < 0)).alias("bad_sales"),
        safe_date("order_date").isNull().alias("bad_date"),
        F.col("customer_id").isNull().alias("no_customer"),
    )


def _bad_any() -> F.Column:
    return F.col("no_customer") | F.col("bad_quantity") | F.col("bad_unit_price") | F.col("bad_date")


def quality_report(raw: DataFrame, grouped: bool = False) -> DataFrame:
    """QC1-QC13 as one row of bigint columns named as REPORT_KEYS.

    ``grouped=True``: ``raw`` already is ``row_groups(raw)`` (14 columns + n)."""
    g = _row_groups(raw, grouped)

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    rep = g.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_processed"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        # order_id groups = distinct non-null ids + the null group (pandas treats NaN as equal)
        (F.count_distinct("order_id") + F.max(F.col("order_id").isNull().cast("int"))).alias("_oid_groups"),
        cnt(F.col("no_customer")).alias("missing_customer_id"),
        cnt(F.col("region").isNull()).alias("missing_region"),
        cnt(F.col("category").isNull()).alias("missing_category"),
        cnt(F.col("unit_price").isNull()).alias("missing_unit_price"),
        cnt(F.col("bad_quantity")).alias("invalid_quantities"),
        cnt(F.col("bad_unit_price")).alias("invalid_unit_price"),
        cnt(F.col("bad_sales")).alias("invalid_sales"),
        cnt(F.col("bad_date")).alias("invalid_dates"),
        # a group of n equal rows: all n flagged when bad, else its n-1 later copies
        F.coalesce(F.sum(F.when(_bad_any(), F.col("n")).otherwise(F.col("n") - 1)), F.lit(0))
        .cast("bigint").alias("rows_flagged_invalid"),
    )
    rep = rep.withColumns({
        "duplicate_order_ids": (F.col("rows_processed") - F.coalesce(F.col("_oid_groups"), F.lit(0))).cast("bigint"),
        "estimated_valid_rows": F.col("rows_processed") - F.col("rows_flagged_invalid"),
    })
    return rep.select(*REPORT_KEYS)


def quality_report_long(report: DataFrame) -> DataFrame:
    """QC15: the report as (position, metric, value) rows."""
    pairs = [F.struct(F.lit(i + 1).alias("position"), F.lit(k).alias("metric"), F.col(k).alias("value"))
             for i, k in enumerate(REPORT_KEYS)]
    return report.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def flagged_rows(raw: DataFrame) -> DataFrame:
    """QC14: the row-level flag, one row per distinct raw row.

    ``copies`` equal rows exist; ``flagged_copies`` of them are flagged (all
    when a critical field is bad, otherwise every copy after the first). The
    compact form avoids emitting every copy of a hot duplicate from one task;
    ``explode(sequence(1, copies))`` restores one row per copy if needed.
    Only rows with at least one flagged copy are returned."""
    g = _row_groups(raw)
    flagged = F.when(_bad_any(), F.col("n")).otherwise(F.col("n") - 1)
    return (g.select(*RAW_COLUMNS, F.col("n").alias("copies"), flagged.alias("flagged_copies"),
                     (F.col("n") > 1).alias("is_duplicate"), "no_customer", "bad_quantity",
                     "bad_unit_price", "bad_date")
            .where(F.col("flagged_copies") > 0))


def gate_row(report: DataFrame, threshold: float = CFG.gate_threshold) -> DataFrame:
    """QC16 as data: invalid rate = flagged / max(rows, 1); passes when rate <= threshold."""
    rate = F.col("rows_flagged_invalid") / F.greatest(F.col("rows_processed"), F.lit(1))
    return report.select("rows_processed", "rows_flagged_invalid", rate.alias("invalid_rate"),
                         F.lit(threshold).alias("threshold"), (rate <= F.lit(threshold)).alias("passed"))


def enforce_gate(report: DataFrame, threshold: float = CFG.gate_threshold) -> dict:
    """QC16: raise QualityGateError when more than ``threshold`` of rows are flagged
    (exactly the threshold passes). Returns the report as a dict (one row)."""
    row = report.first().asDict()
    rate = row["rows_flagged_invalid"] / max(row["rows_processed"], 1)
    if rate > threshold:
        raise QualityGateError(f"{rate:.1%} of rows flagged invalid (threshold {threshold:.0%})")
    return row


def null_rate_warnings(raw: DataFrame, threshold: float = CFG.null_rate_warn) -> DataFrame:
    """QC17: per column null count and rate; ``warn`` when the rate exceeds the threshold."""
    cols = raw.columns
    agg = raw.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"),
                      F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)]
    out = agg.select("_rows", F.explode(F.array(*pairs)).alias("r")).select("_rows", "r.*")
    rate = F.col("null_count") / F.greatest(F.col("_rows"), F.lit(1))
    return out.select("position", "column_name", "null_count", rate.alias("null_rate"),
                      (rate > F.lit(threshold)).alias("warn"))
