import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.config import PipelineConfig
from ledgerline.operators.expectations import DataTestError
from ledgerline.plans import job
from ledgerline.sources.fixture import raw_from_tables
from ledgerline.sources.sinks import export_csv

# The categories present in the raw view derived from the driver tables.
FIXTURE_CATEGORIES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard", "Unknown")
from ledgerline.sources import sinks as K


def test_end_to_end_job(spark, tmp_path):
    raw = raw_from_tables(spark, SF_SMALL)
    raw_csv = export_csv(raw, str(tmp_path / "sales_raw.csv"))
    cfg = PipelineConfig(accepted_categories=FIXTURE_CATEGORIES)
    res = job.run(spark, raw_csv, str(tmp_path / "out"), cfg, as_of="2000-01-01", multi_line=True)
    assert res.report["rows_processed"] == 6013 and res.report["rows_flagged_invalid"] == 58
    assert 0 < res.clean_rows <= res.report["rows_processed"]
    assert res.report["rows_flagged_invalid"] / res.report["rows_processed"] < 0.5
    assert all(r["passed"] for r in res.tests), [r for r in res.tests if not r["passed"]]
    staging = K.read_table(spark, res.paths["sales_staging"])
    for c in ["order_id", "order_date", "customer_id", "quantity", "unit_price", "sales"]:
        assert staging.where(F.col(c).isNull()).count() == 0
    assert staging.where("sales < 0").count() == 0
    fc = spark.read.parquet(res.paths["parquet"]).collect()
    assert len(fc) == 6 and all(r["upper_bound"] >= r["lower_bound"] for r in fc)
    assert res.best_models and sum(r["count"] for r in res.best_models) == 1
    mirror = K.read_table(spark, res.paths["forecast"])
    assert res.forecast_mode == "fallback" and mirror.columns == [
        "forecast_date", "predicted_sales", "lower_bound", "upper_bound", "model_name", "generated_at"]


def test_job_targets_and_paths(spark, tmp_path):
    raw = raw_from_tables(spark, SF_SMALL).limit(400)
    res = job.run(spark, raw, str(tmp_path / "out"), PipelineConfig(accepted_categories=FIXTURE_CATEGORIES), as_of="2000-01-01",
                  cloud_target=str(tmp_path / "cloud"), forecast_target=str(tmp_path / "mirror"))
    assert res.mode == res.forecast_mode == "target"
    assert res.paths["sales_staging"] == str(tmp_path / "cloud") and res.paths["forecast"] == str(tmp_path / "mirror")
    assert K.read_table(spark, res.paths["forecast"]).count() == 6


def test_job_ends_when_a_data_test_fails(spark, tmp_path):
    raw = raw_from_tables(spark, SF_SMALL).limit(300)
    with pytest.raises(DataTestError, match="accepted_values"):
        job.run(spark, raw, str(tmp_path / "out"), PipelineConfig(accepted_categories=("Economy",)), as_of="2000-01-01")
    assert not (tmp_path / "out" / "forecast").exists()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"order_date", "total_orders", "total_units", "total_revenue", "avg_order_value"}


def test_registry_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from ledgerline.plans.catalog import REGISTRY
    rows_only = {n for n, q in REGISTRY.items() if q.sql is None}
    assert rows_only <= {"fc_exp_smoothing", "fc_exp_smoothing_params", "fc_compare", "fc_best",
                         "fc_forecast", "fc_scorecard", "fc_forecast_total", "snk_model_comparison"}
