"""JOB1: the end-to-end batch job, the unit a scheduler submits
(``spark-submit --py-files ledgerline.zip ledgerline/plans/job.py RAW_PATH OUT_DIR``).

ingest (+schema check) -> quality report -> gate -> clean -> load the staging
table -> build and write the marts -> data tests (a failure ends the job) ->
forecast -> save. Every stage boundary is a table written under ``out_dir``:
each downstream stage starts from a short plan over a Parquet scan, so the
loss of an executor replays one stage. A new run starts from the raw file.
"""

from __future__ import annotations

import sys
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerline.config import PipelineConfig
from ledgerline.functions.materialize import cleanup
from ledgerline.operators import clean as C
from ledgerline.operators import expectations as X
from ledgerline.operators import forecast as FC
from ledgerline.operators import marts as M
from ledgerline.operators import quality as Q
from ledgerline.sources import raw as R
from ledgerline.sources import sinks as K

MART_ORDER = ["int_customer_sales", "int_product_sales", "dim_customer", "dim_product", "dim_date",
              "fact_sales", "sales_daily", "sales_monthly"]


@dataclass
class JobResult:
    report: dict
    mode: str
    clean_rows: int
    paths: dict = field(default_factory=dict)
    timings: dict = field(default_factory=dict)
    tests: list = field(default_factory=list)
    best_models: list = field(default_factory=list)
    forecast_mode: str = ""


def run(spark: SparkSession, raw: str | DataFrame, out_dir: str, cfg: PipelineConfig = PipelineConfig(),
        run_marts: bool = True, run_forecast: bool = True, series_keys: tuple = (), as_of=None,
        cloud_target: str | None = None, forecast_target: str | None = None, multi_line: bool = False) -> JobResult:
    t = {}

    def stage(name, fn):
        t0 = time.time()
        out = fn()
        t[name] = round(time.time() - t0, 3)
        return out

    raw_df = R.read_raw_csv(spark, raw, multi_line) if isinstance(raw, str) else raw
    stage("validate", lambda: R.validate_schema(raw_df))
    # one full-row shuffle shared by the quality report and the de-duplication
    groups_path = f"{out_dir}/raw/row_groups"
    stage("row_groups", lambda: K.write_table(Q.row_groups(raw_df), groups_path))
    groups = spark.read.parquet(groups_path)
    report = stage("quality", lambda: Q.enforce_gate(Q.quality_report(groups, grouped=True), cfg.gate_threshold))

    staging_path = f"{out_dir}/raw/sales_staging"
    cleaned = stage("clean_plan", lambda: C.clean(groups, cfg, deduplicated=True))
    mode = stage("load", lambda: K.write_with_fallback(cleaned, cloud_target, staging_path))
    used_path = cloud_target if mode == "target" else staging_path
    staging = K.read_table(spark, used_path)
    clean_rows = stage("load_count", staging.count)
    result = JobResult(report=report, mode=mode, clean_rows=clean_rows, paths={"sales_staging": used_path},
                       timings=t)
    if not run_marts:
        return result

    stg = M.stg_sales(staging)
    tables: dict[str, DataFrame] = {"stg_sales": stg}
    builders = {
        "int_customer_sales": lambda: M.int_customer_sales(stg),
        "int_product_sales": lambda: M.int_product_sales(stg),
        "dim_customer": lambda: M.dim_customer(stg),
        "dim_product": lambda: M.dim_product(stg),
        "dim_date": lambda: M.dim_date(stg),
        # the fact takes its surrogate keys from the dimension tables just written
        "fact_sales": lambda: M.fact_sales(stg, tables["dim_customer"], tables["dim_product"]),
        "sales_daily": lambda: M.sales_daily(M.fact_measures(stg)),
        "sales_monthly": lambda: M.sales_monthly(M.fact_measures(stg)),
    }
    for name in MART_ORDER:
        path = f"{out_dir}/analytics/{name}"
        stage(f"mart_{name}", lambda name=name, path=path: K.write_table(builders[name](), path))
        tables[name] = spark.read.parquet(path)
        result.paths[name] = path
    M.register_views(tables)
    tests_path = f"{out_dir}/analytics/data_tests"
    stage("data_tests", lambda: K.write_table(X.run_checks(tables, X.default_checks(cfg)), tests_path))
    tests = spark.read.parquet(tests_path).orderBy("check_id")
    result.tests = [r.asDict() for r in tests.collect()]
    X.assert_all_passed(tests)
    if not run_forecast:
        cleanup(spark)
        return result

    monthly = tables["sales_monthly"]
    obs = FC.from_monthly_mart(monthly) if not series_keys else FC.period_observations(stg, list(series_keys))
    prepared = FC.prepare_series(obs, as_of=as_of)
    fc_dir = f"{out_dir}/forecast"
    outputs = FC.run_forecasting(prepared, cfg, with_smoothing=True)
    best_path = f"{fc_dir}/best_model"
    stage("forecast_select", lambda: K.write_table(outputs["comparison"], f"{fc_dir}/comparison"))
    comparison = spark.read.parquet(f"{fc_dir}/comparison")
    best = comparison.where("is_best").select("series", "model", "RMSE").withColumnRenamed("model", "best_model")
    K.write_table(best, best_path)
    best = spark.read.parquet(best_path)
    fc = FC.generate_forecast(FC.eligible(prepared, cfg.min_history), best, cfg.horizon, cfg.ma_window,
                              cfg.season_length, cfg.band_z, validate=True, start=cfg.smoothing_start)
    result.paths.update(stage("forecast_save", lambda: K.save_forecast(fc, fc_dir)))
    # the warehouse table of six columns, mirrored to the configured target when there is one
    contract = K.forecast_contract(spark.read.parquet(result.paths["parquet"]))
    mirror = f"{fc_dir}/forecast_contract"
    result.forecast_mode = stage("forecast_mirror", lambda: K.write_with_fallback(contract, forecast_target, mirror))
    result.paths["forecast"] = forecast_target if result.forecast_mode == "target" else mirror
    K.write_model_comparison(comparison, f"{fc_dir}/model_comparison.json")
    # one row per model, however many series there are
    result.best_models = [r.asDict() for r in best.groupBy("best_model").count().orderBy("best_model").collect()]
    cleanup(spark)
    return result


def main(argv: list[str]) -> int:
    from ledgerline.session import build_session
    raw_path, out_dir = argv[1], argv[2]
    spark = build_session(None)
    res = run(spark, raw_path, out_dir)
    print({"rows": res.report, "mode": res.mode, "clean_rows": res.clean_rows, "timings": res.timings})
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
