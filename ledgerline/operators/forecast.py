"""Per-series revenue forecasting as relational Spark plans.

The original fits a single monthly revenue series. Here every operator works
on a long table ``(series, period_start, y)``, so thousands of series (one per
region, category, product, ...) are prepared, split, forecast, scored and
selected in parallel; windows and aggregations are partitioned by ``series``
and a series holds one row per period (bounded by the calendar, not by the
number of order lines).

Models: naive (last value), moving average of the last k values, seasonal
naive (last season tiled; naive when shorter than one season) and additive
Holt-Winters exponential smoothing (``ledgerline.operators.smoothing``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.config import PipelineConfig
from ledgerline.functions.materialize import materialize
from ledgerline.functions.text import money_sum, np_round2

CFG = PipelineConfig()

# Model names in the original's comparison order (ties in the
# selection criterion go to the earlier model).
MODEL_ORDER = ["Naive", "Moving Average", "Seasonal Naive", "Exponential Smoothing"]
BASELINES = MODEL_ORDER[:3]


def series_id(keys) -> F.Column:
    if not keys:
        return F.lit("total")
    def part(k):  # the separator and the escape are escaped, null is marked: two keys never share a series
        s = F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(s, F.lit("\\N"))
    return F.concat_ws("|", *[part(k) for k in keys])


def _unit(grain: str) -> str:
    if grain not in ("month", "day"):
        raise ValueError(f"grain must be 'month' or 'day', not {grain!r}")
    return grain


def period_observations(stg: DataFrame, keys=(), grain: str = "month") -> DataFrame:
    """(series, period_start, y): revenue per series and month (or day)."""
    period = F.trunc("order_date", "month") if _unit(grain) == "month" else F.col("order_date")
    return (stg.groupBy(series_id(keys).alias("series"), period.alias("period_start"))
            .agg(money_sum("sales").alias("y")))


def from_monthly_mart(monthly: DataFrame) -> DataFrame:
    """SRC6: the single total series read from the monthly mart."""
    return monthly.select(F.lit("total").alias("series"), F.col("month_start").alias("period_start"),
                          F.col("total_revenue").alias("y"))


def _index(grain: str, date, first) -> F.Column:
    if grain == "month":
        return ((F.year(date) - F.year(first)) * 12 + F.month(date) - F.month(first) + 1).cast("int")
    return (F.datediff(date, first) + 1).cast("int")


def _cut(as_of, unit: str) -> F.Column:
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.trunc(today, "month") if unit == "month" else today


def series_lengths(obs: DataFrame, as_of=None, grain: str = "month") -> DataFrame:
    """(series, n): the periods a prepared series will have, from its first and
    last period alone (no spine is built)."""
    unit = _unit(grain)
    b = obs.groupBy("series").agg(F.min("period_start").alias("_first"), F.max("period_start").alias("_last"))
    n = _index(unit, F.col("_last"), F.col("_first")) - (F.col("_last") >= _cut(as_of, unit)).cast("int")
    return b.select("series", n.cast("bigint").alias("n"))


def prepare_series(obs: DataFrame, as_of=None, grain: str = "month") -> DataFrame:
    """FC1: calendar spine per series, linear gap interpolation (edges take the
    nearest value), and the last period dropped when it is not complete yet.

    ``as_of``: a date (string/date) for "today", None for current_date(); only
    the period that holds this date is incomplete. Output: series,
    period_start, y, idx (1-based), n.
    """
    unit = _unit(grain)
    step = F.expr(f"interval 1 {unit}")
    b = obs.groupBy("series").agg(F.min("period_start").alias("_first"), F.max("period_start").alias("_last"))
    spine = b.select("series", "_first", "_last",
                     F.explode(F.sequence("_first", "_last", step)).alias("period_start"))
    s = spine.join(obs, ["series", "period_start"], "left")
    s = s.withColumn("idx", _index(unit, F.col("period_start"), F.col("_first")))
    w = Window.partitionBy("series").orderBy("idx")
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known_idx = F.when(F.col("y").isNotNull(), F.col("idx"))
    s = s.select("*",
                 F.last("y", ignorenulls=True).over(before).alias("_py"),
                 F.last(known_idx, ignorenulls=True).over(before).alias("_pi"),
                 F.first("y", ignorenulls=True).over(after).alias("_ny"),
                 F.first(known_idx, ignorenulls=True).over(after).alias("_ni"))
    interp = F.col("_py") + (F.col("_ny") - F.col("_py")) / (F.col("_ni") - F.col("_pi")) * (F.col("idx") - F.col("_pi"))
    filled = F.coalesce(F.col("y"), F.when(F.col("_pi").isNotNull() & F.col("_ni").isNotNull(), interp),
                        F.col("_py"), F.col("_ny"))
    s = s.withColumn("y", filled)

    s = s.where(~((F.col("period_start") == F.col("_last")) & (F.col("period_start") >= _cut(as_of, unit))))
    n = F.count(F.lit(1)).over(Window.partitionBy("series"))
    return s.select("series", "period_start", "y", "idx", n.alias("n"))


def eligible(prepared: DataFrame, min_history: int = CFG.min_history) -> DataFrame:
    """FC16: series with at least ``min_history`` periods."""
    return prepared.where(F.col("n") >= min_history)


def skipped_series(lengths: DataFrame, min_history: int = CFG.min_history) -> DataFrame:
    """FC16: series skipped for too short a history, with their length; from
    ``series_lengths`` or a prepared table. A series that has no complete
    period left is no series and is not listed."""
    return lengths.groupBy("series").agg(F.max("n").alias("n")).where((F.col("n") < min_history) & (F.col("n") > 0))


def chronological_split(prepared: DataFrame, test_fraction: float = CFG.test_fraction) -> DataFrame:
    """FC6: split index max(1, floor(n * (1 - f))); train = idx <= split_idx.
    A fraction that leaves no test or no training period is an error."""
    if not 0 < test_fraction < 1:
        raise ValueError(f"test_fraction must lie between 0 and 1, not {test_fraction}")
    keep = 1.0 - test_fraction
    split_idx = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(keep)).cast("int"))
    return (prepared.withColumn("split_idx", split_idx)
            .withColumn("is_train", F.col("idx") <= F.col("split_idx")))


def leakage_violations(split: DataFrame) -> DataFrame:
    """Series whose training period does not end before the test period starts
    (an empty test period also violates it)."""
    g = split.groupBy("series").agg(
        F.max(F.when(F.col("is_train"), F.col("period_start"))).alias("train_end"),
        F.min(F.when(~F.col("is_train"), F.col("period_start"))).alias("test_start"))
    return g.where(F.col("test_start").isNull() | (F.col("train_end") >= F.col("test_start")))


def assert_no_leakage(split: DataFrame) -> None:
    bad = leakage_violations(split).limit(5).collect()
    if bad:
        raise AssertionError(f"Leakage: train period overlaps test period for {[r['series'] for r in bad]}")


def _baselines(history: DataFrame, targets: DataFrame, ma_window: int, season: int) -> DataFrame:
    """Naive / moving average / seasonal naive for each target row.

    history: (series, idx, y) rows up to the forecast origin; targets:
    (series, origin, step, ...) with one row per forecast step. Returns the
    targets with one row per (step, model) and column ``y_pred``."""
    origin = targets.select("series", "origin").distinct()
    h = history.join(origin, "series").where(F.col("idx") <= F.col("origin"))
    level = h.groupBy("series").agg(
        F.max_by("y", "idx").alias("_naive"),
        F.avg(F.when(F.col("idx") > F.col("origin") - ma_window, F.col("y"))).alias("_ma"))
    src = F.when(F.col("origin") >= season,
                 F.col("origin") - season + F.pmod(F.col("step") - 1, F.lit(season)) + 1).otherwise(F.col("origin"))
    t = targets.withColumn("_src", src)
    seas = h.select("series", F.col("idx").alias("_src"), F.col("y").alias("_seasonal"))
    t = t.join(level, "series", "left").join(seas, ["series", "_src"], "left")
    models = F.array(
        F.struct(F.lit(BASELINES[0]).alias("model"), F.col("_naive").alias("y_pred")),
        F.struct(F.lit(BASELINES[1]).alias("model"), F.col("_ma").alias("y_pred")),
        F.struct(F.lit(BASELINES[2]).alias("model"), F.col("_seasonal").alias("y_pred")))
    keep = [c for c in targets.columns]
    return t.select(*keep, F.explode(models).alias("_m")).select(*keep, "_m.model", "_m.y_pred")


def holdout_targets(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train history, test targets) for the hold-out comparison; horizon = test length."""
    train = split.where(F.col("is_train")).select("series", "idx", "y")
    test = (split.where(~F.col("is_train"))
            .select("series", F.col("split_idx").alias("origin"), (F.col("idx") - F.col("split_idx")).alias("step"),
                    "period_start", F.col("y").alias("y_true")))
    return train, test


def holdout_predictions(split: DataFrame, ma_window: int = CFG.ma_window, season: int = CFG.season_length,
                        with_smoothing: bool = False, start: str = CFG.smoothing_start) -> DataFrame:
    """FC2-FC5 on the hold-out: (series, origin, step, period_start, y_true, model, y_pred)."""
    train, test = holdout_targets(split)
    preds = _baselines(train, test, ma_window, season)
    if with_smoothing:
        from ledgerline.operators.smoothing import holt_winters_forecasts
        preds = preds.unionByName(holt_winters_forecasts(train, test, season, start))
    return preds


def evaluate(preds: DataFrame) -> DataFrame:
    """FC7-FC10: MAE, RMSE, MAPE (%; zero actuals masked, null when all zero), rounded to 2."""
    err = F.col("y_true") - F.col("y_pred")
    mape = F.avg(F.when(F.col("y_true") != 0, F.abs(err / F.col("y_true")))) * 100
    return preds.groupBy("series", "model").agg(
        np_round2(F.avg(F.abs(err))).alias("MAE"),
        np_round2(F.sqrt(F.avg(err * err))).alias("RMSE"),
        np_round2(mape).alias("MAPE"))


def _model_rank() -> F.Column:
    rank = F.lit(len(MODEL_ORDER) + 1)
    for i, m in reversed(list(enumerate(MODEL_ORDER))):
        rank = F.when(F.col("model") == m, F.lit(i + 1)).otherwise(rank)
    return rank


def select_best(metrics: DataFrame, criterion: str = "RMSE") -> DataFrame:
    """FC12: per series the model with the lowest (rounded) criterion; ties go to the
    earlier model in MODEL_ORDER."""
    return (metrics.withColumn("_rank", _model_rank())
            .groupBy("series")
            .agg(F.min_by("model", F.struct(F.col(criterion), F.col("_rank"))).alias("best_model"),
                 F.min(criterion).alias(criterion)))


def comparison_table(metrics: DataFrame, best: DataFrame) -> DataFrame:
    """FC13: metrics per model with the winner marked."""
    return (metrics.join(best.select("series", "best_model"), "series")
            .select("series", "model", "MAE", "RMSE", "MAPE", (F.col("model") == F.col("best_model")).alias("is_best")))


def future_targets(prepared: DataFrame, horizon: int = CFG.horizon, grain: str = "month") -> DataFrame:
    """(series, origin, step, forecast_date) for steps 1..horizon after the last period."""
    last = prepared.groupBy("series").agg(F.max("idx").alias("origin"), F.max("period_start").alias("_last"))
    t = last.select("series", "origin", "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    date = F.add_months("_last", F.col("step")) if grain == "month" else F.date_add("_last", F.col("step"))
    return t.select("series", "origin", "step", date.alias("forecast_date"))


def band_width(prepared: DataFrame, z: float = CFG.band_z) -> DataFrame:
    """AG11 + FC15: z * sample std-dev of the first differences, per series."""
    w = Window.partitionBy("series").orderBy("idx")
    d = prepared.select("series", (F.col("y") - F.lag("y").over(w)).alias("_d"))
    return d.groupBy("series").agg((F.lit(z) * F.stddev_samp("_d")).alias("_zsd"))


def generate_forecast(prepared: DataFrame, best: DataFrame, horizon: int = CFG.horizon,
                      ma_window: int = CFG.ma_window, season: int = CFG.season_length,
                      z: float = CFG.band_z, grain: str = "month", with_smoothing: bool = True,
                      with_generated_at: bool = True, validate: bool = False, start: str = CFG.smoothing_start) -> DataFrame:
    """FC14 + FC15: refit the selected model per series on all history, forecast
    ``horizon`` periods, band +/- z*std(diff)*sqrt(step), all rounded to 2.

    ``validate=True`` first checks (one small collect of the distinct model
    names) that every selected model is known, raising ValueError otherwise."""
    if validate:
        names = [r[0] for r in best.select("best_model").distinct().collect()]
        unknown = [n for n in names if n not in MODEL_ORDER]
        if unknown:
            raise ValueError(f"Unknown model: {unknown[0]}")
    history = prepared.select("series", "idx", "y")
    targets = future_targets(prepared, horizon, grain)
    preds = _baselines(history, targets, ma_window, season)
    if with_smoothing:  # only series whose winner is the smoothing are fitted again
        from ledgerline.operators.smoothing import MODEL_NAME, holt_winters_forecasts
        won = best.where(F.col("best_model") == MODEL_NAME).select("series")
        preds = preds.unionByName(holt_winters_forecasts(
            history.join(won, "series", "left_semi"), targets.join(won, "series", "left_semi"), season, start))
    chosen = preds.join(best.select("series", F.col("best_model").alias("model")), ["series", "model"])
    width = F.col("_zsd") * F.sqrt(F.col("step").cast("double"))
    out = chosen.join(band_width(prepared, z), "series", "left").select(
        "series", "forecast_date", "step",
        np_round2(F.col("y_pred")).alias("predicted_sales"),
        np_round2(F.col("y_pred") - width).alias("lower_bound"),
        np_round2(F.col("y_pred") + width).alias("upper_bound"),
        F.col("model").alias("model_name"))
    if with_generated_at:
        out = out.withColumn("generated_at", F.current_timestamp())
    return out


def history_and_forecast(prepared: DataFrame, forecast: DataFrame) -> DataFrame:
    """FC18 / SO2: actuals followed by the forecast with its band, for the combo chart."""
    hist = prepared.select("series", F.col("period_start").alias("date"), F.lit("actual").alias("kind"),
                           F.col("y").alias("value"))
    fc = forecast.select("series", F.col("forecast_date").alias("date"), F.lit("forecast").alias("kind"),
                         F.col("predicted_sales").alias("value"), "lower_bound", "upper_bound", "model_name")
    return hist.unionByName(fc, allowMissingColumns=True)


def scorecard(best: DataFrame, horizon: int = CFG.horizon) -> DataFrame:
    """FC19: horizon, selected model and its hold-out RMSE per series."""
    return best.select("series", F.lit(horizon).alias("horizon"), F.col("best_model").alias("model_name"), "RMSE")


def run_forecasting(prepared: DataFrame, cfg: PipelineConfig = CFG, with_smoothing: bool = True,
                    grain: str = "month") -> dict[str, DataFrame]:
    """FC17: eligible series -> split -> compare -> select -> refit and forecast."""
    prepared = materialize(prepared, "prepared")  # small (series x periods), read by every branch below
    ok = eligible(prepared, cfg.min_history)
    split = chronological_split(ok, cfg.test_fraction)
    assert_no_leakage(split)
    preds = holdout_predictions(split, cfg.ma_window, cfg.season_length, with_smoothing, cfg.smoothing_start)
    metrics = materialize(evaluate(preds), "metrics")  # the parameter search runs once
    best = select_best(metrics)
    fc = generate_forecast(ok, best, cfg.horizon, cfg.ma_window, cfg.season_length, cfg.band_z, grain,
                           with_smoothing=with_smoothing, start=cfg.smoothing_start)
    return {"split": split, "predictions": preds, "metrics": metrics, "best": best,
            "comparison": comparison_table(metrics, best), "forecast": fc,
            "skipped": skipped_series(prepared, cfg.min_history), "scorecard": scorecard(best, cfg.horizon)}
