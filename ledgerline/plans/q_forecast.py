"""Registered queries: per-series forecasting (category series of monthly revenue,
plus the total series at monthly and daily grain)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.config import PipelineConfig
from ledgerline.operators import forecast as FC
from ledgerline.operators import marts as M
from ledgerline.operators import smoothing as HW
from ledgerline.plans.oracle import with_chain
from ledgerline.plans.q_core import mart_of, stg_of
from ledgerline.plans.registry import query

CFG = PipelineConfig()
KEEP = repr(1.0 - CFG.test_fraction)
K, S, H = CFG.ma_window, CFG.season_length, CFG.horizon
# Fixed dates of the registered queries: one after the data (every month is
# complete) and one in their last month (which is then the incomplete one).
AS_OF, AS_OF_LAST = "2000-01-01", "1998-08-02"


def _round2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def _prep_ctes(prefix: str, obs_sql: str, unit: str, as_of: str = AS_OF) -> list[tuple[str, str]]:
    """Spine, interpolation and incomplete-period drop, in DuckDB."""
    diff = "date_diff('month', f, period_start)" if unit == "month" else "date_diff('day', f, period_start)"
    return [
        (f"{prefix}_obs", obs_sql),
        (f"{prefix}_bounds", f"SELECT series, min(period_start) AS f, max(period_start) AS l FROM {prefix}_obs GROUP BY series"),
        (f"{prefix}_spine", f"""SELECT series, f, l, CAST(unnest(generate_series(f, l, INTERVAL 1 {unit.upper()})) AS DATE)
            AS period_start FROM {prefix}_bounds"""),
        (f"{prefix}_joined", f"""SELECT s.series, s.period_start, s.l, o.y,
            CAST({diff.replace('f,', 's.f,').replace('period_start)', 's.period_start)')} + 1 AS INTEGER) AS idx
            FROM {prefix}_spine s LEFT JOIN {prefix}_obs o ON s.series = o.series AND s.period_start = o.period_start"""),
        (f"{prefix}_interp", f"""SELECT *,
            last_value(y IGNORE NULLS) OVER w1 AS py, last_value(CASE WHEN y IS NOT NULL THEN idx END IGNORE NULLS) OVER w1 AS pi,
            first_value(y IGNORE NULLS) OVER w2 AS ny, first_value(CASE WHEN y IS NOT NULL THEN idx END IGNORE NULLS) OVER w2 AS ni
            FROM {prefix}_joined
            WINDOW w1 AS (PARTITION BY series ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   w2 AS (PARTITION BY series ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
        (f"{prefix}_filled", f"""SELECT series, period_start, l, idx,
            coalesce(y, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL THEN py + (ny - py) / (ni - pi) * (idx - pi) END, py, ny) AS y
            FROM {prefix}_interp
            WHERE NOT (period_start = l AND period_start >= date_trunc('{unit}', DATE '{as_of}'))"""),
        (f"{prefix}_prep", f"""SELECT series, period_start, y, idx, count(*) OVER (PARTITION BY series) AS n
            FROM {prefix}_filled"""),
    ]


CAT_OBS = """SELECT category AS series, CAST(date_trunc('month', order_date) AS DATE) AS period_start,
    CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS y FROM stg GROUP BY 1, 2"""
DAY_OBS = """SELECT 'total' AS series, order_date AS period_start,
    CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS y FROM stg GROUP BY 1, 2"""

MODEL_CASE = ("CASE model WHEN 'Naive' THEN 1 WHEN 'Moving Average' THEN 2 WHEN 'Seasonal Naive' THEN 3 "
              "WHEN 'Exponential Smoothing' THEN 4 ELSE 5 END")


def _baseline_union(targets: str, hist: str, level: str, cols: str) -> str:
    seas_idx = f"CASE WHEN t.origin >= {S} THEN t.origin - {S} + ((t.step - 1) % {S}) + 1 ELSE t.origin END"
    return f"""SELECT {cols}, 'Naive' AS model, lv.naive AS y_pred FROM {targets} t LEFT JOIN {level} lv ON t.series = lv.series
      UNION ALL SELECT {cols}, 'Moving Average' AS model, lv.ma AS y_pred FROM {targets} t LEFT JOIN {level} lv ON t.series = lv.series
      UNION ALL SELECT {cols}, 'Seasonal Naive' AS model, h.y AS y_pred FROM {targets} t
        LEFT JOIN {hist} h ON h.series = t.series AND h.idx = {seas_idx}"""


FC_CTES = _prep_ctes("fc", CAT_OBS, "month") + [
    ("fc_ok", "SELECT * FROM fc_prep WHERE n >= 6"),
    ("fc_split", f"""SELECT *, greatest(1, CAST(floor(n * {KEEP}::DOUBLE) AS INTEGER)) AS split_idx,
        idx <= greatest(1, CAST(floor(n * {KEEP}::DOUBLE) AS INTEGER)) AS is_train FROM fc_ok"""),
    ("fc_train", "SELECT series, idx, y, split_idx AS origin FROM fc_split WHERE is_train"),
    ("fc_level", f"""SELECT series, arg_max(y, idx) AS naive, avg(CASE WHEN idx > origin - {K} THEN y END) AS ma
        FROM fc_train GROUP BY series"""),
    ("fc_test", """SELECT series, split_idx AS origin, idx - split_idx AS step, period_start, y AS y_true
        FROM fc_split WHERE NOT is_train"""),
    ("fc_hold", _baseline_union("fc_test", "fc_train", "fc_level",
                                "t.series, t.origin, t.step, t.period_start, t.y_true")),
    ("fc_metrics", f"""SELECT series, model, {_round2('avg(abs(y_true - y_pred))')} AS MAE,
        {_round2('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))')} AS RMSE,
        {_round2('avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100')} AS MAPE
        FROM fc_hold GROUP BY series, model"""),
    ("fc_best", f"""SELECT series, best_model, RMSE FROM (SELECT series, model AS best_model, RMSE,
        row_number() OVER (PARTITION BY series ORDER BY RMSE, {MODEL_CASE}) AS rn FROM fc_metrics) WHERE rn = 1"""),
    ("fc_last", "SELECT series, max(idx) AS origin, max(period_start) AS last FROM fc_ok GROUP BY series"),
    ("fc_future", f"""SELECT series, origin, CAST(r.range AS INTEGER) AS step,
        CAST(last + CAST(r.range AS INTEGER) * INTERVAL 1 MONTH AS DATE) AS forecast_date
        FROM fc_last CROSS JOIN range(1, {H + 1}) r"""),
    ("fc_hist", "SELECT o.series, o.idx, o.y FROM fc_ok o"),
    ("fc_flevel", f"""SELECT h.series, arg_max(h.y, h.idx) AS naive, avg(CASE WHEN h.idx > l.origin - {K} THEN h.y END) AS ma
        FROM fc_hist h JOIN fc_last l ON h.series = l.series GROUP BY h.series"""),
    ("fc_fpred", _baseline_union("fc_future", "fc_hist", "fc_flevel", "t.series, t.origin, t.step, t.forecast_date")),
    ("fc_std", f"""SELECT series, {CFG.band_z} * stddev_samp(d) AS zsd FROM (
        SELECT series, y - lag(y) OVER (PARTITION BY series ORDER BY idx) AS d FROM fc_ok) GROUP BY series"""),
    ("fc_band", f"""SELECT p.series, p.forecast_date, p.step, {_round2('p.y_pred')} AS predicted_sales,
        {_round2('p.y_pred - s.zsd * sqrt(p.step)')} AS lower_bound,
        {_round2('p.y_pred + s.zsd * sqrt(p.step)')} AS upper_bound, p.model AS model_name
        FROM fc_fpred p JOIN fc_best b ON p.series = b.series AND p.model = b.best_model
        LEFT JOIN fc_std s ON p.series = s.series"""),
]


def fc_sql(select_sql: str) -> str:
    return with_chain(select_sql, FC_CTES)


def _prepared(spark, d):
    return FC.prepare_series(FC.period_observations(stg_of(spark, d), ["category"]), as_of=AS_OF)


def _split(spark, d):
    return FC.chronological_split(FC.eligible(_prepared(spark, d)), CFG.test_fraction)


def _holdout(spark, d, with_smoothing=False):
    return FC.holdout_predictions(_split(spark, d), K, S, with_smoothing)


def _best_baselines(spark, d):
    return FC.select_best(FC.evaluate(_holdout(spark, d)))


@query("fc_prepare", fc_sql("SELECT * FROM fc_prep"), ("y",))
def fc_prepare(spark, d):
    return _prepared(spark, d)


@query("fc_prepare_daily", with_chain("SELECT * FROM fcd_prep", _prep_ctes("fcd", DAY_OBS, "day")), ("y",))
def fc_prepare_daily(spark, d):
    """FC20: the daily grain option of the series preparation."""
    obs = FC.period_observations(stg_of(spark, d), [], grain="day")
    return FC.prepare_series(obs, as_of=AS_OF, grain="day")


@query("fc_split", fc_sql("SELECT * FROM fc_split"), ("y",))
def fc_split(spark, d):
    return _split(spark, d)


def _one_model(name):
    return fc_sql(f"SELECT * FROM fc_hold WHERE model = '{name}'")


@query("fc_naive", _one_model("Naive"), ("y_true", "y_pred"))
def fc_naive(spark, d):
    return _holdout(spark, d).where(F.col("model") == "Naive")


@query("fc_moving_average", _one_model("Moving Average"), ("y_true", "y_pred"))
def fc_moving_average(spark, d):
    return _holdout(spark, d).where(F.col("model") == "Moving Average")


@query("fc_seasonal_naive", _one_model("Seasonal Naive"), ("y_true", "y_pred"))
def fc_seasonal_naive(spark, d):
    return _holdout(spark, d).where(F.col("model") == "Seasonal Naive")


@query("fc_metrics_baselines", fc_sql("SELECT * FROM fc_metrics"))
def fc_metrics_baselines(spark, d):
    return FC.evaluate(_holdout(spark, d))


@query("fc_select_baselines", fc_sql("SELECT * FROM fc_best"))
def fc_select_baselines(spark, d):
    return _best_baselines(spark, d)


@query("fc_band", fc_sql("SELECT * FROM fc_band"))
def fc_band(spark, d):
    return FC.generate_forecast(FC.eligible(_prepared(spark, d)), _best_baselines(spark, d), H, K, S, CFG.band_z,
                                with_smoothing=False, with_generated_at=False)


@query("fc_history_and_forecast", fc_sql("""SELECT series, period_start AS date, 'actual' AS kind, y AS value,
    CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound, CAST(NULL AS VARCHAR) AS model_name
    FROM fc_ok
  UNION ALL SELECT series, forecast_date AS date, 'forecast' AS kind, predicted_sales AS value, lower_bound,
    upper_bound, model_name FROM fc_band"""), ("value",))
def fc_history_and_forecast(spark, d):
    prepared = FC.eligible(_prepared(spark, d))
    fc = FC.generate_forecast(prepared, _best_baselines(spark, d), H, K, S, CFG.band_z,
                              with_smoothing=False, with_generated_at=False)
    return FC.history_and_forecast(prepared, fc)


# ---- with exponential smoothing: the oracle runs the recursion over time as a
# recursive query, one state for each series and grid point
def _smoothing_ctes(p: str, hist: str) -> list[tuple[str, str]]:
    """CTEs ending in {p}_fit(series, seasonal, alpha, beta, gamma, level, trend,
    season, sse, n), fitted on ``hist`` (series, idx, y)."""
    mid = repr((S - 1) / 2.0)

    def grid(name: str, rows: str) -> tuple[str, str]:
        return name, f"""SELECT g.series, g.a, g.b, g.g, s.seasonal, s.l0, s.b0, s.s0, s.tail
            FROM ({rows}) g JOIN {p}_start s ON g.series = s.series"""

    def run(name: str, over: str) -> tuple[str, str]:
        return name, f"""SELECT series, a, b, g, 0 AS t, l0 AS lv, b0 AS tr, s0 AS s, CAST(0 AS DOUBLE) AS sse, seasonal, tail FROM {over}
          UNION ALL
          SELECT series, a, b, g, t + 1, ln, b * (ln - lv) + (1 - b) * tr,
            CASE WHEN seasonal THEN list_transform(s, lambda x, i: CASE WHEN i = t % {S} + 1 THEN g * (y - lv - tr) + (1 - g) * sc ELSE x END)
                 ELSE s END,
            sse + (y - (lv + tr + sc)) * (y - (lv + tr + sc)), seasonal, tail
          FROM (SELECT *, a * (y - sc) + (1 - a) * (lv + tr) AS ln
                FROM (SELECT *, tail[t + 1] AS y, CASE WHEN seasonal THEN s[t % {S} + 1] ELSE 0.0 END AS sc
                      FROM {name} WHERE t < len(tail)))"""

    def best(name: str, over: str) -> tuple[str, str]:
        return name, f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY sse, a, b, g) AS rn
            FROM {over} WHERE t = len(tail)) WHERE rn = 1"""

    tenths = "(SELECT CAST(i AS DOUBLE) / 10 AS v FROM range(1, 10) r(i))"
    around = lambda c: f"(SELECT DISTINCT series, least(greatest(round({c} + k * 0.02, 2), 0.01), 0.99) AS v FROM {p}_best1, range(-4, 5) q(k))"
    return [
        (f"{p}_list", f"SELECT series, list(y ORDER BY idx) AS y, count(*) AS n FROM {hist} GROUP BY series"),
        (f"{p}_mean", f"""SELECT series, y, n, n >= {2 * S} AS seasonal, list_sum(y[1:{S}]) / {S}.0 AS m1,
            list_sum(y[{S + 1}:{2 * S}]) / {S}.0 AS m2 FROM {p}_list"""),
        (f"{p}_start", f"""SELECT series, n, seasonal,
            CASE WHEN seasonal THEN m1 + {mid} * ((m2 - m1) / {S}) ELSE y[1] END AS l0,
            CASE WHEN seasonal THEN (m2 - m1) / {S} WHEN n > 1 THEN y[2] - y[1] ELSE 0.0 END AS b0,
            CASE WHEN seasonal THEN list_transform(y[1:{S}], lambda x, i: x - m1 - ((i - 1) - {mid}) * ((m2 - m1) / {S}))
                 ELSE list_transform(range(0, {S}), lambda i: CAST(0 AS DOUBLE)) END AS s0,
            CASE WHEN seasonal THEN y[{S + 1}:] ELSE y[2:] END AS tail FROM {p}_mean"""),
        grid(f"{p}_grid1", f"""SELECT st.series, a.v AS a, b.v AS b, CASE WHEN st.seasonal THEN c.v ELSE 0.0 END AS g
            FROM {p}_start st, {tenths} a, {tenths} b, {tenths} c WHERE st.seasonal OR c.v < 0.15"""),
        run(f"{p}_run1", f"{p}_grid1"),
        best(f"{p}_best1", f"{p}_run1"),
        grid(f"{p}_grid2", f"""SELECT DISTINCT o.series, a.v AS a, b.v AS b, CASE WHEN o.seasonal THEN c.v ELSE 0.0 END AS g
            FROM {p}_best1 o JOIN {around('a')} a ON a.series = o.series JOIN {around('b')} b ON b.series = o.series
            JOIN {around('g')} c ON c.series = o.series"""),
        run(f"{p}_run2", f"{p}_grid2"),
        best(f"{p}_best2", f"{p}_run2"),
        (f"{p}_fit", f"""SELECT o.series, o.seasonal, a AS alpha, b AS beta, CASE WHEN o.seasonal THEN g END AS gamma, lv AS level,
            tr AS trend, CASE WHEN o.seasonal THEN list_transform(range(0, {S}), lambda i: s[(i + len(o.tail)) % {S} + 1]) ELSE s END AS season,
            sse, CAST(st.n AS INTEGER) AS n FROM {p}_best2 o JOIN {p}_start st ON st.series = o.series"""),
    ]


def _smoothing_rows(targets: str, fit: str, cols: str) -> str:
    return f"""SELECT {cols}, 'Exponential Smoothing' AS model, f.level + t.step * f.trend + f.season[(t.step - 1) % {S} + 1] AS y_pred
        FROM {targets} t JOIN {fit} f ON f.series = t.series"""


SMOOTH_CTES = FC_CTES + _smoothing_ctes("fc_h", "fc_train") + [
    ("fc_hw", _smoothing_rows("fc_test", "fc_h_fit", "t.series, t.origin, t.step, t.period_start, t.y_true")),
    ("fc_hold4", "SELECT * FROM fc_hold UNION ALL SELECT * FROM fc_hw"),
    ("fc_metrics4", dict(FC_CTES)["fc_metrics"].replace("FROM fc_hold ", "FROM fc_hold4 ")),
    ("fc_best4", dict(FC_CTES)["fc_best"].replace("FROM fc_metrics)", "FROM fc_metrics4)")),
    ("fc_comparison", """SELECT m.series, m.model, m.MAE, m.RMSE, m.MAPE, m.model = b.best_model AS is_best
        FROM fc_metrics4 m JOIN fc_best4 b ON m.series = b.series"""),
]
FORECAST_CTES = SMOOTH_CTES + _smoothing_ctes("fc_f", "fc_hist") + [
    ("fc_fpred4", "SELECT * FROM fc_fpred UNION ALL " + _smoothing_rows(
        "fc_future", "fc_f_fit", "t.series, t.origin, t.step, t.forecast_date")),
    ("fc_band4", dict(FC_CTES)["fc_band"].replace("fc_fpred p", "fc_fpred4 p").replace("fc_best b", "fc_best4 b")),
]


def _full(spark, d):
    return FC.run_forecasting(_prepared(spark, d), CFG, with_smoothing=True)


@query("fc_exp_smoothing", with_chain("SELECT * FROM fc_hw", SMOOTH_CTES), ("y_true", "y_pred"))
def fc_exp_smoothing(spark, d):
    split = _split(spark, d)
    train, test = FC.holdout_targets(split)
    return HW.holt_winters_forecasts(train, test, S)


@query("fc_exp_smoothing_params", with_chain(
    "SELECT series, seasonal, alpha, beta, gamma, level, trend, sqrt(sse / n) AS one_step_rmse, n FROM fc_f_fit",
    FC_CTES + _smoothing_ctes("fc_f", "fc_hist")), ("level", "trend", "one_step_rmse"))
def fc_exp_smoothing_params(spark, d):
    fit = HW.fitted_parameters(FC.eligible(_prepared(spark, d)).select("series", "idx", "y"), S)
    return fit.withColumn("one_step_rmse", F.sqrt(F.col("sse") / F.col("n"))).drop("sse")


@query("fc_compare", with_chain("SELECT * FROM fc_comparison", SMOOTH_CTES))
def fc_compare(spark, d):
    return _full(spark, d)["comparison"]


@query("fc_best", with_chain("SELECT * FROM fc_best4", SMOOTH_CTES))
def fc_best(spark, d):
    return _full(spark, d)["best"]


@query("fc_forecast", with_chain("SELECT * FROM fc_band4", FORECAST_CTES))
def fc_forecast(spark, d):
    return _full(spark, d)["forecast"].drop("generated_at")


@query("fc_scorecard", with_chain(f"SELECT series, {H} AS horizon, best_model AS model_name, RMSE FROM fc_best4", SMOOTH_CTES))
def fc_scorecard(spark, d):
    return _full(spark, d)["scorecard"]


def _estimated_ctes(p: str, hist: str) -> list[tuple[str, str]]:
    """CTEs ending in {p}_fit(series, n, scale, a, b, g, seasonal, sse, l, tr, s): start values by the normal
    equations of the recursion's errors, which are solved by elimination, for each grid point."""
    def run(name: str, over: str) -> tuple[str, str]:
        return name, f"""SELECT *, 0 AS t, CAST([] AS DOUBLE[]) AS e FROM (SELECT id, a, b, g, seasonal, v, l, tr, s FROM {over})
          UNION ALL
          SELECT id, a, b, g, seasonal, v, ln, b * (ln - l) + (1 - b) * tr,
            CASE WHEN seasonal THEN list_transform(s, lambda x, i: CASE WHEN i = t % {S} + 1 THEN g * (y - l - tr) + (1 - g) * sc ELSE x END)
                 ELSE s END, t + 1, list_append(e, y - (l + tr + sc))
          FROM (SELECT *, a * (y - sc) + (1 - a) * (l + tr) AS ln
                FROM (SELECT *, v[t + 1] AS y, CASE WHEN seasonal THEN s[t % {S} + 1] ELSE 0.0 END AS sc FROM {name} WHERE t < len(v)))"""

    def fit(k: int, rows: str) -> list[tuple[str, str]]:
        """The grid points ``rows`` (series, a, b, g) with least squared errors and starts."""
        q = f"{p}{k}"
        nought = f"list_transform(range(0, {S}), lambda i: CAST(0 AS DOUBLE))"
        return [
            (f"{q}_grid", rows),
            # a zero series from each start: level, trend, and each season against the last
            (f"{q}_unit", f"""SELECT CAST(k AS VARCHAR) AS id, a, b, g, seasonal, list_transform(range(0, longest), lambda i: CAST(0 AS DOUBLE)) AS v,
                CAST(k = 0 AS DOUBLE) AS l, CAST(k = 1 AS DOUBLE) AS tr,
                list_transform(range(0, {S}), lambda i: CAST(CASE WHEN k < 2 THEN 0 WHEN i = k - 2 THEN 1 WHEN i = {S - 1} THEN -1 ELSE 0 END AS DOUBLE)) AS s
                FROM (SELECT DISTINCT a, b, g, seasonal FROM {q}_grid JOIN {p}_list USING (series)),
                     (SELECT max(n) AS longest FROM {p}_list), range(0, {S + 1}) r(k) WHERE seasonal OR k < 2"""),
            run(f"{q}_urun", f"{q}_unit"),
            (f"{q}_cols", f"SELECT a, b, g, seasonal, list(e ORDER BY CAST(id AS INT)) AS cols FROM {q}_urun WHERE t = len(v) GROUP BY ALL"),
            (f"{q}_own", f"SELECT series AS id, a, b, g, seasonal, z AS v, CAST(0 AS DOUBLE) AS l, CAST(0 AS DOUBLE) AS tr, {nought} AS s "
                         f"FROM {q}_grid JOIN {p}_list USING (series)"),
            run(f"{q}_orun", f"{q}_own"),
            (f"{q}_mat", f"""SELECT id, o.a, o.b, o.g, o.seasonal, len(cols) AS p, list_inner_product(o.e, o.e) AS whole,
                list_transform(cols, lambda x: list_inner_product(x[1:len(o.e)], o.e)) AS h,
                list_transform(cols, lambda x: list_append(list_transform(cols, lambda y: list_inner_product(x[1:len(o.e)], y[1:len(o.e)])),
                                                           list_inner_product(x[1:len(o.e)], o.e))) AS m
                FROM {q}_orun o JOIN {q}_cols c ON o.a = c.a AND o.b = c.b AND o.g = c.g AND o.seasonal = c.seasonal WHERE o.t = len(o.v)"""),
            (f"{q}_solve", f"""SELECT *, 1 AS k FROM {q}_mat
              UNION ALL
              SELECT id, a, b, g, seasonal, p, whole, h, list_transform(m, lambda x, i: CASE WHEN i = k THEN x ELSE
                list_transform(x, lambda v, j: v - x[k] / m[k][k] * m[k][j]) END), k + 1 FROM {q}_solve WHERE k <= p"""),
            (f"{q}_theta", f"""SELECT *, whole + list_inner_product(theta, h) AS sse FROM (
                SELECT *, list_transform(m, lambda x, i: -x[p + 1] / x[i]) AS theta FROM {q}_solve WHERE k = p + 1)"""),
            (f"{q}_best", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(greatest(sse, 0), 12), a, b, g) AS place
                FROM {q}_theta) WHERE place = 1"""),
        ]

    fifths = "(SELECT (2 * i + 1) / 10.0 AS v FROM range(0, 5) r(i))"
    around = lambda c: f"(SELECT DISTINCT id, least(greatest(round({c} + away * 0.05, 2), 0.05), 0.95) AS v FROM {p}1_best, range(-2, 3) q(away))"
    return [
        (f"{p}_list", f"""SELECT series, n, seasonal, scale, list_transform(y, lambda x: x / scale) AS z FROM (
            SELECT series, list(y ORDER BY idx) AS y, count(*) AS n, count(*) >= {2 * S} AS seasonal, avg(abs(y)) AS scale FROM {hist} GROUP BY series)"""),
        *fit(1, f"""SELECT series, CAST(x.v AS DOUBLE) AS a, CAST(y.v AS DOUBLE) AS b, CAST(CASE WHEN seasonal THEN w.v ELSE 0 END AS DOUBLE) AS g
            FROM {p}_list, {fifths} x, {fifths} y, {fifths} w WHERE seasonal OR w.v < 0.15"""),
        *fit(2, f"""SELECT DISTINCT o.id AS series, CAST(x.v AS DOUBLE) AS a, CAST(y.v AS DOUBLE) AS b, CAST(CASE WHEN o.seasonal THEN w.v ELSE 0 END AS DOUBLE) AS g
            FROM {p}1_best o JOIN {around('a')} x ON x.id = o.id JOIN {around('b')} y ON y.id = o.id JOIN {around('g')} w ON w.id = o.id"""),
        (f"{p}_again", f"""SELECT id, a, b, g, o.seasonal, z AS v, theta[1] AS l, theta[2] AS tr,
            CASE WHEN o.seasonal THEN list_append(theta[3:], -list_sum(theta[3:])) ELSE list_transform(range(0, {S}), lambda i: CAST(0 AS DOUBLE)) END AS s
            FROM {p}2_best o JOIN {p}_list i ON i.series = o.id"""),
        run(f"{p}_last", f"{p}_again"),
        (f"{p}_fit", f"""SELECT i.series, i.n, i.scale, a, b, CASE WHEN o.seasonal THEN g END AS g, list_inner_product(e, e) AS sse, l, tr, s
            FROM {p}_last o JOIN {p}_list i ON i.series = o.id WHERE t = len(v)"""),
    ]


@query("fc_exp_smoothing_estimated", with_chain(f"""SELECT series, a AS alpha, b AS beta, g AS gamma, CAST(n AS INTEGER) AS n,
    sqrt(sse / n) AS rmse_ratio, CAST(step AS INTEGER) AS step, l + step * tr + s[(n + step - 1) % {S} + 1] AS y_ratio
    FROM fc_e_fit, range(1, {H + 1}) r(step)""", FC_CTES + _estimated_ctes("fc_e", "fc_hist")), ("rmse_ratio", "y_ratio"))
def fc_exp_smoothing_estimated(spark, d):
    """FC5: start values estimated jointly with the weights; one-step error and
    forecasts relative to the mean absolute value of the series."""
    history = FC.eligible(_prepared(spark, d)).select("series", "idx", "y")
    fit = HW.fit_holt_winters(history, S, "estimated")
    scale = history.groupBy(F.col("series").alias("of")).agg(F.avg(F.abs("y")).alias("scale"))
    season = F.element_at("season", F.pmod(F.col("step") - 1, F.lit(S)) + 1)
    fit = fit.join(scale, F.col("series") == F.col("of")).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(H))))
    return fit.select("series", "alpha", "beta", "gamma", "n", (F.sqrt(F.col("sse") / F.col("n")) / F.col("scale")).alias("rmse_ratio"), "step",
                      ((F.col("level") + F.col("step") * F.col("trend") + season) / F.col("scale")).alias("y_ratio"))


def _part(x: str) -> str:
    return f"coalesce(replace(replace({x}, '\\', '\\\\'), '|', '\\|'), '\\N')"


PAIR_OBS = f"""SELECT {_part('customer_id')} || '|' || {_part('product_id')} AS series,
    CAST(date_trunc('month', order_date) AS DATE) AS period_start, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS y
    FROM stg GROUP BY 1, 2"""
NAME_OBS = PAIR_OBS.replace("customer_id", "product_name").replace("product_id", "region")


@query("fc_skipped_series", with_chain(
    "SELECT series, max(n) AS n FROM fcp_prep GROUP BY series HAVING max(n) < 6",
    _prep_ctes("fcp", PAIR_OBS, "month")))
def fc_skipped_series(spark, d):
    """FC16 on per-(customer, product) series: the many series whose history is too
    short to forecast, told by their first and last month."""
    obs = FC.period_observations(stg_of(spark, d), ["customer_id", "product_id"])
    return FC.skipped_series(FC.series_lengths(obs, AS_OF), CFG.min_history)


@query("fc_two_keys", with_chain("SELECT * FROM fcn_obs", [("fcn_obs", NAME_OBS)]), ("y",))
def fc_two_keys(spark, d):
    """Series of two keys whose values hold the separator."""
    return FC.period_observations(stg_of(spark, d), ["product_name", "region"])


def _forecast_ctes(prefix: str, obs_sql: str, ctes=FC_CTES) -> list[tuple[str, str]]:
    """The category-series CTE chain re-targeted at another observation table."""
    import re
    rename = lambda t: re.sub(r"\bfc_", f"{prefix}_", t)
    out = [(rename(n), rename(s)) for n, s in ctes]
    out[0] = (f"{prefix}_obs", obs_sql)
    return out


TOTAL_OBS = "SELECT 'total' AS series, month_start AS period_start, total_revenue AS y FROM monthly"
TOTAL_CTES = _forecast_ctes("fct", TOTAL_OBS)


def _total_prepared(spark, d, as_of=AS_OF):
    monthly = mart_of(spark, d, "sales_monthly")
    return FC.prepare_series(FC.from_monthly_mart(monthly), as_of=as_of)


@query("fc_prepare_total", with_chain("SELECT * FROM fct_prep", TOTAL_CTES), ("y",))
def fc_prepare_total(spark, d):
    """SRC6 + FC1: the single total series read from the monthly mart."""
    return _total_prepared(spark, d)


@query("fc_band_total", with_chain("SELECT * FROM fct_band", TOTAL_CTES))
def fc_band_total(spark, d):
    """The original single-series flow with the baseline models: compare on the
    hold-out, select by RMSE, refit on all history, forecast with the band."""
    prepared = FC.eligible(_total_prepared(spark, d))
    split = FC.chronological_split(prepared, CFG.test_fraction)
    best = FC.select_best(FC.evaluate(FC.holdout_predictions(split, K, S)))
    return FC.generate_forecast(prepared, best, H, K, S, CFG.band_z, with_smoothing=False, with_generated_at=False)


@query("fc_prepare_incomplete", with_chain("SELECT * FROM fcl_prep", _prep_ctes("fcl", TOTAL_OBS, "month", AS_OF_LAST)), ("y",))
def fc_prepare_incomplete(spark, d):
    """FL5: asked on a day of the last month, that month is left out."""
    return _total_prepared(spark, d, AS_OF_LAST)


@query("fc_forecast_total", with_chain("SELECT * FROM fct_band4", _forecast_ctes("fct", TOTAL_OBS, FORECAST_CTES)))
def fc_forecast_total(spark, d):
    """The original flow on its single series: the monthly mart's total revenue."""
    return FC.run_forecasting(_total_prepared(spark, d), CFG, with_smoothing=True)["forecast"].drop("generated_at")
