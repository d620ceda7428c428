import math
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import forecast as FC
from ledgerline.operators import smoothing as HW


def monthly(spark, n, series="total", start="2023-01-01", skip=()):
    data = [(series, i, 1000 + 20 * i + 50 * math.sin(i / 2)) for i in range(n) if i not in skip]
    df = spark.createDataFrame(data, "series string, i int, y double")
    return df.select("series", F.add_months(F.lit(start).cast("date"), F.col("i")).alias("period_start"), "y")


def prepared(spark, n, **kw):
    return FC.prepare_series(monthly(spark, n, **kw), as_of="2100-01-01")


def test_split_has_no_overlap(spark):
    for f in (0.1, 0.2, 0.3, 0.5):
        s = FC.chronological_split(prepared(spark, 30), f)
        assert FC.leakage_violations(s).count() == 0
        tr = s.where("is_train").agg(F.max("period_start")).first()[0]
        te = s.where("not is_train").agg(F.min("period_start")).first()[0]
        assert tr < te
        assert s.where("is_train").count() == max(1, int(30 * (1 - f)))


def _holdout(spark, n, model):
    s = FC.chronological_split(prepared(spark, n), 0.2)
    return s, FC.holdout_predictions(s).where(F.col("model") == model).orderBy("step").collect()


def test_naive_repeats_last_value(spark):
    s, p = _holdout(spark, 30, "Naive")
    last = s.where("is_train").orderBy(F.desc("idx")).first()["y"]
    assert len(p) == 6 and all(r["y_pred"] == last for r in p)


def test_moving_average_is_mean_of_last_three(spark):
    s, p = _holdout(spark, 30, "Moving Average")
    ys = [r["y"] for r in s.where("is_train").orderBy(F.desc("idx")).limit(3).collect()]
    assert all(abs(r["y_pred"] - sum(ys) / 3) < 1e-9 for r in p)


def test_seasonal_naive_tiles_last_season(spark):
    s, p = _holdout(spark, 30, "Seasonal Naive")
    train = [r["y"] for r in s.where("is_train").orderBy("idx").collect()]
    assert [r["y_pred"] for r in p] == train[-12:][:6]


def test_seasonal_naive_short_history_is_naive(spark):
    s, p = _holdout(spark, 10, "Seasonal Naive")
    last = s.where("is_train").orderBy(F.desc("idx")).first()["y"]
    assert all(r["y_pred"] == last for r in p)


def test_metrics(spark):
    df = spark.createDataFrame([("s", "m", 100.0, 110.0), ("s", "m", 200.0, 190.0), ("s", "m", 300.0, 300.0)],
                               "series string, model string, y_true double, y_pred double")
    m = FC.evaluate(df).first()
    assert abs(m["MAE"] - 6.67) < 0.01 and m["RMSE"] > 0 and m["MAPE"] > 0


def test_mape_masks_zero_actuals(spark):
    df = spark.createDataFrame([("s", "m", 0.0, 5.0), ("s", "m", 100.0, 90.0), ("t", "m", 0.0, 1.0)],
                               "series string, model string, y_true double, y_pred double")
    m = {r["series"]: r for r in FC.evaluate(df).collect()}
    assert m["s"]["MAPE"] == 10.0 and m["t"]["MAPE"] is None


def test_select_best_by_rmse_with_ties(spark):
    df = spark.createDataFrame([("s", "Naive", 10.0, 20.0, 5.0), ("s", "Moving Average", 5.0, 8.0, 3.0),
                                ("t", "Seasonal Naive", 1.0, 2.0, 1.0), ("t", "Naive", 1.0, 2.0, 1.0)],
                               "series string, model string, MAE double, RMSE double, MAPE double")
    b = {r["series"]: r["best_model"] for r in FC.select_best(df).collect()}
    assert b == {"s": "Moving Average", "t": "Naive"}


def test_all_four_models_compared(spark):
    out = FC.run_forecasting(prepared(spark, 30))
    models = {r["model"] for r in out["metrics"].collect()}
    assert models == set(FC.MODEL_ORDER)


def test_forecast_dates_after_history_and_band(spark):
    p = prepared(spark, 24)
    best = spark.createDataFrame([("total", "Naive")], "series string, best_model string")
    fc = FC.generate_forecast(p, best, horizon=6).collect()
    assert len(fc) == 6
    last = p.agg(F.max("period_start")).first()[0]
    assert all(r["forecast_date"] > last and r["upper_bound"] >= r["lower_bound"] for r in fc)


def test_unknown_model_raises(spark):
    best = spark.createDataFrame([("total", "Prophet")], "series string, best_model string")
    with pytest.raises(ValueError):
        FC.generate_forecast(prepared(spark, 24), best, validate=True)


def test_gap_interpolation_and_edges(spark):
    p = {r["idx"]: r["y"] for r in prepared(spark, 12, skip=(3, 4)).collect()}
    y2, y5 = 1000 + 40 + 50 * math.sin(1), 1000 + 100 + 50 * math.sin(2.5)
    assert abs(p[4] - (y2 + (y5 - y2) / 3)) < 1e-9 and abs(p[5] - (y2 + 2 * (y5 - y2) / 3)) < 1e-9
    assert len(p) == 12


def test_incomplete_month_dropped(spark):
    obs = monthly(spark, 12)
    assert FC.prepare_series(obs, as_of="2023-12-15").count() == 11      # last month is the current one
    assert FC.prepare_series(obs, as_of="2024-01-02").count() == 12
    assert FC.prepare_series(obs, as_of="2023-12-15").count() == 11


def test_short_history_skipped(spark):
    p = FC.prepare_series(monthly(spark, 5, series="a").unionByName(monthly(spark, 30, series="b")), as_of="2100-01-01")
    assert [r["series"] for r in FC.skipped_series(p).collect()] == ["a"]
    out = FC.run_forecasting(p)
    assert {r["series"] for r in out["forecast"].collect()} == {"b"}


def test_holt_winters_reproduces_trend_and_season(spark):
    rows = [("s", i + 1, 100 + 2 * i + 10 * math.sin(2 * math.pi * i / 12)) for i in range(48)]
    hist = spark.createDataFrame(rows, "series string, idx int, y double")
    targets = spark.createDataFrame([("s", 48, k) for k in range(1, 7)], "series string, origin int, step int")
    for r in HW.holt_winters_forecasts(hist, targets).collect():
        i = r["origin"] + r["step"] - 1
        assert abs(r["y_pred"] - (100 + 2 * i + 10 * math.sin(2 * math.pi * i / 12))) < 1e-6


def test_holt_winters_trend_only_under_two_seasons(spark):
    hist = spark.createDataFrame([("s", i + 1, 50.0 + 3 * i) for i in range(20)], "series string, idx int, y double")
    fit = HW.fitted_parameters(hist).first()
    assert not fit["seasonal"] and fit["gamma"] is None and abs(fit["trend"] - 3.0) < 1e-9


def test_vectorised_grid_matches_brute_force(spark):
    """The vectorised grid search picks the same parameters as a plain loop over
    every grid point (brute force) on the sf0.001 category series."""
    import numpy as np
    from ledgerline.plans.q_core import stg_of

    prep = FC.eligible(FC.prepare_series(FC.period_observations(stg_of(spark, "/root/testdata/sf0.001"),
                                                                ["category"]), as_of="2000-01-01"))
    got = {r["series"]: r for r in HW.fitted_parameters(prep.select("series", "idx", "y")).collect()}
    for series in list(got)[:3]:
        y = np.array([r["y"] for r in prep.where(F.col("series") == series).orderBy("idx").collect()])
        seasonal, l0, b0, s0, tail = (x if isinstance(x, bool) else x[0] for x in HW._start(y[None, :], 12))

        def sse(a, b, g):
            lv, tr, s, tot = l0, b0, list(s0), 0.0
            for t, v in enumerate(tail):
                j = t % 12
                sc = s[j] if seasonal else 0.0
                err = v - (lv + tr + sc)
                tot += err * err
                l_new = a * (v - sc) + (1 - a) * (lv + tr)
                tr_new = b * (l_new - lv) + (1 - b) * tr
                if seasonal:
                    s[j] = g * (v - lv - tr) + (1 - g) * sc
                lv, tr = l_new, tr_new
            return tot

        gam = HW.COARSE if seasonal else [0.0]
        cands = [(sse(a, b, g), a, b, g) for a in HW.COARSE for b in HW.COARSE for g in gam]
        _, a1, b1, g1 = min(cands)
        fine = [(sse(a, b, g), a, b, g) for a in HW._around(a1) for b in HW._around(b1)
                for g in (HW._around(g1) if seasonal else [0.0])]
        best_sse, a2, b2, g2 = min(fine)
        r = got[series]
        assert (r["alpha"], r["beta"]) == (a2, b2) and (not seasonal or r["gamma"] == g2)
        assert abs(r["sse"] - best_sse) <= 1e-6 * max(1.0, best_sse)


def _errors(y, l, b, s, a, be, g, seasonal):
    """One-step errors, by the plain recursion."""
    s, out = list(s), []
    for t, v in enumerate(y):
        sc = s[t % 12] if seasonal else 0.0
        out.append(v - (l + b + sc))
        new = a * (v - sc) + (1 - a) * (l + b)
        if seasonal:
            s[t % 12] = g * (v - l - b) + (1 - g) * sc
        l, b = new, be * (new - l) + (1 - be) * b
    return out


def test_estimated_start_values():
    """The least squares start beats other starts and weights; a batch of series of one length fits as each alone."""
    import itertools
    import random

    import numpy as np
    rng = random.Random(2)
    for n in (6, 20, 24, 31, 60):
        ys = np.array([[500 + 9 * i * (k + 1) + 40 * math.sin(i * 6.28 / 12 + k) + rng.gauss(0, 15) for i in range(n)] for k in range(3)])
        seasonal, a, b, g, lv, tr, season, sse = HW.fit_estimated(ys, 12)
        alone = [HW.fit_estimated(ys[k:k + 1], 12) for k in range(3)]
        assert [x[1][0] for x in alone] == list(a) and np.allclose([x[7][0] for x in alone], sse)
        old = HW.fit_first_seasons(ys, 12)
        for k in range(3):
            s0, l0, b0, terms, _ = (x if isinstance(x, bool) else x[k] for x in HW._start(ys, 12))
            first = sum(e * e for e in _errors(ys[k], l0, b0, terms, old[1][k], old[2][k], old[3][k], s0))
            assert sse[k] <= first + 1e-6  # the present way, over the same periods
            grid = list(itertools.product(HW.WIDE, HW.WIDE, HW.WIDE if s0 else [0.0]))
            basis = HW._basis(12, s0)
            for w in grid[:: max(1, len(grid) // 9)]:  # least squares by brute force
                cols = np.array([[-x for x in _errors(np.zeros(n), v[0], v[1], v[2:], *w, s0)] for v in basis]).T
                err = np.array(_errors(ys[k], 0.0, 0.0, np.zeros(12), *w, s0))
                theta, *_ = np.linalg.lstsq(cols, err, rcond=None)
                assert sse[k] <= ((err - cols @ theta) ** 2).sum() + 1e-6


def test_estimated_through_spark(spark):
    rows = [(f"s{k}", i + 1, 100.0 + 2 * i * k + 10 * math.sin(2 * math.pi * i / 12)) for k in range(40) for i in range(6 + k)]
    hist = spark.createDataFrame(rows, "series string, idx int, y double")
    targets = spark.createDataFrame([(f"s{k}", 6 + k, 1) for k in range(40)], "series string, origin int, step int")
    out = HW.holt_winters_forecasts(hist, targets, start="estimated").collect()
    assert len(out) == 40 and all(abs(r["y_pred"] - (100 + 2 * r["origin"] * int(r["series"][1:]) + 10 * math.sin(
        2 * math.pi * r["origin"] / 12))) < 1e-4 for r in out if r["origin"] >= 36)
    with pytest.raises(ValueError):
        HW.fit_holt_winters(hist, start="other")


def test_many_short_series_in_one_batch():
    """100,000 series of 8 periods through the batched recursion of one worker."""
    import numpy as np
    import pyarrow as pa
    n = 100_000
    y = np.arange(8 * n, dtype=float) % 97
    batch = pa.record_batch([pa.array([str(i) for i in range(n)]), pa.ListArray.from_arrays(pa.array(np.arange(0, 8 * n + 1, 8, dtype=np.int32)), pa.array(y))],
                            ["series", "y"])
    t = time.time()
    out = pa.Table.from_batches(list(HW._fitter(12, "first_seasons")(iter([batch]))))
    assert out.num_rows == n and time.time() - t < 120
