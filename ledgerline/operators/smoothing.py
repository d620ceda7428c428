"""Additive Holt-Winters exponential smoothing, many series at a time.

A series is one row (its values in order, bounded by the calendar, not by the
number of order lines). Rows come in Arrow batches; all series of one length
are fitted together: the recursion runs over time on arrays of series x grid
points, so a period costs a few vector operations for a whole chunk of series.
Forecasts are then a plain join of the fitted state with the forecast steps.

State: level l, trend b and m seasonal terms; a series shorter than two seasons
has no seasonal terms. Two ways to start it:

``first_seasons``: from the first two seasons (means m1, m2; b0 = (m2 - m1)/m;
l0 = m1 + (m - 1)/2 * b0; s0[i] = y[i] - m1 - (i - (m - 1)/2) * b0), running
after the first season (l0 = y1, b0 = y2 - y1 without seasons). The weights are
those of least squared one-step error on a grid of 0.1, then on one of 0.02
around the winner.

``estimated``: start values and weights minimise the squared one-step errors of
all periods jointly. For fixed weights the errors are linear in the start
values (seasonal terms that sum to 0), with a matrix that depends on the
weights and the length alone: one orthogonal factor per grid point serves all
series of a length, and gives each series its least squared error and start
values. So only the weights are searched: on a grid of 0.2, then on one of 0.05
around the winner.

Ties go to the smaller alpha, beta, gamma.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import ship_package

MODEL_NAME = "Exponential Smoothing"
# Fixed search grids: coarse 0.1..0.9 per parameter, then +/- 4 steps of 0.02.
COARSE = np.round(np.arange(1, 10) * 0.1, 2)
FINE_STEP, FINE_SPAN = 0.02, 4
# The same for estimated start values: coarse, then +/- 2 steps of 0.05.
WIDE = np.round(np.arange(1, 10, 2) * 0.1, 2)
NEAR_STEP, NEAR_SPAN = 0.05, 2
STARTS = ("first_seasons", "estimated")
#: Numbers of one state array at a time.
CELLS = 1 << 19

FIT_SCHEMA = ("series string, seasonal boolean, alpha double, beta double, gamma double, "
              "level double, trend double, season array<double>, sse double, n int")


def _start(y: np.ndarray, m: int):
    """(seasonal, l0, b0, s0, what the recursion runs over) of series (rows) of one length."""
    n = y.shape[-1]
    if n >= 2 * m:
        mid = (m - 1) / 2.0
        m1, m2 = y[..., :m].mean(-1), y[..., m:2 * m].mean(-1)
        b0 = (m2 - m1) / m
        return True, m1 + mid * b0, b0, y[..., :m] - m1[..., None] - (np.arange(m) - mid) * b0[..., None], y[..., m:]
    b0 = (y[..., 1] - y[..., 0]) if n > 1 else np.zeros(y.shape[:-1])
    return False, y[..., 0], b0, np.zeros((*y.shape[:-1], m)), y[..., 1:]


def _recurse(tail, l0, b0, s0, a, b, g, seasonal: bool, m: int, errors: bool = False):
    """Run series x grid points at once; returns (l, b, s, squared error), and the errors of each period if asked for.
    ``tail`` (series, periods), ``l0``/``b0`` (series,), ``s0`` (series, m); weights (series or 1, grid points)."""
    shape = np.broadcast_shapes((len(l0), 1), a.shape)
    lv, tr = (np.broadcast_to(np.asarray(x, float)[:, None], shape) for x in (l0, b0))
    s = [np.broadcast_to(np.asarray(s0[:, j], float)[:, None], shape) for j in range(m)]
    sse, each = np.zeros(shape), []
    for t in range(tail.shape[1]):
        y, j = tail[:, t, None], t % m
        sc = s[j] if seasonal else 0.0
        err = y - (lv + tr + sc)
        sse = sse + err * err
        if errors:
            each.append(err)
        l_new = a * (y - sc) + (1 - a) * (lv + tr)
        tr_new = b * (l_new - lv) + (1 - b) * tr
        if seasonal:
            s[j] = g * (y - lv - tr) + (1 - g) * sc
        lv, tr = l_new, tr_new
    out = lv, tr, np.stack(s, axis=-1), sse
    return (*out, np.stack(each, axis=-1)) if errors else out


def _grid(av, bv, gv):
    A, B, G = np.meshgrid(av, bv, gv, indexing="ij")
    return A.ravel(), B.ravel(), G.ravel()


def _around(v, step: float = FINE_STEP, span: int = FINE_SPAN, least: float = 0.01):
    return np.unique(np.clip(np.round(v + np.arange(-span, span + 1) * step, 2), least, 1 - least))


def _state(y, m, seasonal, found, weights, end):
    """Result columns of fitted series: weights (a, b, g), final level, trend, season terms, squared error."""
    lv, tr, s, sse = found
    season = np.roll(s[:, 0], -(end % m), axis=1) if seasonal else np.zeros((len(y), m))
    return *weights, lv[:, 0], tr[:, 0], season, sse[:, 0]


def fit_first_seasons(y: np.ndarray, m: int):
    """Series (rows) of one length, started from their first two seasons."""
    seasonal, l0, b0, s0, tail = _start(y, m)
    none = np.array([0.0])
    grid = [x[None, :] for x in _grid(COARSE, COARSE, COARSE if seasonal else none)]
    best = np.argmin(_recurse(tail, l0, b0, s0, *grid, seasonal, m)[3], axis=1)
    fine = [_grid(*[_around(x[0, k]) for x in grid[:2]], _around(grid[2][0, k]) if seasonal else none) for k in best]
    fine = [np.stack(x) for x in zip(*fine)]
    best = np.argmin(_recurse(tail, l0, b0, s0, *fine, seasonal, m)[3], axis=1)
    a, b, g = (x[np.arange(len(y)), best] for x in fine)
    found = _recurse(tail, l0, b0, s0, a[:, None], b[:, None], g[:, None], seasonal, m)
    return seasonal, *_state(y, m, seasonal, found, (a, b, g), tail.shape[1])


def _basis(m: int, seasonal: bool) -> np.ndarray:
    """The start states (l, b, s_0 ..) whose sums are all starts; seasonal terms sum to 0."""
    out = np.zeros((2 + (m - 1) * seasonal, 2 + m))
    out[0, 0] = out[1, 1] = 1
    if seasonal:
        out[2:, 2: m + 1] = np.eye(m - 1)
        out[2:, m + 1] = -1
    return out


def _least_squares(y: np.ndarray, weights, seasonal: bool, m: int):
    """(squared error of series x grid points with their best start, projections, triangular factors)."""
    basis = _basis(m, seasonal)
    zero = np.zeros((len(basis), y.shape[1]))
    # errors of a zero series from each start: what that start adds to the prediction errors of any series
    column = _recurse(zero, basis[:, 0], basis[:, 1], basis[:, 2:], *weights, seasonal, m, errors=True)[4]
    q, r = np.linalg.qr(np.moveaxis(column, 0, -1))  # (grid points, periods, starts)
    none = np.zeros(len(y))
    err = _recurse(y, none, none, np.zeros((len(y), m)), *weights, seasonal, m, errors=True)[4]
    part = np.einsum("gnp,sgn->sgp", q, err, optimize=True)
    return np.maximum((err * err).sum(-1) - (part * part).sum(-1), 0), part, r


def fit_estimated(y: np.ndarray, m: int):
    """Series (rows) of one length; start values and weights of least squared error."""
    if y.shape[1] < 2:
        return fit_first_seasons(y, m)
    seasonal = y.shape[1] >= 2 * m
    none = np.array([0.0])
    scale = np.maximum(np.abs(y).mean(1), 1e-300)  # rounding is relative to the series' size
    z = y / scale[:, None]
    grid = [x[None, :] for x in _grid(WIDE, WIDE, WIDE if seasonal else none)]
    first = np.argmin(np.round(_least_squares(z, grid, seasonal, m)[0], 12), axis=1)
    out = [np.zeros(len(y)) for _ in range(5)] + [np.zeros((len(y), m)), np.zeros(len(y))]
    near = lambda v: _around(v, NEAR_STEP, NEAR_SPAN, NEAR_STEP)
    for k in np.unique(first):  # series with one winner share the finer grid
        its = np.flatnonzero(first == k)
        fine = [x[None, :] for x in _grid(near(grid[0][0, k]), near(grid[1][0, k]), near(grid[2][0, k]) if seasonal else none)]
        sse, part, r = _least_squares(z[its], fine, seasonal, m)
        best = np.argmin(np.round(sse, 12), axis=1)
        start = -np.linalg.solve(r[best], part[np.arange(len(its)), best][..., None])[..., 0] @ _basis(m, seasonal)
        start *= scale[its, None]
        a, b, g = (x[0, best] for x in fine)
        found = _recurse(y[its], start[:, 0], start[:, 1], start[:, 2:], a[:, None], b[:, None], g[:, None], seasonal, m)
        for to, x in zip(out, _state(y[its], m, seasonal, found, (a, b, g), y.shape[1])):
            to[its] = x
    return seasonal, *out


def _fitter(m: int, start: str) -> Callable:
    """(series, y) -> FIT_SCHEMA; the series of one length go together, in chunks."""
    fit, grid = (fit_first_seasons, len(COARSE) ** 3) if start == STARTS[0] else (fit_estimated, len(WIDE) ** 3 * m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            off = np.asarray(lists.offsets)
            flat, size = lists.values.to_numpy(zero_copy_only=False).astype(float), np.diff(off)
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                step = max(1, CELLS // (grid * m))
                for i in range(0, len(rows), step):
                    its = rows[i: i + step]
                    y = flat[off[its][:, None] + np.arange(n)]
                    seasonal, a, b, g, lv, tr, season, sse = fit(y, m)
                    k = len(its)
                    yield pa.record_batch([
                        batch.column(0).take(pa.array(its)), pa.array([seasonal] * k), pa.array(a), pa.array(b),
                        pa.array(g) if seasonal else pa.nulls(k, pa.float64()), pa.array(lv), pa.array(tr),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, k * m + 1, m, dtype=np.int32)), pa.array(season.ravel())),
                        pa.array(sse), pa.array(np.full(k, n, np.int32))],
                        ["series", "seasonal", "alpha", "beta", "gamma", "level", "trend", "season", "sse", "n"])
    return run


def fit_holt_winters(history: DataFrame, m: int = 12, start: str = STARTS[0]) -> DataFrame:
    """(series, idx, y) -> one fitted row per series (FIT_SCHEMA)."""
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}, not {start!r}")
    spark = history.sparkSession
    ship_package(spark)
    # a fixed number of partitions: the fit is heavy, though its rows are few
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (history.select("series", "idx", F.col("y").cast("double").alias("y")).repartition(parts, "series").groupBy("series")
            .agg(F.array_sort(F.collect_list(F.struct("idx", "y"))).alias("own")))
    return rows.select("series", F.transform("own", lambda x: x["y"]).alias("y")).mapInArrow(_fitter(m, start), FIT_SCHEMA)


def holt_winters_forecasts(history: DataFrame, targets: DataFrame, m: int = 12, start: str = STARTS[0]) -> DataFrame:
    """Forecast rows (targets + model, y_pred) from a fit on the history up to each origin."""
    origin = targets.select("series", "origin").distinct()
    h = history.join(origin, "series").where(F.col("idx") <= F.col("origin")).select("series", "idx", "y")
    fitted = fit_holt_winters(h, m, start)
    t = targets.join(fitted, "series")
    season_term = F.element_at("season", (F.pmod(F.col("step") - 1, F.lit(m)) + 1).cast("int"))
    y_pred = F.col("level") + F.col("step") * F.col("trend") + season_term
    return t.select(*targets.columns, F.lit(MODEL_NAME).alias("model"), y_pred.alias("y_pred"))


def fitted_parameters(history: DataFrame, m: int = 12, start: str = STARTS[0]) -> DataFrame:
    """(series, seasonal, alpha, beta, gamma, level, trend, sse) fitted on the whole history."""
    return fit_holt_winters(history, m, start).select("series", "seasonal", "alpha", "beta", "gamma", "level", "trend",
                                               "sse", "n")
