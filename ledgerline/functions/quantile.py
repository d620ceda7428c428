"""Exact grouped quantiles that stay distributed when one group is huge.

``percentile`` keeps one value->count map per group and merges it in a single
task, so a group holding a third of the rows (one category, one product)
lands on one executor with all its distinct values. Here the work is split:

1. the (group, value, count) histogram is aggregated once, map-side first (a
   hot group is spread over many reducers by value), and written;
2. while some group still has more than ``WINDOW_ROWS`` values, the values of
   each group are cut at approximate quantiles into ``BINS`` bins, the rows of
   each bin are counted, and only the bins that hold the two order statistics
   go on (their values are few, whatever the group's size);
3. a running count over what is left finds the exact order statistics.

The bins are counted, not estimated: borders that lie badly only make a further
turn necessary, so the result always equals ``percentile``/``quantile_cont``
with linear interpolation between the order statistics at floor and ceil of
(n-1)*q. A group whose keys hold a null gets no quantile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.materialize import materialize

#: Values of a group that one window may order, and the bins of a turn.
WINDOW_ROWS, BINS = 1_000_000, 64


def histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, _v, _c): how often each value occurs in a group, nulls included, written."""
    return materialize(df.groupBy(*keys, F.col(value).cast("double").alias("_v"))
                       .agg(F.count(F.lit(1)).alias("_c")), "histogram")


def _narrowed(live: DataFrame, keys: list[str], accuracy: int) -> DataFrame:
    """The values in the bins that hold the order statistics of their group."""
    splits = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    borders = live.groupBy(*keys).agg(F.percentile_approx("_v", splits, accuracy).alias("_borders"))
    at = F.size(F.filter("_borders", lambda b: b < F.col("_v")))
    binned = live.join(borders, keys).withColumn("_bin", at).drop("_borders")
    bins = binned.groupBy(*keys, "_bin").agg(
        F.sum("_c").alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        F.first("_base").alias("_base"), F.first("_pos").alias("_pos"))
    upto = F.col("_base") + F.sum("_rows").over(
        Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bins = bins.withColumn("_upto", upto)
    held = bins.where((F.col("_upto") > F.floor("_pos")) & (F.col("_upto") - F.col("_rows") <= F.ceil("_pos")))
    held = held.groupBy(*keys).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
                                   F.min(F.col("_upto") - F.col("_rows")).alias("_below"))
    kept = live.join(held, keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    return kept.select(*keys, "_v", "_c", "_pos", F.col("_below").alias("_base"))


def quantile_of_histogram(hist: DataFrame, keys: list[str], q: float, out: str = "quantile",
                          accuracy: int = 10000, window_rows: int | None = None) -> DataFrame:
    """The exact ``q`` quantile of each group of a written ``histogram`` (null values left out)."""
    limit = WINDOW_ROWS if window_rows is None else window_rows
    hist = hist.where(F.col("_v").isNotNull())
    sizes = hist.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_values"))
    largest = sizes.agg(F.max("_values")).first()[0] or 0
    live = hist.join(sizes.select(*keys, ((F.col("_n") - 1) * F.lit(q)).alias("_pos")), keys) \
        .withColumn("_base", F.lit(0).cast("bigint"))
    while largest > limit:
        live = materialize(_narrowed(live, keys, accuracy), "quantile-bins")
        before, largest = largest, live.groupBy(*keys).count().agg(F.max("count")).first()[0]
        if largest >= before:   # a limit below what two neighbouring bins hold
            break
    w = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = live.withColumn("_cum", F.col("_base") + F.sum("_c").over(w))
    low, high = F.floor("_pos"), F.ceil("_pos")
    picked = counted.groupBy(*keys).agg(
        F.first("_pos").alias("_pos"),
        F.min(F.when(F.col("_cum") > low, F.col("_v"))).alias("_vf"),
        F.min(F.when(F.col("_cum") > high, F.col("_v"))).alias("_vc"))
    # same interpolation as Spark's percentile: (c-pos)*lo + (pos-f)*hi
    val = F.when(low == high, F.col("_vf")).otherwise(
        (high - F.col("_pos")) * F.col("_vf") + (F.col("_pos") - low) * F.col("_vc"))
    return picked.select(*keys, val.alias(out))


def exact_group_quantile(df: DataFrame, keys: list[str], value: str, q: float,
                         out: str = "quantile", accuracy: int = 10000,
                         method: str = "bracketed") -> DataFrame:
    """One row per group of ``keys``: the exact ``q`` quantile of non-null ``value``.

    ``method="simple"`` uses Spark's ``percentile`` aggregate directly (one
    shuffle, fine for small groups); ``"bracketed"`` is the skew-safe plan above.
    """
    if method == "simple":
        base = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
        return base.groupBy(*keys).agg(F.percentile("_v", q).alias(out))
    return quantile_of_histogram(histogram(df, keys, value), keys, q, out, accuracy)
