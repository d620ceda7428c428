"""Report metrics and chart data over the marts: scorecard KPIs, customer
counts, revenue by category/region/segment x weekday, top-k lists, the
dashboard filters and calendar year-over-year growth.

Top-k lists are ``orderBy(...).limit(k)`` with an id tie-break, which Spark
plans as a per-partition top-k followed by one small merge (no global sort).
Scalar KPIs are one-row aggregates combined through scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import surrogate_key
from ledgerline.functions.materialize import materialize
from ledgerline.functions.text import money_sum

#: The month of a row, by which a partitioned fact has its folders.
MONTH = "order_month"


def kpi_scorecard(fact: DataFrame, monthly: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """AG21: total revenue, orders, average order value, customers, latest MoM growth.

    ``fact`` needs order_id, customer_id (or customer_key) and revenue; the
    measures-only fact (no surrogate keys) is enough. ``approx=True`` counts
    distinct orders/customers with HyperLogLog++ (``approx_count_distinct``,
    relative error ``rsd``): one small sketch per task instead of a shuffle of
    every distinct id."""
    cust = "customer_id" if "customer_id" in fact.columns else "customer_key"
    distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    f = fact.agg(money_sum("revenue").alias("total_revenue"),
                 distinct("order_id").alias("total_orders"),
                 distinct(cust).alias("total_customers"))
    latest = monthly.agg(F.max_by("mom_growth_pct", "month_start")).scalar()
    aov = F.round(F.col("total_revenue") / F.when(F.col("total_orders") != 0, F.col("total_orders")), 2)
    return f.select("total_revenue", "total_orders", aov.alias("avg_order_value"),
                    "total_customers", latest.alias("latest_mom_growth_pct"))


def new_customers_by_month(int_customers: DataFrame) -> DataFrame:
    """AG16: customers whose first order falls in each month."""
    return (int_customers.groupBy(F.trunc("first_order_date", "month").alias("month_start"))
            .agg(F.count(F.lit(1)).alias("new_customers")))


def new_customers_between(int_customers: DataFrame, start: str, end: str) -> DataFrame:
    """AG16 for a period [start, end]."""
    return (int_customers.where(F.col("first_order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .agg(F.count(F.lit(1)).alias("new_customers")))


def repeat_customers(dim_cust: DataFrame) -> DataFrame:
    """AG15 + AG17: total and repeat customers and their share."""
    return dim_cust.agg(F.count(F.lit(1)).alias("total_customers"),
                        F.count_if(F.col("is_repeat_customer")).alias("repeat_customers")) \
        .withColumn("repeat_rate", F.round(F.col("repeat_customers") / F.col("total_customers"), 4))


def revenue_per_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """AG18: total revenue / total customers (``customers``: one row per customer,
    e.g. dim_customer or int_customer_sales)."""
    cust = customers.agg(F.count(F.lit(1))).scalar()
    rev = fact.agg(money_sum("revenue").alias("total_revenue"))
    return rev.withColumn("total_customers", cust).withColumn(
        "revenue_per_customer", F.round(F.col("total_revenue") / F.col("total_customers"), 2))


def revenue_by_category(dim_prod: DataFrame) -> DataFrame:
    """AG19: category revenue from the product dimension."""
    return dim_prod.groupBy("category").agg(money_sum("total_revenue").alias("total_revenue"),
                                            F.count(F.lit(1)).alias("products"))


def revenue_by_region(fact: DataFrame) -> DataFrame:
    """AG20."""
    return fact.groupBy("region").agg(money_sum("revenue").alias("total_revenue"),
                                      F.count_distinct("order_id").alias("total_orders"))


def revenue_by_segment_weekday(fact: DataFrame, dim_cust: DataFrame, dim_dt: DataFrame) -> DataFrame:
    """JN8: a star query over the surrogate/date keys."""
    j = (fact.select("customer_key", "date_key", "order_id", "revenue")
         .join(dim_cust.select("customer_key", "segment"), "customer_key", "left")
         .join(dim_dt.select(F.col("date_day").alias("date_key"), "day_of_week", "is_weekend"), "date_key", "left"))
    return j.groupBy("segment", "day_of_week", "is_weekend").agg(
        money_sum("revenue").alias("total_revenue"), F.count_distinct("order_id").alias("total_orders"))


def top_k(df: DataFrame, measure: str, key: str, k: int = 10) -> DataFrame:
    """ST2-ST5: the k largest by ``measure``, ties broken by ``key``."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc_nulls_first()).limit(k)


def filtered_sales(fact: DataFrame, dim_prod: DataFrame, date_from: str | None = None, date_to: str | None = None,
                   regions: list[str] | None = None, categories: list[str] | None = None,
                   product_search: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """FL1-FL4: the dashboard filters (date range, region set, category set,
    case-insensitive product text search) applied to the fact with its product.

    With ``dates`` (dim_date) and a fact that is partitioned by its month
    (``MONTH``), the date dimension is filtered first and its months prune the
    fact's folders at run time, whatever the filter of the dates is."""
    f = fact
    day = lambda c: ([F.col(c) >= F.lit(date_from).cast("date")] if date_from else []) + (
        [F.col(c) <= F.lit(date_to).cast("date")] if date_to else [])
    for cond in day("date_key"):
        f = f.where(cond)
    if dates is not None and MONTH in fact.columns and day("date_day"):
        days = dates
        for cond in day("date_day"):
            days = days.where(cond)
        # as many rows as the calendar has months
        months = days.select(F.trunc("date_day", "month").alias("_month")).distinct()
        f = f.join(F.broadcast(months), F.col(MONTH) == F.col("_month"), "left_semi")
    f = f.drop(MONTH)
    if regions:
        f = f.where(F.col("region").isin(*regions))
    p = dim_prod.select("product_key", "product_name", "category")
    if categories:
        p = p.where(F.col("category").isin(*categories))
    if product_search:
        p = p.where(F.lower("product_name").contains(product_search.lower()))
    return f.join(p, "product_key", "inner")


def yoy_calendar(monthly: DataFrame) -> DataFrame:
    """WN6: growth against the same calendar month one year earlier (a self-join on
    add_months, so a missing month yields null instead of a wrong row offset)."""
    prev = monthly.select(F.add_months("month_start", 12).alias("month_start"),
                          F.col("total_revenue").alias("prev_year_revenue"))
    j = monthly.select("month_start", "total_revenue").join(prev, "month_start", "left")
    g = F.round(F.lit(100.0) * (F.col("total_revenue") - F.col("prev_year_revenue"))
                / F.when(F.col("prev_year_revenue") != 0, F.col("prev_year_revenue")), 2)
    return j.select("month_start", "total_revenue", "prev_year_revenue", g.alias("yoy_calendar_pct"))


def daily_bitmaps(fact: DataFrame) -> DataFrame:
    """AG13, AG15, AG16 for any period: exact distinct counts that merge.

    One row per (date_key, kind, bucket): ``bits`` marks the customers
    (``customer_key``) or orders of that day whose number falls in the bucket.
    Orders are numbered by their first day (and least ``sale_id``), so a day's
    orders fill few buckets; they are found on their distinct days, so a hot
    order is pre-aggregated before its rows meet. The distinct numbers of a
    bucket, at most as many as it has bits, come together before its bits are
    made: none travel. Rows without a day, and null customers or orders, are
    not counted, as ``count(distinct)`` does."""
    days = (fact.where(F.col("date_key").isNotNull() & F.col("order_id").isNotNull())
            .groupBy("order_id", "date_key").agg(F.min("sale_id").alias("_first")))
    days = materialize(days, "order-days")
    first = days.groupBy("order_id").agg(F.min("date_key").alias("_day"), F.min("_first").alias("_first"))
    numbers = surrogate_key(first, ["_day", "_first"], "_number").select("order_id", "_number")
    orders = days.join(numbers, "order_id").select("date_key", F.lit("order").alias("kind"), "_number")
    customers = (fact.where(F.col("date_key").isNotNull() & F.col("customer_key").isNotNull())
                 .select("date_key", F.lit("customer").alias("kind"), F.col("customer_key").alias("_number")).distinct())
    by = ["date_key", "kind", "bucket"]
    numbered = orders.unionByName(customers).withColumn("bucket", F.bitmap_bucket_number("_number"))
    n = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return numbered.repartition(n, *by).groupBy(*by).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"))


def distinct_in_periods(bitmaps: DataFrame, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """Orders, customers and new customers (none of their orders before the
    period) of each period [from, to], from ``daily_bitmaps`` alone: one pass,
    whatever the number of periods; the fact is not read. Periods may overlap;
    one without orders has zeros. Days after the last period are not read."""
    between = lambda a, b: F.col("date_key").between(F.lit(a).cast("date"), F.lit(b).cast("date"))
    merged, counts = [], []
    for i, (period, (start, end)) in enumerate(periods.items()):
        upto = F.col("date_key") <= F.lit(end).cast("date")
        before = F.col("date_key") < F.lit(start).cast("date")
        merged += [F.bitmap_or_agg(F.when(cond, F.col("bits"))).alias(f"{name}{i}")
                   for name, cond in (("in", between(start, end)), ("upto", upto), ("before", before))]
        total = lambda kind, col: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count(col))), F.lit(0))
        counts.append(F.struct(
            F.lit(period).alias("period"),
            total("order", f"in{i}").alias("total_orders"), total("customer", f"in{i}").alias("total_customers"),
            (total("customer", f"upto{i}") - total("customer", f"before{i}")).alias("new_customers")))
    last = max(end for _, end in periods.values())
    per_bucket = bitmaps.where(F.col("date_key") <= F.lit(last).cast("date")).groupBy("kind", "bucket").agg(*merged)
    return per_bucket.agg(F.array(*counts).alias("p")).select(F.inline("p"))
