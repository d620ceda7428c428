"""Star-schema models: staging, intermediate rollups, dimensions, fact, daily
and monthly aggregates.

Plan notes:
* ``int_customer_sales`` and the segment/region lookup of ``dim_customer`` group
  the same rows by the same key, so they are one aggregation here.
* ``count(distinct order_id)`` per customer/day/month is planned by Spark as an
  aggregation on (key, order_id) first, so a hot customer or day is spread
  across reducers by order_id before the final per-key merge.
* Surrogate keys use the distributed ``surrogate_key`` (no single-task window).
* Money totals are accumulated in decimal (``money_sum``): reproducible
  regardless of partitioning.
* Joins of the fact to the dimensions are left to AQE: broadcast when the
  dimension turns out small at run time, a shuffle join (skew split on) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.keys import surrogate_key
from ledgerline.functions.text import money_sum
from ledgerline.schema import STG_COLUMNS


def stg_sales(clean: DataFrame) -> DataFrame:
    """MD1 / PJ1: typed projection. The quantity is rounded half to even, as the
    SQL cast of a double does; one that does not fit an int becomes null."""
    return clean.select(
        "order_id", F.col("order_date").cast("date").alias("order_date"), "customer_id", "customer_name",
        "product_id", "product_name", "category", "region", "country", "segment",
        F.rint(F.col("quantity")).try_cast("int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount").cast("double").alias("discount"),
        F.col("sales").cast("double").alias("sales"))


def customer_rollup(stg: DataFrame) -> DataFrame:
    """AG1 + AG3 in one aggregation; ``any_value`` is realised as ``min`` (a legal,
    deterministic choice)."""
    return stg.groupBy("customer_id").agg(
        F.min("customer_name").alias("customer_name"),
        F.count_distinct("order_id").alias("order_count"),
        money_sum("sales").alias("total_revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.min("segment").alias("segment"),
        F.min("region").alias("region"))


def int_customer_sales(stg: DataFrame) -> DataFrame:
    """MD2."""
    return customer_rollup(stg).select("customer_id", "customer_name", "order_count", "total_revenue",
                                       "first_order_date", "last_order_date")


def int_product_sales(stg: DataFrame) -> DataFrame:
    """MD3 / AG2."""
    return stg.groupBy("product_id").agg(
        F.min("product_name").alias("product_name"),
        F.min("category").alias("category"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        money_sum("sales").alias("total_revenue"))


def dim_customer(stg: DataFrame) -> DataFrame:
    """MD4: customer_key = row_number() over (order by customer_id)."""
    r = customer_rollup(stg).select(
        "customer_id", "customer_name", "segment", "region", "order_count", "total_revenue",
        (F.col("order_count") > 1).alias("is_repeat_customer"))
    keyed = surrogate_key(r, ["customer_id"], "customer_key")
    return keyed.select("customer_key", "customer_id", "customer_name", "segment", "region",
                        "order_count", "total_revenue", "is_repeat_customer")


def dim_product(stg: DataFrame) -> DataFrame:
    """MD5: product_key = row_number() over (order by product_id)."""
    keyed = surrogate_key(int_product_sales(stg), ["product_id"], "product_key")
    return keyed.select("product_key", "product_id", "product_name", "category", "units_sold", "total_revenue")


def dim_date(stg: DataFrame) -> DataFrame:
    """MD6: one row per day present in the data."""
    d = F.col("date_day")
    return (stg.select(F.col("order_date").alias("date_day")).distinct()
            .select("date_day",
                    F.dayofmonth(d).alias("day"), F.month(d).alias("month"),
                    F.date_format(d, "MMMM").alias("month_name"),
                    F.quarter(d).alias("quarter"), F.year(d).alias("year"),
                    F.weekofyear(d).alias("week"),
                    F.date_format(d, "EEEE").alias("day_of_week"),
                    F.dayofweek(d).isin(1, 7).alias("is_weekend")))


# Fixed tie-break: order_id first, then every staging column, so sale_id is
# deterministic even though order_id repeats.
FACT_ORDER = STG_COLUMNS
FACT_COLUMNS = ["order_id", "order_date", "customer_id", "product_id", "region", "country", "quantity",
                "unit_price", "discount", "sales"]


def fact_sales(stg: DataFrame, dim_cust: DataFrame | None = None, dim_prod: DataFrame | None = None) -> DataFrame:
    """MD7: order-line fact with sale_id and the dimensions' surrogate keys."""
    dim_cust = dim_cust if dim_cust is not None else dim_customer(stg)
    dim_prod = dim_prod if dim_prod is not None else dim_product(stg)
    keyed = surrogate_key(stg, FACT_ORDER, "sale_id", computed=False, keep=FACT_COLUMNS)
    cust = dim_cust.select("customer_key", "customer_id")
    prod = dim_prod.select("product_key", "product_id")
    f = keyed.join(cust, "customer_id", "left").join(prod, "product_id", "left")
    return f.select("sale_id", "order_id", F.col("order_date").alias("date_key"), "customer_key", "product_key",
                    "region", "country", "quantity", "unit_price", "discount", F.col("sales").alias("revenue"))


def fact_measures(stg: DataFrame) -> DataFrame:
    """The fact's measure columns without the surrogate keys: what the daily and
    monthly aggregates read. Joining the dimensions only to drop their keys
    again would cost two shuffles and three checkpoints for nothing."""
    return stg.select("order_id", F.col("order_date").alias("date_key"), "customer_id", "product_id", "region",
                      "country", "quantity", F.col("sales").alias("revenue"))


def sales_daily(fact: DataFrame) -> DataFrame:
    """MD8 / AG5: per day orders, units, revenue and average order value."""
    g = fact.groupBy("date_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("quantity").cast("bigint").alias("total_units"),
        money_sum("revenue").alias("total_revenue"))
    # round half away on the scaled double, as SQL round(x, 2) of a double does
    average = F.col("total_revenue") / F.nullif(F.col("total_orders"), F.lit(0))
    return g.select(F.col("date_key").alias("order_date"), "total_orders", "total_units", "total_revenue",
                    (F.round(average * 100) / 100).alias("avg_order_value"))


def _growth(cur, prev) -> F.Column:
    return F.round(F.lit(100.0) * (cur - prev) / F.when(prev != 0, prev), 2)


def sales_monthly(fact: DataFrame) -> DataFrame:
    """MD9: monthly orders and revenue with month-over-month and row-offset
    year-over-year growth (the months are few, so the unpartitioned lag window
    runs over a tiny table)."""
    m = fact.groupBy(F.trunc("date_key", "month").alias("month_start")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("revenue").alias("total_revenue"))
    w = Window.orderBy("month_start")
    return m.select("month_start", "total_orders", "total_revenue",
                    _growth(F.col("total_revenue"), F.lag("total_revenue", 1).over(w)).alias("mom_growth_pct"),
                    _growth(F.col("total_revenue"), F.lag("total_revenue", 12).over(w)).alias("yoy_growth_pct"))


def build_marts(stg: DataFrame) -> dict[str, DataFrame]:
    """MAT3: the model DAG stg -> int -> dim -> fact -> daily/monthly. The three
    surrogate keys are built (and staged) here; the rest is lazy."""
    dc, dp = dim_customer(stg), dim_product(stg)
    fact = fact_sales(stg, dc, dp)
    return {
        "stg_sales": stg,
        "int_customer_sales": int_customer_sales(stg),
        "int_product_sales": int_product_sales(stg),
        "dim_customer": dc,
        "dim_product": dp,
        "dim_date": dim_date(stg),
        "fact_sales": fact,
        "sales_daily": sales_daily(fact_measures(stg)),
        "sales_monthly": sales_monthly(fact_measures(stg)),
    }


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """MAT1: expose models as session temp views (view materialization), so SQL
    users can query ``stg_sales``, ``fact_sales``... with ``spark.sql``."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
