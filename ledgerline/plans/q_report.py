"""Registered queries: declarative data tests and report metrics."""

from __future__ import annotations

from ledgerline.operators import expectations as X
from ledgerline.operators import marts as M
from ledgerline.operators import metrics as R
from ledgerline.plans.oracle import money, with_chain
from ledgerline.plans.q_core import bitmaps_of, fact_by_month, mart_of, stg_of
from ledgerline.plans.registry import query

CTE_OF = {"stg_sales": "stg", "int_customer_sales": "int_cust", "int_product_sales": "int_prod",
          "dim_customer": "dim_cust", "dim_product": "dim_prod", "dim_date": "dim_date", "fact_sales": "fact",
          "sales_daily": "daily", "sales_monthly": "monthly"}
CHECKS = X.default_checks()


def _check_sql(i: int, c: X.Check) -> str:
    t, col = CTE_OF[c.model], c.column
    head = f"SELECT {i} AS check_id, '{c.model}' AS model, '{col}' AS column_name, '{c.kind}' AS test, "
    if c.kind == "not_null":
        body = f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)"
    elif c.kind == "unique":
        body = (f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1))")
    elif c.kind == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in c.values)
        body = f"(SELECT count(DISTINCT {col}) FROM {t} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
    else:
        pt, pc = CTE_OF[c.to[0]], c.to[1]
        body = (f"(SELECT count(*) FROM {t} WHERE {col} IS NOT NULL AND {col} NOT IN "
                f"(SELECT {pc} FROM {pt} WHERE {pc} IS NOT NULL))")
    return head + f"CAST({body} AS BIGINT) AS failures"


def _checks_sql(kinds: set[str]) -> str:
    parts = [_check_sql(i + 1, c) for i, c in enumerate(CHECKS) if c.kind in kinds]
    return with_chain("SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")")


def _run(spark, d, kinds):
    needed = [c for c in CHECKS if c.kind in kinds]
    names = {c.model for c in needed} | {c.to[0] for c in needed if c.to}
    return X.run_checks({n: mart_of(spark, d, n) for n in sorted(names)}, needed, ids={c: i + 1 for i, c in enumerate(CHECKS)})


@query("dt_not_null", _checks_sql({"not_null"}))
def dt_not_null(spark, d):
    return _run(spark, d, {"not_null"})


@query("dt_unique", _checks_sql({"unique"}))
def dt_unique(spark, d):
    return _run(spark, d, {"unique"})


@query("dt_accepted_values", _checks_sql({"accepted_values"}))
def dt_accepted_values(spark, d):
    return _run(spark, d, {"accepted_values"})


@query("dt_relationships", _checks_sql({"relationships"}))
def dt_relationships(spark, d):
    return _run(spark, d, {"relationships"})


@query("dt_summary", _checks_sql({"not_null", "unique", "accepted_values", "relationships"}))
def dt_summary(spark, d):
    return _run(spark, d, {"not_null", "unique", "accepted_values", "relationships"})


# ---------------------------------------------------------------- metrics
@query("kpi_scorecard", with_chain(f"""SELECT f.total_revenue, f.total_orders,
    round(f.total_revenue / nullif(f.total_orders, 0), 2) AS avg_order_value, f.total_customers,
    (SELECT arg_max(mom_growth_pct, month_start) FROM monthly) AS latest_mom_growth_pct
  FROM (SELECT {money('revenue')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT customer_key) AS total_customers FROM fact) f"""), ("total_revenue",))
def kpi_scorecard(spark, d):
    fact = M.fact_measures(stg_of(spark, d))
    return R.kpi_scorecard(fact, mart_of(spark, d, "sales_monthly"))


@query("kpi_new_customers", with_chain("""SELECT CAST(date_trunc('month', first_order_date) AS DATE) AS month_start,
    count(*) AS new_customers FROM int_cust GROUP BY 1"""))
def kpi_new_customers(spark, d):
    return R.new_customers_by_month(mart_of(spark, d, "int_customer_sales"))


@query("kpi_repeat_customers", with_chain("""SELECT count(*) AS total_customers,
    count(*) FILTER (WHERE is_repeat_customer) AS repeat_customers,
    round(count(*) FILTER (WHERE is_repeat_customer) / count(*), 4) AS repeat_rate FROM dim_cust"""))
def kpi_repeat_customers(spark, d):
    return R.repeat_customers(M.customer_rollup(stg_of(spark, d)).selectExpr("*", "order_count > 1 AS is_repeat_customer"))


@query("revenue_per_customer", with_chain(f"""SELECT r.total_revenue, c.total_customers,
    round(r.total_revenue / c.total_customers, 2) AS revenue_per_customer
  FROM (SELECT {money('revenue')} AS total_revenue FROM fact) r, (SELECT count(*) AS total_customers FROM dim_cust) c"""),
       ("total_revenue",))
def revenue_per_customer(spark, d):
    stg = stg_of(spark, d)
    return R.revenue_per_customer(M.fact_measures(stg), M.int_customer_sales(stg))


@query("revenue_by_category", with_chain(f"""SELECT category, {money('total_revenue')} AS total_revenue,
    count(*) AS products FROM dim_prod GROUP BY category"""), ("total_revenue",))
def revenue_by_category(spark, d):
    return R.revenue_by_category(M.int_product_sales(stg_of(spark, d)))


@query("revenue_by_region", with_chain(f"""SELECT region, {money('revenue')} AS total_revenue,
    count(DISTINCT order_id) AS total_orders FROM fact GROUP BY region"""), ("total_revenue",))
def revenue_by_region(spark, d):
    return R.revenue_by_region(M.fact_measures(stg_of(spark, d)))


@query("revenue_by_segment_weekday", with_chain(f"""SELECT c.segment, dd.day_of_week, dd.is_weekend,
    {money('f.revenue')} AS total_revenue, count(DISTINCT f.order_id) AS total_orders
  FROM fact f LEFT JOIN dim_cust c ON f.customer_key = c.customer_key
  LEFT JOIN dim_date dd ON f.date_key = dd.date_day GROUP BY ALL"""), ("total_revenue",))
def revenue_by_segment_weekday(spark, d):
    return R.revenue_by_segment_weekday(*(mart_of(spark, d, n) for n in ("fact_sales", "dim_customer", "dim_date")))


@query("top_products_units", with_chain(
    "SELECT * FROM dim_prod ORDER BY units_sold DESC NULLS LAST, product_id NULLS FIRST LIMIT 10"),
       ("total_revenue",))
def top_products_units(spark, d):
    return R.top_k(mart_of(spark, d, "dim_product"), "units_sold", "product_id", 10)


@query("top_products_revenue", with_chain(
    "SELECT * FROM dim_prod ORDER BY total_revenue DESC NULLS LAST, product_id NULLS FIRST LIMIT 10"),
       ("total_revenue",))
def top_products_revenue(spark, d):
    return R.top_k(mart_of(spark, d, "dim_product"), "total_revenue", "product_id", 10)


@query("top_categories", with_chain(f"""SELECT * FROM (SELECT category, {money('total_revenue')} AS total_revenue,
    count(*) AS products FROM dim_prod GROUP BY category)
  ORDER BY total_revenue DESC NULLS LAST, category NULLS FIRST LIMIT 5"""), ("total_revenue",))
def top_categories(spark, d):
    return R.top_k(R.revenue_by_category(M.int_product_sales(stg_of(spark, d))), "total_revenue", "category", 5)


@query("top_customers", with_chain(
    "SELECT * FROM dim_cust ORDER BY total_revenue DESC NULLS LAST, customer_id NULLS FIRST LIMIT 10"),
       ("total_revenue",))
def top_customers(spark, d):
    return R.top_k(mart_of(spark, d, "dim_customer"), "total_revenue", "customer_id", 10)


# Fixed report filter used by the registered query: two years, two regions,
# two categories and a product-name search term.
FILTER = dict(date_from="1996-01-01", date_to="1997-12-31", regions=["America", "Europe"],
              categories=["Economy", "Promo"], product_search="Bolt")


@query("filtered_sales", with_chain("""SELECT f.product_key, f.sale_id, f.order_id, f.date_key, f.customer_key,
    f.region, f.country, f.quantity, f.unit_price, f.discount, f.revenue, p.product_name, p.category
  FROM fact f JOIN dim_prod p ON f.product_key = p.product_key
  WHERE f.date_key BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND f.region IN ('America', 'Europe')
    AND p.category IN ('Economy', 'Promo') AND contains(lower(p.product_name), 'bolt')"""),
       ("unit_price", "discount", "revenue"))
def filtered_sales(spark, d):
    """FL1-FL4 on the fact in folders by month: the filtered date dimension prunes them."""
    return R.filtered_sales(fact_by_month(spark, d), mart_of(spark, d, "dim_product"), dates=mart_of(spark, d, "dim_date"), **FILTER)


@query("yoy_calendar", with_chain("""SELECT m.month_start, m.total_revenue, p.total_revenue AS prev_year_revenue,
    round(100.0 * (m.total_revenue - p.total_revenue) / nullif(p.total_revenue, 0), 2) + 0.0 AS yoy_calendar_pct
  FROM monthly m LEFT JOIN monthly p ON p.month_start = CAST(m.month_start - INTERVAL 12 MONTH AS DATE)"""),
       ("total_revenue", "prev_year_revenue"))
def yoy_calendar(spark, d):
    return R.yoy_calendar(mart_of(spark, d, "sales_monthly"))


@query("kpi_new_customers_period", with_chain("""SELECT count(*) AS new_customers FROM int_cust
    WHERE first_order_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""))
def kpi_new_customers_period(spark, d):
    """AG16 for one period (a calendar year of the data)."""
    return R.new_customers_between(mart_of(spark, d, "int_customer_sales"), "1996-01-01", "1996-12-31")


# Fixed report periods: a calendar year, and a span of days that overlaps it.
PERIODS = {"year 1996": ("1996-01-01", "1996-12-31"), "turn of the year": ("1996-12-15", "1997-01-20")}


@query("kpi_distinct_periods", with_chain(" UNION ALL ".join(f"""SELECT '{name}' AS period,
    count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_key) AS total_customers,
    (SELECT count(*) FROM int_cust WHERE customer_id IS NOT NULL AND first_order_date BETWEEN DATE '{a}' AND DATE '{b}')
      AS new_customers
  FROM fact WHERE date_key BETWEEN DATE '{a}' AND DATE '{b}'""" for name, (a, b) in PERIODS.items())))
def kpi_distinct_periods(spark, d):
    """AG13, AG15 and AG16 for two periods from the daily bitmaps; the fact is not read again."""
    return R.distinct_in_periods(bitmaps_of(spark, d), PERIODS)
