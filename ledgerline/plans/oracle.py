"""Independent DuckDB SQL definitions of every checked query.

These are written straight from the rule descriptions, not generated from the
Spark code, so the driver's side-by-side run compares two implementations.
Both start from the same raw view text (``sources.fixture``).
"""

from __future__ import annotations

from ledgerline.sources.fixture import raw_view_sql_duckdb

RAW14 = ("order_id, order_date, customer_id, customer_name, product_id, product_name, category, "
         "quantity, unit_price, sales, discount, region, country, segment")
STG14 = ("order_id, order_date, customer_id, customer_name, product_id, product_name, category, "
         "region, country, segment, quantity, unit_price, discount, sales")


_SPACE = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '\A{_SPACE}+|{_SPACE}+\z', '', 'g')"


def title_sql(x: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\p{{L}}+|[^\p{{L}}]+)', 1), "
            r"lambda r: upper(substr(r, 1, 1)) || substr(r, 2)), '')")


def num_sql(x: str) -> str:
    s = strip_sql(x)
    return (rf"CASE WHEN regexp_full_match({s}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') "
            rf"THEN TRY_CAST({s} AS DOUBLE) END")


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


DISC = "least(greatest(coalesce(discount, 0.0), 0.0), 0.9)"

CTES = [
    ("raw", raw_view_sql_duckdb()),
    ("dedup", f"SELECT DISTINCT {RAW14} FROM raw"),
    ("typed", f"""SELECT order_id,
        CASE WHEN regexp_full_match(trim(order_date), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
             THEN CAST(try_strptime(trim(order_date), '%Y-%m-%d') AS DATE) END AS order_date,
        customer_id, customer_name, product_id, product_name, category,
        {num_sql('quantity')} AS quantity, {num_sql('unit_price')} AS unit_price,
        {num_sql('sales')} AS sales, {num_sql('discount')} AS discount, region, country, segment
      FROM dedup"""),
    ("kept", "SELECT * FROM typed WHERE order_date IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0"),
    ("med", "SELECT product_id, quantile_cont(unit_price, 0.5) AS med FROM kept "
            "WHERE product_id IS NOT NULL AND unit_price IS NOT NULL GROUP BY product_id"),
    ("priced", """SELECT k.order_id, k.order_date, k.customer_id, k.customer_name, k.product_id, k.product_name,
        k.category, k.quantity,
        CASE WHEN k.unit_price IS NULL OR k.unit_price < 0 THEN m.med ELSE k.unit_price END AS unit_price,
        k.sales, k.discount, k.region, k.country, k.segment
      FROM kept k LEFT JOIN med m ON k.product_id = m.product_id"""),
    ("priced_ok", "SELECT * FROM priced WHERE unit_price >= 0"),
    ("discounted", f"SELECT * REPLACE ({DISC} AS discount) FROM priced_ok"),
    ("texted", f"""SELECT * REPLACE (
        {title_sql(strip_sql("coalesce(category, 'Unknown')"))} AS category,
        {title_sql(strip_sql("coalesce(region, 'Unknown')"))} AS region,
        {title_sql(strip_sql('customer_name'))} AS customer_name,
        {strip_sql('product_name')} AS product_name,
        {title_sql(strip_sql('country'))} AS country,
        {title_sql(strip_sql("coalesce(segment, 'Consumer')"))} AS segment)
      FROM discounted"""),
    ("resold", "SELECT * REPLACE (round_even(quantity * unit_price * (1 - discount) * 100, 0) / 100 AS sales) FROM texted"),
    ("caps", "SELECT category, quantile_cont(sales, 0.99) AS cap FROM resold GROUP BY category"),
    ("clean", """SELECT r.order_id, r.order_date, r.customer_id, r.customer_name, r.product_id, r.product_name,
        r.category, r.quantity, r.unit_price, least(r.sales, c.cap) AS sales, r.discount, r.region, r.country,
        r.segment
      FROM resold r LEFT JOIN caps c ON r.category = c.category"""),
    ("stg", """SELECT order_id, CAST(order_date AS DATE) AS order_date, customer_id, customer_name, product_id,
        product_name, category, region, country, segment, TRY_CAST(quantity AS INTEGER) AS quantity,
        CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount, CAST(sales AS DOUBLE) AS sales
      FROM clean"""),
    ("int_cust", f"""SELECT customer_id, min(customer_name) AS customer_name, count(DISTINCT order_id) AS order_count,
        {money('sales')} AS total_revenue, min(order_date) AS first_order_date, max(order_date) AS last_order_date
      FROM stg GROUP BY customer_id"""),
    ("int_prod", f"""SELECT product_id, min(product_name) AS product_name, min(category) AS category,
        CAST(sum(quantity) AS BIGINT) AS units_sold, {money('sales')} AS total_revenue
      FROM stg GROUP BY product_id"""),
    ("cust_attr", "SELECT customer_id, min(segment) AS segment, min(region) AS region FROM stg GROUP BY customer_id"),
    ("dim_cust", """SELECT CAST(row_number() OVER (ORDER BY c.customer_id NULLS FIRST) AS BIGINT) AS customer_key,
        c.customer_id, c.customer_name, a.segment, a.region, c.order_count, c.total_revenue,
        c.order_count > 1 AS is_repeat_customer
      FROM int_cust c LEFT JOIN cust_attr a ON c.customer_id = a.customer_id"""),
    ("dim_prod", """SELECT CAST(row_number() OVER (ORDER BY product_id NULLS FIRST) AS BIGINT) AS product_key,
        product_id, product_name, category, units_sold, total_revenue FROM int_prod"""),
    ("dim_date", """SELECT date_day, CAST(extract(day FROM date_day) AS INTEGER) AS day,
        CAST(extract(month FROM date_day) AS INTEGER) AS month, strftime(date_day, '%B') AS month_name,
        CAST(extract(quarter FROM date_day) AS INTEGER) AS quarter, CAST(extract(year FROM date_day) AS INTEGER) AS year,
        CAST(extract(week FROM date_day) AS INTEGER) AS week, strftime(date_day, '%A') AS day_of_week,
        extract(dow FROM date_day) IN (0, 6) AS is_weekend
      FROM (SELECT DISTINCT order_date AS date_day FROM stg)"""),
    ("fact", f"""SELECT CAST(row_number() OVER (ORDER BY {', '.join('s.' + c.strip() + ' NULLS FIRST' for c in STG14.split(','))})
          AS BIGINT) AS sale_id,
        s.order_id, s.order_date AS date_key, c.customer_key, p.product_key, s.region, s.country, s.quantity,
        s.unit_price, s.discount, s.sales AS revenue
      FROM stg s LEFT JOIN (SELECT customer_key, customer_id FROM dim_cust) c ON s.customer_id = c.customer_id
      LEFT JOIN (SELECT product_key, product_id FROM dim_prod) p ON s.product_id = p.product_id"""),
    ("daily", f"""SELECT date_key AS order_date, count(DISTINCT order_id) AS total_orders,
        CAST(sum(quantity) AS BIGINT) AS total_units, {money('revenue')} AS total_revenue,
        round({money('revenue')} / nullif(count(DISTINCT order_id), 0), 2) AS avg_order_value
      FROM fact GROUP BY date_key"""),
    ("monthly_base", f"""SELECT CAST(date_trunc('month', date_key) AS DATE) AS month_start,
        count(DISTINCT order_id) AS total_orders, {money('revenue')} AS total_revenue
      FROM fact GROUP BY 1"""),
    ("monthly", """SELECT month_start, total_orders, total_revenue,
        round(100.0 * (total_revenue - lag(total_revenue) OVER (ORDER BY month_start))
              / nullif(lag(total_revenue) OVER (ORDER BY month_start), 0), 2) + 0.0 AS mom_growth_pct,
        round(100.0 * (total_revenue - lag(total_revenue, 12) OVER (ORDER BY month_start))
              / nullif(lag(total_revenue, 12) OVER (ORDER BY month_start), 0), 2) + 0.0 AS yoy_growth_pct
      FROM monthly_base"""),
]


def with_chain(select_sql: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    ctes = CTES + (extra_ctes or [])
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + select_sql


def present(select_sql: str, double_cols: list[str], digits: int = 4) -> str:
    """Round the named double columns (mirror of the Spark-side presentation)."""
    if not double_cols:
        return select_sql
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({select_sql})"
