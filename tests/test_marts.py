import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import quantile as Qt
from ledgerline.functions.keys import surrogate_key
from ledgerline.functions.quantile import exact_group_quantile
from ledgerline.operators import expectations as X
from ledgerline.operators import marts as M
from ledgerline.operators import metrics as R
from ledgerline.schema import CLEAN_SCHEMA

D = dt.date


def clean_rows(spark):
    data = [
        ("O1", D(2024, 1, 6), "C2", "Bob", "P1", "Widget", "Tools", 2.0, 10.0, 20.0, 0.0, "East", "Usa", "Consumer"),
        ("O1", D(2024, 1, 6), "C2", "Bob", "P2", "Gadget", "Toys", 1.0, 5.0, 5.01, 0.0, "East", "Usa", "Consumer"),
        ("O2", D(2024, 1, 6), "C1", "Al", "P1", "Widget", "Tools", 1.0, 10.0, 10.0, 0.0, "West", "Usa", "Corporate"),
        ("O3", D(2024, 2, 5), "C2", "Bob", "P2", "Gadget", "Toys", 2.6, 5.0, 13.0, 0.0, "East", "Usa", "Consumer"),
        ("O4", D(2025, 1, 1), "C3", "Cy", "P3", "Thing", "Toys", 1.0, 1.0, 1.0, 0.0, "North", "Usa", "Consumer"),
    ]
    return spark.createDataFrame(data, CLEAN_SCHEMA)


def test_marts_values(spark):
    stg = M.stg_sales(clean_rows(spark))
    m = M.build_marts(stg)
    assert [r["quantity"] for r in stg.orderBy("order_id", "product_id").collect()] == [2, 1, 1, 3, 1]
    dc = {r["customer_id"]: r for r in m["dim_customer"].collect()}
    assert [dc[c]["customer_key"] for c in ("C1", "C2", "C3")] == [1, 2, 3]
    assert dc["C2"]["order_count"] == 2 and dc["C2"]["is_repeat_customer"] and not dc["C1"]["is_repeat_customer"]
    assert abs(dc["C2"]["total_revenue"] - 38.01) < 1e-9
    daily = {r["order_date"]: r for r in m["sales_daily"].collect()}
    assert daily[D(2024, 1, 6)]["total_orders"] == 2 and daily[D(2024, 1, 6)]["avg_order_value"] == 17.51
    mon = {r["month_start"]: r for r in m["sales_monthly"].collect()}
    assert mon[D(2024, 2, 1)]["mom_growth_pct"] == round(100 * (13.0 - 35.01) / 35.01, 2)
    assert mon[D(2024, 1, 1)]["mom_growth_pct"] is None
    dd = {r["date_day"]: r for r in m["dim_date"].collect()}
    assert dd[D(2024, 1, 6)]["is_weekend"] and dd[D(2024, 1, 6)]["day_of_week"] == "Saturday"
    assert dd[D(2025, 1, 1)]["week"] == 1 and dd[D(2024, 2, 5)]["month_name"] == "February"
    fact = m["fact_sales"].orderBy("sale_id").collect()
    assert [r["sale_id"] for r in fact] == [1, 2, 3, 4, 5] and fact[0]["order_id"] == "O1"
    assert fact[0]["customer_key"] == 2
    yoy = {r["month_start"]: r for r in R.yoy_calendar(m["sales_monthly"]).collect()}
    assert yoy[D(2025, 1, 1)]["prev_year_revenue"] == 35.01


def test_data_tests_pass_and_fail(spark):
    m = M.build_marts(M.stg_sales(clean_rows(spark)))
    res = X.run_checks(m, X.default_checks()).collect()
    assert len(res) == 32
    failed = [r for r in res if not r["passed"]]
    assert [(r["test"], r["failures"]) for r in failed] == [("accepted_values", 2)]   # Tools, Toys


def test_checks_count_what_they_say(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, None)], "k int, v string")
    child = spark.createDataFrame([(1, "x"), (None, "y"), (3, "y"), (3, None), (4, "x")], "k int, c string")
    checks = [X.Check("p", "k", "unique"), X.Check("p", "v", "not_null"), X.Check("p", "v", "unique"),
              X.Check("c", "k", "not_null"), X.Check("c", "c", "accepted_values", values=("y",)),
              X.Check("c", "k", "relationships", to=("p", "k"))]
    res = X.run_checks({"p": parent, "c": child}, checks)
    assert [(r["check_id"], r["failures"]) for r in res.orderBy("check_id").collect()] == [
        (1, 1), (2, 1), (3, 0), (4, 1), (5, 1), (6, 3)]
    assert [r["passed"] for r in res.orderBy("check_id").collect()] == [False, False, True, False, False, False]
    none = X.run_checks({"p": parent.limit(0), "c": child.limit(0)}, checks).collect()
    assert len(none) == 6 and all(r["passed"] for r in none)


def test_each_model_is_read_once_by_its_checks(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(300).selectExpr("id as k", "id % 7 as c").mapInArrow(count, "k bigint, c bigint")
    checks = [X.Check("m", "k", kind) for kind in ("unique", "not_null")] + [
        X.Check("m", "c", "relationships", to=("m", "k"))]
    assert all(r["passed"] for r in X.run_checks({"m": df}, checks).collect()) and seen.value == 300


def test_distinct_counts_of_periods_from_bitmaps(spark):
    n = 90_000   # numbers of three bitmap buckets
    fact = spark.range(1, n + 1).selectExpr(
        "id as sale_id", "concat('O', if(id % 3 = 0, 0, id div 2)) as order_id",
        "date_add(date'2024-01-01', cast(id * 31 % 60 as int)) as date_key", "if(id % 17 = 0, null, id % 70001) as customer_key")
    periods = {"a": ("2024-01-05", "2024-01-20"), "b": ("2024-01-15", "2024-02-10"), "none": ("2030-01-01", "2030-12-31")}
    out = {r["period"]: r for r in R.distinct_in_periods(R.daily_bitmaps(fact), periods).collect()}
    firsts = fact.where("customer_key is not null").groupBy("customer_key").agg(F.min("date_key").alias("first"))
    for name, (a, b) in periods.items():
        want = fact.where(F.col("date_key").between(a, b)).agg(F.count_distinct("order_id"), F.count_distinct("customer_key")).first()
        new = firsts.where(F.col("first").between(a, b)).count()
        assert (out[name]["total_orders"], out[name]["total_customers"], out[name]["new_customers"]) == (*want, new)
    empty = R.distinct_in_periods(R.daily_bitmaps(fact.limit(0)), periods).collect()
    assert [r["new_customers"] for r in empty] == [0, 0, 0]


def test_surrogate_key_equals_row_number(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    keyed = surrogate_key(df, ["l_orderkey", "l_linenumber", "l_partkey"], "k", num_partitions=5)
    w = Window.orderBy("l_orderkey", "l_linenumber", "l_partkey")
    ref = df.withColumn("rn", F.row_number().over(w).cast("bigint"))
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    got = [tuple(r) for r in keyed.orderBy("k").select("k", *cols).collect()]
    want = [tuple(r) for r in ref.orderBy("rn").select("rn", *cols).collect()]
    assert got == want and len(got) == df.count()


def test_exact_quantile_matches_percentile(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for q in (0.5, 0.99, 0.01):
        a = exact_group_quantile(df, ["l_returnflag"], "l_extendedprice", q, accuracy=50)
        b = df.groupBy("l_returnflag").agg(F.percentile("l_extendedprice", q).alias("p"))
        diffs = a.join(b, "l_returnflag").where(F.abs(F.col("quantile") - F.col("p")) > 1e-6).count()
        assert diffs == 0


def test_quantiles_of_narrowed_groups(spark):
    """Groups beyond the window's rows are cut down to counted bins, the result stays exact."""
    df = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919) % 20011 / 8).alias("v"))
    hist = Qt.histogram(df, ["g"], "v")
    for q in (0.0, 0.01, 0.5, 0.99, 1.0):
        for accuracy in (20, 10000):
            a = Qt.quantile_of_histogram(hist, ["g"], q, "a", accuracy, window_rows=150)
            b = df.groupBy("g").agg(F.percentile("v", q).alias("p"))
            out = a.join(b, "g").collect()
            assert len(out) == 6 and all(abs(r["a"] - r["p"]) < 1e-9 for r in out), (q, accuracy)
    empty = df.where("v < 0")
    assert exact_group_quantile(empty, ["g"], "v", 0.5).count() == 0


def test_key_input_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("id")).mapInArrow(count, "id bigint")
    keyed = surrogate_key(df, ["id"], "k", num_partitions=4)
    assert keyed.where("k = id + 1").count() == 5000 and seen.value == 5000


def test_hot_key_skew(spark):
    """One key holding a third of the rows: exact quantile and surrogate keys stay exact."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("g"),
        ((F.col("id") * 7919) % 10007 / 100.0).alias("v"), F.col("id"))
    a = exact_group_quantile(df, ["g"], "v", 0.99, accuracy=1000)
    b = df.groupBy("g").agg(F.percentile("v", 0.99).alias("p"))
    assert a.join(b, "g").where(F.abs(F.col("quantile") - F.col("p")) > 1e-9).count() == 0
    hot = df.where("g = 'HOT'").select(F.lit("ORD-1").alias("order_id"), "id")   # one order id for 10k rows
    keyed = surrogate_key(hot, ["order_id", "id"], "k", num_partitions=8)
    parts = keyed.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["k"] for r in keyed.collect()) == list(range(1, n // 3 + 1))
    ids = [r["id"] for r in keyed.orderBy("k").collect()]
    assert ids == sorted(ids)
    assert len(parts) > 1      # the hot order id is spread by the tie-break column


def test_views_and_approx_scorecard(spark):
    stg = M.stg_sales(clean_rows(spark))
    m = M.build_marts(stg)
    M.register_views({"fact_sales": m["fact_sales"]}, prefix="t_")
    assert spark.sql("select count(*) from t_fact_sales").first()[0] == 5
    exact = R.kpi_scorecard(M.fact_measures(stg), m["sales_monthly"]).first()
    approx = R.kpi_scorecard(M.fact_measures(stg), m["sales_monthly"], approx=True).first()
    assert exact["total_orders"] == 4 and exact["total_customers"] == 3
    assert approx["total_orders"] == 4 and approx["total_customers"] == 3
