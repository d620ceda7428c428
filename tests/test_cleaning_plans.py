"""The cheaper plans of the cleaning give the rows of the plain ones."""

import itertools
import random

from conftest import CLEAN_BASE, row, rows
from pyspark.sql import functions as F

from ledgerline.functions import materialize as Mt
from ledgerline.functions import text as T
from ledgerline.operators import clean as C


def _dirty(spark, n=400, seed=5):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    out = [row(CLEAN_BASE, order_id=pick("a", "b", None), customer_id=pick("k", None, "l"), product_id=pick("p", "q", None, "r"),
               unit_price=pick("1.5", "-5.0", None, "2.5", "x"), quantity=pick("1", " 2", "-1"), segment=pick(None, "a"), country=pick("a", None))
           for _ in range(n)]
    # nulls that change places hash alike
    out += [row(CLEAN_BASE, segment=None, country="same"), row(CLEAN_BASE, segment="same", country=None)] * 2
    return rows(spark, *out)




def test_only_rows_of_equal_hashes_are_compared(spark, monkeypatch):
    raw = _dirty(spark)
    want = sorted(map(str, raw.dropDuplicates().collect()))
    deduplicated = C.dedup(raw)
    assert sorted(map(str, deduplicated.collect())) == want
    plan = deduplicated._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    # more equal hashes than are broadcast
    monkeypatch.setattr(Mt, "FEW_ROWS", 3)
    many = C.dedup(raw)
    assert "LeftAnti" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, many.collect())) == want


def test_distinct_rows_are_not_moved(spark):
    """Without duplicates the wide rows do not leave their tasks."""
    raw = rows(spark, *[row(CLEAN_BASE, order_id=str(i)) for i in range(50)]).repartition(4)
    ids = C.dedup(raw).select("order_id", F.spark_partition_id().alias("p")).collect()
    assert len(ids) == 50
    before = {r["order_id"]: r["p"] for r in raw.select("order_id", F.spark_partition_id().alias("p")).collect()}
    assert {r["order_id"]: r["p"] for r in ids} == before


def test_imputation_is_the_same_either_way(spark, monkeypatch):
    df = C.drop_unattributable(C.coerce_numbers(C.parse_dates(C.dedup(_dirty(spark)))))
    few = sorted(map(str, C.impute_price(df).collect()))
    counted = []
    histogram = C.histogram
    monkeypatch.setattr(C, "histogram", lambda d, k, v: (counted.append(d), histogram(d, k, v))[1])
    only_r = df.where("product_id = 'r' or unit_price >= 0")
    C.impute_price(only_r)
    assert {r["product_id"] for r in counted[0].select("product_id").distinct().collect()} == {"r"}
    monkeypatch.setattr(Mt, "FEW_ROWS", 0)
    assert sorted(map(str, C.impute_price(df).collect())) == few and few


def test_text_shortcuts(spark):
    pieces = ["a", "B", "ab", " ", "\t", "-", "9", "ß", "É", " ", "ǆ", "'", "~", "!", "\x7f", "İ", ""]
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product(pieces, repeat=n)]
    df = spark.createDataFrame([(t,) for t in sorted(set(texts))], "t string")
    slow_title = T.title_case(F.concat(F.lit("é-"), F.col("t")))   # never one ASCII word
    got = df.select("t", T.title_case("t").alias("title"), F.substring(slow_title, 3, 1 << 30).alias("slow"), T.strip_ws("t").alias("strip"),
                    F.regexp_replace("t", T.EDGE_SPACE_PATTERN, "").alias("plain")).collect()
    assert all(r["title"] == r["slow"] and r["strip"] == r["plain"] for r in got)
    assert spark.range(1).select(T.title_case(F.lit(None).cast("string")).alias("t"), T.strip_ws(F.lit(None).cast("string")).alias("s")).first()[:] == (None, None)


def test_dates(spark):
    texts = ["2023-02-28", "2023-02-29", "2024-02-29", "0000-01-01", "0001-01-01", "9999-12-31", "1582-10-10", "2023-13-01", "2023-00-10",
             "2023-04-31", " 2023-04-30 ", "2023-4-30", "2023-04-30T00", "", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.when(F.trim("t").rlike(T.DATE_PATTERN), F.try_to_date(F.trim("t"), "yyyy-MM-dd"))
    assert df.where(~T.safe_date("t").eqNullSafe(plain)).count() == 0 and df.where(T.safe_date("t").isNotNull()).count() == 7


def test_raw_view_in_one_pass(spark):
    """The raw lines of Spark's plan are those of the agreed text, which reads the tables twice."""
    from ledgerline.sources import fixture as X
    d = "/root/testdata/sf0.001"
    got = X.raw_from_tables(spark, d)
    plain = spark.sql("select * from (" + X.RAW_VIEW_SQL + ")", **X.load_tables(spark, d)).select(*got.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert got._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") and got.inputFiles()
    scans = got._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")
    assert scans * 2 <= plain._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")


def test_numbers(spark):
    texts = ["5", " 5", "5\n", "\t5.5 \n", "+.5", "-1.e3", "1e400", "-1e999", "2.5d", "NaN", "Infinity", "", " ", "5 5", "0x1", "1e", ".", "5\x00", " 7 ", "１", None]
    want = [5.0, 5.0, 5.0, 5.5, 0.5, -1000.0] + [None] * 12 + [7.0, None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(T.safe_double("t")).collect()] == want


def test_bitmaps_of_a_day_are_few(spark):
    """A day's orders fill neighbouring bits, however the orders' ids run over the days."""
    from ledgerline.operators import metrics as R
    n, days = 200_000, 400
    fact = spark.range(n).select(F.concat(F.lit("o"), "id").alias("order_id"), (F.col("id") + 1).alias("sale_id"), (F.col("id") % 50).alias("customer_key"),
                                 F.expr(f"date_add(date'2020-01-01', cast(pmod(id * 7919, {days}) as int))").alias("date_key"))
    bits = R.daily_bitmaps(fact).cache()
    assert bits.where("kind = 'order'").count() <= days + n // 32768 + 1
    got = R.distinct_in_periods(bits, {"all": ("2020-01-01", "2022-01-01"), "some": ("2020-02-01", "2020-02-10")}).collect()
    own = fact.where("date_key between '2020-02-01' and '2020-02-10'").agg(F.count_distinct("order_id"), F.count_distinct("customer_key")).first()
    assert tuple(got[0])[1:3] == (n, 50) and tuple(got[1])[1:3] == tuple(own)


def test_only_kept_columns_are_written(spark):
    """The fact's ids follow the whole row, but only the columns that it has are staged."""
    from ledgerline.functions import keys as Ky
    df = spark.createDataFrame([("b", 1, "z"), ("a", 2, "y"), ("a", 1, "x"), ("a", 1, "w")], "k string, v int, wide string")
    got = Ky.surrogate_key(df, ["k", "v", "wide"], "id", keep=["k", "v"])
    assert got.columns == ["id", "k", "v"] and "wide" not in spark.read.parquet(got.inputFiles()[0]).columns
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "b", 1)]


def test_rows_are_not_shuffled_to_their_caps(spark):
    """The caps, a few rows, go to the lines: these would else be sorted into as many tasks as there are categories."""
    raw = rows(spark, *[row(CLEAN_BASE, order_id=str(i), unit_price=str(1 + i)) for i in range(3000)])
    typed = C.normalize_text(C.coerce_numbers(C.parse_dates(raw)))
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "8k")
    try:
        capped = C.winsorize(C.recompute_sales(C.fill_discount(typed)))
        plan = capped._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert capped.count() == 3000 and capped.agg(F.max("sales")).first()[0] < 3000 * 4


def test_imputation_counts_only_its_products(spark, monkeypatch):
    """Also where the products with a bad price are too many to be sent to every executor."""
    df = C.coerce_numbers(C.parse_dates(_dirty(spark))).where("product_id = 'r' or unit_price >= 0")
    counted = []
    histogram = C.histogram
    monkeypatch.setattr(C, "histogram", lambda d, k, v: (counted.append(d), histogram(d, k, v))[1])
    monkeypatch.setattr(Mt, "FEW_ROWS", 0)
    C.impute_price(df)
    assert {r["product_id"] for r in counted[0].select("product_id").distinct().collect()} == {"r"}
