"""What must hold at any size: settings from outside, keys, stages, sinks, series."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from conftest import QUALITY_BASE, row, rows
from pyspark.sql import functions as F

from ledgerline.functions import keys, materialize
from ledgerline.operators import forecast as FC
from ledgerline.operators import marts as M
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sources import raw as R
from ledgerline.sources import sinks as K

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_settings_from_outside_are_kept():
    code = ("from ledgerline.session import build_session; s = build_session('local[1]'); "
            "print('N', s.conf.get('spark.sql.shuffle.partitions')); "
            "print('M', build_session('local[1]', shuffle_partitions=5).conf.get('spark.sql.shuffle.partitions'))")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=2000 pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout
    assert "N 2000" in out and "M 5" in out


def test_keys_with_skewed_partitions(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") % 3 * 0).alias("k"), F.col("id").alias("v"))
    out = keys.surrogate_key(df, ["k", "v"], "key", num_partitions=5).orderBy("v").collect()
    assert [r["key"] for r in out] == list(range(1, 5001))
    one = keys.surrogate_key(df, ["k"], "key", num_partitions=4)  # one value: all rows in one partition
    assert sorted(r["key"] for r in one.collect()) == list(range(1, 5001))
    assert keys.surrogate_key(df.limit(0), ["k"], "key").count() == 0
    monkeypatch.setattr(keys, "POSITION_LIMIT", 1 << 10)
    with pytest.raises(ValueError, match="cannot be numbered"):
        keys.surrogate_key(df, ["k"], "key", num_partitions=4)


def test_cleanup_empties_the_stage_folder(spark):
    df = materialize.materialize(spark.range(5), "t")
    folder = df.inputFiles()[0].removeprefix("file:").removeprefix("//").rsplit("/", 2)[0]
    assert os.listdir(folder)
    materialize.cleanup(spark)
    assert not os.path.exists(folder)


def test_stage_follows_its_inputs(spark, tmp_path):
    d, made = str(tmp_path), []
    build = lambda: made.append(1) or spark.read.parquet(f"{d}/t.parquet")
    for n in (3, 3, 4):
        if not made or n == 4:
            spark.range(n).write.mode("overwrite").parquet(f"{d}/t.parquet")
        assert materialize.stage(spark, d, ("t",), "x", build).count() == n
    assert len(made) == 2


HEAD = ",".join(RAW_COLUMNS) + "\n"


@pytest.mark.parametrize("line,multi,fault", [
    (",".join("x" * 14) + ",extra", False, "More than 14 fields"),
    (",".join("x" * 14) + ",", False, "More than 14 fields"),
    ('O1,d,c,"two\nlines",' + ",".join("x" * 10), False, "goes over a line end"),
    ('O1,d,c,"two\nlines",' + ",".join("x" * 10), True, None),
    ('O1,d,c,"a, ""b"", c",' + ",".join("x" * 10), False, None),
    ("O1,short", False, None),
])
def test_csv_lines(spark, tmp_path, line, multi, fault):
    p = tmp_path / "r.csv"
    p.write_text(HEAD + line + "\n")
    df = R.read_raw_csv(spark, str(p), multi)
    if fault:
        for read in (df.collect, df.count, df.select("segment").collect):
            with pytest.raises(Exception, match=fault):
                read()
    else:
        r = df.first()
        assert df.count() == 1 and r["order_id"] in ("O1", "x")
        assert r["customer_name"] in (None, "two\nlines", 'a, "b", c')


def test_export_is_read_back(spark, tmp_path):
    name = '5" pipe, "x"\nsecond \\ line'
    df = rows(spark, row(QUALITY_BASE, product_name=name))
    back = R.read_raw_csv(spark, K.export_csv(df, str(tmp_path / "e.csv")), multi_line=True)
    assert back.first()["product_name"] == name


def test_metadata_is_one_row_per_file(spark, tmp_path, monkeypatch):
    df = rows(spark, *[row(QUALITY_BASE, order_id=str(i)) for i in range(9)]).repartition(3)
    path = K.export_csv(df, str(tmp_path / "m.csv"))
    small = {r["filename"]: r for r in R.ingest_metadata(spark, path).collect()}
    assert len(small) == 3 and sum(r["row_count"] for r in small.values()) == 9
    monkeypatch.setattr(R, "WHOLE_FILE", 10)
    large = {r["filename"]: r for r in R.ingest_metadata(spark, path).collect()}
    assert small.keys() == large.keys() and all(small[f]["sha256"] != large[f]["sha256"] for f in small)


def sales(spark, n):
    return spark.range(n).select(F.concat(F.lit("O"), "id").alias("order_id"), F.lit(dt.date(2024, 1, 5)).alias("order_date"),
                                 F.lit("Toys").alias("category"), F.lit("East").alias("region"), F.col("id").cast("double").alias("sales"))


def test_a_hot_combination_is_written_by_several_tasks(spark, tmp_path):
    path = K.write_partitioned_sales(sales(spark, 4000), str(tmp_path / "p"), num_partitions=4)
    back = K.read_partitioned_sales(spark, path)
    assert back.count() == 4000 and back.select(F.input_file_name()).distinct().count() == 4


def test_only_the_sinks_own_failures_fall_back(spark, tmp_path, caplog):
    fb = str(tmp_path / "fb")
    (tmp_path / "file").write_text("x")
    assert K.write_with_fallback(sales(spark, 3), f"{tmp_path}/file/below", fb) == "fallback"
    assert "failed, using" in caplog.text
    broken = sales(spark, 3).withColumn("sales", F.raise_error(F.lit("a fault of the query")).cast("double"))
    with pytest.raises(Exception, match="a fault of the query"):
        K.write_with_fallback(broken, str(tmp_path / "t"), fb)
    assert K.read_table(spark, fb).count() == 3


def test_a_corrupt_table_is_not_a_missing_one(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        K.health_counts(spark, {"bad": str(tmp_path / "bad")})


@pytest.mark.parametrize("text,want", [("2.5", 2), ("3.5", 4), ("0.5", 0), ("7", 7), ("1e12", None)])
def test_quantity_cast(spark, text, want):
    df = rows(spark, row(QUALITY_BASE)).withColumn("quantity", F.lit(float(text)))
    assert M.stg_sales(df.withColumn("order_date", F.lit("2024-01-01"))).first()["quantity"] == want


def test_daily_average_of_huge_totals(spark):
    fact = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1, 4e13), ("b", dt.date(2024, 1, 1), 1, 1e13 + 0.5)],
                                 "order_id string, date_key date, quantity int, revenue double")
    r = M.sales_daily(fact).first()
    assert r["total_revenue"] == 5e13 + 0.5 and r["avg_order_value"] == 2.5e13 + 0.25


def test_series_of_two_keys_do_not_meet(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("null", "x"), ("a\\", "|c"), ("a\\|", "c"), ("\\N", "x")]
    df = spark.createDataFrame([(a, b, dt.date(2024, 1, 1), 1.0) for a, b in pairs], "a string, b string, order_date date, sales double")
    assert FC.period_observations(df, ["a", "b"]).count() == len(pairs)


def obs(spark, n, last=(2024, 6)):
    months = [dt.date(last[0] + (last[1] - 1 - i) // 12, (last[1] - 1 - i) % 12 + 1, 1) for i in range(n)]
    return spark.createDataFrame([("s", m, float(m.month)) for m in months], "series string, period_start date, y double")


@pytest.mark.parametrize("as_of,n", [("2024-06-01", 9), ("2024-06-30", 9), ("2024-07-01", 10), ("2030-01-01", 10), ("2024-01-01", 9), (None, 10)])
def test_only_the_current_month_is_incomplete(spark, as_of, n):
    o = obs(spark, 10)
    assert FC.prepare_series(o, as_of=as_of).count() == n
    assert FC.series_lengths(o, as_of).first()["n"] == n


def test_fractions_without_a_test_period_are_errors(spark):
    p = FC.prepare_series(obs(spark, 10))
    for f in (0, 1, -0.1):
        with pytest.raises(ValueError, match="test_fraction"):
            FC.chronological_split(p, f)


def test_only_winners_are_fitted_again(spark):
    p = FC.prepare_series(obs(spark, 30))
    best = spark.createDataFrame([("s", "Naive", 1.0)], "series string, best_model string, RMSE double")
    assert FC.generate_forecast(p, best).count() == 6


def test_date_filter_prunes_the_months_of_the_fact(spark):
    """The scan of the fact reads only the folders of the months that the filtered date dimension leaves."""
    import re

    from ledgerline.operators import metrics as R
    from ledgerline.plans.q_core import fact_by_month, mart_of
    d = "/root/testdata/sf0.001"
    fact, dates = fact_by_month(spark, d), mart_of(spark, d, "dim_date")
    df = R.filtered_sales(fact, mart_of(spark, d, "dim_product"), "1996-02-10", "1996-03-20", dates=dates)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)
    got = sorted(map(str, df.collect()))
    assert got == sorted(map(str, R.filtered_sales(mart_of(spark, d, "fact_sales"), mart_of(spark, d, "dim_product"), "1996-02-10", "1996-03-20").collect())) and got
    assert R.filtered_sales(fact, mart_of(spark, d, "dim_product"), dates=dates).count() == fact.count()
