import datetime as dt

from pyspark.sql import functions as F

from ledgerline.sources import sinks as K


def _sales(spark):
    rows = [("O1", dt.date(2024, 1, 5), "Toys", "East", 10.0), ("O2", dt.date(2024, 1, 20), "Tools", "West", 5.0),
            ("O3", dt.date(2024, 2, 1), "Toys", "West", 7.5)]
    return spark.createDataFrame(rows, "order_id string, order_date date, category string, region string, sales double")


def test_fallback_and_replace(spark, tmp_path):
    df = _sales(spark)
    fb = str(tmp_path / "fb")
    assert K.write_with_fallback(df, "unconfigured-scheme://x/y", fb) == "fallback"
    assert K.write_with_fallback(df, None, fb) == "fallback"
    tgt = str(tmp_path / "tgt")
    assert K.write_with_fallback(df, tgt, fb) == "target"
    path, n = K.load_local(df.limit(1), tgt)
    assert n == 1                                     # full replace, not append


def test_partitioned_layout(spark, tmp_path):
    path = K.write_partitioned_sales(_sales(spark), str(tmp_path / "p"), num_partitions=2)
    back = K.read_partitioned_sales(spark, path)
    assert sorted(r["order_month"] for r in back.select("order_month").distinct().collect()) == \
        [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert back.where(F.col("order_month") == F.lit("2024-02-01").cast("date")).count() == 1


def test_health_counts_and_describe(spark, tmp_path):
    df = _sales(spark)
    K.write_table(df, str(tmp_path / "t1"))
    h = {r["table_name"]: r for r in K.health_counts(spark, {"t1": str(tmp_path / "t1"),
                                                              "t2": str(tmp_path / "t2")}).collect()}
    assert h["t1"]["row_count"] == 3 and h["t1"]["status"] == "ok"
    assert h["t2"]["row_count"] is None and h["t2"]["status"] == "not found"
    d = K.describe(df).collect()
    assert [(r["column_name"], r["data_type"]) for r in d][:2] == [("order_id", "string"), ("order_date", "date")]


def test_save_forecast_files(spark, tmp_path):
    fc = spark.createDataFrame([(dt.date(2024, 3, 1), 1.0, 0.5, 1.5, "Naive")],
                               "forecast_date date, predicted_sales double, lower_bound double, upper_bound double, "
                               "model_name string").withColumn("generated_at", F.current_timestamp())
    paths = K.save_forecast(fc, str(tmp_path / "fc"))
    assert spark.read.parquet(paths["parquet"]).count() == 1
    assert spark.read.option("header", True).csv(paths["csv"]).count() == 1
    assert spark.read.parquet(paths["table"]).count() == 1
    assert K.forecast_contract(spark.read.parquet(paths["parquet"])).columns == \
        ["forecast_date", "predicted_sales", "lower_bound", "upper_bound", "model_name", "generated_at"]


def test_a_failing_replacement_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    import os

    import pytest
    from ledgerline.sources import versions as V
    df, path = _sales(spark), str(tmp_path / "t")
    K.write_table(df.limit(1), path)  # a plain table is taken over
    assert K.read_table(spark, path).count() == 1
    assert K.load_local(df, path) == (path, 3)
    broken = df.withColumn("sales", F.when(F.col("order_id") == "O3", F.raise_error(F.lit("boom")).cast("double")).otherwise(1.0))
    begun = K.read_table(spark, path)
    with pytest.raises(Exception, match="boom"):
        K.load_local(broken, path)
    assert K.read_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        V.replace_table(df.limit(1), path, least=2)
    assert K.read_table(spark, path).count() == 3 and len(os.listdir(f"{path}/{V.VERSIONS}")) == 1

    def lost(*_):
        raise OSError("the pointer cannot be written")
    with monkeypatch.context() as m:
        m.setattr(V, "_point", lost)
        with pytest.raises(OSError):
            K.load_local(df.limit(2), path)
    assert K.read_table(spark, path).count() == 3
    K.load_local(df.limit(2), path)
    assert K.read_table(spark, path).count() == 2 and begun.count() == 3  # a reader that began before ends with its rows
    K.load_local(df.limit(1), path)
    assert len(os.listdir(f"{path}/{V.VERSIONS}")) == 2 and K.health_counts(spark, {"t": path}).first()["row_count"] == 1
