import pytest
from conftest import QUALITY_BASE, row, rows

from ledgerline.schema import RAW_COLUMNS
from ledgerline.sources import raw as R
from ledgerline.sources import sinks as K


def test_csv_roundtrip_reads_strings_and_nulls(spark, tmp_path):
    df = rows(spark, row(QUALITY_BASE), row(QUALITY_BASE, order_id="O2", region=None, customer_name="  PADDED  "))
    path = K.export_csv(df, str(tmp_path / "raw.csv"))
    back = R.read_raw_csv(spark, path)
    assert back.columns == RAW_COLUMNS
    assert all(t == "string" for _, t in back.dtypes)
    got = {r["order_id"]: r for r in back.collect()}
    assert got["O2"]["region"] is None and got["O2"]["customer_name"] == "  PADDED  "
    R.validate_schema(back)


def test_na_tokens_become_null(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text(",".join(RAW_COLUMNS) + "\n" + ",".join(["O1", "NA", "N/A", "null"] + ["x"] * 10) + "\n")
    r = R.read_raw_csv(spark, str(p)).first()
    assert r["order_date"] is None and r["customer_id"] is None and r["customer_name"] is None


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("O1",)], "order_id string")
    with pytest.raises(R.SchemaValidationError):
        R.validate_schema(df)


def test_empty_raises(spark):
    with pytest.raises(R.SchemaValidationError):
        R.validate_schema(R.empty_raw(spark))
    with pytest.raises(R.SchemaValidationError):
        R.validate_not_empty(R.empty_raw(spark))


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception):
        R.read_raw_csv(spark, str(tmp_path / "nope.csv"))


def test_metadata(spark, tmp_path):
    df = rows(spark, row(QUALITY_BASE), row(QUALITY_BASE, order_id="O2"))
    path = K.export_csv(df.coalesce(1), str(tmp_path / "m.csv"))
    m = R.ingest_metadata(spark, path).first()
    assert m["row_count"] == 2 and m["column_count"] == 14 and len(m["sha256"]) == 64
