from conftest import QUALITY_BASE, row, rows

from ledgerline.operators import quality as Q


def report(spark, *ds):
    return Q.quality_report(rows(spark, *ds)).first().asDict()


def test_duplicate_rows_counted(spark):
    r = report(spark, row(QUALITY_BASE), row(QUALITY_BASE))
    assert r["duplicate_rows"] == 1
    assert r["duplicate_order_ids"] == 1


def test_missing_customer_id(spark):
    assert report(spark, row(QUALITY_BASE, customer_id=None), row(QUALITY_BASE, order_id="O2"))["missing_customer_id"] == 1


def test_invalid_quantity(spark):
    assert report(spark, row(QUALITY_BASE, quantity="-1"), row(QUALITY_BASE, order_id="O2"))["invalid_quantities"] == 1


def test_invalid_date(spark):
    assert report(spark, row(QUALITY_BASE, order_date="not-a-date"), row(QUALITY_BASE, order_id="O2"))["invalid_dates"] == 1


def test_clean_rows_not_flagged(spark):
    r = report(spark, *[row(QUALITY_BASE, order_id=f"O{i}") for i in range(5)])
    assert r["rows_flagged_invalid"] == 0
    assert r["estimated_valid_rows"] == 5


def test_flag_rules_and_null_order_ids(spark):
    r = report(spark,
               row(QUALITY_BASE, order_id=None), row(QUALITY_BASE, order_id=None, customer_id="C2"),
               row(QUALITY_BASE, order_id="O3", unit_price="-2"), row(QUALITY_BASE, order_id="O4", unit_price="0"),
               row(QUALITY_BASE, order_id="O5", sales="-1", region=None, category=None),
               row(QUALITY_BASE, order_id="O6", quantity="2.5d"))
    assert r["duplicate_order_ids"] == 1          # the two null ids count as equal
    assert r["invalid_unit_price"] == 1           # zero price is valid
    assert r["invalid_sales"] == 1 and r["missing_region"] == 1 and r["missing_category"] == 1
    assert r["invalid_quantities"] == 1           # '2.5d' is not a number
    # sales/region/category problems do not flag; price -2 and quantity '2.5d' do
    assert r["rows_flagged_invalid"] == 2


def test_gate(spark):
    import pytest
    bad = [row(QUALITY_BASE, order_id=f"B{i}", customer_id=None) for i in range(3)]
    good = [row(QUALITY_BASE, order_id=f"G{i}") for i in range(3)]
    Q.enforce_gate(Q.quality_report(rows(spark, *bad, *good)))        # exactly 0.5 passes
    with pytest.raises(Q.QualityGateError):
        Q.enforce_gate(Q.quality_report(rows(spark, *bad, *good[:2])))


def test_flagged_rows_and_long_report(spark):
    df = rows(spark, row(QUALITY_BASE), row(QUALITY_BASE), row(QUALITY_BASE, order_id="X", customer_id=None))
    fl = {r["order_id"]: r for r in Q.flagged_rows(df).collect()}
    assert fl["A-77"]["copies"] == 2 and fl["A-77"]["flagged_copies"] == 1
    assert fl["X"]["flagged_copies"] == 1 and fl["X"]["no_customer"]
    long = Q.quality_report_long(Q.quality_report(df)).orderBy("position").collect()
    assert [r["metric"] for r in long] == Q.REPORT_KEYS


def test_null_rate_warnings(spark):
    df = rows(spark, row(QUALITY_BASE, region=None), *[row(QUALITY_BASE, order_id=f"O{i}") for i in range(9)])
    w = {r["column_name"]: r for r in Q.null_rate_warnings(df, 0.05).collect()}
    assert w["region"]["warn"] and w["region"]["null_count"] == 1
    assert not w["order_id"]["warn"]
