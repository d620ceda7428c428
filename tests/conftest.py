import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="ledgerline-test-ckpt-")
    s = (SparkSession.builder.master("local[*]").appName("ledgerline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


QUALITY_BASE = dict(order_id="A-77", order_date="2023-11-30", customer_id="K9", customer_name="Mara Lind",
                    product_id="T42", product_name="Bench vice 120 mm", category="Tools", quantity="4",
                    unit_price="12.5", sales="50.0", discount="0.0", region="Nordics", country="Norway",
                    segment="Trade")
#: The same line as a till would send it: padded, in odd case, with a wrong total.
CLEAN_BASE = dict(QUALITY_BASE, customer_name="\tMARA lind ", category="tOOLS", sales="1.0", discount=None,
                  region="nordics", country="NORWAY")


def rows(spark, *dicts):
    return spark.createDataFrame([tuple(d.get(c) for c in RAW_COLUMNS) for d in dicts], RAW_SCHEMA)


def row(base, **kw):
    d = dict(base)
    d.update(kw)
    return d
