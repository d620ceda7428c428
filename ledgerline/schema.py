"""Column sets and struct types of the raw, clean and staging tables."""

from pyspark.sql import types as T

# The 14 required raw columns, in file order.
RAW_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name",
    "product_id", "product_name", "category", "quantity",
    "unit_price", "sales", "discount", "region", "country", "segment",
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

NUMERIC_COLUMNS = ["quantity", "unit_price", "sales", "discount"]

# staging column order (typed projection)
STG_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name", "product_id",
    "product_name", "category", "region", "country", "segment",
    "quantity", "unit_price", "discount", "sales",
]

CLEAN_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("segment", T.StringType()),
])

FORECAST_SCHEMA = T.StructType([
    T.StructField("forecast_date", T.DateType()),
    T.StructField("predicted_sales", T.DoubleType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("generated_at", T.TimestampType()),
])
