"""Sinks: full-replace table writes with read-back counts, a write with a
fallback target, partitioned + clustered layouts, CSV exports, forecast files,
model-comparison JSON, table health counts and column descriptions.

All writes are executor-side (one file per task); nothing is collected to
the driver except counts.
"""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schema import FORECAST_SCHEMA
from ledgerline.sources.versions import read_table, replace_table


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, options: dict | None = None) -> str:
    w = df.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def load_local(df: DataFrame, path: str, fmt: str = "parquet") -> tuple[str, int]:
    """SNK1: replace the table at ``path`` with ``df`` at once (a failure leaves the old
    rows); the count is that of the re-read table. ``read_table`` reads it."""
    return path, replace_table(df, path, fmt)[1]


def write_with_fallback(df: DataFrame, target: str | None, fallback: str, fmt: str = "parquet",
                        target_format: str | None = None) -> str:
    """SNK2/SNK3/SNK7: replace the table at ``target`` (any Spark format/path, e.g. a
    cloud bucket; formats of files at once, read with ``read_table``); when no target is configured or the write fails, write to the
    local ``fallback`` instead. Returns which one was used ("target"/"fallback").

    Only the target's own failures fall back (its file system or connector: no
    such scheme, refused, forbidden), with a logged warning that names the
    cause. A failure of the query itself is not a sink problem and is raised."""
    if target:
        try:
            _replace(df, target, target_format or fmt)
            return "target"
        except (Py4JJavaError, PySparkException) as e:
            if not _is_sink_failure(e):
                raise
            log.warning("writing %s failed, using %s instead: %s", target, fallback, str(e).splitlines()[0])
    _replace(df, fallback, fmt)
    return "fallback"


#: Spark's formats that are folders of files; others (connectors) replace by their own means.
FILE_FORMATS = ("parquet", "orc", "avro", "csv", "json", "text")


def _replace(df: DataFrame, target: str, fmt: str) -> None:
    if fmt in FILE_FORMATS:
        replace_table(df, target, fmt)
    else:
        write_table(df, target, fmt)


log = logging.getLogger(__name__)


def _is_sink_failure(e: Exception) -> bool:
    """An I/O or connector error while the target is opened or committed; an
    error inside a task (a SparkException) comes from the query."""
    if isinstance(e, PySparkException) and e.getCondition() == "DATA_SOURCE_NOT_FOUND":
        return True
    cause = getattr(e, "java_exception", None) or getattr(e, "_origin", None)
    while cause is not None:
        name = cause.getClass().getName()
        if name.endswith("SparkException") and "task" in str(cause.getMessage()).lower():
            return False
        if name.startswith(("java.io.", "java.net.", "java.nio.", "org.apache.hadoop.")) or name.endswith("SQLException"):
            return True
        cause = cause.getCause()
    return False


def write_partitioned_sales(df: DataFrame, path: str, date_col: str = "order_date",
                            cluster_by: tuple[str, ...] = ("category", "region"),
                            num_partitions: int | None = None) -> str:
    """SNK4: directories per month (days are too small as directories), rows
    clustered by ``cluster_by`` inside each file.

    A range repartition on (month, cluster columns, row hash) gives balanced
    tasks even when one month, or one combination, dominates (the trailing hash
    splits equal combinations), each task writing to the few months of its
    range, and already sorted for the clustering."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    month = F.trunc(F.col(date_col), "month")
    out = df.withColumn("order_month", month)
    order = ["order_month", *cluster_by]
    out = out.repartitionByRange(n, *order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    return write_table(out, path, partition_by=["order_month"])


def read_partitioned_sales(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("order_month", F.col("order_month").cast("date"))


def write_forecast_table(forecast: DataFrame, path: str) -> str:
    """SNK5: forecast rows partitioned by forecast_date."""
    return write_table(forecast, path, partition_by=["forecast_date"])


def save_forecast(forecast: DataFrame, out_dir: str) -> dict[str, str]:
    """SNK6: the forecast as CSV, as Parquet and as a date-partitioned table.
    The forecast is materialized once (Parquet) and the other copies are made
    from that file, so the model is not re-fitted per copy."""
    pq = f"{out_dir}/forecast_results.parquet"
    write_table(forecast, pq)
    saved = forecast.sparkSession.read.parquet(pq)
    csv = write_table(saved, f"{out_dir}/forecast_results.csv", fmt="csv", options={"header": "true"})
    table = write_forecast_table(saved, f"{out_dir}/forecast_results_table")
    return {"parquet": pq, "csv": csv, "table": table}


def forecast_contract(forecast: DataFrame) -> DataFrame:
    """The six warehouse columns of the forecast table, in DDL order."""
    return forecast.select(*[F.col(f.name).cast(f.dataType) for f in FORECAST_SCHEMA.fields])


def export_csv(df: DataFrame, path: str) -> str:
    """SNK8: headered, comma-separated CSV (leading/trailing blanks kept, quotes
    doubled as standard readers expect)."""
    return write_table(df, path, fmt="csv", options={"header": "true", "sep": ",", "escape": '"',
                                                     "ignoreLeadingWhiteSpace": "false",
                                                     "ignoreTrailingWhiteSpace": "false"})


def export_marts_csv(marts: dict[str, DataFrame], out_dir: str,
                     names=("sales_daily", "sales_monthly", "dim_customer", "dim_product", "fact_sales")) -> dict:
    return {n: export_csv(marts[n], f"{out_dir}/{n}.csv") for n in names}


def write_model_comparison(comparison: DataFrame, path: str) -> str:
    """SNK9: metrics per model with the best marked, as JSON lines."""
    return write_table(comparison, path, fmt="json")


def health_counts(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """HLT1: row count per named table path; a missing table reports status
    'not found' instead of failing."""
    rows = []
    for name, path in tables.items():
        try:
            n = read_table(spark, path, fmt).count()
            rows.append((name, n, "ok"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # a corrupt or forbidden table is not a missing one
            rows.append((name, None, "not found"))
    return spark.createDataFrame(rows, "table_name string, row_count bigint, status string")


def describe(df: DataFrame) -> DataFrame:
    """HLT2: (position, column_name, data_type, nullable) from the schema."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
