"""Exploration profile: shape, first rows, types, null counts, frequencies, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame) -> DataFrame:
    """PRF1: one row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))


def head(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """PRF2: the first ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols]).limit(n)


def dtypes(df: DataFrame) -> DataFrame:
    """PRF3: (position, column_name, data_type) rows (schema metadata, no scan)."""
    rows = [(i + 1, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def null_counts(df: DataFrame) -> DataFrame:
    """PRF4: null count per column in one pass, returned long."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"),
                      F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)]
    return agg.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """PRF5: frequency of each value, the null group included, most frequent first."""
    return (df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("value")))


def duplicate_count(df: DataFrame) -> DataFrame:
    """PRF6: rows equal to an earlier row = rows - distinct rows (one aggregation)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def raw_vs_clean(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """PRF7: raw rows, clean rows and rows dropped, one row."""
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    c = clean.agg(F.count(F.lit(1))).scalar()
    return r.withColumn("clean_rows", c).withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))
