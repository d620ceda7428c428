"""Distributed surrogate keys equal to ``row_number() over (order by ...)``.

A global ``Window.orderBy`` without a partition moves every row into one task.
Instead: range-partition on the ordering (tie-break columns included so even a
hot leading key is split across partitions), sort inside each partition, write
the rows with their partition number and their position as a columnar stage,
having written the input itself before unless it is a table's projection (its
count, the sample for the ranges and the numbering would each compute it), count
rows per partition from the one narrow column (as many rows as
partitions: a broadcast with a proven bound) and add the running offsets. Ids
and counts come from one materialization, so a recomputed task cannot change
them. ``materialize.cleanup`` deletes the stage once the result is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.materialize import materialize

#: Rows aimed at per partition, and the most that a position can number.
PARTITION_ROWS, POSITION_LIMIT = 20_000_000, 1 << 33


def _sort_exprs(order_cols) -> list[Column]:
    out = []
    for c in order_cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.asc_nulls_first())
    return out


def surrogate_key(df: DataFrame, order_cols, name: str, num_partitions: int | None = None,
                  computed: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Add ``name`` (bigint, 1..n) numbering rows in ``order_cols`` order; the
    other columns (those of ``keep``, if given: only these are written) are unchanged. Ties in ``order_cols`` are numbered arbitrarily,
    as with ``row_number``; pass tie-break columns to make it deterministic.
    ``computed=False``: ``df`` only projects a written table, so reading it again
    is cheaper than writing it; otherwise it is computed once and written."""
    spark = df.sparkSession
    columns = keep or df.columns
    if computed:
        df = materialize(df, f"input-{name}")
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PARTITION_ROWS))
    order = _sort_exprs(order_cols)
    # the lower 33 bits of the id are the row's position in its partition
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_LIMIT - 1))
    staged = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .select(*columns, F.spark_partition_id().alias("_pid"), position.alias("_pos")), f"key-{name}")
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    too_many = counts.where(F.col("_cnt") > POSITION_LIMIT).limit(1).collect()
    if too_many:
        raise ValueError(f"a partition of {too_many[0]['_cnt']} rows cannot be numbered: raise num_partitions or the shuffle count")
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_pid").alias("_of"), F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    keyed = staged.join(F.broadcast(offsets), F.col("_pid") == F.col("_of"))
    return keyed.select((F.col("_off") + F.col("_pos") + 1).cast("bigint").alias(name), *[F.col(c) for c in columns])
