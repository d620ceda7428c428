"""Distributed connected components by alternating large and small stars.

Every step is an aggregation with partial sums and an equi-join between two
written tables, so a node with very many neighbours is split by AQE's skew
join; nothing is gathered per node or on the driver. The steps end when every
component is a star around its least node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge, root the least node of its
    component. Null ends and self-loops are ignored; no edges, no rows."""
    scratch = Scratch(edges.sparkSession, "components")
    u, v = F.greatest(a, b), F.least(a, b)
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = scratch.table(e.select(u.alias("u"), v.alias("v")).distinct(), "e0")
    step = 0
    while not _stars(e):
        step += 1
        both = e.union(e.select("v", "u"))
        least = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("x"), F.least("u", "m").alias("m")), f"m{step}")
        both = scratch.table(both.where(F.col("v") > F.col("u")), f"b{step}")
        large = both.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.table(large.where("u != v").distinct(), f"l{step}")
        least = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x"), f"s{step}")
        small = large.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u != v").union(least.select("x", "m")).distinct()
        new = scratch.table(small, f"e{step}")
        for old in (f"m{step}", f"b{step}", f"l{step}", f"s{step}", f"e{step - 1}"):
            scratch.drop(old)
        e = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def _stars(e: DataFrame) -> bool:
    """Whether each node has one edge up, to a node that has none."""
    n, nodes = e.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
    return n == nodes and not e.join(e.select(F.col("u").alias("x")), F.col("v") == F.col("x"), "left_semi").limit(1).count()
