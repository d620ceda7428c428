"""Named-query registry: a Spark builder, its DuckDB oracle text (or None for a
rows-only check) and the double columns rounded for presentation on both sides."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.oracle import present


@dataclass
class NamedQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.doubles:
            # half away from zero on the scaled double, as the oracle's round(x, 4) does
            df = df.withColumns({c: F.round(F.col(c) * 10000.0) / 10000.0 for c in self.doubles})
        return df

    def oracle(self) -> str | None:
        return None if self.sql is None else present(self.sql, list(self.doubles))


REGISTRY: dict[str, NamedQuery] = {}


def query(name: str, sql: str | None, doubles: tuple[str, ...] | list[str] = ()):
    def deco(fn):
        REGISTRY[name] = NamedQuery(name, fn, sql, tuple(doubles))
        return fn
    return deco
