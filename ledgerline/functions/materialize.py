"""Write a DataFrame as a Parquet table under the shared checkpoint folder and
read it back: the lineage is cut (an executor loss no longer replays the
upstream plan), and downstream plans start from a plain file scan that still
gets column pruning and filter pushdown."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-tables"


def table_path(df: DataFrame, name: str) -> str:
    return f"{_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = table_path(df, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of one number that are sent to every executor (some 100 MB there).
FEW_ROWS = 1_000_000


def if_few(keys: DataFrame) -> DataFrame | None:
    """The written ``keys`` (one number a row), to be broadcast; None if there are more than ``FEW_ROWS``."""
    return F.broadcast(keys) if keys.count() <= FEW_ROWS else None


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def cleanup(spark: SparkSession) -> None:
    """Delete all tables materialized by this application (its checkpoint folder
    is its own). Call it once nothing reads them any more."""
    p, fs = _fs(spark, _root(spark))
    fs.delete(p, True)


def stage(spark: SparkSession, source: str, names: tuple[str, ...], name: str, build, write=None) -> DataFrame:
    """A table derived from the Parquet inputs ``source/<names>.parquet``, written
    once. Its folder is keyed by the inputs' files, lengths and modification
    times, so changed data are a new stage, and a finished stage (``_SUCCESS``)
    is read by all later queries of the application, whose checkpoint folder is
    its own. ``write(df, path)`` lays the table out in another way than plain."""
    import hashlib
    state = []
    for t in names:
        p, fs = _fs(spark, f"{source}/{t}.parquet")
        state += sorted(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p))
    key = hashlib.sha256("\n".join(state).encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-stages/{key}/{name}"
    done, fs = _fs(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        if write:
            write(build(), path)
        else:
            build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
