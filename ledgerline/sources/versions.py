"""Tables that are replaced at once.

A table is a folder with its versions (``_versions/<name>``) and a pointer file
that names the current one. A new version is written beside the others, read
back and counted; only then the pointer is switched, by one rename over the old
one. A writer that fails, or is lost, at any step leaves the old rows in place,
and a reader that began before the switch ends with the version it began with:
the one before the current is kept until the next replacement.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER, VERSIONS = "_CURRENT", "_versions"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the current version, None if the folder has no versions."""
    p, fs = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        size = fs.getFileStatus(p).getLen()
        return "".join(chr(stream.read()) for _ in range(size)).strip()
    finally:
        stream.close()


def table_folder(spark: SparkSession, path: str) -> str:
    """Where the rows of the table are: its current version, or the folder itself if it was written plainly."""
    name = current_version(spark, path)
    return path if name is None else f"{path}/{VERSIONS}/{name}"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(table_folder(spark, path))


def _point(spark: SparkSession, path: str, name: str) -> None:
    """Write the pointer beside the old one and rename it over that, in one step."""
    new, fs = _fs(spark, f"{path}/{POINTER}-{name}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    old, _ = _fs(spark, f"{path}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(old), options)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", least: int | None = None) -> tuple[str, int]:
    """Replace the table by ``df``; (its folder, its row count). ``least``: with fewer rows nothing is replaced."""
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex[:16]}"
    before = current_version(spark, path)
    folder = f"{path}/{VERSIONS}/{name}"
    try:
        df.write.mode("error").format(fmt).save(folder)
        n = spark.read.format(fmt).load(folder).count()
        if least is not None and n < least:
            raise ValueError(f"{path} is not replaced: {n} rows, of {least} at least")
        _point(spark, path, name)
    except BaseException:
        p, fs = _fs(spark, folder)
        fs.delete(p, True)
        raise
    _tidy(spark, path, {name, before})
    return folder, n


def _tidy(spark: SparkSession, path: str, keep: set[str | None]) -> None:
    """Delete versions that nobody can have begun with lately, and the files of a plain table that was there."""
    top, fs = _fs(spark, path)
    for status in fs.listStatus(top):
        if status.getPath().getName() not in (POINTER, VERSIONS):
            fs.delete(status.getPath(), True)
    versions, fs = _fs(spark, f"{path}/{VERSIONS}")
    for status in fs.listStatus(versions):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)
