"""Raw file scan, schema validation and the ingest metadata sidecar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schema import RAW_COLUMNS, RAW_SCHEMA
from ledgerline.sources.records import csv_records, file_digests, numbered_lines, tree_digest

# The tokens pandas.read_csv reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class SchemaValidationError(Exception):
    pass


BROKEN = "_broken_line"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool | str = False) -> DataFrame:
    """Headered CSV, every column a nullable string (no inference), NA tokens -> null.

    Columns are matched by header name; extra columns pass through untouched.
    A missing path raises (Spark's AnalysisException) like a missing file did.

    A row with more fields than the header raises when it is read, as does a
    quoted value that goes over a line end (short rows are filled with nulls).
    ``multi_line=True`` reads such values from splits of the files (see
    ``sources.records``); it asks for quotes in quoted values only, doubled.
    ``multi_line="whole"`` takes any quotes, but makes a file one task's work.
    """
    return _raw_rows(spark, path, multi_line).drop(FILE)


FILE = "_of_file"


def _raw_rows(spark: SparkSession, path: str, multi_line: bool | str) -> DataFrame:
    """The rows with the path of their file in ``FILE``."""
    if multi_line not in (False, True, "whole"):
        raise ValueError(f'multi_line must be False, True or "whole", not {multi_line!r}')
    options = {"header": "true", "escape": '"', "multiLine": str(bool(multi_line)).lower()}
    header = spark.read.options(**options).option("inferSchema", False).csv(path).columns
    schema = ", ".join(f"`{c}` string" for c in [*header, BROKEN])
    if multi_line is True:
        df = csv_records(spark, path, header, schema, BROKEN, FILE)
    else:
        df = (spark.read.options(**options).option("enforceSchema", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False)
              .schema(schema).csv(path).select("*", F.col("_metadata.file_path").alias(FILE)))
    # a marked line is short (accepted), long, or ends inside quotes
    # (a mark after its last field shows how many fields it has)
    wide = [f"c{i}" for i in range(len(header) + 2)]
    cells = F.from_csv(F.concat(BROKEN, F.lit(",\x02")), ", ".join(f"{c} string" for c in wide), {"escape": '"'})
    fits = F.array_contains(F.array(*[F.coalesce(cells[c], F.lit("")) for c in wide[:-1]]), "\x02")
    quotes = F.length(BROKEN) - F.length(F.replace(F.col(BROKEN), F.lit('"')))
    fault = (F.when(F.col(BROKEN).isNull(), None)
             .when(quotes % 2 == 1, F.lit("A quoted value goes over a line end (read with multi_line=True): "))
             .when(~fits, F.lit(f"More than {len(header)} fields: ")))
    df = df.where(F.when(fault.isNotNull(), F.raise_error(F.concat_ws("", fault, F.lit("["), f"`{header[0]}`", F.lit("] "), BROKEN)).cast("boolean")).otherwise(True))
    return df.select(*[F.when(F.col(f"`{c}`").isin(*NA_TOKENS), None).otherwise(F.col(f"`{c}`")).alias(c)
                       for c in header], FILE)


def validate_schema(df: DataFrame) -> None:
    """Required columns present and at least one row; raises SchemaValidationError."""
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise SchemaValidationError(f"Missing required columns: {missing}")
    if df.isEmpty():
        raise SchemaValidationError("Dataset is empty")


def validate_not_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise SchemaValidationError("Dataset has zero rows")


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMA)


#: The largest file that one task digests; beyond, the digest is a tree over the lines.
WHOLE_FILE = (1 << 31) - 1 - (1 << 20)
#: Files that the line readers would unpack: their bytes are read whole.
PACKED = ("gz", "bz2", "deflate", "lz4", "snappy", "zst", "zstd", "passthrough")


def ingest_metadata(spark: SparkSession, path: str, source: str = "file", multi_line: bool | str = False) -> DataFrame:
    """One row per file (told by its path): source, ingest time, file name,
    row/column count, sha256, the kind of that digest, and the path.

    ``digest_kind`` is ``sha256`` where the digest is of the file's bytes (one
    task per file, which holds a batch of its lines at a time), and ``sha256-lines`` for files beyond ``WHOLE_FILE``: there
    it is ``records.tree_digest`` of the lines in order, with the length of the
    file; it is computed from splits and does not depend on them."""
    name = F.element_at(F.split(F.col("path"), "/"), -1).alias("filename")
    found = spark.read.format("binaryFile")
    files = found.load(path).select(F.col("_metadata.file_path").alias("path"), name, "length")
    packed = found.option("pathGlobFilter", f"*.{{{','.join(PACKED)}}}").load(path).where(F.col("length") <= WHOLE_FILE)
    packed = packed.select(F.col("_metadata.file_path").alias("file"), F.sha2("content", 256).alias("sha256"))
    own = packed.unionByName(file_digests(spark, path, WHOLE_FILE, PACKED))
    digests = files.where(F.col("length") <= WHOLE_FILE).join(own, F.col("path") == F.col("file"), "left").select(
        "path", "filename", "sha256", F.lit("sha256").alias("digest_kind"))
    large = files.where(F.col("length") > WHOLE_FILE).select("path", "filename", "length")
    if large.limit(1).count():
        lines = numbered_lines(spark, path)
        lines = lines.join(F.broadcast(large.select(F.col("path").alias("of"))), F.col("file") == F.col("of"), "left_semi")
        tree = tree_digest(lines.select("file", "line", F.col("value").cast("binary").alias("value")), ["file"])
        tree = large.join(tree, F.col("path") == F.col("file")).select("path", "filename", F.sha2(
            F.concat_ws(":", "digest", F.col("length").cast("string")), 256).alias("sha256"), F.lit("sha256-lines").alias("digest_kind"))
        digests = digests.unionByName(tree)
    df = _raw_rows(spark, path, multi_line)
    rows = df.groupBy(FILE).agg(F.count(F.lit(1)).alias("row_count"))
    return (digests.join(rows, F.col("path") == F.col(FILE), "left")
            .select(F.lit(source).alias("source"), F.current_timestamp().alias("ingested_at"), "filename",
                    F.coalesce("row_count", F.lit(0)).alias("row_count"),
                    F.lit(len(df.columns) - 1).cast("bigint").alias("column_count"), "sha256", "digest_kind", "path"))
