"""Text files read in splits, with what needs the order of their lines: records
that go over line ends, line numbers, and a digest that merges.

The text source gives each split's lines in order, with the split's place in
its file. One short aggregation counts per split (quotes, lines); a running sum
over a file's splits, of which there are as many as the file has blocks, then
tells every split where it begins: inside quotes or not, and with which line
number. That table is joined back to the lines without moving them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.materialize import materialize, table_path
from ledgerline.session import ship_package

#: Lines that one node of the digest's lowest level covers.
LEAVES = 1 << 16


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, id, value): lines (ended by line feeds), ids ascending within a split, without gaps."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), "value")


def split_sums(lines: DataFrame, **sums: Column) -> DataFrame:
    """(f, p, first): the splits of the lines' files with their first id; and, per name, the sum over all earlier splits of the file."""
    each = lines.groupBy(F.col("file").alias("f"), F.col("split").alias("p")).agg(
        F.min("id").alias("first"), *[c.alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy("f").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("f", "p", "first", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(n) for n in sums])


def with_splits(lines: DataFrame, each: DataFrame) -> DataFrame:
    """The lines with the other columns of their splits (f, p)."""
    out = lines.join(F.broadcast(each), (F.col("file") == F.col("f")) & (F.col("split") == F.col("p")), "left")
    # both scans must cut the files alike; a change of the session's parallelism in between would show here
    known = F.when(F.col("first").isNull(), F.raise_error(F.lit("The files were split in another way meanwhile; read them again")).cast("boolean")).otherwise(True)
    return out.where(known).drop("f", "p")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): line numbers from 0 per file, whatever its splits are."""
    lines = split_lines(spark, path)
    lines = with_splits(lines, split_sums(lines, before=F.count(F.lit(1))))
    return lines.select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line"), "value")


def tree_digest(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, digest) of rows (keys, line, value): the SHA-256 of each value, of
    these digests (as hexadecimal text, in line order) for each ``LEAVES``
    lines, and of those for each group. Nodes merge in any order of arrival, but
    another order of lines is another digest; a group is never gathered, only
    its nodes are."""
    def level(df: DataFrame, by: list[Column | str], order: str) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("digest").alias("d"))))
        return df.groupBy(*by).agg(F.sha2(F.array_join(F.transform(parts, lambda x: x["d"]), ""), 256).alias("digest"))

    leaf = lines.select(*keys, "line", F.sha2("value", 256).alias("digest"))
    nodes = level(leaf, [*keys, F.floor(F.col("line") / F.lit(LEAVES)).alias("node")], "line")
    return level(nodes, keys, "node")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, size, value) lines of whole files in order -> (file, sha256) of the files' bytes.

    The line reader drops the last line feed and a byte order mark; the size
    tells whether they were there (null for a file that it changed otherwise)."""
    mark, at, size, fed, plain, marked = b"\xef\xbb\xbf", None, 0, 0, None, None

    def ended() -> pa.RecordBatch:
        short = size - fed - len(mark) if size - fed >= len(mark) else size - fed
        digest = plain if size - fed < len(mark) else marked
        if short == 1:
            digest.update(b"\n")
        return pa.record_batch([pa.array([at]), pa.array([digest.hexdigest() if short in (0, 1) else None], pa.string())],
                               ["file", "sha256"])

    for b in batches:
        files = b.column("file")
        i = 0
        while i < len(files):
            file = files[i].as_py()
            same = pc.index(pc.not_equal(files.slice(i), file), True).as_py()
            n = len(files) - i if same < 0 else same
            if file != at:
                if at is not None:
                    yield ended()
                at, size, fed = file, b.column("size")[i].as_py(), 0
                plain, marked = hashlib.sha256(), hashlib.sha256(mark)
            else:
                plain.update(b"\n"), marked.update(b"\n")
                fed += 1
            data = b"\n".join(b.column("value").slice(i, n).to_pylist())
            plain.update(data), marked.update(data)
            fed, i = fed + len(data), i + n
    if at is not None:
        yield ended()


def file_digests(spark: SparkSession, path: str, largest: int, packed: tuple[str, ...]) -> DataFrame:
    """(file, sha256) of the bytes of each file of at most ``largest`` bytes that
    has a line and no ``packed`` ending, written: one task reads a file's lines
    in order and holds a batch of them at a time."""
    ship_package(spark)
    # a session of its own, as files are not split here: as many partitions as files
    whole = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if whole.conf.isModifiable(k):
            whole.conf.set(k, v)
    whole.conf.set("spark.sql.files.maxPartitionBytes", str(largest + 1))
    whole.conf.set("spark.sql.files.openCostInBytes", str(largest + 1))
    name, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    lines = whole.read.option("lineSep", "\n").text(path).where(size <= largest).where(~name.rlike(rf"\.({'|'.join(packed)})$"))
    lines = lines.select(name.alias("file"), size.alias("size"), F.col("value").cast("binary").alias("value"))
    out = table_path(lines, "digests")
    lines.mapInArrow(_digest, "file string, sha256 string").write.parquet(out)
    return spark.read.schema("file string, sha256 string").parquet(out)


def _assemble(pieces: bool) -> Callable:
    """(split, open, value) lines in order, with their split's number -> (split, place, part, text).

    part 0: a whole record; 1: the beginning of one that the split does not end;
    2: the end of one, or a middle, that the split did not begin. ``place``
    numbers a split's records. Only pieces (parts 1 and 2), or only whole
    records, are given. Lines that are records by themselves stay in their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, held, place, begun = None, False, [], 0, True

        def rest() -> list[tuple]:
            return [(at, place, 1 if begun else 2, "\n".join(held))] if held and pieces else []

        for b in batches:
            split = b.column(0).to_numpy()
            starts = np.flatnonzero(np.diff(split, prepend=-1, append=-1)).tolist()
            for i, j in zip(starts, starts[1:]):
                own = int(split[i])
                if own != at:
                    if left := rest():
                        yield _records(left)
                    start = bool(b.column(1)[i].as_py() % 2)
                    at, inside, held, place, begun = own, start, [], 0, not start
                value = b.column(2).slice(i, j - i)
                odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) % 2
                after = (np.cumsum(odd) + inside) % 2 > 0
                # the lines at which records end; one that begins where the last line ended one is whole
                ends = np.flatnonzero(~after)
                begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
                out = []
                if len(ends) and (held or not begun):  # what earlier lines began
                    text = "\n".join([*held, *value.slice(0, int(ends[0]) + 1).to_pylist()])
                    if begun != pieces:
                        out.append((at, place, 0 if begun else 2, text))
                    held, begun, place, begins, ends = [], True, place + 1, begins[1:], ends[1:]
                if not pieces and len(ends):
                    alone = begins == ends
                    places = place + np.arange(len(ends))
                    lines = value.take(pa.array(ends[alone]))
                    yield pa.record_batch([pa.array(np.full(len(lines), own)), pa.array(places[alone]),
                                           pa.array(np.zeros(len(lines), np.int32)), lines], _RECORD)
                    out += [(own, int(p), 0, "\n".join(value.slice(int(x), int(y) - int(x) + 1).to_pylist()))
                            for x, y, p in zip(begins[~alone], ends[~alone], places[~alone])]
                place += len(ends)
                done = np.flatnonzero(~after)
                held += value.slice(int(done[-1]) + 1 if len(done) else 0).to_pylist()
                inside = bool(after[-1])
                if out:
                    yield _records(out)
        if left := rest():
            yield _records(left)
    return run


_RECORD = ["split", "place", "part", "text"]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _RECORD)


def _quotes(of: str = "text") -> Column:
    return F.length(of) - F.length(F.replace(F.col(of), F.lit('"'), F.lit("")))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, text, closed): the records of quoted text files, whose quoted values
    may go over line ends; ``first`` marks the first record of a file, ``closed``
    those whose quotes are. A split knows from the quotes before it whether it begins
    inside a value. Pieces of records that go over splits, two a split at most,
    are written and put together apart."""
    ship_package(spark)
    lines = split_lines(spark, path)
    each = split_sums(lines, open=F.sum(_quotes("value")))
    each = materialize(each.withColumn("no", F.monotonically_increasing_id()), "splits")
    lines = with_splits(lines, each).select("no", "open", "value")
    kind = "no long, place long, part int, text string"
    of = F.broadcast(each.select(F.col("no").alias("of"), F.col("f").alias("file"), F.col("p").alias("split")))
    whole, some = (lines.mapInArrow(_assemble(pieces), kind).join(of, F.col("no") == F.col("of")) for pieces in (False, True))
    whole = whole.select("file", ((F.col("split") == 0) & (F.col("place") == 0)).alias("first"), "text", F.lit(True).alias("closed"))
    order = Window.partitionBy("file").orderBy("split", "place")
    some = materialize(some.select("file", "split", "place", "part", "text"), "pieces")
    some = some.withColumn("record", F.sum(F.when(F.col("part") == 1, 1).otherwise(0)).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("split", "place", "text")))
    joined = some.groupBy("file", "record").agg(F.min(F.struct("split", "place")).alias("at"), pieces.alias("own"))
    joined = joined.select("file", ((F.col("at.split") == 0) & (F.col("at.place") == 0)).alias("first"),
                           F.array_join(F.transform("own", lambda x: x["text"]), "\n").alias("text"))
    joined = joined.withColumn("closed", _quotes() % 2 == 0)
    return whole.unionByName(joined).withColumn("text", F.when(F.contains("text", F.lit("\r")), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text")))


def csv_records(spark: SparkSession, path: str, header: list[str], schema: str, broken: str, file: str) -> DataFrame:
    """The records by Spark's CSV parser, with the column ``broken`` as the CSV
    source fills it, and the file. Each file's first record must be the header."""
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    rows = quoted_records(spark, path).where(F.trim("text") != "")
    names = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(header))), {"escape": '"'})
    same = F.array(*[names[f"c{i}"] for i in range(len(header))]) == F.array(*[F.lit(c) for c in header])
    told = F.raise_error(F.concat(F.lit("A file begins with another header: "), "text")).cast("boolean")
    open_ = F.raise_error(F.concat(F.lit("A quoted value is never closed: "), F.substring("text", 1, 200))).cast("boolean")
    rows = rows.where(F.when(~F.col("closed"), open_).when(~F.col("first"), True).when(same, False).otherwise(told))
    # a generator, as the fields of a projected struct would each parse the text
    return rows.select(F.inline(F.array(F.from_csv("text", schema, options))), F.col("file").alias(file))
