"""What the operators of this subpackage share: scratch tables in the shared
checkpoint folder, content keys, and byte-level word hashing in numpy.

A *word* is a run of bytes that are digits, letters or non-ASCII after A-Z is
lower-cased, that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
NO_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_GAPS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


class Scratch:
    """Parquet tables under ``spark.checkpoint.dir`` of one query; a written
    table cuts the lineage, so the loss of an executor replays one step only."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that are done:
    it acts when the driver's JVM collects its garbage."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: An Arrow batch: a task holds it several times, in the JVM (whose buffers double as they grow, and are pooled) and in Python.
ARROW_BYTES = 4 << 20


def python_ready(spark: SparkSession) -> None:
    """Ship the package, and bound Arrow batches by bytes: rows of long texts
    would not fit a worker's memory by the thousand."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, f"{(1 << 31) - 1}").lower().rstrip("b") == f"{(1 << 31) - 1}":  # not set
        spark.conf.set(key, str(ARROW_BYTES))


def words_column(text: Column) -> Column:
    """The words of a text; a null text has none. One pass lower-cases A-Z and
    blanks what is no word, which is cheaper than matching words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + _GAPS, LOWER + " " * len(_GAPS))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    """The number of words (case does not matter for it)."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), NO_WORD), ""))


def content_key(text: Column) -> Column:
    """A 128-bit key of the text; null and the empty text share one."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> _U(30))) * _M1
        x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.arange(256, dtype=np.uint8)
    low = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint8)
    word = ((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 122)) | (low >= 128)
    return low, word, mix(low.astype(np.uint64) + _U(77))


LOW, IS_WORD, BYTE_CODE = _tables()
_BASE = _U(0xD1342543DE82EF95)
_INV = _U(pow(0xD1342543DE82EF95, -1, 1 << 64))
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0.. and base^-0.. modulo 2^64, n + 1 of each at least."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POW:
        _POW.clear()
        out = []
        for step in (_BASE, _INV):
            a = np.full(size + 1, step, np.uint64)
            a[0] = 1
            with np.errstate(over="ignore"):
                out.append(np.multiply.accumulate(a))
        _POW[size] = (out[0], out[1])
    return _POW[size]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """s with s[j] - s[i] = sum of codes[x] * base^x over i <= x < j."""
    s = np.zeros(len(codes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(codes * powers(len(codes))[0][: len(codes)], out=s[1:])
    return s


def string_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column, and where each row begins
    (n + 1 offsets); a null row is empty."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset: a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None and len(a) else np.zeros(0, np.uint8)
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[off[0]: off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte) of every word of the rows, and the number of
    words before each row (n + 1 offsets); a word never crosses rows."""
    m = IS_WORD[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    pad = np.concatenate(([False], m, [False]))
    start = np.flatnonzero(m & (~pad[:-2] | cut[:-1]))
    end = np.flatnonzero(m & (~pad[2:] | cut[1:])) + 1
    return start, end, np.searchsorted(start, off)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each (lower-cased) span, in pieces of bounded memory."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + piece, "right")))
        hi = end[j - 1]
        s = prefix_hash(BYTE_CODE[buf[lo:hi]])
        _, inv = powers(hi - lo)
        a, b = start[i:j] - lo, end[i:j] - lo
        with np.errstate(over="ignore"):
            out[i:j] = mix((s[b] - s[a]) * inv[a] + (b - a).astype(np.uint64))
        i = j
    return out


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of the rows, and the number of words before each row."""
    buf, off = string_buffer(column)
    start, end, words = word_spans(buf, off)
    return span_hashes(buf, start, end), words


def shingles(h: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of each row, in order, and the number
    before each row. A row of fewer words, but not none, is one shingle."""
    n = np.diff(words)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.concatenate(([0], np.cumsum(count)))
    total = int(first[-1])
    if not total:
        return np.zeros(0, np.uint64), first
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(total) - first[row] + words[row]
    end = words[row + 1]
    padded = np.concatenate((h, np.zeros(k, np.uint64)))
    out = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            w = np.where(at + j < end, padded[at + j], _U(j))
            out = mix(out * _BASE + w)
    return out, first


def slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text, one row at least."""
    col = batch.column(batch.schema.get_field_index(text))
    _, off = string_buffer(col)
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also where body
    uses it inside a lambda (a column expression would run for each element)."""
    return F.get(F.transform(F.array(value), body), 0)


def upto(n: Column) -> Column:
    """0 .. n - 1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
