"""Exact substring de-duplication: a depth-limited radix sort of suffixes.

Two suffixes matter to each other only if their first ``threshold`` bytes are
equal, so the sort goes by digits, most significant first, and stops there;
groups of equal suffixes are the repeated windows. A pass keeps only groups of
two or more.

* Digit 0 is the window's *minimiser*: the least hash of its ``k``-byte grams.
  Equal windows have equal minimisers at the same place, so no repeated window
  is lost. Neighbouring windows mostly share it; they travel as one *run*.
* Digit 1 is the run's whole context (all bytes of its windows). Equal contexts
  mean that all windows of the run repeat: copies, however many, are settled
  here by a count that is pre-aggregated before the shuffle.
* Only where one minimiser has several different contexts, one run of each is
  cut into *cells* of ``cell`` neighbouring windows (aligned to the minimiser).
  Digit 2 is a cell's core, the bytes that all its windows share: a cell whose
  core occurs in no other context has no repeated window. Digit 3 is all its
  bytes: equal cells repeat as a whole. Digit 4, for the few cells left (the
  ends of repeated passages), is the single window.

All counts are pre-aggregated before the shuffle; no group is gathered anywhere.

Digits are 64-bit fingerprints of bytes (two windows are taken as equal when
minimiser and all digits agree). Bytes are judged on the input and removed
wherever a repeated window covers them.

Defined results: null and empty texts have no bytes and keep the digest of the
empty string; texts shorter than the threshold keep everything; rows that are
repeated (same id and text) are other places of the same string, so they lose
it all; null ids are carried; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, free_shuffles, mix, powers, prefix_hash, python_ready, slices, string_buffer, signed

THRESHOLD, CELL, PIECE = 400, 10, 1 << 20
_U = np.uint64
_LOW = _U((1 << 24) - 1)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every w neighbours, by block prefixes and suffixes."""
    n = len(x) - w + 1
    blocks = -(-len(x) // w)
    a = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    a[: len(x)] = x
    a = a.reshape(blocks, w)
    right = np.minimum.accumulate(a, axis=1).ravel()
    left = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[w - 1: w - 1 + n])


def runs(buf: np.ndarray, off: np.ndarray, threshold: int = THRESHOLD, k: int = THRESHOLD // 2) -> tuple[np.ndarray, ...]:
    """(row, first window, windows, place of the minimiser in the first window,
    minimiser, context) of every run of the rows."""
    n = len(buf)
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if n < threshold:
        return none
    s = prefix_hash(buf.astype(np.uint64) + _U(1))
    inv = powers(n)[1]
    with np.errstate(over="ignore"):
        h = mix((s[k:] - s[:-k]) * inv[: n - k + 1])
    at = np.arange(len(h), dtype=np.uint64)
    best = sliding_min((h & ~_LOW) | (_LOW - at), threshold - k + 1)
    arg = (_LOW - (best & _LOW)).astype(np.int64)
    start = np.arange(len(arg))
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(arg)]
    ok = start + threshold <= off[row + 1]
    new = ok & np.concatenate(([True], ~ok[:-1] | (arg[1:] != arg[:-1])))
    first = np.flatnonzero(new)
    if not len(first):
        return none
    last = np.flatnonzero(ok & np.concatenate((~ok[1:] | (arg[1:] != arg[:-1]), [True])))
    a = arg[first]
    with np.errstate(over="ignore"):
        c = mix((s[last + threshold] - s[first]) * inv[first])
        c = mix(c + ((last - first) << 24 | (a - first)).astype(np.uint64))
    return row[first], first - off[row[first]], last - first + 1, a - first, h[a], c


def _run_rows(threshold: int, k: int) -> Callable:
    names = ["r1", "r2", "first", "n", "o", "h", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", PIECE):
                buf, off = string_buffer(b.column(2))
                r1, r2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                step = len(buf) if b.num_rows > 1 else PIECE  # one long text goes in overlapping pieces
                for lo in range(0, max(len(buf), 1), max(step, 1)):
                    part = buf[lo: lo + step + (threshold - 1 if b.num_rows == 1 else 0)]
                    row, first, n, o, h, c = runs(part, off if b.num_rows > 1 else np.array([0, len(part)]), threshold, k)
                    if len(row):
                        yield pa.record_batch([pa.array(x) for x in (
                            r1[row], r2[row], first + lo, n, o, signed(h), signed(c))], names)
    return run


RUN = "r1 long, r2 long, first long, n long, o long, h long, c long"


def _context_rows(threshold: int) -> Callable:
    """(text, places) -> the bytes of each context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, ctx in zip(b.column(0), b.column(1)):
                data, rows = (text.as_py() or "").encode(), ctx.as_py()
                for i in range(0, len(rows), 4000):
                    part = rows[i: i + 4000]
                    yield pa.record_batch([pa.array([x[f] for x in part], pa.int64()) for f in ("h", "c", "o", "n")] + [pa.array(
                        [data[x["first"]: x["first"] + x["n"] + threshold - 1] for x in part], pa.binary())], ["h", "c", "o", "n", "bytes"])
    return run


def _sums(s: np.ndarray, inv: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of the bytes [a, b)."""
    with np.errstate(over="ignore"):
        return signed(mix((s[b] - s[a]) * inv[a] + (b - a).astype(np.uint64)))


def _cell_rows(threshold: int, cell: int) -> Callable:
    """Contexts -> (h, c, i, j, n, core, whole): cell i has the n windows from j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, c, o, n, data in zip(*(x.to_pylist() for x in b.columns)):
                s, inv = prefix_hash(np.frombuffer(data, np.uint8).astype(np.uint64) + _U(1)), powers(len(data))[1]
                i = np.arange(o // cell, (o - n + 1) // cell - 1, -1)  # the minimiser is o bytes into the first window
                j = np.maximum(o - (i * cell + cell - 1), 0)
                end = np.minimum(o - i * cell, n - 1)
                core = o - i * cell
                out.append((np.full(len(i), h), np.full(len(i), c), i, j, end - j + 1,
                            _sums(s, inv, core, core - (cell - 1) + threshold), _sums(s, inv, j, end + threshold)))
            if out:
                yield _columns(out, ["h", "c", "i", "j", "n", "core", "whole"])
    return run


def _window_rows(threshold: int) -> Callable:
    """(context, cells) -> (h, c, j, at, window, open) of every window of the cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, c, o, data, cells in zip(*(x.to_pylist() for x in b.columns)):
                s, inv = prefix_hash(np.frombuffer(data, np.uint8).astype(np.uint64) + _U(1)), powers(len(data))[1]
                j = np.concatenate([np.arange(x["j"], x["j"] + x["n"]) for x in cells])
                open_ = np.repeat([x["open"] for x in cells], [x["n"] for x in cells])
                out.append((np.full(len(j), h), np.full(len(j), c), j, o - j, _sums(s, inv, j, j + threshold), open_))
            if out:
                yield _columns(out, ["h", "c", "j", "at", "window", "open"])
    return run


def _columns(out: list, names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out)], names)


def _shared(rows: DataFrame, digits: list[str], name: str, scratch: Scratch) -> DataFrame:
    """The digit groups (columns x_<digit>, least) that two contexts share."""
    g = rows.groupBy(*digits).agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least != most")
    return scratch.table(g.select(*[F.col(d).alias(f"x_{d}") for d in digits], "least"), name)


def _on(digits: list[str]):
    return F.expr(" AND ".join(f"{d} = x_{d}" for d in digits))


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a:bigint,b:bigint>>, kept string"


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cutter(keep_text: bool) -> Callable:
    fields = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("kept", pa.string())])

    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for t, x in zip(text, spans):
            data = (t.as_py() or "").encode()
            gone = union([(y["a"], y["b"]) for y in x.as_py() or []])
            at, kept = 0, []
            for a, b in gone:
                kept.append(data[at:a])
                at = b
            left = b"".join([*kept, data[at:]])
            rows.append({"n_bytes": len(data), "n_removed": len(data) - len(left), "n_spans": len(gone),
                         "kept_sha256": hashlib.sha256(left).hexdigest(), "spans": [{"a": a, "b": b} for a, b in gone],
                         "kept": left.decode("utf-8", "ignore") if keep_text else None})
        return pa.array(rows, fields)
    return cut


def repeated_spans(docs: DataFrame, threshold: int, k: int, cell: int, scratch: Scratch) -> DataFrame:
    """(r1, r2, spans): for each document reference the byte ranges (a, b) of
    its repeated windows. ``docs`` has r1, r2 and text."""
    spark = docs.sparkSession
    rows = scratch.table(docs.select("r1", "r2", "text").where(F.octet_length("text") >= threshold)
                         .mapInArrow(_run_rows(threshold, k), RUN), "runs")
    # digit 0: minimisers that occur twice or more
    twice = rows.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("h").alias("h0"))
    twice = scratch.table(twice, "twice")
    free_shuffles(spark)
    again = scratch.table(rows.join(twice, F.col("h") == F.col("h0"), "left_semi"), "again")
    scratch.drop("runs")
    scratch.drop("twice")
    # digit 1: contexts; one place of each stands for all
    ctx = again.groupBy("h", "c").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("r1", "r2", "first", "n", "o")).alias("at"))
    ctx = scratch.table(ctx, "contexts")
    several = ctx.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("h").alias("h0"))
    mixed = ctx.join(scratch.table(several, "several"), F.col("h") == F.col("h0"), "left_semi")
    places = mixed.select("h", "c", "at.*").groupBy(F.col("r1").alias("p1"), F.col("r2").alias("p2")).agg(
        F.collect_list(F.struct("first", "n", "o", "h", "c")).alias("ctx"))
    text = docs.select("r1", "r2", "text").where(F.octet_length("text") >= threshold)
    text = text.join(scratch.table(places, "places"), (F.col("r1") == F.col("p1")) & (F.col("r2") == F.col("p2")))
    data = text.select("text", "ctx").mapInArrow(_context_rows(threshold), "h long, c long, o long, n long, bytes binary")
    data = scratch.table(data, "data")
    scratch.drop("places")
    free_shuffles(spark)
    # digits 2 and 3: the cores and the bytes of cells
    cells = scratch.table(data.mapInArrow(_cell_rows(threshold, cell), "h long, c long, i long, j long, n long, core long, whole long"), "cells")
    core, whole = ["h", "i", "core"], ["h", "i", "whole"]
    cells = cells.join(_shared(cells, core, "cores", scratch), _on(core), "left_semi")
    cells = scratch.table(cells, "live")
    cells = cells.join(_shared(cells, whole, "wholes", scratch), _on(whole), "left").drop("x_h", "x_i", "x_whole")
    cells = scratch.table(cells, "marked")  # least: the context that speaks for equal cells, null for a cell of its own
    free_shuffles(spark)
    # digit 4: single windows of the cells left, compared with one of each kind that has their core
    left = scratch.table(cells.where("least IS NULL").select(*[F.col(d).alias(f"x_{d}") for d in core]).distinct(), "open")
    part = cells.where("least IS NULL OR least = c").join(left, _on(core), "left_semi").groupBy(
        F.col("h").alias("x_h"), F.col("c").alias("x_c")).agg(
        F.collect_set(F.struct("j", "n", F.col("least").isNull().alias("open"))).alias("cells"))
    windows = data.join(scratch.table(part, "parts"), _on(["h", "c"])).select("h", "c", "o", "bytes", "cells")
    windows = scratch.table(windows.mapInArrow(_window_rows(threshold), "h long, c long, j long, at long, window long, open boolean"), "windows")
    digits = ["h", "at", "window"]
    equal = windows.where("open").join(_shared(windows, digits, "equal", scratch), _on(digits), "left_semi")
    # back to the documents: whole runs, whole cells, single windows
    kind = F.struct(F.col("j").alias("a"), (F.col("j") + F.col("n") + (threshold - 1)).alias("b"))
    own = cells.where("least IS NOT NULL").select("h", "c", kind.alias("s")).union(
        equal.withColumn("n", F.lit(1)).select("h", "c", kind.alias("s")))
    own = own.groupBy(F.col("h").alias("x_h"), F.col("c").alias("x_c")).agg(F.collect_set("s").alias("s"))
    alone = ctx.where("m = 1").select("h", "c")
    whole_runs = ctx.where("m > 1").select(F.col("h").alias("x_h"), F.col("c").alias("x_c"), F.array(
        F.struct(F.lit(0).cast("long").alias("a"), (F.col("at.n") + (threshold - 1)).alias("b"))).alias("s"))
    found = scratch.table(own.join(alone, _on(["h", "c"]), "left_semi").unionByName(whole_runs), "found")
    for old in ("cells", "live", "marked", "windows", "data", "contexts", "parts"):
        scratch.drop(old)
    free_shuffles(spark)
    hit = again.join(found, _on(["h", "c"])).select("r1", "r2", F.transform(
        "s", lambda x: F.struct((F.col("first") + x["a"]).alias("a"), (F.col("first") + x["b"]).alias("b"))).alias("s"))
    out = scratch.table(hit.groupBy("r1", "r2").agg(F.flatten(F.collect_set("s")).alias("spans")), "spans")
    scratch.drop("again")
    free_shuffles(spark)
    return out


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                   k: int | None = None, cell: int = CELL, keep_text: bool = True) -> DataFrame:
    """Per row: id and RESULT (spans: maximal removed byte ranges; kept: the
    text that is left, or null with keep_text=False)."""
    python_ready(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "suffix")
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    d = d.select("id", F.xxhash64("id").alias("r1"), F.xxhash64("text").alias("r2"), "text")
    spans = repeated_spans(d, threshold, k or threshold // 2, min(cell, threshold // 2), scratch)
    spans = spans.withColumnsRenamed({"r1": "s1", "r2": "s2"})
    out = d.join(spans, (F.col("r1") == F.col("s1")) & (F.col("r2") == F.col("s2")), "left")
    cut = F.arrow_udf(_cutter(keep_text), f"struct<{','.join(':'.join(c.split(' ', 1)) for c in RESULT.split(', '))}>")
    return out.select("id", cut("text", "spans").alias("r")).select("id", "r.*")
