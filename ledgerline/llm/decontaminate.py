"""Benchmark decontamination by winnowing, in DataFrame functions only.

A *window* is ``span`` consecutive item words (an item of fewer, but not none,
is one window). Every window of ``span`` words holds ``span - k + 1`` k-grams;
its fingerprint is their least hash. Equal windows have equal fingerprints, so
a join on fingerprints misses no shared window (the winnowing guarantee).
Neighbouring windows mostly share their least k-gram: a document therefore
sends one row per *run* of windows with the same fingerprint. Runs whose
fingerprint the benchmark has are extended word by word: each window of the
run is compared as text, and the equal ones make up the hit spans.

Defined results: a null text has no words; a text without words is clean; a
null id is carried through; repeated rows get the same result each; an empty
benchmark leaves every document clean; extra columns are ignored. Items of the
same text count each under their own id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, content_key, let, upto, word_count, words_column

SPAN, K = 10, 5
#: Up to so many distinct benchmark windows are broadcast (about 150 bytes each); beyond, all joins shuffle.
BROADCAST_WINDOWS = 200_000
#: Their bytes of text and item ids, at most; a window may hold very long words, and an id list may be long.
BROADCAST_BYTES = 64 << 20


def _grams(words: Column, k: int) -> Column:
    return let(words, lambda w: F.transform(
        upto(F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i + 1, F.lit(k)))))


def _fingerprints(words: Column, span: int, k: int) -> Column:
    """The fingerprint of each window of ``span`` words, in order."""
    n = span - k + 1
    return let(_grams(words, k), lambda g: F.transform(
        upto(F.size(g) - (n - 1)), lambda i: F.array_min(F.slice(g, i + 1, F.lit(n)))))


def _runs(words: Column, span: int, k: int) -> Column:
    """(n, fp, first, windows) for each run of windows with one fingerprint."""
    def starts(m: Column) -> Column:
        return F.filter(F.transform(m, lambda x, i: F.when((i == 0) | (x != F.get(m, i - 1)), i)),
                        lambda i: i.isNotNull())

    def rows(m: Column) -> Column:
        return let(starts(m), lambda f: F.transform(f, lambda i, j: F.struct(
            F.lit(span).alias("n"), F.get(m, i).alias("fp"), i.alias("first"),
            (F.coalesce(F.get(f, j + 1), F.size(m)) - i).alias("windows"))))

    return let(_fingerprints(words, span, k), rows)


def _short_runs(words: Column, n: int) -> Column:
    """Windows of items of n words, fewer than a full window: each is its own run."""
    return let(words, lambda w: F.transform(upto(F.size(w) - (n - 1)), lambda i: F.struct(
        F.lit(n).alias("n"), F.xxhash64(F.slice(w, i + 1, F.lit(n))).alias("fp"), i.alias("first"),
        F.lit(1).alias("windows"))))


def benchmark_windows(items: DataFrame, span: int = SPAN, k: int = K, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(n, fp, window, items): each distinct window of n words, its fingerprint
    and the sorted ids of the items that hold it. A null id is left out of the
    lists, but its windows count as hits."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words_column(F.col(text_col)).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(span)))
    w = w.select("item", "n", F.explode(let(F.struct("w", "n"), lambda x: F.transform(
        upto(F.size(x["w"]) - x["n"] + 1), lambda i: F.slice(x["w"], i + 1, x["n"])))).alias("w"))
    return (w.select("item", "n", F.concat_ws(" ", "w").alias("window"),
                     F.when(F.col("n") == span, F.array_min(_grams(F.col("w"), k))).otherwise(
                         F.xxhash64("w")).alias("fp"))
            .groupBy("n", "fp", "window").agg(F.array_sort(F.collect_set("item")).alias("items")))


def hit_windows(docs: DataFrame, bench: DataFrame, span: int = SPAN, k: int = K, broadcast: bool = True) -> DataFrame:
    """(k1, k2, start, n, items): every benchmark window in a document, with the
    position of its first word. ``docs`` has the keys k1, k2 and the words w;
    rows of equal keys have equal words."""
    short = [r.n for r in bench.where(F.col("n") < span).select("n").distinct().collect()]  # at most span - 1 values
    mark = F.broadcast if broadcast else (lambda d: d)
    parts = [_runs(F.col("w"), span, k), *(_short_runs(F.col("w"), n) for n in sorted(short))]
    runs = docs.select("k1", "k2", *["w"] * broadcast, F.inline(F.concat(*parts) if short else parts[0]))
    hit = runs.join(mark(bench.select("n", "fp").distinct()), ["n", "fp"], "left_semi")
    if not broadcast:  # only narrow rows are shuffled; hit documents get their words again
        d = docs.select(F.col("k1").alias("d1"), F.col("k2").alias("d2"), "w")
        hit = hit.distinct().join(d, (F.col("k2") == F.col("d2")) & F.col("k1").eqNullSafe(F.col("d1")))
    hit = hit.select("k1", "k2", "w", "n", F.explode(F.sequence(
        F.col("first"), F.col("first") + F.col("windows") - 1)).alias("start"))
    hit = hit.select("k1", "k2", "n", "start", F.concat_ws(" ", F.slice("w", F.col("start") + 1, F.col("n"))).alias("window"))
    return hit.join(mark(bench.select("n", "window", "items")), ["n", "window"]).select("k1", "k2", "start", "n", "items")


def covered_spans(at: Column) -> Column:
    """Maximal (a, b) word ranges covered by windows (start, n)."""
    words = F.array_sort(F.array_distinct(F.flatten(F.transform(
        at, lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1)))))
    return let(words, lambda p: F.arrays_zip(
        F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) < x - 1)).alias("a"),
        F.transform(F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) > x + 1)), lambda x: x + 1).alias("b")))


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  broadcast_windows: int = BROADCAST_WINDOWS, broadcast_bytes: int = BROADCAST_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: (id, n_words, n_hit, items, spans) and the
    columns named in ``carry``. ``items`` are the sorted ids as strings,
    ``spans`` the maximal hit ranges (a: first word, b: end word)."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    bench = scratch.table(benchmark_windows(items, span, k, item_col, item_text), "bench")
    n, size = bench.agg(F.count(F.lit(1)), F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", ",")))).first()
    few = n <= broadcast_windows and (size or 0) <= broadcast_bytes
    text = F.col(text_col)
    keyed = docs.select(F.col(id_col).cast("string").alias("k1"), content_key(text).alias("k2"), words_column(text).alias("w"))
    found = hit_windows(keyed, bench, span, k, few).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", "n")).alias("at"), F.collect_set("items").alias("sets"))
    found = scratch.table(found.select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), covered_spans(F.col("at")).alias(
        "spans"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items")), "found")
    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("k1"), content_key(text).alias("k2"),
                       word_count(text).cast("long").alias("n_words"), F.struct(*carry).alias("own"))
    out = rows.join(found, (F.col("k2") == F.col("f2")) & F.col("k1").eqNullSafe(F.col("f1")), "left")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["b"] - x["a"]).cast("long"))
    return out.select("id", "n_words", F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("spans"),
                      *[F.col("own").getField(c).alias(c) for c in carry])
