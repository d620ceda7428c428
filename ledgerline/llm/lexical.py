"""Ranked lexical search with bag de-duplication.

The items are the queries, all documents are searched. A document is restricted
to the items' vocabulary: its vector of (term, frequency) and its length weight
m are all that its scores depend on. Documents with the same vector and m are
one class (grouped by a hash, and held against each other as bytes, in the same
aggregation; copies collapse before the shuffle). Each class is scored once
against all items through the items' postings, and a task hands on its best
classes per item alone: an item's best documents lie in its best classes, in
the order (score, first id). Only the classes that win are expanded to their
members, in ascending order of ids.

Items are searched in blocks of bounded bytes, so that vocabulary, postings and
weights of a block fit each task; every block meets all documents.

Defined results: ids are integers, and null ids come last; a null text has no
terms; repeated rows of documents count and are ranked each, repeated items are
each answered; an item without terms, or without a document that holds one,
has no row; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import (IS_WORD, LOW, Scratch, free_shuffles, python_ready, slices, string_buffer, word_spans,
                                   words_column)

TOP = 10
#: An item block's bytes of text and number of items, at most (an item is never divided).
BLOCK_BYTES, BLOCK_ITEMS = 4 << 20, 1024
#: Cells of scores, and posting entries, that a task holds at once.
CELLS, ENTRIES = 1 << 21, 1 << 22
LAST = np.iinfo(np.int64).max


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all rows, A-Z lower-cased, and the number before each row (n + 1)."""
    buf, off = string_buffer(column)
    start, end, first = word_spans(buf, off)
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    data = LOW[buf[IS_WORD[buf]]]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())), first


def _vectors(vocabulary: list[str]) -> Callable:
    """(id, text) -> (id, n, vec): the number of terms, and (term, frequency) as pairs of 32 bits in term order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_string())
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                terms, first = terms_of(b.column(1))
                at = pc.index_in(terms, value_set=known)
                held = np.flatnonzero(np.asarray(at.is_valid()))
                row = np.searchsorted(first, held, "right") - 1
                code = row * max(len(vocabulary), 1) + at.drop_null().to_numpy().astype(np.int64)
                code, tf = np.unique(code, return_counts=True)
                row, term = np.divmod(code, max(len(vocabulary), 1))
                pairs = np.stack((term, tf), axis=1).astype("<u4")
                ends = 8 * np.searchsorted(row, np.arange(b.num_rows + 1))
                vec = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [
                    None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(pairs.tobytes())])
                yield pa.record_batch([b.column(0), pa.array(np.diff(first).astype(np.int64)), vec.cast(pa.binary())], ["id", "n", "vec"])
    return run


def pairs_of(vec: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, frequencies, where each row begins) of vectors."""
    vec = vec.cast(pa.large_binary())
    off = np.frombuffer(vec.buffers()[1], np.int64)[vec.offset: vec.offset + len(vec) + 1] if len(vec) else np.zeros(1, np.int64)
    data = np.frombuffer(vec.buffers()[2], "<u4")[off[0] // 4: off[-1] // 4].astype(np.int64) if off[-1] > off[0] else np.zeros(0, np.int64)
    return data[::2], data[1::2], (off - off[0]) // 8


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec, size) -> (term, df) as far as a batch goes."""
    for b in batches:
        term, _, off = pairs_of(b.column(0))
        size = np.repeat(b.column(1).to_numpy(), np.diff(off))
        kinds, at = np.unique(term, return_inverse=True)
        df = np.zeros(len(kinds), np.int64)
        np.add.at(df, at, size)
        yield pa.record_batch([pa.array(kinds), pa.array(df)], ["term", "df"])


class Postings:
    """The items of a block by term, with each term's weight; all arrays of integers."""

    def __init__(self, items: list[list[str]], vocabulary: list[str]):
        number = {t: i for i, t in enumerate(vocabulary)}
        code = [number[t] * len(items) + j for j, terms in enumerate(items) for t in terms]
        code, self.times = np.unique(np.array(code, np.int64), return_counts=True)
        term, self.item = np.divmod(code, max(len(items), 1))
        self.first = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        self.n_items, self.longest = len(items), max(map(len, items), default=0)
        self.weight = np.zeros(len(vocabulary), np.int64)

    def scores(self, term: np.ndarray, part: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """The matrix of rows x items: for each (row, term), ``part`` times the item's number of that term."""
        n = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell = np.repeat(row, n) * self.n_items + self.item[at]
        value = np.repeat(part, n) * self.times[at]
        if self.longest * int(self.weight.max(initial=0)) * 10**6 < 1 << 53:  # every sum is exact as a double
            out = np.bincount(cell, weights=value, minlength=rows * self.n_items).astype(np.int64)
        else:
            out = np.zeros(rows * self.n_items, np.int64)
            np.add.at(out, cell, value)
        return out.reshape(rows, self.n_items)


def best_of(found: list[np.ndarray], top: int) -> list[np.ndarray]:
    """Of (item, score, first, cid) arrays each item's ``top`` rows: higher scores first, then smaller first ids."""
    item, score, first, cid = found
    order = np.lexsort((cid, first, -score, item))
    item = item[order]
    begin = np.searchsorted(item, item)
    keep = order[np.arange(len(item)) - begin < top]
    return [x[keep] for x in found]


def _scorer(postings: Postings, top: int) -> Callable:
    """(cid, vec, m, first) -> the task's best classes per item."""
    def chunks(off: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, int]]:
        i, n = 0, len(off) - 1
        while i < n:
            j = int(np.searchsorted(reach[off], reach[off[i]] + ENTRIES, "right")) - 1
            j = min(max(j, i + 1), i + max(1, CELLS // max(postings.n_items, 1)), n)
            yield i, j
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64)] * 4
        bar = np.ones(postings.n_items, np.int64)  # what an item's class must reach
        for b in batches:
            term, tf, off = pairs_of(b.column(1))
            cid, m = (b.column(c).to_numpy() for c in (0, 2))
            first = b.column(3).fill_null(LAST).to_numpy()
            part = postings.weight[term] * ((10**9 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(off))))
            reach = np.concatenate(([0], np.cumsum(postings.first[term + 1] - postings.first[term])))
            for i, j in chunks(off, reach):
                its = slice(off[i], off[j])
                row = np.repeat(np.arange(j - i), np.diff(off[i: j + 1]))
                s = postings.scores(term[its], part[its], row, j - i)
                if j - i > top:  # the chunk's own bar keeps its candidates few
                    bar = np.maximum(bar, np.partition(s, j - i - top, axis=0)[j - i - top])
                r, item = np.nonzero(s >= bar)
                new = [item, s[r, item], first[i + r], cid[i + r]]
                best = best_of([np.concatenate(x) for x in zip(best, new)], top)
                full = np.flatnonzero(np.bincount(best[0], minlength=postings.n_items) >= top)
                last = np.searchsorted(best[0], full, "right") - 1
                bar[full] = np.maximum(bar[full], best[1][last])
        yield pa.record_batch([pa.array(x) for x in best], ["item", "score", "first", "cid"])
    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP) -> DataFrame:
    """Per item its ``top`` documents of highest score: item, rank, id, score."""
    spark = docs.sparkSession
    python_ready(spark)
    scratch = Scratch(spark, "lexical")
    text = F.coalesce(F.col(item_text), F.lit(""))
    own = scratch.table(items.select(F.col(item_id).alias("item"), F.monotonically_increasing_id().alias("q"), text.alias("text")), "items")
    size, count = own.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    blocks = max(1, -(-(size or 0) // BLOCK_BYTES), -(-count // BLOCK_ITEMS))
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = []
    for i in range(blocks):
        block = own.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i)
        rows = block.select("q", words_column(F.col("text")).alias("terms")).collect()
        found = search_block(d, [(r.q, r.terms) for r in rows], top, scratch, i)
        out.append(scratch.table(found, f"found{i}"))
        free_shuffles(spark)
    found = reduce(DataFrame.union, out).withColumnRenamed("q", "x")
    return found.join(own.select("item", "q"), F.col("x") == F.col("q")).select("item", "rank", "id", "score")


def search_block(d: DataFrame, items: list[tuple[int, list[str]]], top: int, scratch: Scratch, i: int) -> DataFrame:
    """(q, rank, id, score) of the items (q, terms) over all documents (id, text)."""
    spark = d.sparkSession
    vocabulary = sorted({t for _, terms in items for t in terms})
    vectors = scratch.table(d.mapInArrow(_vectors(vocabulary), "id long, n long, vec binary"), f"vectors{i}")
    n_docs, length = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    n_docs, length = n_docs or 0, max(length or 0, 1)
    # m of the document's length, as exact integers beyond 64 bits
    m = F.expr(f"CAST(25 + (75 * CAST(n AS DECIMAL(19, 0)) * CAST({n_docs} AS DECIMAL(16, 0))) div {length} AS BIGINT)")
    bags = vectors.where("octet_length(vec) > 0").select("id", "vec", m.alias("m")).withColumn("h", F.xxhash64("vec", "m"))
    classes = bags.groupBy("h", "m", "vec").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first"))
    classes = scratch.table(classes.withColumn("cid", F.monotonically_increasing_id()), f"classes{i}")
    free_shuffles(spark)
    postings = Postings([terms for _, terms in items], vocabulary)
    for term, df in classes.select("vec", "size").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(
            F.sum("df").alias("df")).select("term", F.expr(
                f"CAST(floor(1000 * ln(CAST({2 * n_docs + 2} AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)")).collect():
        postings.weight[term] = df
    best = classes.select("cid", "vec", "m", "first").mapInArrow(
        _scorer(postings, top), "item long, score long, first long, cid long").where("score > 0")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "cid")
    best = scratch.table(best.withColumn("at", F.row_number().over(order)).where(F.col("at") <= top).select("item", "score", "cid"), f"best{i}")
    # at most ``top`` classes per item of the block: a broadcast of a bounded size
    won = scratch.table(classes.join(F.broadcast(best.select(F.col("cid").alias("x")).distinct()), F.col("cid") == F.col("x")).drop("x"), f"won{i}")
    hashes = won.where("size > 1").select(F.col("h").alias("of")).distinct()
    member = bags.join(F.broadcast(hashes), F.col("h") == F.col("of"), "left_semi")
    order = Window.partitionBy("h", "m", "vec").orderBy(F.col("id").asc_nulls_last())
    member = member.withColumn("at", F.row_number().over(order)).where(F.col("at") <= top)
    member = member.select("id", F.col("h").alias("mh"), F.col("m").alias("mm"), F.col("vec").alias("mv"))
    member = won.where("size > 1").join(member, (F.col("h") == F.col("mh")) & (F.col("m") == F.col("mm")) & (F.col("vec") == F.col("mv")))
    member = member.select("cid", "id").union(won.where("size = 1").select("cid", "first"))
    found = best.join(member.withColumnRenamed("cid", "x"), F.col("cid") == F.col("x"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    name = spark.createDataFrame([(j, q) for j, (q, _) in enumerate(items)], "j long, q long")
    return found.join(F.broadcast(name), F.col("item") == F.col("j")).select("q", "rank", "id", "score")
