"""Spelling variants by a dictionary of trie-node pairs.

Words that differ by exactly one inserted, deleted or replaced code point are
*near*. The words are put into two tries, of the words and of the reversed
words, whose nodes are numbered: a prefix is one integer, and so is a suffix.
Leaving out position i of a word gives the pair (node of the prefix before i,
node of the suffix after i); cutting a word between two positions gives the
pair of the two parts. Two words with a common *skip* pair differ there by a
replacement; a word whose skip pair is another word's *cut* pair has one code
point more. So one grouping of integer pairs finds every near pair, and nothing
else: there is nothing to verify. A group holds at most one cut word and one
skip word per code point of the alphabet, however frequent its parts are; of
its members only the number and the best other one leave it, not pairs.

The words are range-dealt at boundary words (a bounded sample of the words by
hash), so a task numbers the nodes of its own range from the words in order,
and prefixes of boundary words, which several ranges may share, are numbered
beforehand from the boundaries alone.

Defined results: a null text has no words, a null id counts as the empty
string; repeated rows count again; a word's near word of equal count that comes
first in code-point order wins; an empty table gives no word; extra columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, UPPER, Scratch, free_shuffles, python_ready

#: What ends a run of letters, once A-Z is lower-cased.
NO_LETTER = "[^a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO, TYPO = 6, 5, 5, 199
#: Code points of words in one range, and sampled words per range.
RANGE_POINTS, SAMPLED = 1 << 20, 16
#: Node numbers: those of boundary prefixes lie below, those of range i begin at (i + 1) * SPAN.
SPAN = 1 << 40
#: Rows of a pair group: a word with one position left out (whose code point differs from the one before it, or
#: not), or a word cut in two.
FRESH, REPEAT, CUT = 1, 0, 2


def typed_words(docs: DataFrame, id_col: str, text_col: str, least: int, typo: int) -> DataFrame:
    """(word) per run of letters of ``least`` code points or more; every
    ``typo``-th occurrence (by a checksum of id and run) loses a code point."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("k"), F.explode(F.split(text, NO_LETTER)).alias("w"))
    runs = runs.where(F.length("w") >= least).withColumn("h", F.crc32(F.concat_ws(":", "k", "w")))
    at = (F.col("h") % F.length("w")).cast("int")
    cut = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    words = runs.select(F.when(F.col("h") % typo == 0, cut).otherwise(F.col("w")).alias("word"))
    return words.where(F.length("word") >= least)


def boundaries(words: DataFrame, col: str, points: int) -> list[str]:
    """Words that begin the ranges after the first; a bounded sample by hash decides."""
    n = -(-points // RANGE_POINTS)
    if n < 2:
        return []
    rows = words.select(col).orderBy(F.xxhash64(col), col).limit(SAMPLED * n).collect()
    some = sorted(r[0] for r in rows)
    return sorted(set(some[SAMPLED::SAMPLED]))


def shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def boundary_nodes(bounds: list[str]) -> list[np.ndarray]:
    """The numbers of every boundary's prefixes of 1.. code points; equal prefixes have one number."""
    out, last, free = [], "", 1
    for b in bounds:
        k = shared(last, b)
        out.append(np.concatenate((out[-1][:k] if out else np.zeros(0, np.int64), np.arange(free, free + len(b) - k))).astype(np.int64))
        free += len(b) - k
        last = b
    return out


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, and where each begins (n + 1 offsets)."""
    text = words.to_pylist()
    off = np.concatenate(([0], np.cumsum([len(t) for t in text]))).astype(np.int64)
    return np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32), off


def number_nodes(points: np.ndarray, off: np.ndarray, first: int, edges: list[tuple[str, np.ndarray]]) -> np.ndarray:
    """The node number of every prefix (at the place of its last code point) of
    distinct words in code-point order. A prefix of an edge, that is of a
    boundary word beside this range, has the number given there; the others
    are numbered from ``first``. All words go down the trie together."""
    n = np.diff(off)
    out = np.zeros(len(points), np.int64)
    edge = [(np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32), num, np.ones(len(n), bool)) for w, num in edges]
    row = np.flatnonzero(n > 0)
    same = np.concatenate(([False], np.ones(max(len(row) - 1, 0), bool)))  # as the word before, so far
    d = 0
    while len(row):
        at = off[row] + d
        c = points[at]
        equal = same & np.concatenate(([False], c[1:] == c[:-1]))
        known = np.zeros(len(row), bool)
        node = np.zeros(len(row), np.int64)
        for k, (word, num, on) in enumerate(edge):
            on[row] &= (c == word[d]) if d < len(word) else False
            node = np.where(on[row], num[d] if d < len(word) else 0, node)
            known |= on[row]
        new = ~equal & ~known
        node = np.where(known, node, first + np.cumsum(new) - 1)
        first += int(new.sum())
        out[at] = node
        d += 1
        on_ = n[row] > d
        broken = np.concatenate(([0], np.cumsum(~equal)))  # a word between two that go on parts them
        row = row[on_]
        left = np.flatnonzero(on_)
        same = np.concatenate(([False], broken[left[1:] + 1] == broken[left[:-1] + 1])) if len(left) else np.zeros(0, bool)
    return out


def _range_of(bounds: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = [bisect_right(bounds, w) for w in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(part, pa.int64()), *b.columns], ["part", *b.schema.names])
    return run


def _number(bounds: list[str]) -> Callable:
    """Rows (part, word, r, n) of one range -> (r, n, nodes, fresh); a null r becomes the word's place."""
    def run(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc
        table = table.combine_chunks()
        table = table.take(pc.sort_indices(table.column("word")))  # by bytes, which is by code points
        part, words = table.column("part")[0].as_py(), table.column("word").combine_chunks()
        nums = boundary_nodes(bounds)
        edges = [(bounds[k], nums[k]) for k in (part - 1, part) if 0 <= k < len(bounds)]
        points, off = code_points(words)
        nodes = number_nodes(points, off, (part + 1) * SPAN, edges)
        fresh = np.concatenate(([True], points[1:] != points[:-1])) if len(points) else np.zeros(0, bool)
        fresh[off[:-1][np.diff(off) > 0]] = True
        place = pa.array((part << 33) + np.arange(len(words), dtype=np.int64))
        r = pc.coalesce(table.column("r").combine_chunks(), place)
        at = pa.array(off.astype(np.int32))
        return pa.table({"r": r, "word": words, "n": table.column("n"), "nodes": pa.ListArray.from_arrays(at, pa.array(nodes)),
                         "fresh": pa.ListArray.from_arrays(at, pa.array(fresh))})
    return run


def trie_nodes(words: DataFrame, points: int) -> DataFrame:
    """(r, word, n, nodes, fresh) per row (word, r, n) of distinct words:
    ``nodes[i]`` numbers the prefix of i + 1 code points, ``fresh[i]`` says
    whether code point i differs from the one before it, and a null ``r``
    becomes the word's number in code-point order."""
    bounds = boundaries(words, "word", points)
    dealt = words.select("word", "r", "n").mapInArrow(_range_of(bounds), "part long, word string, r long, n long")
    return dealt.groupBy("part").applyInArrow(_number(bounds), "r long, word string, n long, nodes array<long>, fresh array<boolean>")


def pair_rows(both: DataFrame) -> DataFrame:
    """(p, s, r, n, kind): the integer pairs of every word with one position left out, and of every word cut in two."""
    f = F.concat(F.array(F.lit(0).cast("long")), "nodes")
    g = F.concat(F.array(F.lit(0).cast("long")), "back")
    both = both.select("r", "n", f.alias("f"), g.alias("g"), "fresh", F.size("nodes").alias("len"))
    skip = F.transform("fresh", lambda x, i: F.struct(
        F.get("f", i).alias("p"), F.get("g", F.col("len") - 1 - i).alias("s"), F.when(x, FRESH).otherwise(REPEAT).alias("kind")))
    cut = F.transform("f", lambda x, i: F.struct(x.alias("p"), F.get("g", F.col("len") - i).alias("s"), F.lit(CUT).alias("kind")))
    return both.select("r", "n", F.explode(F.concat(skip, cut)).alias("x")).select("x.p", "x.s", "r", "n", F.col("x.kind").alias("kind"))


def near_words(pairs: DataFrame) -> DataFrame:
    """(r, n_near, best struct(n, r)) per word with a near word: their number,
    and the one of largest n, least r."""
    member = F.struct(F.col("n"), (-F.col("r")).alias("back"), F.col("kind"))
    group = pairs.groupBy("p", "s").agg(F.collect_list(member).alias("all")).where(F.size("all") > 1)
    group = group.select(F.array_sort("all").alias("all"))
    group = group.select(F.reverse(F.filter("all", lambda x: x["kind"] != CUT)).alias("skip"),
                         F.get(F.filter("all", lambda x: x["kind"] == CUT), 0).alias("cut"))
    fresh = F.filter("skip", lambda x: x["kind"] == FRESH)
    # a group's best other member is its first one, or its second for the first itself
    other = lambda x: F.when(x["back"] == F.get("skip", 0)["back"], F.get("skip", 1)).otherwise(F.get("skip", 0))
    pick = lambda x: F.when(x.isNotNull(), F.struct(x["n"].alias("n"), x["back"].alias("back")))
    owns = lambda x: (x["kind"] == FRESH) & F.col("cut").isNotNull()
    rows = F.transform("skip", lambda x: F.struct(
        (-x["back"]).alias("r"), (F.size("skip") - 1 + F.when(owns(x), 1).otherwise(0)).cast("long").alias("n_near"),
        F.greatest(pick(other(x)), F.when(owns(x), pick(F.col("cut")))).alias("best")))
    longer = F.when(F.col("cut").isNotNull() & (F.size(fresh) > 0), F.array(F.struct(
        (-F.col("cut.back")).alias("r"), F.size(fresh).cast("long").alias("n_near"), pick(F.get(fresh, 0)).alias("best"))))
    each = group.select(F.explode(F.concat(rows, F.coalesce(longer, F.array_repeat(F.get(rows, 0), 0)))).alias("x"))
    near = each.groupBy("x.r").agg(F.sum("x.n_near").alias("n_near"), F.max("x.best").alias("best")).where("n_near > 0")
    return near.select("r", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.back")).alias("best_r"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(r, root) of (r, form): the last of the forms, by pointer doubling."""
    now, step = scratch.table(forms.select("r", F.col("form").alias("root")), "roots0"), 0
    while True:
        step += 1
        onward = now.select(F.col("r").alias("x"), F.col("root").alias("next"))
        new = now.join(onward, F.col("root") == F.col("x"), "left").select(
            "r", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        new = scratch.table(new, f"roots{step}")
        now = new.select("r", "root")
        if new.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH,
                      count: int = LEAST_COUNT, ratio: int = RATIO, typo: int = TYPO) -> DataFrame:
    """Per word of the corpus: word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = typed_words(docs, id_col, text_col, least, typo).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)
    return variants(words, ratio, scratch)


def variants(words: DataFrame, ratio: int = RATIO, scratch: Scratch | None = None) -> DataFrame:
    """As ``spelling_variants``, from distinct words and their counts (word, n)."""
    spark = words.sparkSession
    python_ready(spark)
    scratch = scratch or Scratch(spark, "spelling")
    words = scratch.table(words.select("word", F.col("n").cast("long").alias("n"), F.lit(None).cast("long").alias("r")), "words")
    points = words.agg(F.sum(F.length("word"))).first()[0] or 0
    ahead = scratch.table(trie_nodes(words, points), "ahead")
    back = scratch.table(trie_nodes(ahead.select(F.reverse("word").alias("word"), "r", "n"), points).select(
        F.col("r").alias("b"), F.col("nodes").alias("back")), "back")
    both = ahead.join(back, F.col("r") == F.col("b")).select("r", "n", "nodes", "back", "fresh")
    near = scratch.table(near_words(pair_rows(both)), "near")
    free_shuffles(spark)
    forms = scratch.table(near.join(ahead.select(F.col("r").alias("x"), "n"), F.col("r") == F.col("x")).select(
        "r", "n_near", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_r")).alias("form")), "forms")
    root = roots(forms.where("form IS NOT NULL"), scratch)
    own = ahead.select("r", "word", "n")
    named = lambda c: own.select(F.col("r").alias(f"{c}_r"), F.col("word").alias(c), F.col("n").alias(f"{c}_n"))
    about = forms.join(root.select(F.col("r").alias("x"), F.col("root").alias("to")), F.col("r") == F.col("x"), "left").select(
        F.col("r").alias("of"), "n_near", F.col("form").alias("form_at"), "to")
    about = about.join(named("form"), F.col("form_at") == F.col("form_r"), "left").join(
        named("root"), F.col("to") == F.col("root_r"), "left").select("of", "n_near", "form", "form_n", "root")
    return own.join(about, F.col("r") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
