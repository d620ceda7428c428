"""Near-duplicate documents: BagMinHash signatures, banding, verification.

A document is the multiset of its k-word shingles. For every (shingle, count)
the weight axis (0, count] is cut at powers of two; each of these dyadic bands
has its own Poisson process, seeded by shingle and band, whose points carry an
arrival time, a signature component and a weight level. A point counts for a
document if its level is at most the document's count, so equal points are
shared exactly by the common part of two weights and

    P(component equal) = sum of min(counts) / sum of max(counts).

Points come in order of arrival and stop at the largest component so far. All
documents of a batch run through this together in numpy.

Banding gives buckets of signature parts. Documents of equal multisets are one
*node* before that, so copies cost one aggregation. Bucket members are never
paired with each other. The member that shares most (in all its buckets) leads
a bucket, and each node is verified against its few leaders. Two members that
are both linked to the leader are in one class. For the others the difference
of a member from its leader decides: with D(x) the multiset difference of x
and leader, |x - y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|, which gives the exact
similarity of any two members from small sets. Within a leader's group, blocks
of bounded size list their differences by element; a member that failed looks
up who shares its elements, and one link per class found is returned. So every
pair of every bucket is decided exactly, without a row per pair.
Verification is exact: multiset Jaccard of whole documents, ``threshold`` or more.

Defined results: null texts and texts without words form a class of their own
each; a text of fewer than k words is one shingle; class ids are the least id
(null ids last); repeated rows share a class and one of them is kept; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, free_shuffles, mix, python_ready, shingles, signed, slices, word_hashes
from ledgerline.llm.components import components

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 20, 4
BLOCK_BYTES = 8 << 20
_U = np.uint64


def bags(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count): the multisets of the rows, sorted."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.concatenate((at, [len(h)])))


def signatures(row: np.ndarray, h: np.ndarray, count: np.ndarray, n_rows: int, m: int = BANDS * ROWS) -> np.ndarray:
    """n_rows x m arrival times; rows without elements stay infinite."""
    sig = np.full((n_rows, m), np.inf)
    flat = sig.ravel()
    level, low = 0, 0
    while len(h):
        high = 1 << level
        width = float(high - low)
        with np.errstate(over="ignore"):
            seed = mix(h ^ (_U(level + 1) * _U(0xA0761D6478BD642F)))
        act_row, act_seed, act_count = row, seed, count
        x = np.zeros(len(h))
        t = 0
        while len(act_row):
            with np.errstate(over="ignore"):
                r1 = mix(act_seed + _U(t) * _U(0xE7037ED1A0B428DB))
            r2 = mix(r1 ^ _U(0x8EBC6AF09C88C6E3))
            x = x - np.log(((r1 >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / width
            part = ((r2 >> _U(40)) % _U(m)).astype(np.int64)
            at = low + ((r2 & _U((1 << 40) - 1)).astype(np.float64) + 1.0) * (width * 2.0 ** -40)
            ok = at <= act_count
            np.minimum.at(flat, act_row[ok] * m + part[ok], x[ok])
            top = sig.max(axis=1)
            go = x < top[act_row]
            act_row, act_seed, act_count, x = act_row[go], act_seed[go], act_count[go], x[go]
            t += 1
        low, level = high, level + 1
        more = count > low
        row, h, count = row[more], h[more], count[more]
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """rows x bands 64-bit keys of equal signature parts."""
    s = sig.view(np.uint64).reshape(len(sig), bands, -1)
    out = np.zeros(s.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64)
    for i in range(s.shape[2]):
        out = mix(out * _U(0x9FB21C651E98DF25) ^ s[:, :, i])
    return out


def node_keys(h: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """A 128-bit key of each row's multiset; None without shingles."""
    n = np.diff(first)
    out = np.zeros((len(n), 2), np.uint64)
    if len(h):
        at = np.minimum(first[:-1], len(h) - 1)
        with np.errstate(over="ignore"):
            for i, c in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                out[:, i] = np.add.reduceat(mix(h ^ _U(c)), at)
    return [out[i].tobytes() if n[i] else None for i in range(len(n))]


def _signer(k: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                h, first = shingles(*word_hashes(b.column(2)), k)
                row, e, count = bags(h, first)
                keys = band_keys(signatures(row, e, count, b.num_rows, bands * rows), bands)
                yield pa.record_batch([
                    b.column(0), b.column(1), pa.array(node_keys(h, first), pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, bands * b.num_rows + 1, bands, dtype=np.int32), signed(keys).ravel())],
                    ["id", "ref", "node", "bands"])
    return run


def _bagger(k: int) -> Callable:
    """(node, text) -> (node, multiset): sorted shingles, then their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                row, e, count = bags(*shingles(*word_hashes(b.column(1)), k))
                cut = np.searchsorted(row, np.arange(b.num_rows + 1))
                yield pa.record_batch([b.column(0), pa.array([
                    e[i:j].tobytes() + count[i:j].astype(np.uint32).tobytes() for i, j in zip(cut, cut[1:])], pa.binary())], ["node", "bag"])
    return run


def unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(bag) // 12
    return np.frombuffer(bag, np.uint64, n), np.frombuffer(bag, np.uint32, n, n * 8).astype(np.int64)


def difference(a: bytes, b: bytes) -> tuple[float, int, np.ndarray]:
    """(similarity, size of b, the multiset difference of b from a as a set:
    one hash for each unit that b has more or less of an element)."""
    ha, ca = unpack(a)
    hb, cb = unpack(b)
    keys, at = np.unique(np.concatenate((ha, hb)), return_inverse=True)
    d = np.zeros(len(keys), np.int64)
    d[at[: len(ha)]] -= ca
    d[at[len(ha):]] += cb
    moved, total = int(np.abs(d).sum()), int(ca.sum() + cb.sum())
    both = (total - moved) // 2
    some = np.flatnonzero(d)
    n = np.abs(d[some])
    unit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    side = np.repeat((d[some] > 0).astype(np.uint64), n)
    return both / (total - both), int(cb.sum()), mix(np.repeat(keys[some], n) ^ mix(unit.astype(np.uint64) * _U(2) + side))


def _verifier(threshold: float) -> Callable:
    names = ["a", "b", "linked", "size", "units"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*batch.columns):
                sim, size, units = difference(x.as_py(), y.as_py())
                out.append((a, b, sim >= threshold, size, units.tobytes()))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.binary()))], names)
    return run


def siblings(asked: list, members: list, threshold: float) -> list[tuple[bytes, bytes]]:
    """Links between members of one leader that its own links don't give:
    (node, size, units) of those that failed, against (node, linked, size,
    units) of the members. One link per class found."""
    units = [np.frombuffer(u, np.uint64) for *_, u in members]
    owner = np.repeat(np.arange(len(members)), [len(u) for u in units])
    flat = np.concatenate(units) if units else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    n_units = np.array([len(u) for u in units], np.int64)
    size = np.array([m[2] for m in members], np.int64)
    name = {m[0]: i for i, m in enumerate(members)}
    linked = np.array([m[1] for m in members], bool)
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    out = []
    for node, own, u in asked:
        u = np.frombuffer(u, np.uint64)
        lo, hi = np.searchsorted(flat, u, "left"), np.searchsorted(flat, u, "right")
        n = hi - lo
        at = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
        shared = np.bincount(owner[at], minlength=len(members))
        total = own + size
        both = (total - (len(u) + n_units - 2 * shared)) // 2
        ok = both / (total - both) >= threshold
        if node in name:
            ok[name[node]] = False
        passed = np.flatnonzero(ok & linked)
        for i in [*passed[:1], *np.flatnonzero(ok & ~linked)]:  # the linked ones are one class
            x, y = find(node), find(members[i][0])
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((node, members[i][0]))
    return out


def _group(threshold: float) -> Callable:
    def run(t: pa.Table) -> pa.Table:
        rows = t.select(["b", "linked", "size", "units", "asks"]).to_pylist()
        found = siblings([(r["b"], r["size"], r["units"]) for r in rows if r["asks"]],
                         [(r["b"], r["linked"], r["size"], r["units"]) for r in rows if not r["asks"]], threshold)
        return pa.table([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], ["a", "b"])
    return run


def links(live: DataFrame, bag: DataFrame, threshold: float, scratch: Scratch, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b): verified links that connect what any pair of members of a bucket
    (bucket, node, pop) connects."""
    spark = live.sparkSession
    lead = live.groupBy("bucket").agg(F.max(F.struct("pop", "node")).alias("lead")).select(F.col("bucket").alias("of"), "lead.node")
    lead = scratch.table(lead, "lead").withColumnRenamed("node", "a")
    pairs = live.join(lead, F.col("bucket") == F.col("of")).where("node != a").select("a", F.col("node").alias("b")).distinct()
    pairs = scratch.table(pairs, "pairs")
    own = bag.select(F.col("node").alias("nb"), F.col("bag").alias("bag_b"))
    of = bag.select(F.col("node").alias("na"), F.col("bag").alias("bag_a"))
    both = pairs.join(own, F.col("b") == F.col("nb")).join(of, F.col("a") == F.col("na")).select("a", "b", "bag_a", "bag_b")
    seen = both.mapInArrow(_verifier(threshold), "a binary, b binary, linked boolean, size long, units binary")
    seen = scratch.table(seen, "seen")
    free_shuffles(spark)
    # groups with a member that failed, in blocks: the failed ask every block of members
    weight = F.length("units") + 64
    parts = lambda c: F.ceil(F.sum(c) / F.lit(block_bytes)).cast("int")
    groups = seen.groupBy(F.col("a").alias("g")).agg(
        parts(weight).alias("blocks"), parts(F.when(~F.col("linked"), weight)).alias("asking"), F.count(F.lit(1)).alias("n")).where(
        "asking > 0 AND n > 1")
    m = seen.join(scratch.table(groups, "groups"), F.col("a") == F.col("g"))
    cols = ["a", "b", "linked", "size", "units"]
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    answer = m.select(*cols, F.lit(False).alias("asks"), F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("y"), spread("asking").alias("x"))
    ask = m.where("NOT linked").select(*cols, F.lit(True).alias("asks"), spread("blocks").alias("y"), F.pmod(
        F.xxhash64(F.lit(1), "b"), F.col("asking")).cast("int").alias("x"))
    found = answer.unionByName(ask).groupBy("a", "x", "y").applyInArrow(_group(threshold), "a binary, b binary")
    return scratch.table(seen.where("linked").select("a", "b").union(found), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, ref, class_id, class_size, kept) per row: the class of near-duplicates,
    named by its least id, the number of its rows, and whether the row is the one
    that stays. ``ref`` is a hash of the text."""
    spark = docs.sparkSession
    python_ready(spark)
    scratch = Scratch(spark, "bagminhash")
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("ref"), F.col(text_col).alias("text"))
    kind = docs.select(id_col).dtypes[0][1]
    signed_ = scratch.table(d.mapInArrow(_signer(k, bands, rows), f"id {kind}, ref long, node binary, bands array<long>"), "signed")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "ref")
    nodes = scratch.table(signed_.where("node IS NOT NULL").groupBy("node").agg(
        F.min(rank).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "nodes")
    free_shuffles(spark)
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    size = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnRenamed("bucket", "of")
    size = scratch.table(size, "sizes")
    live = scratch.table(buckets.join(size, F.col("bucket") == F.col("of")).select("bucket", "node", "size"), "buckets")
    pop = live.groupBy(F.col("node").alias("x")).agg(F.sum("size").alias("pop"))
    pop = scratch.table(pop, "pop")
    live = scratch.table(live.join(pop, F.col("node") == F.col("x")).select("bucket", "node", "pop"), "live")
    need = nodes.join(pop, F.col("node") == F.col("x"), "left_semi").select("node", F.col("rep.id").alias("i"), F.col("rep.ref").alias("r"))
    # texts meet their nodes by a shuffle at every size, so that cost follows the input
    bag = d.join(scratch.table(need, "need").hint("merge"), (F.col("ref") == F.col("r")) & F.col("id").eqNullSafe(F.col("i"))).select("node", "text")
    bag = scratch.table(bag.mapInArrow(_bagger(k), "node binary, bag binary").dropDuplicates(["node"]), "bags")
    free_shuffles(spark)
    edges = links(live, bag, threshold, scratch)
    scratch.drop("bags")
    scratch.drop("seen")
    free_shuffles(spark)
    label = components(edges)
    of = label.select(F.col("node").alias("x"), "root")
    named = nodes.join(of, F.col("node") == F.col("x"), "left").select("node", "rep", "copies", F.coalesce("root", "node").alias("root"))
    named = scratch.table(named, "named")
    classes = scratch.table(named.groupBy(F.col("root").alias("y")).agg(F.min("rep").alias("best"), F.sum("copies").alias("class_size")), "classes")
    named = named.join(classes, F.col("root") == F.col("y")).select(F.col("node").alias("x"), "best", "class_size")
    named = scratch.table(named, "classed")
    out = signed_.select("id", "ref", "node").join(named, F.col("node") == F.col("x"), "left")
    return out.select("id", "ref", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("class_id"),
                      F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
                      F.when(F.col("node").isNull(), F.lit(True)).otherwise(
                          F.col("id").eqNullSafe(F.col("best.id")) & (F.col("ref") == F.col("best.ref"))).alias("kept"))
