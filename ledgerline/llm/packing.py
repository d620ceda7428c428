"""Packing: documents, in order, into token sequences of at most ``capacity``.

Documents are dealt by ranges of their id (equal ids by content, so that one id
is never one task's whole load), sorted, tokenised and laid end to end. Cut
points are document ends (free), sentence ends (a small penalty) and, inside
long stretches without one, every ``STEP`` tokens (a larger penalty). The least
total of padding and penalties follows from

    f[j] = penalty[j] + capacity - p[j] + min over p[j] - p[i] <= capacity of (f[i] + p[i])

whose minimum slides over a window: a monotone queue gives each f[j] in constant
time. A sequence whose length is a power of two needs no padding, so the end of
a partition is split by powers of two where that is cheaper than padding it.
The stream is packed in blocks; the unfinished last window of a block is carried
into the next, so memory is one block and one document.

Defined results: a null or empty text is the end token alone; null ids sort
first; repeated rows are packed each; extra columns are ignored; empty tables
give no pieces. Piece ``start`` counts the tokens of the document before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import python_ready

CAPACITY, END_ID, BLOCK, STEP, LONG = 2048, 1, 1 << 18, 8, 16
SENTENCE_PENALTY, INNER_PENALTY = 1.0, 4.0
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
_LOADED: dict = {}


def default_ranks() -> str:
    """The ranks of ``byte_bpe_50k.json``: the same vocabulary and ids."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """The added tokens of ``byte_bpe_50k.json``, which the ranks do not hold."""
    import json

    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def encoder(ranks: str, added: dict[str, int] | None = None):
    """(encode, sentence-end flag of each id); loaded once per worker."""
    added = added or {}
    name = ranks, tuple(sorted(added.items()))
    if name not in _LOADED:
        import base64

        import public_tokenizers
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=added)
        ends = np.zeros(max(*table.values(), *added.values()) + 2, bool)
        for token, i in table.items():
            ends[i] = token.rstrip(b" \"')]").endswith((b".", b"!", b"?")) or b"\n" in token
        _LOADED[name] = enc, ends
    return _LOADED[name]


def tokens(text: str | None, enc) -> np.ndarray:
    ids = enc.encode_to_numpy(text, allowed_special="all", disallowed_special=()) if text else np.zeros(0, np.uint32)
    return np.append(ids, END_ID).astype("<u4")


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the allowed cuts, 0 first and len(ids) last."""
    n = len(ids)
    at = np.flatnonzero(ends[ids]) + 1
    at = np.unique(np.concatenate(([0], at, doc_ends, [n])))
    gap = np.diff(at)
    wide = np.flatnonzero(gap > LONG)
    if len(wide):
        more = (gap[wide] - 1) // STEP
        first = np.repeat(at[wide], more)
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        inner = first + step * STEP
    else:
        inner = np.zeros(0, np.int64)
    pos = np.concatenate((at, inner))
    pen = np.concatenate((np.full(len(at), SENTENCE_PENALTY), np.full(len(inner), INNER_PENALTY)))
    pen[np.isin(pos, doc_ends)] = 0
    order = np.argsort(pos, kind="stable")
    return pos[order], pen[order]


def best_cuts(pos: list[int], pen: list[float], capacity: int = CAPACITY) -> tuple[list[float], list[int]]:
    """(cost, predecessor) of each cut point by the monotone queue."""
    n = len(pos)
    f, prev, g = [0.0] * n, [-1] * n, [0.0] * n
    g[0] = float(pos[0])
    queue, head = [0], 0
    for j in range(1, n):
        p = pos[j]
        low = p - capacity
        while pos[queue[head]] < low:
            head += 1
        i = queue[head]
        cost = g[i] + capacity - p + pen[j]
        f[j], prev[j] = cost, i
        value = g[j] = cost + p
        while len(queue) > head and g[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    return f, prev


def chain(prev: list[int], pos: list[int], last: int) -> list[int]:
    out = []
    while last >= 0:
        out.append(pos[last])
        last = prev[last]
    return out[::-1]


def tail_lengths(n: int, capacity: int = CAPACITY, penalty: float = INNER_PENALTY) -> list[int]:
    """Lengths for the last n <= capacity tokens: pad them, or peel off powers of two."""
    out = []
    while n:
        power = 1 << (n.bit_length() - 1)
        if power == n or capacity - n <= penalty:
            return [*out, n]
        out.append(power)
        n -= power
    return out


class Stream:
    """Documents laid end to end; tokens leave it as finished sequences."""

    def __init__(self, first_sequence: int, ends: np.ndarray, capacity: int):
        self.ids, self.n = [], 0
        self.docs: list[tuple[int | None, int, int]] = []  # id, position of its first token, its tokens
        self.sequence, self.ends, self.capacity = first_sequence, ends, capacity
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.n, len(ids)))
        self.ids.append(ids)
        self.n += len(ids)

    def pack(self, final: bool) -> None:
        """Cut what is there; unless final, the last open window stays."""
        if not self.n:
            return
        ids = np.concatenate(self.ids)
        doc_ends = np.array([s + n for _, s, n in self.docs if s + n <= self.n], np.int64)
        pos, pen = cut_points(ids, doc_ends, self.ends)
        pos, pen = pos.tolist(), pen.tolist()
        f, prev = best_cuts(pos, pen, self.capacity)
        # the open window [pos[i], n) costs nothing yet: least f[i] + p[i] within the last capacity
        last = min((i for i in range(len(pos)) if pos[i] >= self.n - self.capacity and pos[i] < self.n), key=lambda i: f[i] + pos[i])
        cuts = chain(prev, pos, last)
        if final:
            for n in tail_lengths(self.n - pos[last], self.capacity):
                cuts.append(cuts[-1] + n)
        self._emit(ids, cuts)
        done = cuts[-1]
        self.docs = [(d, s - done, n) for d, s, n in self.docs if s + n > done]
        self.ids = [ids[done:].copy()] if done < self.n else []
        self.n -= done

    def _emit(self, ids: np.ndarray, cuts: list[int]) -> None:
        d = 0
        for a, b in zip(cuts, cuts[1:]):
            while d < len(self.docs) and self.docs[d][1] + self.docs[d][2] <= a:
                d += 1
            k = d
            while k < len(self.docs) and self.docs[k][1] < b:
                doc, s, n = self.docs[k]
                lo, hi = max(a, s), min(b, s + n)
                self.rows.append((doc, lo - s, hi - lo, zlib.crc32(ids[lo:hi].tobytes()), n, self.sequence, lo - a))
                k += 1
            self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self.rows)], schema=_SCHEMA)
        self.rows = []
        return out


def _packer(ranks: str, capacity: int, block: int, added: dict[str, int] | None) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ends = encoder(ranks, added)
        s = Stream(TaskContext.get().partitionId() << 40, ends, capacity)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                s.add(doc_id, tokens(text.as_py(), enc))
                if s.n >= block:
                    s.pack(False)
                    if len(s.rows) > 10_000:
                        yield s.batch()
        s.pack(True)
        if s.rows:
            yield s.batch()
    return pack


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
         capacity: int = CAPACITY, block: int = BLOCK, added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: see PIECE. ``added``: literals that are one token
    each, as ``added_tokens()``; without it they are text as any other."""
    python_ready(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    d = d.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    d = d.sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    return d.mapInArrow(_packer(ranks or default_ranks(), capacity, block, added), PIECE)
