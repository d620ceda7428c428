import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import packing


def ids_of(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_every_token_once_and_little_padding(spark, documents):
    docs = documents.select("doc_id", "text", F.lit(1).alias("id"), F.lit("y").alias("length"))
    docs = docs.unionByName(spark.createDataFrame([(900100, "<|endoftext|> is text 日本 🎈", 1, "y")], docs.schema))
    pieces = packing.pack(docs.coalesce(3)).collect()
    pad, total = check_all(pieces, docs)
    assert pad <= 0.02 * total


def check_all(pieces, docs):
    seqs, n = defaultdict(list), defaultdict(int)
    for p in pieces:
        seqs[p.sequence_id].append(p)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(ids_of(text))
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p.doc_id] += p.length
        assert any(len(i) == p.doc_tokens and zlib.crc32(i[p.start: p.start + p.length].tobytes()) == p.ids_crc32 for i in want[p.doc_id])
    assert tokens == {d: sum(map(len, x)) for d, x in want.items()}
    for d, x in want.items():
        if len(x) == 1:
            at = 0
            for p in sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start):
                assert p.start == at
                at += p.length
    pad = total = 0
    for s in seqs.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048
        total += at
        pad += 2048 - at if at & (at - 1) else 0
    return pad, total


def test_order_is_kept(spark):
    docs = spark.createDataFrame([(i, f"Document {i} has a few words." * 40) for i in range(60)], "doc_id long, text string")
    rows = sorted(packing.pack(docs.repartition(7)).collect(), key=lambda p: (p.sequence_id, p.offset))
    assert [(p.doc_id, p.start) for p in rows] == sorted((p.doc_id, p.start) for p in rows)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0.0, 1.0, 4.0])), min_size=1, max_size=14), st.integers(9, 20))
def test_monotone_queue_equals_all_transitions(steps, capacity):
    pos = np.concatenate(([0], np.cumsum([s for s, _ in steps]))).tolist()
    pen = [0.0] + [p for _, p in steps]
    f = [0.0]
    for j in range(1, len(pos)):
        f.append(min(f[i] + capacity - (pos[j] - pos[i]) for i in range(j) if pos[j] - pos[i] <= capacity) + pen[j])
    got, prev = packing.best_cuts(pos, pen, capacity)
    assert got == f
    cuts = packing.chain(prev, pos, len(pos) - 1)
    assert cuts[0] == 0 and cuts[-1] == pos[-1] and all(b - a <= capacity for a, b in zip(cuts, cuts[1:]))


@given(st.integers(0, 2048))
def test_tail_is_padded_or_powers_of_two(n):
    lengths = packing.tail_lengths(n)
    assert sum(lengths) == n and sum(2048 - x for x in lengths if x & (x - 1)) <= packing.INNER_PENALTY


def test_blocks_and_small_capacity():
    s = packing.Stream(5, np.zeros(60_000, bool), 64)
    for i in range(40):
        s.add(i, np.full(i * 7 % 50 + 1, i, "<u4"))
        if i % 3 == 0:
            s.pack(False)
    s.pack(True)
    total = sum(r[2] for r in s.rows)
    assert total == sum(i * 7 % 50 + 1 for i in range(40)) and s.n == 0


def test_added_tokens_are_those_of_the_tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc, ends = packing.encoder(packing.default_ranks(), packing.added_tokens())
    for text in ("end. <|endoftext|> new", "<|endoftext|>", "a<|endoftext|><|endoftext|>b\n", "<|endoftext|", "plain 日本 🎈"):
        want = t.encode(text, add_special_tokens=False).ids
        assert packing.tokens(text, enc).tolist() == [*want, 1] and max(want) < len(ends)


def test_query_packs_added_tokens(spark, tmp_path):
    from ledgerline.llm.queries import QUERIES
    spark.createDataFrame([(1, "end. <|endoftext|> new")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(QUERIES["op3_packing"](spark, str(tmp_path)).collect(), key=lambda p: p.start)
    assert {p.doc_tokens for p in rows} == {6} and sum(p.length for p in rows) == 6
