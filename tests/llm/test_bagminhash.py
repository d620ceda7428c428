import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import bagminhash as B
from ledgerline.llm.common import shingles, word_hashes
from tests.llm.conftest import words


def bag(text, k=5):
    w = words(text)
    if not w:
        return None
    return Counter(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)])


def classes(rows, threshold=0.8):
    """(id, text) -> class by comparing all pairs."""
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            if a and b and min(a.total(), b.total()) >= threshold * max(a.total(), b.total()):
                both = (a & b).total()
                if both >= threshold * (a.total() + b.total() - both):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return Counter((str(d), str(least.get(find(i)) if bags[i] else d)) for i, (d, _) in enumerate(rows))


def got(df):
    return Counter((str(r.id), str(r.class_id)) for r in df.collect())


def test_equals_all_pairs(spark, clashing):
    assert got(B.near_duplicates(clashing)) == classes([(r.doc_id, r.text) for r in clashing.collect()])


def near(rng, base, n):
    w = list(base)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [8 << 20, 20_000])
def test_star_of_near_copies_and_one_row_of_each_class_stays(spark, monkeypatch, block):
    """Copies are near their base, hardly near each other; some only share parts of it."""
    monkeypatch.setattr(B.links, "__defaults__", (block,))
    rng = random.Random(3)
    base = [f"w{rng.randrange(4000)}" for _ in range(300)]
    rows = [(i, near(rng, base, 5)) for i in range(1, 150)] + [(500, " ".join(base))]
    rows += [(600 + i, " ".join([*base[: 150 + i], *(f"y{i}z{j}" for j in range(150 - i))])) for i in range(60)]
    rows += [(500, " ".join(base)), (None, " ".join(base)), (None, None), (700, None), (701, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = B.near_duplicates(df)
    assert got(out) == classes(rows)
    kept = out.where("kept").groupBy("class_id").agg(F.countDistinct("id", "ref").alias("n")).where("n > 1 AND class_id IS NOT NULL")
    assert kept.count() == 0


def test_empty_table(spark):
    assert B.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signature_is_unbiased_for_weights():
    rng = np.random.default_rng(1)
    e = rng.integers(1, 2 ** 63, 60).astype(np.uint64)
    ca, cb = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    m = 4000
    rows = np.concatenate((np.zeros((ca > 0).sum(), int), np.ones((cb > 0).sum(), int)))
    sig = B.signatures(rows, np.concatenate((e[ca > 0], e[cb > 0])), np.concatenate((ca[ca > 0], cb[cb > 0])), 2, m)
    true = np.minimum(ca, cb).sum() / np.maximum(ca, cb).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / m)


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f g " * 30, None, "one", "p q r s t u v w"]
    def sig(t):
        h, first = shingles(*word_hashes(pa.array(t, pa.string())), 5)
        return B.signatures(*B.bags(h, first), len(t), 16)
    whole = sig(texts)
    for i, t in enumerate(texts):
        assert (sig([t])[0] == whole[i]).all()
    assert np.isinf(whole[1]).all() and np.isfinite(whole[2]).all()


def packed(text):
    _, e, c = B.bags(*shingles(*word_hashes(pa.array([text])), 5))
    return e.tobytes() + c.astype(np.uint32).tobytes()


def test_verification_is_multiset_jaccard():
    for a, b in (("a b c d e " * 5, "a b c d e " * 3), ("a b c d e f", "a b c d e g"), ("x", "x")):
        x, y = bag(a), bag(b)
        sim, size, units = B.difference(packed(a), packed(b))
        assert sim == (x & y).total() / (x | y).total() and size == y.total()
        assert len(set(units.tolist())) == len(units) == (x | y).total() - (x & y).total()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), min_size=5, max_size=25), min_size=2, max_size=7), st.sampled_from([0.5, 0.8]))
def test_siblings_connect_what_all_pairs_connect(docs, threshold):
    texts = sorted({" ".join(d) for d in docs})
    lead, members = texts[0], []
    for t in texts[1:]:
        sim, size, units = B.difference(packed(lead), packed(t))
        members.append((t.encode(), sim >= threshold, size, units.tobytes()))
    found = B.siblings([(n, s, u) for n, ok, s, u in members if not ok], members, threshold)
    found += [(lead.encode(), n) for n, ok, _, _ in members if ok]
    true = [(a.encode(), b.encode()) for a in texts for b in texts if a < b and (lambda x, y: (x & y).total() / (x | y).total())(bag(a), bag(b)) >= threshold]

    def parts(edges):
        root = {t.encode(): t.encode() for t in texts}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        return {x: find(x) for x in root}
    assert parts(found) == parts(true)
    assert all(tuple(sorted(e)) in true for e in found)
