import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lexical
from tests.llm.conftest import words


def brute(docs, items, top=10):
    """(item number, rank, id, score), from the definition"""
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, Counter(w), len(w)) for i, w in bags if w]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for j, text in enumerate(items):
        terms, found = words(text), []
        for i, c, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // total
            s = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i, s))
        out += [(j, r, x[3], x[4]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def check(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted([(r.item, r["rank"], r.id, r.score) for r in lexical.search(d, q, **kw).collect()], key=str)
    assert got == brute(docs, items, kw.get("top", 10))
    return got


def test_documents_against_brute_force(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()]
    check(spark, docs, items + [items[0], None, "", "?!", "notinanydocument"])


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ITEMS": 2}, {"BLOCK_BYTES": 8}, {"CELLS": 4, "ENTRIES": 3}])
def test_classes_ties_and_blocks(spark, monkeypatch, limits):
    """Many copies of one bag (words in another order, words outside the vocabulary), ties between classes, null ids."""
    for k, v in limits.items():
        monkeypatch.setattr(lexical, k, v)
    docs = [(i, "red green other") for i in range(40, 0, -1)] + [(100 + i, "GREEN red word") for i in range(5)]
    docs += [(200 + i, f"blue{'!' * i} sky thing") for i in range(15)] + [(7, "blue sky"), (7, "blue sky"), (None, "blue sky"), (3, "sky blue " * 50)]
    docs += [(300, None), (301, ""), (302, "Éé straße naïve"), (303, "éé")]
    check(spark, docs, ["green red red", "blue sky", "blue", "Éé", "sky blue green", "none at all", "thing thing"])


def test_large_scores_take_integers(spark, monkeypatch):
    item = "alpha " * 70000 + "beta"
    docs = [(i, "alpha " * i + "beta gamma") for i in range(1, 30)] + [(i, "delta") for i in range(100, 200)]
    p = lexical.Postings([words(item)], ["alpha", "beta"])
    p.weight[:] = 10**6
    assert p.longest * 10**6 * 10**6 > 1 << 53
    check(spark, docs, [item])


def test_empty_tables(spark):
    assert check(spark, [], ["a b"]) == [] and check(spark, [(1, "a b")], []) == []


def test_clashing_columns(spark, clashing):
    q = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    names = ["item", "rank", "q", "vec", "m", "h", "cid", "first"]
    plain = lexical.search(clashing.select("doc_id", "text"), q)
    got = lexical.search(clashing.withColumns({c: F.lit("x") for c in names}), q.withColumns({c: F.lit(1) for c in names}))
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
