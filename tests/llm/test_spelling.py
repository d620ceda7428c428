import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import spelling
from ledgerline.llm.common import LOWER, UPPER


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best is not None and counts[best] >= ratio * n else None, n, len(near))
    def root(w):
        return w if out[w][0] is None else root(out[w][0])
    return {w: (f, root(w), n, k, counts[f] if f else None) for w, (f, n, k) in out.items()}


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                counts[w] += 1
    return Counter({w: n for w, n in counts.items() if n >= 5})


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_whole_documents_against_brute_force(documents):
    docs = documents.unionByName(documents.sparkSession.createDataFrame(
        [(910000 + i, "Lettering letteringg LETTERXNG étoile ÉTOILE", "en", "s", 1) for i in range(6)], documents.schema))
    want = brute(brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert result(spelling.spelling_variants(docs)) == want
    assert any(v[0] for v in want.values())


@pytest.mark.parametrize("points", [1 << 20, 40])
def test_made_words_against_brute_force(spark, monkeypatch, points):
    """Runs of equal letters, words that are prefixes of others, chains of forms, many ranges."""
    monkeypatch.setattr(spelling, "RANGE_POINTS", points)
    monkeypatch.setattr(spelling, "SAMPLED", 2)
    r = random.Random(3)
    counts = {"".join(r.choice("abé\U0001F600") for _ in range(r.randint(1, 7))): r.choice([1, 2, 5, 5, 26, 130, 700]) for _ in range(400)}
    counts |= {"a" * n: 10 ** (n % 4) for n in range(1, 12)} | {"x" * 3000: 5, "x" * 3001: 25, "x" * 2999 + "y": 25}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.variants(words)) == brute(counts)


def test_equal_counts_and_extra_columns(spark):
    text = " ".join(["winter"] * 50 + ["wonter"] * 50 + ["wnter wunter"] * 0 + ["wynter"] * 5)
    docs = spark.createDataFrame([(1, text, "x", "y"), (2, None, "x", "y"), (None, "", "x", "y")], "doc_id long, text string, r string, word string")
    got = result(spelling.spelling_variants(docs, typo=1 << 40))
    assert got["wynter"][:2] == ("winter", "winter") and got["winter"][0] is None and got["winter"][3] == 2


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(empty).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "short 12 !")], "doc_id long, text string")
    assert spelling.spelling_variants(docs).collect() == []


def test_clashing_columns(clashing):
    plain = result(spelling.spelling_variants(clashing.select("doc_id", "text")))
    assert result(spelling.spelling_variants(clashing.withColumns({"k": F.lit(1), "h": F.lit(2)}))) == plain


def test_boundary_prefixes_have_one_number():
    a, b, c = spelling.boundary_nodes(["abc", "abd", "b"])
    assert list(a[:2]) == list(b[:2]) and b[2] not in a and c[0] not in {*a, *b}
