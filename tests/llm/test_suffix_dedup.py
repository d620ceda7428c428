import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import suffix_dedup as S


def brute(rows, t):
    texts = [(d, (x or "").encode()) for d, x in rows]
    seen = Counter(b[i: i + t] for _, b in texts for i in range(len(b) - t + 1))
    out = Counter()
    for d, b in texts:
        gone = S.union([(i, i + t) for i in range(len(b) - t + 1) if seen[b[i: i + t]] > 1])
        at, kept = 0, []
        for x, y in gone:
            kept.append(b[at:x])
            at = y
        left = b"".join([*kept, b[at:]])
        out[(str(d), len(b), len(b) - len(left), tuple(gone), hashlib.sha256(left).hexdigest())] += 1
    return out


def got(df):
    return Counter((str(r.id), r.n_bytes, r.n_removed, tuple((s.a, s.b) for s in r.spans), r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("threshold", [24, 101])
def test_equals_brute_force(spark, clashing, threshold):
    from pyspark.sql import functions as F
    few = clashing.where("doc_id IS NULL OR doc_id < 60 OR doc_id >= 900000")
    few = few.withColumn("text", F.substring("text", 1, 3000))
    rng = random.Random(2)
    more = [(10 ** 6 + i, "".join(rng.choice("ab") for _ in range(150))) for i in range(40)]
    p = "é" * 60 + "passage" * 9
    more += [(10 ** 6 + 50 + i, f"{i}{p[: 40 + 7 * i]}{i}") for i in range(10)] + [(None, p), (None, p)]
    df = few.select("doc_id", "text", "ref", "r1").unionByName(spark.createDataFrame([(*m, "q", "r") for m in more], "doc_id long, text string, ref string, r1 string"))
    assert got(S.remove_repeats(df, threshold)) == brute([(r.doc_id, r.text) for r in df.collect()], threshold)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 5000)
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    rows = [(1, body + body[4900:5600]), (2, "x" + body[9000:9800]), (3, body[:399])]
    step = S._run_rows(400, 200)
    import pyarrow as pa
    batch = pa.record_batch([pa.array([1]), pa.array([2]), pa.array([rows[0][1]])], ["r1", "r2", "text"])
    got_ = pa.Table.from_batches(list(step(iter([batch]))))
    assert sum(got_["n"].to_pylist()) == len(rows[0][1]) - 399  # every window is in one run
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(S.remove_repeats(df)) == brute(rows, 400)


def test_kept_text(spark):
    p = "p" * 30 + "q" * 30
    df = spark.createDataFrame([(1, "one " + p), (2, p + " two"), (3, None)], "doc_id long, text string")
    kept = {r.id: r.kept for r in S.remove_repeats(df, 50).collect()}
    assert kept == {1: "one ", 2: " two", 3: ""}


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 50, 97).astype(np.uint64)
    for w in (1, 2, 7, 97):
        assert S.sliding_min(x, w).tolist() == [x[i: i + w].min() for i in range(97 - w + 1)]
