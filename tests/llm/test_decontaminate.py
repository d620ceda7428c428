import pytest

from ledgerline.llm.decontaminate import decontaminate
from tests.llm.conftest import SF, words


def brute(docs, items, span):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), span)
        for j in range(len(w) - n + 1 if n else 0):
            windows.setdefault(n, {}).setdefault(tuple(w[j: j + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n, m in windows.items():
            for j in range(len(w) - n + 1):
                if (x := m.get(tuple(w[j: j + n]))) is not None:
                    found |= {str(i) for i in x if i is not None}
                    hit.update(range(j, j + n))
        spans = [(a, a + 1) for a in sorted(hit)]
        merged = []
        for a, b in spans:
            if merged and merged[-1][1] == a:
                merged[-1] = (merged[-1][0], b)
            else:
                merged.append((a, b))
        out.append((str(d), len(w), len(hit), tuple(sorted(found)), tuple(merged)))
    return sorted(out)


def got(df):
    return sorted((str(r.id), r.n_words, r.n_hit, tuple(r["items"]), tuple((s.a, s.b) for s in r.spans)) for r in df.collect())


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_equals_brute_force(spark, clashing, broadcast):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(501, "two words"), (502, "word"), (None, "without an id"), (503, None), (504, ""), (505, "TWO words"),
              (506, "word " * 25), (507, "z" * 30000), (507, "some words in it")]
    df = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, w string")
    docs = [(r.doc_id, r.text) for r in clashing.collect()]
    assert got(decontaminate(clashing, df, broadcast_windows=broadcast)) == brute(docs, items, 10)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 and not r["items"] for r in decontaminate(documents, none).collect())
    assert decontaminate(documents.limit(0), spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


def test_no_python_in_the_plan(spark, documents):
    plan = decontaminate(documents, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_words_are_not_broadcast(spark):
    long_ = "z" * 4000
    docs = spark.createDataFrame([(1, f"a {long_} b"), (2, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(7, long_), (8, "b")], "item_id long, text string")
    rows = lambda **kw: sorted(map(str, decontaminate(docs, items, **kw).collect()))
    assert rows() == rows(broadcast_bytes=1000) and "contaminated" not in rows()[0]
