import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm import decision_list as D
from ledgerline.llm.queries import QUERIES
from tests.llm.conftest import SF


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    inside = {i + j for i in range(len(w) - 4) if seen[tuple(w[i: i + 5])] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(spark, clashing):
    more = spark.createDataFrame([(1, "a b c d e f a b c d e\n\nx\nx\n \t\nx"), (2, "\u00a0nbsp is\x0bno\x0cspace 🎈#"),
                                  (3, "a b c d a b c d a b c d a"), (4, "\n\n"), (5, "# # # | <a> $")], "doc_id long, text string")
    df = clashing.select("doc_id", "text", "n").unionByName(more.withColumn("n", F.lit("x")))
    rows = Counter((str(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words)
                   for r in D.text_statistics(df).collect())
    assert rows == Counter((str(r.doc_id), *brute(r.text)) for r in df.collect())


def test_query_and_its_verdicts(spark):
    sf = SF.replace("0.001", "0.01")
    out = QUERIES["op7_quality_rules"](spark, sf)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rows = {r.doc_id: r for r in out.collect()}
    for r in rows.values():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    labels = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in rows]
    good = [r for q, r in labels if q == 1 and not r.base_failed]
    bad = [r for q, r in labels if q == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_no_python_in_the_plan(spark, documents):
    plan = D.judge(documents, spark.read.parquet(f"{SF}/labels.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_learns_ordered_conjunctions(spark):
    """Bad: many symbols, or long words in short texts; the latter needs two terms."""
    rows = []
    for i in range(600):
        sym, long_, short = i % 5 == 0, i % 3 == 0, i % 4 == 0
        n = 20 if short else 200
        rows.append((i, n, n * (9 if long_ else 4), n // 2 if sym else 0, 5, 0, 0, int(not (sym or (long_ and short)))))
    df = spark.createDataFrame(rows, "id long, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
                                     "n_repeat_words long, good int")
    rules = D.learn(df.drop("good"), df.select(F.col("id").alias("doc_id"), F.col("good").alias("quality")))
    assert {len(r.terms) for r in rules} == {1, 2}
    assert df.where((F.col("good") == 1) != D.verdict(rules)).count() == 0


def test_without_labels_the_base_rules_decide(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(900004, 1), (None, 0)], "doc_id long, quality int")):
        assert D.judge(documents, labels).where("kept = base_failed").count() == 0
    assert D.judge(documents.limit(0), none).count() == 0


def test_worst_of_several_labels_counts(spark, documents):
    lab = [(r.doc_id, q) for r in documents.where("doc_id < 100").collect() for q in (1, 0, None)]
    stats = D.text_statistics(documents)
    assert D.learn(stats, spark.createDataFrame(lab, "doc_id long, quality int")) in ([], D.learn(
        stats, spark.createDataFrame([(d, 0) for d, _ in lab], "doc_id long, quality int")))
