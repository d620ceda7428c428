import json
import os
import subprocess
import sys


import corpus_pipeline
from ledgerline.llm import queries
from tests.llm.conftest import SF, words
from tests.llm.test_bagminhash import classes
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_packing import check_all
from tests.llm.test_passages import exact_repeats

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows(df):
    return sorted((str(r.doc_id), r.text) for r in df.select("doc_id", "text").collect())


def test_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]


def test_language_stage_keeps_clean_documents(spark, clashing):
    out = stage("language_id")(spark, clashing, SF)
    assert out.columns == clashing.columns
    gone = set(r.doc_id for r in clashing.collect()) - set(r.doc_id for r in out.collect())
    assert {900001, 900002, 900003} <= gone and not any(d is None or d < 900000 for d in gone)


def test_near_dedup_stage_equals_all_pairs(spark, clashing):
    out = stage("near_dedup")(spark, clashing, SF)
    assert out.columns == clashing.columns
    label = classes([(r.doc_id, r.text) for r in clashing.collect()])
    no_word = sum(not words(r.text) for r in clashing.collect())
    kept = [r.doc_id for r in out.collect() if words(r.text)]
    assert len(kept) == len(set(kept)) == len({c for _, c in label}) - no_word
    assert {str(d) for d in kept} <= {c for _, c in label}


def test_substring_stage_cuts_repeated_passages(spark, clashing):
    out = stage("substring_dedup")(spark, clashing, SF)
    assert out.columns == clashing.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    gone = exact_repeats([(r.doc_id, r.text) for r in clashing.collect()])
    after = {d: len(words(t)) for d, t in left if d is not None}
    for d, t in {r.doc_id: r.text for r in clashing.collect() if r.doc_id is not None}.items():
        assert after.get(d, 0) <= len(words(t)) - len(gone[d])
    assert all(not x for x in exact_repeats([x for x in left if x[0] != 900007]).values())
    assert out.where("n_chars != length(text)").count() == 0


def test_decontamination_stage(spark, clashing):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in clashing.collect()]
    out = stage("decontamination")(spark, clashing, SF)
    clean = [h[2] == 0 for h in map(lambda d: hits([d], items, 10)[0], docs)]
    assert out.columns == clashing.columns and 0 < clean.count(False) < len(docs)
    assert rows(out) == sorted((str(d), t) for (d, t), c in zip(docs, clean) if c) or len(rows(out)) == clean.count(True)


def test_whole_run(spark):
    pieces = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = f(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    pad, total = check_all(pieces.collect(), docs)
    assert total and pad <= 0.05 * total


def test_empty_documents(spark, documents):
    docs = documents.limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, SF).count() == 0


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert {n.split("_")[0] for n in queries.ORACLES} == {"op1", "op2", "op8", "op10"}


def test_the_rest_works_without_these_folders(tmp_path):
    """The entry module imports from a tree that has neither the subpackage nor the pipeline."""
    entry = (tmp_path / "__spark_entry__.py")
    entry.write_text(open(f"{ROOT}/__spark_entry__.py").read())
    pkg = tmp_path / "ledgerline"
    pkg.mkdir()
    for n in os.listdir(f"{ROOT}/ledgerline"):
        if n not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/ledgerline/{n}", pkg / n)
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    names, oracles = json.loads(got.stdout.strip().splitlines()[-1])
    assert "sales_daily" in names and "pipeline" not in names and not any(n.startswith("op") for n in names + oracles)
