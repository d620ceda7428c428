import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import langid
from ledgerline.llm.queries import QUERIES
from tests.llm.conftest import SF


def test_held_out_accuracy(spark):
    out = QUERIES["op6_language_id"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = out.collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_learns_only_from_its_rows(spark, clashing):
    """Neither held-out rows nor the language, source or id of a row change its prediction."""
    ask = lambda d: {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.predict(d).select("doc_id", "text", "lang_pred", "score").collect()}
    one = ask(clashing)
    hidden = clashing.withColumn("lang", F.when(~langid.held_out(F.col("doc_id")), F.col("lang")).otherwise(F.lit("xx")))
    hidden = hidden.withColumn("source", F.lit("other"))
    assert ask(hidden) == one


def test_edge_rows(spark, clashing):
    out = langid.predict(clashing)
    assert out.columns == [*clashing.columns, "lang_pred"] and out.count() == clashing.count()
    rows = {r.doc_id: r for r in out.collect()}
    for i in (900001, 900002, 900003):
        assert rows[i].lang_pred == "und" and rows[i].score == 0.0
    assert rows[None].lang_pred == "en"
    unknown = spark.createDataFrame([(1, "some text", None), (5, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(unknown).collect()} == {"und"}
    assert langid.predict(clashing.limit(0)).count() == 0


def test_one_language_is_enough(spark):
    df = spark.createDataFrame([(i, "nur deutsch hier", "de") for i in range(20)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(df).collect()} == {"de"}


def test_counts_are_the_plain_counts():
    texts = ["Ab, c", None, "ÀÀ à!", "", "x" * 10]
    x, has = langid.counts(texts, 1 << 10)
    assert has.tolist() == [True, False, True, False, True]
    fold = ["ab c", "", "àà à ", "", "x" * 10]
    assert x.sum(axis=1).tolist() == [sum(max(len(f) - n + 1, 0) for n in (1, 2, 3)) for f in fold]
    assert np.array_equal(langid.counts(["xx"], 1 << 10)[0][0] > 0, langid.counts(["xx"], 1 << 10)[0][0] > 0)


def test_long_text_in_pieces(monkeypatch):
    text = "wörter und mehr, " * 500
    whole = langid.counts([text])[0]
    monkeypatch.setattr(langid, "PIECE", 1000)
    pieces = langid.counts([text])[0]
    assert abs(whole - pieces).sum() <= 8 * 5 * 3  # only n-grams at the seams


def test_ftrl_learns_sparse_weights():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 300)
    rows = [(np.array([c, 3 + rng.integers(0, 50)]), np.array([1.0, 1.0])) for c in y]
    w = langid.ftrl(rows, y, 60, 3, l1=1.0)
    assert all((w[i[0]]).argmax() == c for (i, _), c in zip(rows, y))
    assert (w[3:53] == 0).mean() > 0.5  # the noise is mostly shrunk away


def test_temperature():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3))
    y = np.array([rng.choice(3, p=p) for p in langid.softmax(z)])
    assert abs(np.log(langid.calibrate(z * 5, y) / 5)) < 0.25


def test_more_languages_than_the_bound_are_an_error(spark):
    import pytest
    rows = [(i, f"text number {i} of some words", f"l{i % 3}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.train(df, max_languages=2)
