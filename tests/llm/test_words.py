import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm.common import python_ready, shingles, span_hashes, string_buffer, word_count, word_hashes, word_spans, words_column
from tests.llm.conftest import words

TEXT = st.text(alphabet=st.sampled_from("aAbZz09 ,.\n\tÉéß你🎈-"), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=8))
def test_word_hashes_follow_the_definition(texts):
    h, at = word_hashes(pa.array(texts, pa.string()))
    expected = [words(t) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in expected]
    seen = {}
    for w, x in zip(sum(expected, []), h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6), st.integers(1, 6))
def test_shingles_are_equal_as_their_words_are(texts, k):
    h, first = shingles(*word_hashes(pa.array(texts, pa.string())), k)
    seen = {}
    for i, t in enumerate(texts):
        w = words(t)
        grams = [tuple(w[j: j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] * bool(w)
        assert first[i + 1] - first[i] == len(grams)
        for g, x in zip(grams, h[first[i]: first[i + 1]].tolist()):
            assert seen.setdefault(g, x) == x
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_pieces():
    buf, off = string_buffer(pa.array(["alpha beta gamma " * 50, "beta"]))
    start, end, _ = word_spans(buf, off)
    assert (span_hashes(buf, start, end, 16) == span_hashes(buf, start, end)).all()


def test_word_columns(spark):
    texts = ["Hello, WORLD 9x", None, "", "É été—ß", "a\x00b\tc\x7fd", " lead trail "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", words_column(F.col("t")).alias("w"), word_count(F.col("t")).alias("n")).collect()
    for r in rows:
        assert r.w == words(texts[r.i]) and r.n == len(r.w)


def test_batches_are_bounded_by_bytes(spark):
    """A worker gets rows of long texts by few megabytes, however many rows a batch may have."""
    python_ready(spark)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    long_ = spark.range(24, numPartitions=1).selectExpr("repeat('long text ', 100000) AS text")
    got = long_.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 24 and max(r.bytes for r in got) < 6 << 20
