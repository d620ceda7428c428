"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, then temperature calibration.

Features are hashed 1- to 3-grams of lower-cased letters (anything else is one
space). Document frequencies cover all training rows (one distributed pass).
The classifier is fitted on a bounded, hash-chosen sample of about
``sample_rows`` training rows, balanced over languages, a fifth of which only
sets the temperature; at most ``max_languages`` languages, the most frequent,
are learned. Prediction reads whole texts.

Defined results: text that is null or has no letter is ``und`` with score 0;
without training rows every text is ``und``; rows with a null language or a
null id are never learned from; ties go to the alphabetically first language;
repeated rows are predicted alike; extra columns are kept by ``predict``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import mix, python_ready

DIMENSIONS, ORDERS = 1 << 14, 3
SAMPLE_ROWS, MAX_LANGUAGES, EPOCHS = 4000, 400, 4
PIECE = 1 << 20
_CASE: list[np.ndarray] = []
_U = np.uint64


def _fold_table() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else a space."""
    if not _CASE:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if 0xD800 <= c < 0xE000:
                continue
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _CASE.append(t)
    return _CASE[0]


def letters(text: str) -> np.ndarray:
    """Folded code points, runs of spaces as one."""
    a = _fold_table()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    space = a == 32
    return a[~(space & np.concatenate(([False], space[:-1])))]


def _grams(a: np.ndarray, row: np.ndarray, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of every n-gram of the laid-out rows."""
    shift = _U(64 - dims.bit_length() + 1)
    c = a.astype(np.uint64)
    h = np.zeros(len(a), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, ORDERS + 1):
            if len(a) < n:
                return
            h = h[: len(a) - n + 1] * _U(0x9E3779B97F4A7C15) + c[n - 1:]
            ok = row[: len(h)] == row[n - 1:]
            yield row[: len(h)][ok], (mix(h[ok] + _U(n << 40)) >> shift).astype(np.int64)


def counts(texts: list[str | None], dims: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram counts: rows x dims, whether a row has a letter), in pieces of bounded size."""
    out = np.zeros((len(texts), dims), np.float32)
    has = np.zeros(len(texts), bool)
    arrays, rows, size = [], [], 0

    def flush() -> None:
        if not arrays:
            return
        a = np.concatenate(arrays)
        r = np.repeat(rows, [len(x) for x in arrays])
        for at, feature in _grams(a, r, dims):
            np.add(out, np.bincount(at * dims + feature, minlength=out.size).reshape(out.shape), out=out, casting="unsafe")
        has[np.unique(r[a != 32])] = True
        arrays.clear()
        rows.clear()

    for i, t in enumerate(texts):
        for j in range(0, len(t or ""), PIECE):
            a = letters(t[max(0, j - ORDERS + 1): j + PIECE])
            arrays.append(a)
            rows.append(i)
            size += len(a)
            if size > PIECE:
                flush()
                size = 0
    flush()
    return out, has


def _groups(column, rows: int = 32) -> Iterator[list[str | None]]:
    for i in range(0, len(column), rows):
        yield column.slice(i, rows).to_pylist()


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # dims + 1 (bias) x languages
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.log1p(x) * self.idf
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return (x / np.maximum(norm, 1e-12)) @ self.weights[:-1] + self.weights[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        x, has = counts(texts, len(self.idf))
        p = softmax(self.logits(x) / self.temperature)
        best = p.argmax(axis=1)
        return ([self.languages[b] if h else "und" for b, h in zip(best, has)],
                [float(p[i, b]) if h else 0.0 for i, (b, h) in enumerate(zip(best, has))])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, classes: int, epochs: int = EPOCHS,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4) -> np.ndarray:
    """FTRL-proximal weights (dims + 1 x classes); the last row is the bias."""
    z, n = np.zeros((dims + 1, classes)), np.zeros((dims + 1, classes))

    def weights(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            i, v = rows[r]
            i, v = np.append(i, dims), np.append(v, 1.0)
            zi, ni = z[i], n[i]
            w = weights(zi, ni)
            p = softmax(v @ w)
            p[y[r]] -= 1.0
            g = v[:, None] * p[None, :]
            root = np.sqrt(ni + g * g)
            z[i] = zi + g - (root - np.sqrt(ni)) / alpha * w
            n[i] = ni + g * g
    return weights(z, n)


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 120))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _frequencies(dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dims, np.int64), 0
        for b in batches:
            for texts in _groups(b.column(0)):
                df += (counts(texts, dims)[0] > 0).sum(axis=0)
                n += len(texts)
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["feature", "df"])
    return run


def _features(dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, langs = [], b.column(1).to_pylist()
            for texts in _groups(b.column(0)):
                for row in counts(texts, dims)[0]:
                    i = np.flatnonzero(row).astype(np.int32)
                    out.append(i.tobytes() + row[i].astype(np.float32).tobytes())
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "x"])
    return run


def train(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS,
          max_languages: int = MAX_LANGUAGES, dims: int = DIMENSIONS) -> Model | None:
    """Learn from all given rows that have a text and a language; None if there are none."""
    python_ready(rows.sparkSession)
    t = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    t = t.where("text IS NOT NULL AND lang IS NOT NULL")
    per = t.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages + 1).collect()
    if len(per) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages (none is left out)")
    if not per:
        return None
    df = t.select("text").mapInArrow(_frequencies(dims), "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    freq = dict(df.collect())  # dims + 1 rows at most
    n = freq.pop(-1)
    idf = np.log((1.0 + n) / (1.0 + np.array([freq.get(i, 0) for i in range(dims)]))) + 1.0
    share = {r["lang"]: min(1.0, sample_rows / len(per) / r["count"]) for r in per}
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("key"), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang")), F.lit(0.0))
    sample = t.where(draw < chosen).select("text", "lang").mapInArrow(_features(dims), "lang string, x binary").collect()
    sample.sort(key=lambda r: (r["lang"], r["x"]))
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return None
    xs, ys = [], np.array([languages.index(r["lang"]) for r in sample])
    for r in sample:
        half = len(r["x"]) // 2
        i, c = np.frombuffer(r["x"][:half], np.int32), np.frombuffer(r["x"][half:], np.float32)
        v = np.log1p(c) * idf[i]
        xs.append((i, v / max(np.sqrt((v * v).sum()), 1e-12)))
    fit = np.arange(len(xs)) % 5 != 0
    if len(languages) == 1 or not fit.any():
        return Model(languages, idf, np.zeros((dims + 1, len(languages))), 1.0)
    w = ftrl([x for x, f in zip(xs, fit) if f], ys[fit], dims, len(languages))
    held = [(x, y) for x, y, f in zip(xs, ys, fit) if not f]
    logits = np.array([v @ w[i] + w[-1] for (i, v), _ in held])
    return Model(languages, idf.astype(np.float32), w.astype(np.float32), calibrate(logits, np.array([y for _, y in held])))


def language_column(spark, model: Model | None, text: Column) -> Column:
    """struct<lang, score> of a text column."""
    if model is None:
        return F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)  # dims x languages floats, bounded by the parameters
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def run(column: pa.Array) -> pa.Array:
        names, scores = [], []
        for texts in _groups(column):
            a, b = shared.value.predict(texts)
            names += a
            scores += b
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    return F.arrow_udf(run, "lang string, score double")(text)


def held_out(key: Column) -> Column:
    """One fifth of the ids; never learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def predict(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", **options) -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` (replacing columns of that name)."""
    model = train(docs.where(F.col(key).isNotNull() & ~held_out(F.col(key))), text, lang, key, **options)
    out = docs.withColumn("lang_pred", language_column(docs.sparkSession, model, F.col(text)))
    return out.withColumn("score", F.col("lang_pred.score")).withColumn("lang_pred", F.col("lang_pred.lang"))
