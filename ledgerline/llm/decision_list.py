"""Quality rules: text statistics and a learned decision list, in DataFrame
functions only.

Sequential covering: the labelled statistics are binned at quantiles and
counted into cells (one aggregation over all labelled rows; at most
``(cuts + 1) ** features`` cells reach the driver, whatever the input). Over
these counts a rule, a conjunction of thresholds, is *grown* by FOIL gain on
two thirds of the rows and *pruned* on the rest; the rows it covers are then
set aside and the next rule is learned. The result is an ordered Spark
``CASE WHEN``.

Defined results: a null or empty text has no words and fails the base rules; a
null id is carried through and never labelled; repeated rows are judged alike;
without labels of both kinds the list is empty and the base rules decide;
of several labels of one document the worst counts; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, let, upto

SPACE = "[\\x20\\x09-\\x0D]+"
SPACES, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
CUTS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
FEATURES = ("n_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share")


def _repeat_words(words: Column, k: int = 5) -> Column:
    """Words inside k-word windows that the text has twice or more."""
    def covered(g: Column) -> Column:
        z = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        at = let(z, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda e, j: (e["x"] == F.get(s, j - 1)["x"]) | (e["x"] == F.get(s, j + 1)["x"])),
            lambda e: e["i"])))
        return let(at, lambda p: F.aggregate(F.transform(
            p, lambda v, j: F.least(F.coalesce(F.get(p, j + 1) - v, F.lit(k)), F.lit(k))),
            F.lit(0), lambda a, b: a + b))

    grams = let(words, lambda w: F.transform(upto(F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i + 1, F.lit(k)))))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)
    per row; lines are those with a word."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), t.alias("t"), F.array_remove(F.split(t, SPACE), "").alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    d = d.select("id", "w", (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
                 F.length(F.translate("t", SPACES, "")).alias("word_chars"),
                 let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("l"))
    return d.select("id", *[x.cast("long").alias(n) for n, x in (
        ("n_words", F.size("w")), ("word_chars", F.col("word_chars")), ("n_symbols", F.col("n_symbols")),
        ("n_lines", F.col("l.n")), ("n_dup_lines", F.col("l.d")), ("n_repeat_words", _repeat_words(F.col("w"))))])


def features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_share": F.col("n_repeat_words") / n,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, above?, threshold) and what it says."""
    terms: tuple[tuple[str, bool, float], ...]
    bad: bool = True

    def column(self) -> Column:
        f = features()
        out = F.lit(True)
        for name, above, cut in self.terms:
            out = out & (f[name] > F.lit(cut) if above else f[name] <= F.lit(cut))
        return out


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality",
          max_rules: int = 8, max_terms: int = 4, least_precision: float = 0.9, least_cover: int = 10,
          cuts: tuple[float, ...] = CUTS) -> list[Rule]:
    """The ordered rules that tell bad documents (label 0)."""
    lab = (labels.select(F.col(id_col).alias("l_id"), F.col(good_col).alias("good"))
           .where(F.col("l_id").isNotNull() & F.col("good").isNotNull()).groupBy("l_id").agg(F.min("good").alias("good")))
    f = features()
    rows = stats.join(lab, F.col("id") == F.col("l_id")).select(
        "id", (F.col("good") == 0).alias("bad"), *[f[n].alias(n) for n in FEATURES])
    # exact thresholds would not differ between runs more than these: one value per quantile, from all labelled rows
    q = rows.agg(*[F.percentile_approx(n, list(cuts), 100_000).alias(n) for n in FEATURES]).first()
    if q is None or q[FEATURES[0]] is None:
        return []
    at = {n: sorted(set(q[n])) for n in FEATURES}
    bins = [sum([(F.col(n) > F.lit(c)).cast("int") for c in at[n]], F.lit(0)).alias(n) for n in FEATURES]
    cells = (rows.select((F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("prune"), "bad", *bins)
             .groupBy("prune", "bad", *FEATURES).count().collect())
    return cover([(tuple(c[n] for n in FEATURES), c["bad"], c["prune"], c["count"]) for c in cells],
                 at, max_rules, max_terms, least_precision, least_cover)


def cover(cells: list, at: dict[str, list[float]], max_rules: int, max_terms: int, least_precision: float,
          least_cover: int) -> list[Rule]:
    """Sequential covering over counted cells (bins, bad?, prune?, count)."""
    terms = [(i, above, j) for i, n in enumerate(FEATURES) for j in range(len(at[n])) for above in (True, False)]

    def holds(b: tuple, rule: tuple) -> bool:
        return all((b[i] > j) == above for i, above, j in rule)

    def counts(rows: list, rule: tuple) -> tuple[int, int]:
        p = n = 0
        for b, bad, _, c in rows:
            if holds(b, rule):
                p, n = (p + c, n) if bad else (p, n + c)
        return p, n

    out: list[Rule] = []
    left = cells
    while len(out) < max_rules:
        grow, prune = [c for c in left if not c[2]], [c for c in left if c[2]]
        rule: tuple = ()
        p0, n0 = counts(grow, rule)
        if p0 < least_cover:
            break
        inside = grow
        while len(rule) < max_terms and n0:
            def gain(t: tuple) -> tuple[float, int]:
                p, n = counts(inside, (t,))
                return (p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0), p
            best = max(terms, key=gain)
            if gain(best)[0] <= 1e-9:
                break
            rule += (best,)
            inside = [c for c in inside if holds(c[0], (best,))]
            p0, n0 = counts(inside, ())

        def worth(r: tuple) -> float:
            p, n = counts(prune, r)
            return (p + 1) / (p + n + 2)
        while len(rule) > 1 and (shorter := max((rule[:i] + rule[i + 1:] for i in range(len(rule))), key=worth)) \
                and worth(shorter) >= worth(rule):
            rule = shorter
        p, n = counts(left, rule)
        if not rule or p < least_cover or p / (p + n) < least_precision or worth(rule) < least_precision - 0.1:
            break
        out.append(Rule(tuple((FEATURES[i], above, at[FEATURES[i]][j]) for i, above, j in rule)))
        left = [c for c in left if not holds(c[0], rule)]
    return out


def verdict(rules: list[Rule]) -> Column:
    """True (kept) unless the first rule that holds says bad."""
    out = None
    for r in rules:
        out = (F.when if out is None else out.when)(r.column(), F.lit(not r.bad))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", good_col: str = "quality") -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of every document row (column
    ``id``). The statistics are written once; learning and judging read them."""
    stats = Scratch(docs.sparkSession, "quality").table(text_statistics(docs, id_col, text_col), "stats")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rules = learn(stats.where(~failed), labels, label_id, good_col)  # the list judges what the base rules pass
    return stats.select("*", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
