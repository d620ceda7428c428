"""Scalar expressions reproducing pandas/numpy behaviour with built-in Spark functions.

Everything here returns a Column made of built-in functions, so it stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from functools import cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: a plain decimal / scientific number (what numeric coercion
# accepts), an ISO calendar date, and leading/trailing whitespace (every
# Unicode white space, as str.strip() removes it).
NUMBER_PATTERN = r"[+-]?+(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SPACE_CLASS = (r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
PADDED_NUMBER_PATTERN = rf"\A{SPACE_CLASS}*+({NUMBER_PATTERN}){SPACE_CLASS}*+\z"
EDGE_SPACE_PATTERN = rf"\A{SPACE_CLASS}+|{SPACE_CLASS}+\z"
# A run of cased characters, or of others.
WORD_RUN_PATTERN = r"([\p{IsLowercase}\p{IsUppercase}\p{Lt}]+|[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]+)"
# One run of ASCII letters, then ASCII characters that are none.
ONE_WORD_PATTERN = r"\A[A-Za-z]*+[\x00-\x40\x5B-\x60\x7B-\x7F]*+\z"
FIRST_EXCEPTION = "\u00df"


@cache
def title_exceptions() -> dict[str, str]:
    """Characters whose title case is not their upper case (ligatures, digraphs, iota subscripts)."""
    chars = map(chr, range(ord(FIRST_EXCEPTION), 0x10000))
    return {c: c.title() for c in chars if c.title() != c.upper()}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """str.strip(): remove all leading/trailing whitespace (trim() only removes spaces).
    Text that begins and ends with a printable ASCII character is left as it is."""
    c = _c(c)
    edge = lambda at: F.substring(c, at, 1).between(F.lit("!"), F.lit("~"))
    return F.when(edge(1) & edge(-1), c).otherwise(F.regexp_replace(c, EDGE_SPACE_PATTERN, ""))


def title_case(c) -> Column:
    """str.title(): the first character of every run of cased characters in
    title case, the rest in lower case.

    ``initcap`` only splits on spaces ('usb-c' -> 'Usb-c'); this splits on any
    uncased character ('usb-c' -> 'Usb-C'). Characters whose title case differs
    from their upper case ('\u00df' -> 'Ss') are looked up; no others are. One
    ASCII word with no letter after it needs no splitting.
    """
    c = _c(c)
    runs = F.regexp_extract_all(F.lower(c), F.lit(WORD_RUN_PATTERN), 1)
    special = F.create_map(*[F.lit(x) for x in chain.from_iterable(title_exceptions().items())])

    def titled(run):
        first = F.substring(run, 1, 1)
        head = F.when(first < F.lit(FIRST_EXCEPTION), F.upper(first)) \
            .otherwise(F.coalesce(F.try_element_at(special, first), F.upper(first)))
        return F.concat(head, F.substring(run, 2, 1 << 30))
    one_word = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
    return F.when(c.rlike(ONE_WORD_PATTERN), one_word).otherwise(F.array_join(F.transform(runs, titled), ""))


def safe_double(c) -> Column:
    """to_numeric(errors='coerce'): a number string -> double, anything else -> null.

    The pattern guard rejects what Spark would otherwise accept ('2.5d', 'NaN',
    'Infinity'), and a number beyond the doubles ('1e400') is invalid too, so no
    non-finite value ever reaches a comparison or a sum.
    """
    # one pattern and one cast: several such columns make a method that the JVM still compiles
    value = F.regexp_extract(_c(c), PADDED_NUMBER_PATTERN, 1).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def safe_date(c) -> Column:
    """Strict yyyy-MM-dd parse, invalid -> null (ANSI to_date would raise)."""
    s = F.trim(_c(c))
    return F.when(s.rlike(DATE_PATTERN), s.try_cast("date"))


def np_round2(c) -> Column:
    """numpy round(x, 2): half-to-even on x*100."""
    return F.rint(_c(c) * 100) / 100


def money_sum(c, scale: int = 6) -> Column:
    """Sum of a money column accumulated in decimal, returned as double.

    Each value is fixed to ``scale`` decimals before adding, so the total is
    exact and independent of partitioning and task order: two runs over the
    same data (or a re-run after an executor loss) give bit-identical totals.
    """
    return F.sum(_c(c).cast(f"decimal(38,{scale})")).cast("double")
