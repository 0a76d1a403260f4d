"""Scalar column functions used by staging, variance, features and scoring.

Each returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text the source exports use for a missing value (the
# tokens a pandas CSV reader treats as missing by default).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The characters DuckDB's trim() removes — space and no-break space.
TRIM_CHARS = "\u0020\u00a0"

# Fixed value: the source timestamp text, e.g. "7/4/2021 12:00:00 AM".
SOURCE_TS_FORMAT = "M/d/yyyy h:mm:ss a"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_chars(c, chars: str = TRIM_CHARS) -> Column:
    """Trim the given characters from both ends (default: space and NBSP)."""
    return F.trim(_c(c), F.lit(chars))


def clean_text(c) -> Column:
    """Trimmed text; NULL stays NULL (an all-blank value stays the empty string, as in the source SQL)."""
    return trim_chars(c)


def null_tokens_to_null(c, tokens=None) -> Column:
    """Normalise the reader's missing-value tokens to NULL (pandas-style)."""
    col = _c(c)
    toks = NULL_TOKENS if tokens is None else list(tokens)
    return F.when(col.isin(toks), F.lit(None).cast("string")).otherwise(col)


def parse_timestamp(c, fmt: str = SOURCE_TS_FORMAT) -> Column:
    """Source timestamp text, trimmed and parsed; NULL where it does not match (``stage`` turns
    that into an error in strict mode)."""
    return F.try_to_timestamp(trim_chars(c), F.lit(fmt))


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL on a zero or NULL denominator."""
    d = _c(den)
    return _c(num) / F.when(d != 0, d)


def calendar_day_diff(start, end) -> Column:
    """Calendar-day boundaries from ``start`` to ``end`` (negative = early), as BIGINT."""
    return F.datediff(_c(end), _c(start)).cast("bigint")


def log_positive(c) -> Column:
    """``ln(x)`` for x > 0, else NULL (zero and negatives count as missing)."""
    col = _c(c)
    return F.when(col > 0, F.ln(col))


def logistic(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def score_0_100(p) -> Column:
    """Probability → integer score, rounding half to even like numpy."""
    return F.bround(_c(p) * 100.0, 0).cast("int")
