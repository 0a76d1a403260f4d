"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from projectpulse.functions.scalar import (  # noqa: F401
    NULL_TOKENS,
    clean_text,
    log_positive,
    logistic,
    null_tokens_to_null,
    parse_timestamp,
    safe_ratio,
    score_0_100,
    trim_chars,
    calendar_day_diff,
)
