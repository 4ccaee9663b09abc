"""Text helpers shared by every operator (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by "trim": every code point up to and including the space, the same
# set a JVM String.trim() removes.
_TRIM_CHARS = "".join(chr(i) for i in range(0, 33))


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    return F.trim(col_of(c).cast("string"), F.lit(_TRIM_CHARS))


def normalize(c) -> Column:
    """Trimmed text, blank -> null (the null rule used everywhere)."""
    return F.nullif(trimmed(c), F.lit(""))


def normalize_py(value) -> str | None:
    """Driver-side twin of :func:`normalize` for spec values."""
    if value is None:
        return None
    text = str(value).strip(_TRIM_CHARS)
    return text or None


def upper_norm(c) -> Column:
    return F.upper(normalize(c))


def lower_norm(c) -> Column:
    return F.lower(normalize(c))


# Words read as "true" by the indicator/boolean helpers.
TRUE_WORDS = ("y", "yes", "true", "1", "t", "on")
FALSE_WORDS = ("n", "no", "false", "0", "f", "off")


def as_bool(c, default: bool) -> Column:
    """Boolean view of a Y/N-ish value; blank or unknown text -> default."""
    v = lower_norm(c)
    return (
        F.when(v.isin(*TRUE_WORDS), F.lit(True))
        .when(v.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default))
    )


def indicator(c, default: bool) -> Column:
    """Boolean-ish value -> 'Y' / 'N'."""
    return F.when(as_bool(c, default), F.lit("Y")).otherwise(F.lit("N"))


def is_mutation(doc) -> Column:
    """Comment lines removed, then the document starts with the word ``mutation``."""
    stripped = trimmed(F.regexp_replace(col_of(doc), r"(?m)^\s*#[^\n]*$", ""))
    return F.coalesce(F.lower(stripped).rlike(r"(?s)^mutation\b.*"), F.lit(False))


def json_file_name(name, fallback) -> Column:
    """A result name ends in ``.json`` (appended when missing)."""
    n = F.coalesce(normalize(name), col_of(fallback))
    return F.when(F.lower(n).endswith(".json"), n).otherwise(F.concat(n, F.lit(".json")))


def jsonl_file_name(name, fallback) -> Column:
    """Sidecar name: keep ``.jsonl``; else replace a trailing ``.json`` by ``.jsonl``."""
    n = F.coalesce(normalize(name), col_of(fallback))
    return F.when(F.lower(n).endswith(".jsonl"), n).otherwise(
        F.concat(F.regexp_replace(n, r"(?i)\.json$", ""), F.lit(".jsonl"))
    )
