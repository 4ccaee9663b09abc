"""Amounts and cost arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, normalize

AMOUNT_TYPE = "decimal(20,4)"

# Throttle delay bounds in milliseconds.
DEFAULT_THROTTLE_DELAY_MILLIS = 1000
MAX_THROTTLE_DELAY_MILLIS = 10000


def to_decimal_or_null(c, dtype: str = AMOUNT_TYPE) -> Column:
    """Bad amount text -> null (never an error)."""
    return normalize(c).try_cast(dtype)


def throttle_delay_millis(requested, available, restore_rate) -> Column:
    """``ceil((requested - available) / restoreRate, 3) * 1000`` bounded to
    1000..10000 ms; any missing input, a rate <= 0 or no deficit -> 1000 ms."""
    req = to_decimal_or_null(col_of(requested), "decimal(28,6)")
    avail = to_decimal_or_null(col_of(available), "decimal(28,6)")
    rate = to_decimal_or_null(col_of(restore_rate), "decimal(28,6)")
    missing = req - avail
    seconds = F.ceil(missing / rate, 3)
    millis = (seconds * 1000).cast("long")
    bounded = F.least(F.lit(MAX_THROTTLE_DELAY_MILLIS).cast("long"),
                      F.greatest(F.lit(DEFAULT_THROTTLE_DELAY_MILLIS).cast("long"), millis))
    return (
        F.when(req.isNull() | avail.isNull() | rate.isNull() | (rate <= 0) | (missing <= 0),
               F.lit(DEFAULT_THROTTLE_DELAY_MILLIS).cast("long"))
        .otherwise(bounded)
    )
