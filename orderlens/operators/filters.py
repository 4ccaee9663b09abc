"""Filters and predicates (F1, F2, F4, F5) compiled to Columns.

Datetime predicates compare a typed instant column, so that on Parquet-backed inputs the
comparison reaches the scan as ``PushedFilters`` (GreaterThanOrEqual / LessThan).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.instants import parse_instant_py, parse_iso_instant
from ..functions.text import normalize
from ..plans.catalog import SourceDef

INSTANT_PREFIX = "_ts_"
# Date partition columns a stored order table may carry (``write_records(partition_by_day=...)``).
PARTITION_DATE_COLUMNS = {"createdAt": "created_date", "updatedAt": "updated_date", "processedAt": "processed_date"}


def instant_column(df: DataFrame, name: str) -> Column:
    """Typed instant for a DateTime field: the shadow column ``_ts_<name>`` when the input
    carries one (adapters derive it straight from a timestamp column), else the text parsed."""
    shadow = INSTANT_PREFIX + name
    if shadow in df.columns:
        return F.col(shadow)
    return parse_iso_instant(F.col(name))


def instant_literal(df: DataFrame, name: str, iso_text: str) -> Column:
    """A literal of the same timestamp flavour as the instant column (no cast on the column)."""
    value = parse_instant_py(iso_text)
    shadow = INSTANT_PREFIX + name
    if shadow in df.columns and isinstance(df.schema[shadow].dataType, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ") + "Z").cast("timestamp")


def compile_filters(df: DataFrame, source: SourceDef, filters: dict) -> Column | None:
    """every normalised filter as a predicate, AND-ed; None when there are none.

    F1: ``From`` is ``>=``, ``To`` is ``<`` (half-open). F2: keyword equality, case-insensitive."""
    defs = source.filters_by_key()
    preds = []
    for key, value in filters.items():
        d = defs[key]
        if d.type == "datetime":
            c = instant_column(df, d.column)
            lit = instant_literal(df, d.column, value)
            preds.append(c >= lit if d.comparator == ">=" else c < lit)
            day_col = PARTITION_DATE_COLUMNS.get(d.column)
            if day_col in df.columns:
                # implied predicate on the date partition column: lets Spark prune partitions
                day = F.to_date(F.lit(value[:10]))
                preds.append(F.col(day_col) >= day if d.comparator == ">=" else F.col(day_col) <= day)
        else:
            preds.append(F.lower(F.col(d.column)) == F.lit(value.lower()))
    return reduce(and_, preds) if preds else None


def apply_filters(df: DataFrame, source: SourceDef, filters: dict) -> DataFrame:
    pred = compile_filters(df, source, filters)
    return df if pred is None else df.filter(pred)


def not_keyword(c, value: str) -> Column:
    """negated term, e.g. ``-return_status:no_return``; null status is kept."""
    return ~F.lower(normalize(c)).eqNullSafe(F.lit(value.lower()))
