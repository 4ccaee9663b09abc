"""Sorts, keyset pages and caps.

A page is ``filter(after cursor) -> orderBy -> limit`` which Spark plans as one
``TakeOrderedAndProject`` (a per-partition top-k, then a merge of at most
partitions x page-size rows): no full sort of the input, whatever its size.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.instants import format_instant, parse_instant_py
from .filters import instant_column, instant_literal

# Sort keys and the DateTime field each one orders by.
SORT_FIELDS = {"UPDATED_AT": "updatedAt", "CREATED_AT": "createdAt", "PROCESSED_AT": "processedAt"}


def sort_columns(df: DataFrame, sort_key: str, reverse: bool, id_col: str = "id") -> list[Column]:
    """Sort on the key's instant, nulls last, with an id tiebreak (ours) for a total order."""
    k = instant_column(df, SORT_FIELDS[sort_key])
    if reverse:
        return [k.desc_nulls_last(), F.col(id_col).desc_nulls_last()]
    return [k.asc_nulls_last(), F.col(id_col).asc_nulls_last()]


def encode_cursor(sort_text: str | None, row_id: str) -> str:
    return base64.urlsafe_b64encode(json.dumps([sort_text, row_id]).encode()).decode()


def decode_cursor(cursor: str) -> tuple:
    try:
        sort_text, row_id = json.loads(base64.urlsafe_b64decode(cursor.encode()).decode())
        return sort_text, row_id
    except Exception as exc:  # noqa: BLE001 - any malformed text is the same error
        raise ValueError("Cursor is not valid.") from exc


def cursor_column(df: DataFrame, sort_key: str, id_col: str = "id") -> Column:
    """Edge cursor of each row: (sort instant text, id), opaque to callers."""
    k = instant_column(df, SORT_FIELDS[sort_key])
    payload = F.to_json(F.array(format_instant(k), F.col(id_col)))
    return F.translate(F.base64(F.encode(payload, "UTF-8")), "+/", "-_")


def after_predicate(df: DataFrame, sort_key: str, cursor: str, reverse: bool, id_col: str = "id") -> Column:
    """Keyset condition: rows strictly after the cursor in the page order (nulls last)."""
    sort_text, row_id = decode_cursor(cursor)
    field = SORT_FIELDS[sort_key]
    k, i = instant_column(df, field), F.col(id_col)
    if sort_text is None or parse_instant_py(sort_text) is None:
        return k.isNull() & ((i < F.lit(row_id)) if reverse else (i > F.lit(row_id)))
    v = instant_literal(df, field, sort_text)
    # a bound on the key alone, which the scan can use, and the rows of the cursor's own instant up to
    # it taken out; the second part shares no term with the first, or the optimizer would fold both
    # into one OR that no scan understands
    if reverse:
        return ((k <= v) | k.isNull()) & ~(k.eqNullSafe(v) & (i >= F.lit(row_id)))
    return ((k >= v) | k.isNull()) & ~(k.eqNullSafe(v) & (i <= F.lit(row_id)))


@dataclass
class Page:
    rows: DataFrame          # at most ``size`` rows, in page order, with a ``cursor`` column
    probe: DataFrame         # at most ``size + 1`` rows: decides ``hasNextPage``
    size: int

    def info(self) -> DataFrame:
        """pageInfo: hasNextPage and endCursor (cursor of the last row of the page)."""
        p = self.probe.select("cursor", "_page_pos")
        return p.agg(
            (F.count(F.lit(1)) > self.size).alias("hasNextPage"),
            F.max_by(F.when(F.col("_page_pos") <= self.size, F.col("cursor")),
                     F.when(F.col("_page_pos") <= self.size, F.col("_page_pos"))).alias("endCursor"),
        )


def page(df: DataFrame, sort_key: str, size: int, after: str | None = None, reverse: bool = False,
         id_col: str = "id") -> Page:
    """One keyset page. ``rows`` keeps every input column plus ``cursor``."""
    if after:
        df = df.filter(after_predicate(df, sort_key, after, reverse, id_col))
    # one top-k of size + 1 rows; cursor texts and positions are made for those rows only
    top = df.orderBy(*sort_columns(df, sort_key, reverse, id_col)).limit(size + 1)
    probe = top.withColumn("cursor", cursor_column(top, sort_key, id_col)).withColumn(
        "_page_pos", F.row_number().over(Window.orderBy(*sort_columns(top, sort_key, reverse, id_col))))
    rows = probe.filter(F.col("_page_pos") <= size).orderBy("_page_pos").drop("_page_pos")
    return Page(rows=rows, probe=probe, size=size)


def truncated_flag(df: DataFrame, max_rows: int | None) -> DataFrame:
    """One-row frame: did the input hold more than ``max_rows`` rows?"""
    if max_rows is None:
        return df.sparkSession.range(1).select(F.lit(False).alias("truncated"))
    return df.limit(max_rows + 1).agg((F.count(F.lit(1)) > max_rows).alias("truncated"))
