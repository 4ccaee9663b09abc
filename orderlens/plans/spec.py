"""Read specs compiled to lazy DataFrames (S3 paged read, S4 bulk read).

The remote service used to do the scanning, filtering and sorting; here a spec becomes
``filter -> (keyset page | full result) -> select`` and Catalyst does the rest: filters on
instant columns are pushed into the Parquet scan and the projection prunes nested columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_py
from ..operators.filters import apply_filters
from ..operators.paging import Page, page
from ..operators.projection import attach_children, prune_nested, slice_children
from ..session import written_stage
from .catalog import (ORDERS, SourceDef, clamp, normalize_filters, render_search_query, require_source,
                      resolve_child_page_sizes, resolve_field_paths, resolve_sort_key)


#: Whether an order has more children than the page shows.
MORE_ITEMS = "hasMoreLineItems"


@dataclass
class ReadSpec:
    source_id: str | None = ORDERS
    api_version: str | None = None
    fields: list = field(default_factory=list)
    filters: dict = field(default_factory=dict)
    page_size: object = None
    after: str | None = None
    reverse: object = False
    child_page_sizes: dict = field(default_factory=dict)


@dataclass
class Plan:
    """What a spec resolved to (the metadata K3 reports) plus the DataFrame."""
    source: SourceDef
    paths: list
    filters: dict
    search_query: str
    sort_key: str
    page_size: int | None
    child_sizes: dict
    reverse: bool
    df: DataFrame
    page: Page | None = None


def as_flag(value, default=False) -> bool:
    """A flag of a spec: a boolean or one of the words for it."""
    if isinstance(value, bool):
        return value
    v = normalize_py(value)
    if v is None:
        return default
    return v.lower() in ("y", "yes", "true", "1", "t", "on")


def line_item_columns(children: DataFrame) -> dict:
    """Child fields of the catalogue, taken from a line-item table."""
    return {
        "id": F.col("id"), "name": F.col("name"), "quantity": F.col("quantity"),
        "sku": F.col("sku"), "variant": F.col("variant"),
    }


def read_orders(orders: DataFrame, spec: ReadSpec, line_items: DataFrame | None = None,
                line_item_order=("position",)) -> Plan:
    """S3: validate, filter, keyset page, attach at most n children per order, project.

    ``orders`` has the order shape (``orderlens.sources.adapters``). Children come either
    from a nested ``lineItems`` column or from ``line_items`` (column ``order_id`` = order
    ``id``, child fields, ``line_item_order`` columns)."""
    source = require_source(spec.source_id or ORDERS, spec.api_version)
    paths = resolve_field_paths(source, spec.fields)
    filters = normalize_filters(source, spec.filters)
    size = clamp(spec.page_size, source.default_page_size, source.max_page_size)
    after = normalize_py(spec.after)
    reverse = as_flag(spec.reverse)
    child_sizes = resolve_child_page_sizes(source, paths, spec.child_page_sizes)
    sort_key = resolve_sort_key(source, filters)

    filtered = apply_filters(orders, source, filters)
    pg = page(filtered, sort_key, size, after, reverse)
    rows = pg.rows
    n_items = child_sizes.get("lineItems")
    if n_items is not None:
        if "lineItems" in rows.columns:
            rows = rows.withColumn(MORE_ITEMS, F.coalesce(F.size("lineItems") > n_items, F.lit(False))) \
                .withColumn("lineItems", slice_children("lineItems", n_items))
        elif line_items is not None:
            # a page of at most `size` rows, read by two joins: written once, so orders are scanned once
            rows = attach_children(written_stage(rows, "page"), line_items, "id", "order_id", list(line_item_order),
                                   line_item_columns(line_items), n_items, "lineItems", max_parents=size, truncated=MORE_ITEMS)
        else:
            raise ValueError("lineItems were requested but no line-item input was given.")
    out = rows.select(*prune_nested(rows, paths), *([MORE_ITEMS] if n_items is not None else []), "cursor")
    return Plan(source, paths, filters, render_search_query(source, filters), sort_key, size,
                child_sizes, reverse, out, pg)


def read_orders_bulk(orders: DataFrame, spec: ReadSpec) -> Plan:
    """The bulk form: 20 default fields, child fields refused, no paging, full result."""
    source = require_source(spec.source_id or ORDERS, spec.api_version)
    paths = resolve_field_paths(source, spec.fields, bulk=True)
    filters = normalize_filters(source, spec.filters)
    sort_key = resolve_sort_key(source, filters)
    filtered = apply_filters(orders, source, filters)
    out = filtered.select(*prune_nested(filtered, paths))
    return Plan(source, paths, filters, render_search_query(source, filters), sort_key, None, {},
                False, out)
