"""Exchanges: sweep (S7 F5 F6 W1 W2 P9 A4 T5), nested state (P6 P7 J2 A5), presence.

Returns sit in a child table. The sweep needs only totals and the first match of each order, so it
is one aggregation by order, combined before the shuffle: no array, no window and no limit on the
number of returns. The state's result is nested by contract; its returns are packed once per order.
Caps are options, off by default, and a capped result says where it was cut.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import legacy_from_gid, order_number, to_order_gid_state
from ..functions.instants import format_instant_py, parse_iso_millis
from ..functions.messages import is_canceled
from ..functions.money import to_decimal_or_null
from ..functions.text import normalize, trimmed
from ..session import written_stage
from ..sources.gate import behind
from .filters import instant_column, instant_literal, not_keyword
from .paging import sort_columns, truncated_flag
from .projection import attach_children
from .rownum import number_rows

# Fixed value: orders on a page of the original sweep.
SWEEP_PAGE_SIZE = 100

RETURN_FIELDS = ("id", "name", "status", "createdAt", "exchangeLineItems")


def _named(fields) -> dict:
    return fields if isinstance(fields, dict) else {f: F.col(f) for f in fields}


def nest_returns(orders: DataFrame, returns: DataFrame, order_cols, cap: int | None = None,
                 fields=RETURN_FIELDS) -> DataFrame:
    """T5: the returns of each order (list order) as array column ``returns``; with ``cap`` the
    first that many, and ``returnsTruncated`` says which orders had more.

    ``fields`` is a list of return columns, or a dict {field: Column} of expressions over the
    return rows, evaluated after a cap (so the rows sorted and shuffled stay narrow)."""
    return attach_children(orders, returns, "id", "order_id", list(order_cols), _named(fields), cap, "returns",
                           truncated="returnsTruncated" if cap else None)


def _has_exchange(r) -> Column:
    """A non-empty exchange item list (its entries are not inspected here)."""
    return F.size(F.coalesce(r["exchangeLineItems"], F.array())) > 0


def live_exchange(r) -> Column:
    """>= 1 exchange item and not cancelled; ``r`` is a return struct or {field: Column}."""
    return F.coalesce(_has_exchange(r) & ~is_canceled(r["status"]), F.lit(False))


def in_window_live_exchange(r, start_ms: int, end_ms: int) -> Column:
    """a live exchange whose createdAt parses and start <= t < end."""
    t = parse_iso_millis(r["createdAt"])
    return live_exchange(r) & t.isNotNull() & (t >= F.lit(start_ms)) & (t < F.lit(end_ms))


def first_in_window_return(returns: Column, start_ms: int, end_ms: int) -> Column:
    """W1 on nested input: the first matching return in list order (null when none)."""
    return F.get(F.filter(returns, lambda r: r.isNotNull() & in_window_live_exchange(r, start_ms, end_ms)), 0)


def count_exchange_returns(returns: Column) -> Column:
    """A4 on nested input: live exchanges of any date."""
    return F.size(F.filter(F.coalesce(returns, F.array()), lambda r: r.isNotNull() & live_exchange(r)))


def exchange_totals(returns: DataFrame, return_order, start_ms: int, end_ms: int, fields=RETURN_FIELDS,
                    key: str = "order_id") -> DataFrame:
    """W1 and A4 over the return table: per ``key`` the count of live exchanges, the count of
    returns, and the first in-window live exchange in list order."""
    r = _named(fields)
    hit = in_window_live_exchange(r, start_ms, end_ms)
    first = F.struct(r["id"].alias("id"), r["name"].alias("name"), r["status"].alias("status"),
                     parse_iso_millis(r["createdAt"]).alias("createdMillis"))
    return returns.groupBy(key).agg(
        F.count_if(live_exchange(r)).alias("exchangeReturnCount"),
        F.count(F.lit(1)).alias("returnCount"),
        F.min_by(F.when(hit, first), F.when(hit, F.struct(*return_order))).alias("hit"),
    )


def sweep_candidates(orders: DataFrame, start_iso: str) -> DataFrame:
    """``updatedAt >= start`` (no upper bound: later activity must not hide an in-window
    return) and return status other than ``no_return`` (F5)."""
    ts = instant_column(orders, "updatedAt")
    return orders.filter((ts >= instant_literal(orders, "updatedAt", start_iso)) & not_keyword(F.col("returnStatus"), "no_return"))


def sweep_exchanges(orders: DataFrame, returns: DataFrame, return_order, start_ms: int, end_ms: int,
                    max_pages: int | None = None, page_size: int = SWEEP_PAGE_SIZE, fields=RETURN_FIELDS,
                    status: DataFrame | None = None, keys: tuple[str, str] = ("id", "order_id")):
    """S7 -> optional T4 cap (``max_pages x page_size`` orders in updatedAt order) -> W1 ->
    legacy id present (no gid fallback here) -> P9 with A4.

    Returns ``(exchanges, truncated)``; ``truncated`` is a one-row frame. ``max_pages=None``
    (no cap) is the default: the sweep sees every candidate. ``status`` is the lookup's one-row
    status (column ``ok``): a failed lookup yields no exchanges. ``keys`` name the columns of orders and
    returns that belong together; take the stored keys, if there are any, so that no id text is
    aggregated or shuffled."""
    cands = sweep_candidates(orders, format_instant_py(_dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=start_ms)))
    cap = None if max_pages is None else max_pages * page_size
    truncated = truncated_flag(cands, cap)
    if cap is not None:
        cands = cands.orderBy(*sort_columns(cands, "UPDATED_AT", False)).limit(cap)
    exchanges = sweep_rows(cands, returns, return_order, start_ms, end_ms, fields, keys).drop("_key")
    return behind(exchanges, status), truncated


def sweep_rows(candidates: DataFrame, returns: DataFrame, return_order, start_ms: int, end_ms: int, fields=RETURN_FIELDS,
               keys: tuple[str, str] = ("id", "order_id")) -> DataFrame:
    """W1, A4 and P9 for candidate orders: the rows of the sweep, with the order's ``_key``."""
    own, other = keys
    totals = exchange_totals(returns, return_order, start_ms, end_ms, fields, other).filter(F.col("hit").isNotNull())
    known = candidates.filter(F.coalesce(F.col("legacyResourceId"), F.lit("")) != "").select(F.col(own).alias("_key"), "legacyResourceId", "name")
    return known.join(totals, known["_key"] == totals[other]).select(
        "_key",
        F.col("legacyResourceId").alias("externalId"),
        F.col("name").alias("orderName"),
        F.col("hit.id").alias("returnId"),
        F.col("hit.name").alias("returnName"),
        F.col("hit.status").alias("returnStatus"),
        F.col("hit.createdMillis").alias("returnCreatedAtMillis"),
        F.col("exchangeReturnCount").cast("int").alias("exchangeReturnCount"),
    )


# --- P7 / P6 / J2 -----------------------------------------------------------------------

ITEM_STRUCT = "struct<id:string,sku:string,quantity:string>"
ITEM_SCHEMA = f"array<{ITEM_STRUCT}>"


def child_shape(text: Column) -> Column:
    """Nested list text in either shape -> struct of ``items`` and ``shape``.

    A plain JSON list -> ``list``; an object with a ``nodes`` list -> ``connection``; anything
    else -> empty list, shape null. Entries that are not objects are dropped. A list is read as the
    ``nodes`` of an object, so that one parse serves both shapes; only where that finds no list of
    objects is each entry kept as raw text first, so one bad entry does not void the list."""
    t = normalize(text)
    as_object = F.when(t.startswith("["), F.concat(F.lit('{"nodes":'), t, F.lit("}"))).when(t.startswith("{"), t)
    raw = F.filter(F.from_json(as_object, "nodes array<string>")["nodes"], lambda x: F.coalesce(F.trim(x).startswith("{"), F.lit(False)))
    nodes = F.coalesce(F.from_json(as_object, f"nodes {ITEM_SCHEMA}")["nodes"], F.transform(raw, lambda x: F.from_json(x, ITEM_STRUCT)))
    read = F.struct(t.alias("t"), nodes.alias("nodes"))

    def named(r: Column) -> Column:
        shape = F.when(r["nodes"].isNotNull(), F.when(r["t"].startswith("["), F.lit("list")).otherwise(F.lit("connection")))
        items = F.filter(F.coalesce(r["nodes"], F.array().cast(ITEM_SCHEMA)), lambda x: x.isNotNull())
        return F.struct(items.alias("items"), shape.alias("shape"))
    return F.get(F.transform(F.array(read), named), 0)  # names the parse, which both fields need


def normalize_child_shape(text: Column) -> tuple[Column, Column]:
    """P7 as two columns (items, shape)."""
    both = child_shape(text)
    return both["items"], both["shape"]


def with_child_shape(df: DataFrame, text_col: str, items: str = "items", shape: str = "shape") -> DataFrame:
    """P7 for a column of a table: :func:`child_shape` as two more columns, the parse in one of its own,
    which generated code runs."""
    t, nodes = F.col(f"__{items}_text"), F.col(f"__{items}_nodes")
    step = df.withColumn(f"__{items}_text", trimmed(F.col(text_col)))
    as_object = F.when(t.startswith("["), F.concat(F.lit('{"nodes":'), t, F.lit("}"))).when(t.startswith("{"), t)
    step = step.withColumn(f"__{items}_nodes", F.from_json(as_object, "nodes array<string>")["nodes"])
    objects = F.transform(F.filter(nodes, lambda x: F.coalesce(F.trim(x).startswith("{"), F.lit(False))), lambda x: F.from_json(x, ITEM_STRUCT))
    kept = F.filter(F.coalesce(objects, F.array().cast(ITEM_SCHEMA)), lambda x: x.isNotNull())
    named = F.when(nodes.isNotNull(), F.when(t.startswith("["), F.lit("list")).otherwise(F.lit("connection")))
    return step.withColumns({items: kept, shape: named}).drop(f"__{items}_text", f"__{items}_nodes")


def _line_items(item: Column, is_text: bool) -> Column:
    """items and shape of an exchange item whose ``lineItems`` is an array or JSON text."""
    if is_text:
        return child_shape(item["lineItems"])
    return F.struct(F.filter(F.coalesce(item["lineItems"], F.array()), lambda y: y.isNotNull()).alias("items"), F.lit("list").alias("shape"))


def _state_item(x: Column, is_text: bool) -> Column:
    def named(lines: Column) -> Column:
        return F.struct(
            x["id"].alias("id"), x["quantity"].alias("quantity"),
            F.transform(lines["items"], lambda y: F.struct(y["id"].alias("id"), y["sku"].alias("sku"), y["quantity"].alias("quantity"))).alias("lineItems"),
            lines["shape"].alias("shape"))
    return F.get(F.transform(F.array(_line_items(x, is_text)), named), 0)


def exchange_state(nested: DataFrame, keep=()) -> DataFrame:
    """Per order the return status, current total (bad amount -> null) and the returns that
    carry >= 1 exchange item -- cancelled ones included. Line items come as an array or as JSON
    text in either shape (P7); each exchange item records the ``shape`` it had."""
    item_type = nested.schema["returns"].dataType.elementType["exchangeLineItems"].dataType.elementType
    is_text = isinstance(item_type["lineItems"].dataType, T.StringType)

    def ex(r: Column) -> Column:
        items = F.filter(F.coalesce(r["exchangeLineItems"], F.array()), lambda x: x.isNotNull())
        return F.struct(r["id"].alias("returnId"), r["status"].alias("status"), r["createdAt"].alias("createdAt"),
                        F.transform(items, lambda x: _state_item(x, is_text)).alias("exchangeLineItems"))
    exchanges = F.filter(F.transform(F.filter(F.coalesce(F.col("returns"), F.array()), lambda r: r.isNotNull()), ex),
                         lambda e: F.size(e["exchangeLineItems"]) > 0)
    money = F.col("currentTotalPriceSet.shopMoney")
    return nested.select(
        "id", "legacyResourceId", *keep,
        F.col("returnStatus"),
        to_decimal_or_null(money["amount"]).alias("currentTotalAmount"),
        money["currencyCode"].alias("currentTotalCurrency"),
        exchanges.alias("exchanges"),
    )


def _requested(requests: DataFrame, request_col: str, position_col: str | None, numbered: bool) -> DataFrame:
    """Distinct canonical ids (``numbered``: the order numbers behind them) with their first position."""
    pos = F.col(position_col) if position_col else F.lit(0).cast("long")
    key = order_number(F.col(request_col)) if numbered else to_order_gid_state(F.col(request_col))
    return requests.select(key.alias("_key"), pos.alias("_pos")).filter("_key IS NOT NULL").groupBy("_key").agg(F.min("_pos").alias("_pos"))


def _requested_orders(requests: DataFrame, orders: DataFrame, request_col: str, position_col: str | None, order_key: str, numbered: bool) -> DataFrame:
    req = _requested(requests, request_col, position_col, numbered)
    # an empty legacy id falls back to the gid tail; any other text (even spaces) is the key
    key = F.coalesce(F.nullif(F.col("legacyResourceId"), F.lit("")), legacy_from_gid(F.col("id")))
    mine = orders.select(F.col(order_key).alias("_key"), "id", "legacyResourceId", "returnStatus", "currentTotalPriceSet", key.alias("order_key"))
    return mine.filter("order_key IS NOT NULL").join(req, "_key")


STATE_COLUMNS = ("order_key", "id", "legacyResourceId", "returnStatus", "currentTotalAmount", "currentTotalCurrency")


def exchange_state_lookup(requests: DataFrame, orders: DataFrame, returns: DataFrame, return_order,
                          request_col: str = "requested_id", position_col: str | None = None,
                          fields=RETURN_FIELDS, status: DataFrame | None = None,
                          keys: tuple[str, str] = ("id", "order_id"), numbered: bool = False) -> DataFrame:
    """Requested ids -> canonical gids (deduped) -> matching orders -> P6, keyed by the
    legacy id (else the text after the last ``/``); a later request wins on an equal key (A5).

    ``keys`` name the columns of orders and returns that belong together. With ``numbered`` both hold
    the order number that ends the gid, and ids are compared by it: requests, orders and returns are
    then dealt out by one number, and only the last step, which lets one order a key win, deals anew.
    Returns without an exchange item never enter a list. ``status`` is the lookup's one-row status
    (column ``ok``): a failed lookup yields nothing. Empty input is *not ok*: :func:`state_lookup_ok`
    says so. An order's list is one value; for orders of any size see :func:`exchange_state_parts`."""
    own, other = keys
    chosen = _requested_orders(requests, orders, request_col, position_col, own, numbered)
    value = F.struct(*[c.alias(k) for k, c in _named(fields).items()])
    rows = returns.filter(_has_exchange(_named(fields))).select(
        F.col(other).alias("_key"), F.struct(*[F.col(c) if isinstance(c, str) else c for c in return_order], value.alias("v")).alias("_row"))
    per_order = [c for c in chosen.columns]
    nested = chosen.join(rows, "_key", "left").groupBy(*per_order).agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    state = exchange_state(nested.withColumn("returns", F.transform("_rows", lambda r: r["v"])), keep=("order_key", "_pos"))
    winner = F.struct(*[c for c in state.columns if c not in ("order_key", "_pos")])
    last = state.groupBy("order_key").agg(F.max_by(winner, F.struct("_pos", "id")).alias("w")).select("order_key", "w.*")
    return behind(last, status).select(*STATE_COLUMNS, "exchanges")


def exchange_state_parts(requests: DataFrame, orders: DataFrame, returns: DataFrame, return_order,
                         part_size: int, request_col: str = "requested_id", position_col: str | None = None,
                         fields=RETURN_FIELDS, status: DataFrame | None = None,
                         keys: tuple[str, str] = ("id", "order_id"), numbered: bool = False) -> DataFrame:
    """J2 for orders of any size: the rows of :func:`exchange_state_lookup`, an order's list cut into
    consecutive parts of ``part_size`` returns (``part`` from 0; an order without exchanges has one,
    empty). Parts are cut by row numbers and packed one by one, so a task never holds a whole list, and
    an order too large for one window is numbered over ranges. The orders are written once, the returns
    dealt out once by the order's key, then numbered, packed and joined where they lie.
    ``return_order`` must tell the returns of an order apart."""
    own, other = keys
    chosen = _requested_orders(requests, orders, request_col, position_col, own, numbered)
    last = chosen.groupBy("order_key").agg(F.max_by(F.struct(*[c for c in chosen.columns if c != "order_key"]), F.struct("_pos", "id")).alias("w"))
    last = written_stage(last.select("order_key", "w.*"), "state-orders")
    order = [F.col(c) if isinstance(c, str) else c for c in return_order]
    wanted = returns.filter(_has_exchange(_named(fields))).withColumn("_key", F.col(other)).join(last.select("_key"), "_key", "left_semi")
    cut = number_rows(wanted, order, ["_key"], out="_n").withColumn("part", F.floor((F.col("_n") - 1) / part_size))
    value = F.struct(*[c.alias(k) for k, c in _named(fields).items()])
    packed = cut.groupBy("_key", "part").agg(F.sort_array(F.collect_list(F.struct("_n", value.alias("v")))).alias("_rows")).select(
        "_key", "part", F.transform("_rows", lambda r: r["v"]).alias("returns"))
    none = F.array().cast(packed.schema["returns"].dataType)
    nested = last.join(packed, "_key", "left").withColumns(
        {"part": F.coalesce("part", F.lit(0).cast("long")), "returns": F.coalesce("returns", none)})
    return behind(exchange_state(nested, keep=("order_key", "part")), status).select(*STATE_COLUMNS, "part", "exchanges")


def state_lookup_ok(requests: DataFrame, request_col: str = "requested_id", status: DataFrame | None = None) -> DataFrame:
    """One row: ``ok`` is false when no usable id was requested (the original's contract), or when
    the lookup's own ``status`` is not ok."""
    asked = requests.agg(F.count(to_order_gid_state(F.col(request_col))).alias("n")).select((F.col("n") > 0).alias("ok"))
    if status is None:
        return asked
    return asked.unionByName(status.select("ok")).agg(F.coalesce(F.bool_and("ok") & (F.count("ok") == 2), F.lit(False)).alias("ok"))


def exchange_presence(sweep: DataFrame, other_counts: DataFrame, key: str = "externalId",
                      other_col: str = "other_exchange_count") -> DataFrame:
    """Expected exchange count (sweep) against the other system's count per order."""
    j = sweep.join(other_counts, key, "left")
    other = F.coalesce(F.col(other_col), F.lit(0))
    status = (F.when(other >= F.col("exchangeReturnCount"), F.lit("present"))
              .when(other == 0, F.lit("missing")).otherwise(F.lit("short")))
    return j.select(key, "returnId", "exchangeReturnCount", other.alias(other_col), status.alias("presence"))
