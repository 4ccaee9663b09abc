"""Adapters: the driver's relational tables in the shapes the operators read.

* ``orders_shape``: one row per order with the catalogue's fields (text, as an export carries
  them), nested money/customer/address structs, the keyword ``status`` and ``returnStatus``,
  and typed shadow instants ``_ts_createdAt`` / ``_ts_updatedAt`` / ``_ts_processedAt`` taken
  straight from the timestamp columns, so datetime filters reach the Parquet scan.
* ``line_items_shape``: the child table behind ``lineItems`` (one row per line item).
* ``returns_shape``: one row per return (line items flagged ``A`` or ``R``); ``R`` carries an
  exchange item.

Every rule is a Column expression; the only shuffle is the per-order line aggregate, a
partial (map-side) aggregation followed by a join on the unique order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import ORDER_GID_PREFIX
from ..functions.instants import format_instant

# Gid prefixes of the other object types and the status vocabularies the
# adapters map the relational codes to.
CUSTOMER_GID_PREFIX = "gid://shopify/Customer/"
LINE_ITEM_GID_PREFIX = "gid://shopify/LineItem/"
VARIANT_GID_PREFIX = "gid://shopify/ProductVariant/"
RETURN_GID_PREFIX = "gid://shopify/Return/"
EXCHANGE_ITEM_GID_PREFIX = "gid://shopify/ExchangeLineItem/"
FINANCIAL = {"F": "PAID", "O": "PENDING", "P": "PARTIALLY_PAID"}
FULFILLMENT = {"F": "FULFILLED", "O": "UNFULFILLED", "P": "PARTIALLY_FULFILLED"}
KEYWORD_STATUS = {"F": "closed", "O": "open", "P": "cancelled"}
LEGACY_NULL_EVERY = 7  # every 7th order carries no legacy id (exercises the gid fallback)

# Total order of line items inside an order (list order of children and returns).
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


# Declared schemas of the driver tables (no schema inference job per read).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table read with its declared schema."""
    reader = spark.read.schema(DRIVER_SCHEMAS[name]) if name in DRIVER_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def _money(amount: Column) -> Column:
    return F.struct(F.struct(amount.alias("amount"), F.lit("USD").alias("currencyCode")).alias("shopMoney"))


def _amount_text(x: Column) -> Column:
    return x.cast("decimal(20,2)").cast("string")


def line_totals(lineitem: DataFrame) -> DataFrame:
    """Per order: last ship date, subtotal, tax, number of returns (partial aggregation)."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_last_ship"),
        F.sum(price).alias("_subtotal"),
        F.sum(price * F.col("l_tax").cast("decimal(4,2)")).alias("_tax"),
        F.count_if(F.col("l_returnflag").isin("A", "R")).alias("_returns"),
    )


def orders_shape(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    totals = line_totals(lineitem)
    o = orders.join(totals, orders["o_orderkey"] == totals["l_orderkey"], "left")
    created = F.col("o_orderdate")
    updated = F.coalesce(F.col("_last_ship"), created)
    processed = created + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), F.lit(0), F.lit(0))
    email = F.concat(F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("@example.com"))
    total = _amount_text(F.col("o_totalprice"))
    st = F.col("o_orderstatus")
    return o.select(
        k.alias("order_key"),
        F.concat(F.lit(ORDER_GID_PREFIX), k.cast("string")).alias("id"),
        F.when(k % LEGACY_NULL_EVERY != 0, k.cast("string")).alias("legacyResourceId"),
        F.concat(F.lit("#"), k.cast("string")).alias("name"),
        format_instant(created).alias("createdAt"),
        format_instant(updated).alias("updatedAt"),
        format_instant(processed).alias("processedAt"),
        F.when(st == "P", format_instant(updated)).alias("cancelledAt"),
        email.alias("email"),
        total.alias("totalPrice"),
        _map(st, FINANCIAL).alias("displayFinancialStatus"),
        _map(st, FULFILLMENT).alias("displayFulfillmentStatus"),
        F.lit("USD").alias("currencyCode"),
        _money(total).alias("totalPriceSet"),
        _money(total).alias("currentTotalPriceSet"),
        _money(_amount_text(F.coalesce(F.round(F.col("_tax"), 2), F.lit(0)))).alias("currentTotalTaxSet"),
        _money(_amount_text(F.coalesce(F.col("_subtotal"), F.lit(0)))).alias("subtotalPriceSet"),
        F.struct(F.concat(F.lit(CUSTOMER_GID_PREFIX), F.col("o_custkey").cast("string")).alias("id"),
                 email.alias("email")).alias("customer"),
        F.struct(F.concat(F.lit("City "), (F.col("o_custkey") % 100).cast("string")).alias("city"),
                 F.substring("o_orderpriority", 1, 1).alias("provinceCode"),
                 F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("zip")).alias("shippingAddress"),
        _map(st, KEYWORD_STATUS).alias("status"),
        F.when(F.coalesce(F.col("_returns"), F.lit(0)) > 0, F.lit("RETURNED")).otherwise(F.lit("NO_RETURN")).alias("returnStatus"),
        created.alias("_ts_createdAt"),
        updated.alias("_ts_updatedAt"),
        processed.alias("_ts_processedAt"),
    )


def _line_gid(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(c).cast("string") for c in
                                                     ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))


def _qty() -> Column:
    return F.col("l_quantity").cast("int").cast("string")


def line_items_shape(lineitem: DataFrame) -> DataFrame:
    """Child table for ``lineItems``: ``order_id`` = order gid, catalogue child fields, and the
    line columns that give the list order (``LINE_ORDER``)."""
    return lineitem.select(
        F.concat(F.lit(ORDER_GID_PREFIX), F.col("l_orderkey").cast("string")).alias("order_id"),
        *LINE_ORDER,
        _line_gid(LINE_ITEM_GID_PREFIX).alias("id"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("name"),
        _qty().alias("quantity"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.struct(F.concat(F.lit(VARIANT_GID_PREFIX), F.col("l_partkey").cast("string"), F.lit("-"),
                          F.col("l_suppkey").cast("string")).alias("id"),
                 F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("title")).alias("variant"),
    )


def return_status_rule() -> Column:
    """Return status by rule: open lines with an even line number are cancelled; open line 3
    is spelled ``CANCELLED`` (which does not count as cancelled), open line 5 is `` canceled ``."""
    open_ = F.col("l_linestatus") == "O"
    n = F.col("l_linenumber")
    return (
        F.when(open_ & (n % 2 == 0), F.lit("CANCELED"))
        .when(open_ & (n == 3), F.lit("CANCELLED"))
        .when(open_ & (n == 5), F.lit(" canceled "))
        .otherwise(F.lit("CLOSED"))
    )


RETURN_ROW_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
                      "l_linestatus", "l_shipdate"]
EXCHANGE_ITEMS_TYPE = ("array<struct<id:string,quantity:string,"
                       "lineItems:array<struct<id:string,sku:string,quantity:string>>>>")


def return_rows(lineitem: DataFrame) -> DataFrame:
    """Narrow return rows (raw line columns plus ``order_id``): the nested return fields are
    built from them by :func:`return_fields` only after the per-order top-n, so the sorts and
    shuffles before it move narrow rows."""
    r = lineitem.filter(F.col("l_returnflag").isin("A", "R"))
    cols = list(dict.fromkeys(LINE_ORDER + RETURN_ROW_COLUMNS))
    return r.select(F.concat(F.lit(ORDER_GID_PREFIX), F.col("l_orderkey").cast("string")).alias("order_id"), *cols)


def _children_text(item: Column) -> Column:
    as_list = F.to_json(F.array(item))
    return F.when(F.col("l_linenumber") % 2 == 1, as_list).otherwise(F.concat(F.lit('{"nodes":'), as_list, F.lit("}")))


def return_fields(text_children: bool = False) -> dict:
    """The return struct fields as expressions over :func:`return_rows` columns. With
    ``text_children`` the line items of an exchange item come as JSON text, as a plain list on odd
    lines and under ``nodes`` on even ones."""
    item = F.struct(
        _line_gid(LINE_ITEM_GID_PREFIX).alias("id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        _qty().alias("quantity"),
    )
    exchange = F.struct(
        _line_gid(EXCHANGE_ITEM_GID_PREFIX).alias("id"),
        _qty().alias("quantity"),
        (_children_text(item) if text_children else F.array(item)).alias("lineItems"),
    )
    items_type = EXCHANGE_ITEMS_TYPE if not text_children else "array<struct<id:string,quantity:string,lineItems:string>>"
    return {
        "id": _line_gid(RETURN_GID_PREFIX),
        "name": F.concat(F.lit("#"), F.col("l_orderkey").cast("string"), F.lit("-R"), F.col("l_linenumber").cast("string")),
        "status": return_status_rule(),
        "createdAt": format_instant(F.col("l_shipdate")),
        "exchangeLineItems": F.when(F.col("l_returnflag") == "R", F.array(exchange))
        .otherwise(F.array().cast(items_type)),
    }


# --- logs and configs ---------------------------------------------------------------------

def configs_shape(customer: DataFrame) -> DataFrame:
    """Connection configs, one per customer: tenant = market segment, id = customer name,
    URL / version / zone / token / flags varied by rule (no token when the balance is < 0)."""
    k = F.col("c_custkey")
    ks = k.cast("string")
    url = (F.when(k % 11 == 0, F.concat(F.lit("http://shop"), ks, F.lit(".myshopify.com")))
           .when(k % 13 == 0, F.concat(F.lit("https://shop"), ks, F.lit(".example.com")))
           .when(k % 17 == 0, F.concat(F.lit("https://shop"), ks, F.lit(".myshopify.com/admin/api/2024-01/graphql.json")))
           .otherwise(F.concat(F.lit("https://shop"), ks, F.lit(".myshopify.com/"))))
    nk = F.col("c_nationkey") % 5
    version = (F.when(nk == 0, F.lit("2025-07")).when(nk == 1, F.lit("2025-10")).when(nk == 2, F.lit("2026-01"))
               .when(nk == 3, F.lit("unstable")).otherwise(F.lit("2025-7")))
    zone = F.when(k % 3 == 0, F.lit("America/Chicago")).when(k % 3 == 1, F.lit("America/Los_Angeles"))
    return customer.select(
        F.col("c_name").alias("config_id"),
        F.concat(F.lit("Store "), (k % 97).cast("string")).alias("description"),
        F.col("c_mktsegment").alias("tenant_id"),
        F.concat(F.lit("user"), (k % 20).cast("string")).alias("created_by"),
        url.alias("shop_api_url"),
        version.alias("api_version"),
        zone.alias("time_zone"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("tok-"), ks)).alias("access_token"),
        F.when(k % 10 == 0, F.lit("N")).when(k % 10 == 1, F.lit(None).cast("string")).otherwise(F.lit("Y")).alias("is_active"),
        F.when(k % 4 == 0, F.lit("N")).when(k % 4 == 1, F.lit(None).cast("string")).otherwise(F.lit("Y")).alias("can_read_orders"),
        k.alias("custkey"),
    )


def event_log(events: DataFrame) -> DataFrame:
    """Captured API responses: one per event; a request is (user, day); ``ts`` orders the
    attempts. Status code and body follow the event type (and value) by rule; input columns
    (e.g. an attempt number given before) are kept."""
    k = F.get_json_object("props", "$.k").cast("int")
    ks = k.cast("string")
    v = F.col("value")
    et = F.col("event_type")
    cost_ok = F.concat(
        F.lit('{"data":{"orders":{"edges":[]}},"extensions":{"cost":{"requestedQueryCost":'), (k + 10).cast("string"),
        F.lit(',"actualQueryCost":'), ks, F.lit(',"throttleStatus":{"maximumAvailable":1000,"currentlyAvailable":'),
        (k * 7 % 100).cast("string"), F.lit(',"restoreRate":50}}}}'))
    throttled = F.concat(
        F.lit('{"errors":[{"message":"Throttled","extensions":{"code":"THROTTLED"}}],"extensions":{"cost":{"requestedQueryCost":'),
        (k + 10).cast("string"), F.lit(',"actualQueryCost":0,"throttleStatus":{"maximumAvailable":1000,"currentlyAvailable":'),
        (k % 10).cast("string"), F.lit(',"restoreRate":'), ((k % 5) * 10).cast("string"), F.lit("}}}}"))
    denied = F.lit('{"data":null,"errors":[{"message":"Access denied for orders field.","extensions":{"code":"ACCESS_DENIED"}},{"message":"  "}]}')
    status = (F.when(et.isin("purchase", "view", "click"), F.lit(200))
              .when(et == "signup", F.when(v < 100, F.lit(429)).otherwise(F.lit(503)))
              .otherwise(F.when(v < 200, F.lit(200)).otherwise(F.lit(404))))
    body = (F.when(et == "purchase", cost_ok).when(et == "view", throttled).when(et == "click", denied)
            .when(et == "signup", F.when(v < 100, F.lit("")).otherwise(F.lit("Service Unavailable")))
            .otherwise(F.when(v < 25, F.lit('{"errors":"Not Found"}')).when(v < 50, F.lit('{"errors":{"message":"Not Found"}}'))
                       .when(v < 75, F.lit('{"data":{"orders":1}} trailing')).when(v < 100, F.lit("not-json")).when(v < 200, F.lit('{"errors":[{"message":"   "}],"data":{}}'))
                       .otherwise(F.lit(""))))
    query = F.when(F.col("user_id") % 10 == 0, F.lit("# start a run\nmutation Run { run { id } }")).otherwise(
        F.lit("query Orders { orders { id } }"))
    return events.withColumns({
        "request_id": event_request_id(),
        "status_code": status, "body": body, "query": query,
    })


def event_request_id() -> Column:
    """A request is one user-day of events."""
    return F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd"))
