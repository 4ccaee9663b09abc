"""

Every query reads the driver's parquet tables (adapted to the order / return / log / config
shapes by ``orderlens.sources.adapters`` and the rules below) over whole tables. Each
``oracle_sql`` text computes the same result in DuckDB from the same tables, with the same
column names.
"""

from __future__ import annotations

import importlib
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.ids import ORDER_GID_PREFIX
from orderlens.functions.instants import format_instant, parse_iso_millis, source_window
from orderlens.functions.text import json_file_name, jsonl_file_name
from orderlens.operators import apilog, configs as cfg, exchange as ex, lookup
from orderlens.operators.normalize import normalize_order_ids
from orderlens.operators.paging import encode_cursor
from orderlens.operators.projection import flatten
from orderlens.operators.rownum import number_rows
from orderlens.plans.catalog import ORDER_SOURCE, resolve_field_paths
from orderlens.plans.spec import ReadSpec, read_orders, read_orders_bulk
from orderlens.session import keep_stage, pin_utc, staging_path
from orderlens.sources import adapters as ad
from orderlens.sources.gate import load_gate, release
from orderlens.sources.jsonl import ParsedLines, read_bulk_jsonl
from orderlens.sinks.files import DEFAULT_NAME, _record_schema

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ad.table(spark, sf_dir, name)


def _orders(spark, sf_dir):
    pin_utc(spark)
    return ad.orders_shape(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------------------------------
# Shared SQL: the same adapters in DuckDB.
# ---------------------------------------------------------------------------------------

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
LINE_ORDER_SQL = ("l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
                  "l_discount, l_tax, l_returnflag, l_linestatus")

ORDERS_CTE = f"""
lt AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS subtotal,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS tax,
         count(*) FILTER (WHERE l_returnflag IN ('A','R')) AS n_returns
  FROM lineitem GROUP BY l_orderkey),
ob AS (
  SELECT o.*, coalesce(lt.last_ship, o.o_orderdate) AS ts_updated,
         o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS ts_processed,
         lt.subtotal, lt.tax, coalesce(lt.n_returns, 0) AS n_returns
  FROM orders o LEFT JOIN lt ON o.o_orderkey = lt.l_orderkey),
os AS (
  SELECT o_orderkey AS order_key,
    '{ORDER_GID_PREFIX}' || o_orderkey AS id,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS legacyResourceId,
    '#' || o_orderkey AS name,
    strftime(o_orderdate, {ISO}) AS createdAt,
    strftime(ts_updated, {ISO}) AS updatedAt,
    strftime(ts_processed, {ISO}) AS processedAt,
    CASE WHEN o_orderstatus = 'P' THEN strftime(ts_updated, {ISO}) END AS cancelledAt,
    'customer' || o_custkey || '@example.com' AS email,
    CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS totalPrice,
    CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'PARTIALLY_PAID' END AS displayFinancialStatus,
    CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'UNFULFILLED' WHEN 'P' THEN 'PARTIALLY_FULFILLED' END AS displayFulfillmentStatus,
    'USD' AS currencyCode,
    CAST(CAST(coalesce(round(tax, 2), 0) AS DECIMAL(20,2)) AS VARCHAR) AS taxAmount,
    CAST(CAST(coalesce(subtotal, 0) AS DECIMAL(20,2)) AS VARCHAR) AS subtotalAmount,
    CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' WHEN 'P' THEN 'cancelled' END AS status,
    CASE WHEN n_returns > 0 THEN 'RETURNED' ELSE 'NO_RETURN' END AS returnStatus,
    o_orderdate AS ts_created, ts_updated, ts_processed,
    o_orderdate, o_totalprice
  FROM ob)"""

RETURNS_CTE = f"""
rt AS (
  SELECT l.*,
    '{ORDER_GID_PREFIX}' || l_orderkey AS order_id,
    'gid://shopify/Return/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS return_id,
    '#' || l_orderkey || '-R' || l_linenumber AS return_name,
    CASE WHEN l_linestatus = 'O' AND l_linenumber % 2 = 0 THEN 'CANCELED'
         WHEN l_linestatus = 'O' AND l_linenumber = 3 THEN 'CANCELLED'
         WHEN l_linestatus = 'O' AND l_linenumber = 5 THEN ' canceled '
         ELSE 'CLOSED' END AS return_status,
    strftime(l_shipdate, {ISO}) AS return_created,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS pos
  FROM lineitem l WHERE l_returnflag IN ('A','R')),
rx AS (
  SELECT *, (l_returnflag = 'R') AS has_exchange,
         (l_returnflag = 'R' AND upper(trim(return_status)) <> 'CANCELED') AS live
  FROM rt)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ---------------------------------------------------------------------------------------
# 1. Order reads
# ---------------------------------------------------------------------------------------

WINDOW_FILTERS = {"updatedAtFrom": "1997-01-01T00:00:00Z", "updatedAtTo": "1997-02-01T00:00:00-00:00"}


def q_orders_window(spark, sf_dir):
    """S4 + P2 + F1 + T1 + P4: bulk read of one month by updatedAt, ids normalised."""
    plan = read_orders_bulk(_orders(spark, sf_dir), ReadSpec(filters=WINDOW_FILTERS))
    return flatten(normalize_order_ids(plan.df))


def _sql_money(prefix: str, amount: str) -> str:
    return f"{amount} AS {prefix}_shopMoney_amount, 'USD' AS {prefix}_shopMoney_currencyCode"


SQL_ORDERS_WINDOW = _with(ORDERS_CTE) + f""",
sel AS (SELECT * FROM os WHERE ts_updated >= TIMESTAMP '1997-01-01' AND ts_updated < TIMESTAMP '1997-02-01'),
p4 AS (SELECT *, coalesce(legacyResourceId, nullif(regexp_extract(id, '(\\d+)$', 1), '')) AS legacy FROM sel)
SELECT cancelledAt, createdAt, currencyCode,
  {_sql_money('currentTotalPriceSet', 'totalPrice')},
  {_sql_money('currentTotalTaxSet', 'taxAmount')},
  displayFinancialStatus, displayFulfillmentStatus, email,
  coalesce(legacy, id) AS id, coalesce(legacy, legacyResourceId) AS legacyResourceId,
  name, processedAt,
  {_sql_money('subtotalPriceSet', 'subtotalAmount')},
  totalPrice,
  {_sql_money('totalPriceSet', 'totalPrice')},
  updatedAt, id AS shopifyGid
FROM p4"""

PAGE_AFTER = ("1996-03-01T00:00:00Z", ORDER_GID_PREFIX + "5000")


def q_orders_page(spark, sf_dir):
    """S3 + T2 (500 -> 250) + T3: second-page style keyset read by createdAt."""
    spec = ReadSpec(filters={"createdAtFrom": "1996-01-01T00:00:00Z", "createdAtTo": "1997-01-01T00:00:00-05:00"},
                    page_size=500, after=encode_cursor(*PAGE_AFTER))
    return read_orders(_orders(spark, sf_dir), spec).df


def _sql_cursor(sort_text: str) -> str:
    return f"translate(to_base64(encode(to_json([{sort_text}, id]))), '+/', '-_') AS cursor"


SQL_ORDERS_PAGE = _with(ORDERS_CTE) + f"""
SELECT createdAt, id, legacyResourceId, name, updatedAt, {_sql_cursor('createdAt')}
FROM os
WHERE ts_created >= TIMESTAMP '1996-01-01' AND ts_created < TIMESTAMP '1997-01-01 05:00:00'
  AND (ts_created > TIMESTAMP '1996-03-01' OR (ts_created = TIMESTAMP '1996-03-01' AND id > '{PAGE_AFTER[1]}'))
ORDER BY ts_created, id LIMIT 250"""


def q_orders_status(spark, sf_dir):
    """keyword status filter (case-insensitive), default sort UPDATED_AT, default page."""
    spec = ReadSpec(fields=["name", "displayFinancialStatus", "totalPrice"], filters={"status": "CLOSED"})
    return read_orders(_orders(spark, sf_dir), spec).df


SQL_ORDERS_STATUS = _with(ORDERS_CTE) + f"""
SELECT displayFinancialStatus, id, legacyResourceId, name, totalPrice, {_sql_cursor('updatedAt')}
FROM os WHERE lower(status) = 'closed'
ORDER BY ts_updated, id LIMIT 100"""


def q_orders_children(spark, sf_dir):
    """P5: first 3 line items per order on a 50-order page, exploded to one row per child."""
    spec = ReadSpec(fields=["id", "name", "lineItems.sku", "lineItems.quantity", "lineItems.variant.title"],
                    filters={"createdAtFrom": "1998-03-01T00:00:00Z", "createdAtTo": "1998-04-01T00:00:00Z"},
                    page_size=50, child_page_sizes={"lineItems": 3})
    plan = read_orders(_orders(spark, sf_dir), spec, line_items=ad.line_items_shape(_t(spark, sf_dir, "lineitem")),
                       line_item_order=ad.LINE_ORDER)
    df = plan.df
    return df.select("id", "legacyResourceId", "name", "hasMoreLineItems", F.posexplode_outer("lineItems").alias("p", "li")).select(
        "id", "legacyResourceId", "name", "hasMoreLineItems", (F.col("p") + 1).alias("child_pos"),
        F.col("li.quantity").alias("quantity"), F.col("li.sku").alias("sku"),
        F.col("li.variant.title").alias("variant_title"))


SQL_ORDERS_CHILDREN = _with(ORDERS_CTE) + f""",
pg AS (SELECT order_key, id, legacyResourceId, name FROM os
       WHERE ts_created >= TIMESTAMP '1998-03-01' AND ts_created < TIMESTAMP '1998-04-01'
       ORDER BY ts_created, id LIMIT 50),
li AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS child_pos,
              CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity, 'SKU-' || l_partkey AS sku,
              'Supplier ' || l_suppkey AS variant_title, count(*) OVER (PARTITION BY l_orderkey) AS n
       FROM lineitem WHERE l_orderkey IN (SELECT order_key FROM pg))
SELECT pg.id, pg.legacyResourceId, pg.name, coalesce(li.n > 3, false) AS hasMoreLineItems, li.child_pos, li.quantity, li.sku, li.variant_title
FROM pg LEFT JOIN li ON li.l_orderkey = pg.order_key AND li.child_pos <= 3"""


def q_orders_sorted_desc(spark, sf_dir):
    """T1 reverse: processedAt filter sets the sort key, reverse=true flips it."""
    spec = ReadSpec(fields=["processedAt"], filters={"processedAtFrom": "1999-01-01T00:00:00Z"}, reverse="true")
    return read_orders(_orders(spark, sf_dir), spec).df


SQL_ORDERS_SORTED_DESC = _with(ORDERS_CTE) + f"""
SELECT id, legacyResourceId, processedAt, {_sql_cursor('processedAt')}
FROM os WHERE ts_processed >= TIMESTAMP '1999-01-01'
ORDER BY ts_processed DESC, id DESC LIMIT 100"""


# ---------------------------------------------------------------------------------------
# 2. Bulk JSONL, gate and extraction
# ---------------------------------------------------------------------------------------
# Fixed fixture rule: one export file per month of order creation, orders in key order; lines
# are corrupted by a rule on the order key (m = key % 4999): 11 blank, 22 array, 33 bare
# string, 44 cut object, 55 null, 66 single quotes, 77 an object with a wrongly typed id, 88 two
# objects, 99 a comma after the object, 111 a bracket after it.
CORRUPT_EVERY = 4999
#: Order keys whose lines go into one file of a load.
EXPORT_KEYS = 1 << 20


def _export(spark, sf_dir) -> str:
    """The exports as they land: text files, each load (``load_id=...``) cut by key into files whose names
    keep the key order. Returns the folder."""
    from orderlens.operators.projection import prune_nested
    o = _orders(spark, sf_dir)
    paths = resolve_field_paths(ORDER_SOURCE, [], bulk=True)
    k = F.col("order_key")
    m, ks, body = k % CORRUPT_EVERY, k.cast("string"), F.col("_body")
    line = (F.when(m == 11, F.lit("   "))
            .when(m == 22, F.concat(F.lit("["), body, F.lit("]")))
            .when(m == 33, F.concat(F.lit('"'), F.col("name"), F.lit('"')))
            .when(m == 44, F.expr("substring(_body, 1, length(_body) - 1)"))
            .when(m == 55, F.lit("null"))
            .when(m == 66, F.concat(F.lit("{'id':'"), ks, F.lit("'}")))
            .when(m == 77, F.concat(F.lit('{"id": '), ks, F.lit(', "name": "#'), ks, F.lit('"}')))
            .when(m == 88, F.concat(body, body))
            .when(m == 99, F.concat(body, F.lit(",")))
            .when(m == 111, F.concat(body, F.lit("}")))
            .otherwise(body))
    body_struct = F.struct(*[F.col(c) for c in sorted({p.split(".")[0] for p in paths})])
    load = F.concat(F.lit("orders-"), F.date_format("_ts_createdAt", "yyyy-MM"))
    bodies = o.select("order_key", "name", load.alias("load_id"), F.lpad(F.floor(k / EXPORT_KEYS).cast("string"), 12, "0").alias("part"),
                      F.to_json(body_struct, {"ignoreNullFields": "false"}).alias("_body"))
    dealt = bodies.select("load_id", "part", "order_key", line.alias("value")).repartition("load_id", "part")
    path = staging_path(spark, "export")
    keep_stage(spark, path)
    dealt.sortWithinPartitions("load_id", "part", "order_key").drop("order_key").write.partitionBy("load_id", "part").text(path)
    return path


def _parsed(spark, sf_dir) -> ParsedLines:
    schema = _record_schema(resolve_field_paths(ORDER_SOURCE, [], bulk=True))
    return read_bulk_jsonl(spark, _export(spark, sf_dir), schema, load_col="load_id")


def q_jsonl_records(spark, sf_dir):
    """Valid object lines with their line numbers, values read as text."""
    r = _parsed(spark, sf_dir).records()
    return r.select("load_id", "line_no", "id", "legacyResourceId", "name", "createdAt", "totalPrice",
                    F.col("currentTotalPriceSet.shopMoney.amount").alias("currentAmount"))


def q_jsonl_bad_lines(spark, sf_dir):
    """Rejected lines with the two messages ("not a JSON object" / "not valid JSON")."""
    return _parsed(spark, sf_dir).bad_lines().select("load_id", "line_no", "error")


def _manifest(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    per = o.groupBy(F.concat(F.lit("orders-"), F.date_format("_ts_createdAt", "yyyy-MM")).alias("load_id"),
                    F.month("_ts_createdAt").alias("mo"), F.year("_ts_createdAt").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    expected = (F.when(F.col("mo") % 4 == 1, (F.col("n") + 1).cast("string"))
                .when(F.col("mo") % 4 == 2, F.lit(None).cast("string"))
                .when(F.col("mo") % 4 == 3, F.lit("n/a"))
                .otherwise(F.col("n").cast("string")))
    location = F.when((F.col("yr") == 2001) & (F.col("mo") >= 7), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("landing/"), F.col("load_id"), F.lit(".jsonl")))
    return per.select("load_id", expected.alias("expected_count"), location.alias("location"))


def q_load_gate(spark, sf_dir):
    """Completeness gate per monthly export."""
    return load_gate(_parsed(spark, sf_dir).counts(["load_id"]), _manifest(spark, sf_dir))


def q_extract_summary(spark, sf_dir):
    """K4 + A1 + X22: released (gate-passing) records per export after P4: their number, ids and
    amounts, with file names."""
    parsed = _parsed(spark, sf_dir)
    gate = load_gate(parsed.counts(["load_id"]), _manifest(spark, sf_dir))
    released = normalize_order_ids(release(parsed.records(), gate))
    counts = released.groupBy("load_id").agg(
        F.count(F.lit(1)).alias("recordCount"), F.min("id").alias("firstId"), F.max("id").alias("lastId"),
        F.count_if(F.col("shopifyGid") == F.concat(F.lit(ORDER_GID_PREFIX), F.col("id"))).alias("gidCount"),
        F.sum(F.col("currentTotalPriceSet.shopMoney.amount").try_cast("decimal(20,2)")).cast("string").alias("currentTotal"))
    start = F.to_timestamp(F.concat(F.substring("load_id", 8, 7), F.lit("-01 00:00:00")))
    end = F.add_months(start, 1).cast("timestamp")
    s_ms, e_ms = F.unix_millis(start).cast("string"), F.unix_millis(end).cast("string")
    name = F.replace(F.replace(F.lit(DEFAULT_NAME), F.lit("{start}"), s_ms), F.lit("{end}"), e_ms)
    return gate.join(counts, "load_id", "left").select(
        "load_id", F.col("data_available").alias("dataAvailable"),
        F.coalesce(F.col("recordCount"), F.lit(0)).alias("recordCount"), "firstId", "lastId",
        F.coalesce(F.col("gidCount"), F.lit(0)).alias("gidCount"), "currentTotal",
        json_file_name(name, name).alias("fileName"), jsonl_file_name(name, name).alias("rawFileName"),
        format_instant(start).alias("windowStart"), format_instant(end).alias("windowEnd"))


SQL_JSONL_BASE = _with(ORDERS_CTE) + """,
body AS (
  SELECT order_key, name, 'orders-' || strftime(ts_created, '%Y-%m') AS load_id,
         month(ts_created) AS mo, year(ts_created) AS yr,
         json_object('cancelledAt', cancelledAt, 'createdAt', createdAt, 'currencyCode', currencyCode,
           'currentTotalPriceSet', json_object('shopMoney', json_object('amount', totalPrice, 'currencyCode', 'USD')),
           'currentTotalTaxSet', json_object('shopMoney', json_object('amount', taxAmount, 'currencyCode', 'USD')),
           'displayFinancialStatus', displayFinancialStatus, 'displayFulfillmentStatus', displayFulfillmentStatus,
           'email', email, 'id', id, 'legacyResourceId', legacyResourceId, 'name', name, 'processedAt', processedAt,
           'subtotalPriceSet', json_object('shopMoney', json_object('amount', subtotalAmount, 'currencyCode', 'USD')),
           'totalPrice', totalPrice,
           'totalPriceSet', json_object('shopMoney', json_object('amount', totalPrice, 'currencyCode', 'USD')),
           'updatedAt', updatedAt)::VARCHAR AS b
  FROM os),
lines AS (
  SELECT load_id, mo, yr, order_key,
    row_number() OVER (PARTITION BY load_id ORDER BY order_key) AS line_no,
    CASE order_key % 4999
      WHEN 11 THEN '   '
      WHEN 22 THEN '[' || b || ']'
      WHEN 33 THEN '"' || name || '"'
      WHEN 44 THEN substring(b, 1, length(b) - 1)
      WHEN 55 THEN 'null'
      WHEN 66 THEN '{' || chr(39) || 'id' || chr(39) || ':' || chr(39) || order_key || chr(39) || '}'
      WHEN 77 THEN '{"id": ' || order_key || ', "name": "#' || order_key || '"}'
      WHEN 88 THEN b || b
      WHEN 99 THEN b || ','
      WHEN 111 THEN b || '}'
      ELSE b END AS line
  FROM body),
cls AS (
  SELECT *, trim(line) AS t,
    CASE WHEN trim(line) = '' THEN 'blank'
         WHEN json_valid(trim(line)) AND json_type(trim(line)) = 'OBJECT' THEN 'record'
         ELSE 'bad' END AS kind
  FROM lines),
cnt AS (
  SELECT load_id, count(*) AS line_count, count(*) FILTER (WHERE kind = 'record') AS parsed_count,
         count(*) FILTER (WHERE kind = 'bad') AS bad_count, min(line_no) FILTER (WHERE kind = 'bad') AS first_bad_line
  FROM cls GROUP BY load_id),
man AS (
  SELECT load_id, mo, yr,
    CASE WHEN mo % 4 = 1 THEN CAST(count(*) + 1 AS VARCHAR) WHEN mo % 4 = 2 THEN NULL
         WHEN mo % 4 = 3 THEN 'n/a' ELSE CAST(count(*) AS VARCHAR) END AS exp_text,
    CASE WHEN yr = 2001 AND mo >= 7 THEN NULL ELSE 'landing/' || load_id || '.jsonl' END AS loc
  FROM body GROUP BY load_id, mo, yr),
gate0 AS (
  SELECT m.load_id, m.mo, m.yr,
         CASE WHEN regexp_full_match(m.exp_text, '[+-]?[0-9]+') THEN TRY_CAST(m.exp_text AS BIGINT) END AS expected_count,
         coalesce(c.line_count, 0) AS line_count, coalesce(c.parsed_count, 0) AS parsed_count,
         coalesce(c.bad_count, 0) AS bad_count, c.first_bad_line, m.loc
  FROM man m LEFT JOIN cnt c ON m.load_id = c.load_id),
gate1 AS (
  SELECT *, CASE
      WHEN loc IS NULL AND expected_count > 0 THEN 'Shopify bulk operation completed with ' || expected_count || ' object(s) but returned no result download URL.'
      WHEN loc IS NULL THEN NULL
      WHEN bad_count > 0 THEN 'Shopify bulk operation result could not be parsed: ' || bad_count || ' bad line(s), first at line ' || first_bad_line || '.'
      WHEN expected_count IS NOT NULL AND expected_count <> parsed_count THEN 'Shopify bulk operation result was incomplete: expected ' || expected_count || ' record(s) but parsed ' || parsed_count || '.'
    END AS error
  FROM gate0),
gate AS (
  SELECT load_id, expected_count, line_count, parsed_count, bad_count, error IS NULL AS ok,
    (loc IS NOT NULL AND bad_count = 0 AND expected_count IS NOT NULL AND expected_count <> parsed_count) AS retryable,
    CASE WHEN error IS NULL AND loc IS NOT NULL THEN parsed_count ELSE 0 END AS record_count,
    (error IS NULL AND loc IS NOT NULL AND parsed_count > 0) AS data_available, error, mo, yr
  FROM gate1)"""

SQL_JSONL_RECORDS = SQL_JSONL_BASE + """
SELECT load_id, line_no, json_extract_string(t, '$.id') AS id, json_extract_string(t, '$.legacyResourceId') AS legacyResourceId,
       json_extract_string(t, '$.name') AS name, json_extract_string(t, '$.createdAt') AS createdAt,
       json_extract_string(t, '$.totalPrice') AS totalPrice,
       json_extract_string(t, '$.currentTotalPriceSet.shopMoney.amount') AS currentAmount
FROM cls WHERE kind = 'record'"""

SQL_JSONL_BAD = SQL_JSONL_BASE + """
SELECT load_id, line_no,
  'Shopify bulk operation JSONL line ' || line_no || CASE WHEN json_valid(t) THEN ' was not a JSON object.' ELSE ' was not valid JSON.' END AS error
FROM cls WHERE kind = 'bad'"""

SQL_LOAD_GATE = SQL_JSONL_BASE + """
SELECT load_id, expected_count, line_count, parsed_count, bad_count, ok, retryable, record_count, data_available, error FROM gate"""

SQL_EXTRACT_SUMMARY = SQL_JSONL_BASE + """,
rel AS (
  SELECT r.load_id, count(*) AS n, min(r.oid) AS first_id, max(r.oid) AS last_id,
    count(*) FILTER (WHERE r.gid = 'gid://shopify/Order/' || r.oid) AS gids, CAST(sum(TRY_CAST(r.amount AS DECIMAL(20,2))) AS VARCHAR) AS total
  FROM (SELECT load_id, json_extract_string(t, '$.id') AS gid,
          coalesce(nullif(trim(json_extract_string(t, '$.legacyResourceId')), ''), regexp_extract(json_extract_string(t, '$.id'), '(\\d+)$', 1)) AS oid,
          json_extract_string(t, '$.currentTotalPriceSet.shopMoney.amount') AS amount
        FROM cls WHERE kind = 'record') r JOIN gate g ON r.load_id = g.load_id
  WHERE g.ok AND g.data_available GROUP BY r.load_id),
win AS (SELECT load_id, make_timestamp(yr, mo, 1, 0, 0, 0) AS ws FROM gate)
SELECT g.load_id, g.data_available AS dataAvailable, coalesce(rel.n, 0) AS recordCount, rel.first_id AS firstId, rel.last_id AS lastId,
  coalesce(rel.gids, 0) AS gidCount, rel.total AS currentTotal,
  'shopify-orders-' || epoch_ms(w.ws) || '-' || epoch_ms(w.ws + INTERVAL 1 MONTH) || '.json' AS fileName,
  'shopify-orders-' || epoch_ms(w.ws) || '-' || epoch_ms(w.ws + INTERVAL 1 MONTH) || '.jsonl' AS rawFileName,
  strftime(w.ws, '%Y-%m-%dT%H:%M:%SZ') AS windowStart, strftime(w.ws + INTERVAL 1 MONTH, '%Y-%m-%dT%H:%M:%SZ') AS windowEnd
FROM gate g JOIN win w ON g.load_id = w.load_id LEFT JOIN rel ON rel.load_id = g.load_id"""


# ---------------------------------------------------------------------------------------
# 3. Id lookups
# ---------------------------------------------------------------------------------------
# Fixed fixture rule: the other system asks for one id per line item, spelled by line number:
# 1 numeric, 2 gid, 3 numeric of key x 3, 4 padded numeric, 5 gid beyond the key range,
# 6 gid of another object type, 7 blank.

def _requests(spark, sf_dir) -> DataFrame:
    li = ad.table(spark, sf_dir, "lineitem")
    k, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    raw = (F.when(n == 1, k)
           .when(n == 2, F.concat(F.lit(ORDER_GID_PREFIX), k))
           .when(n == 3, (F.col("l_orderkey") * 3).cast("string"))
           .when(n == 4, F.concat(F.lit(" "), k, F.lit(" ")))
           .when(n == 5, F.concat(F.lit(ORDER_GID_PREFIX), (F.col("l_orderkey") + 1000000).cast("string")))
           .when(n == 6, F.concat(F.lit("gid://shopify/Customer/"), F.col("l_partkey").cast("string")))
           .otherwise(F.lit("   ")))
    return li.select(raw.alias("requested_id"), (F.col("l_orderkey") * 8 + n).alias("position"))


SQL_REQUESTS_CTE = f"""
req0 AS (
  SELECT CASE l_linenumber
      WHEN 1 THEN CAST(l_orderkey AS VARCHAR)
      WHEN 2 THEN '{ORDER_GID_PREFIX}' || l_orderkey
      WHEN 3 THEN CAST(l_orderkey * 3 AS VARCHAR)
      WHEN 4 THEN ' ' || l_orderkey || ' '
      WHEN 5 THEN '{ORDER_GID_PREFIX}' || (l_orderkey + 1000000)
      WHEN 6 THEN 'gid://shopify/Customer/' || l_partkey
      ELSE '   ' END AS raw,
    l_orderkey * 8 + l_linenumber AS position
  FROM lineitem),
req AS (
  SELECT DISTINCT trim(raw) AS requested_id FROM req0 WHERE trim(raw) <> ''),
canon AS (
  SELECT requested_id, CASE WHEN starts_with(requested_id, 'gid://') THEN requested_id
                            ELSE '{ORDER_GID_PREFIX}' || requested_id END AS cid FROM req)"""


def _split(spark, sf_dir):
    return lookup.split_found_missing(_requests(spark, sf_dir), _orders(spark, sf_dir).select("id"))


def q_ids_found(spark, sf_dir):
    """Requested ids (as requested, trimmed, deduped) that exist."""
    return lookup.found_ids(_split(spark, sf_dir))


def q_ids_missing(spark, sf_dir):
    """Requested ids that do not exist."""
    return lookup.missing_ids(_split(spark, sf_dir))


SQL_IDS_FOUND = _with(SQL_REQUESTS_CTE) + f"""
SELECT requested_id FROM canon WHERE cid IN (SELECT '{ORDER_GID_PREFIX}' || o_orderkey FROM orders)"""

SQL_IDS_MISSING = _with(SQL_REQUESTS_CTE) + f"""
SELECT requested_id FROM canon WHERE cid NOT IN (SELECT '{ORDER_GID_PREFIX}' || o_orderkey FROM orders)"""


def q_id_batches(spark, sf_dir):
    """Distinct canonical ids in first-request order, in batches of 250."""
    b = lookup.batch_ids(_requests(spark, sf_dir), size=lookup.LOOKUP_BATCH)
    return b.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.min_by("canonical_id", "id_no").alias("first_id"),
        F.max_by("canonical_id", "id_no").alias("last_id"))


SQL_ID_BATCHES = _with(SQL_REQUESTS_CTE) + f""",
c0 AS (
  SELECT CASE WHEN starts_with(trim(raw), 'gid://') THEN trim(raw) ELSE '{ORDER_GID_PREFIX}' || trim(raw) END AS cid,
         min(position) AS first_pos
  FROM req0 WHERE trim(raw) <> '' GROUP BY 1),
n AS (SELECT cid, row_number() OVER (ORDER BY first_pos, cid) AS id_no FROM c0),
b AS (SELECT cid, id_no, (id_no - 1) // 250 AS batch_no FROM n)
SELECT batch_no, count(*) AS n_ids, arg_min(cid, id_no) AS first_id, arg_max(cid, id_no) AS last_id
FROM b GROUP BY batch_no"""


def _reconciled(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    left = li.select(F.when(F.col("l_linenumber") == 7, F.col("l_orderkey") + 1000000)
                     .otherwise(F.col("l_orderkey")).cast("string").alias("left_id"))
    o = _orders(spark, sf_dir)
    right = o.filter((F.col("_ts_createdAt") >= F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))
                     & (F.col("_ts_createdAt") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))).select(F.col("id").alias("right_id"))
    rec = lookup.reconcile_ids(left, right)
    confirmed = lookup.confirm_missing(rec, o.select("id"))
    return rec.join(confirmed, "canonical_id", "left")


def q_id_reconcile(spark, sf_dir):
    """Other system's ids vs one year's extraction; ids the extraction lacks are
    confirmed against every stored order (J1)."""
    return _reconciled(spark, sf_dir)


SQL_ID_RECONCILE = f"""
WITH l AS (SELECT DISTINCT '{ORDER_GID_PREFIX}' || CASE WHEN l_linenumber = 7 THEN l_orderkey + 1000000 ELSE l_orderkey END AS cid FROM lineitem),
r AS (SELECT DISTINCT '{ORDER_GID_PREFIX}' || o_orderkey AS cid FROM orders
      WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'),
allo AS (SELECT '{ORDER_GID_PREFIX}' || o_orderkey AS cid FROM orders),
j AS (SELECT coalesce(l.cid, r.cid) AS canonical_id,
             CASE WHEN l.cid IS NOT NULL AND r.cid IS NOT NULL THEN 'matched'
                  WHEN l.cid IS NOT NULL THEN 'missing_right' ELSE 'missing_left' END AS state
      FROM l FULL OUTER JOIN r ON l.cid = r.cid)
SELECT canonical_id, state,
  CASE WHEN state = 'missing_right' THEN canonical_id NOT IN (SELECT cid FROM allo) END AS confirmed_missing
FROM j"""


# ---------------------------------------------------------------------------------------
# 4. Exchanges
# ---------------------------------------------------------------------------------------
SWEEP_START_MS = 852076800000   # 1997-01-01T00:00:00Z
SWEEP_END_MS = 854755200000     # 1997-02-01T00:00:00Z


#: The stored order numbers of orders and returns.
ORDER_KEYS = ("order_key", "l_orderkey")


def _returns(spark, sf_dir):
    pin_utc(spark)
    return ad.return_rows(_t(spark, sf_dir, "lineitem"))


def _sweep(spark, sf_dir):
    return ex.sweep_exchanges(_orders(spark, sf_dir), _returns(spark, sf_dir), ad.LINE_ORDER,
                              SWEEP_START_MS, SWEEP_END_MS, fields=ad.return_fields(), keys=ORDER_KEYS)[0]


def q_exchange_sweep(spark, sf_dir):
    """Exchanges created in January 1997 (first live in-window return per order)."""
    return _sweep(spark, sf_dir)


SQL_EXCHANGE_SWEEP = _with(ORDERS_CTE, RETURNS_CTE) + """,
cnt AS (SELECT l_orderkey, count(*) FILTER (WHERE live) AS exchangeReturnCount FROM rx GROUP BY l_orderkey),
hit AS (
  SELECT l_orderkey, arg_min(return_id, pos) AS returnId, arg_min(return_name, pos) AS returnName,
         arg_min(return_status, pos) AS returnStatus, arg_min(epoch_ms(l_shipdate), pos) AS returnCreatedAtMillis
  FROM rx WHERE live AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-02-01'
  GROUP BY l_orderkey)
SELECT os.legacyResourceId AS externalId, os.name AS orderName, hit.returnId, hit.returnName, hit.returnStatus,
       hit.returnCreatedAtMillis, cnt.exchangeReturnCount
FROM os JOIN hit ON hit.l_orderkey = os.order_key JOIN cnt ON cnt.l_orderkey = os.order_key
WHERE os.ts_updated >= TIMESTAMP '1997-01-01' AND lower(os.returnStatus) <> 'no_return'
  AND os.legacyResourceId IS NOT NULL AND os.legacyResourceId <> ''"""


def q_exchange_counts(spark, sf_dir):
    """A4 + T5: per order with returns, its live exchange returns of any date, and all returns."""
    totals = ex.exchange_totals(_returns(spark, sf_dir), ad.LINE_ORDER, SWEEP_START_MS, SWEEP_END_MS, ad.return_fields(), key="l_orderkey")
    return totals.select(F.concat(F.lit(ORDER_GID_PREFIX), F.col("l_orderkey").cast("string")).alias("id"), F.col("exchangeReturnCount").cast("int").alias("exchangeReturnCount"),
                         F.col("returnCount").cast("int").alias("returnCount"))


SQL_EXCHANGE_COUNTS = _with(RETURNS_CTE) + """
SELECT order_id AS id, CAST(count(*) FILTER (WHERE live) AS INTEGER) AS exchangeReturnCount, CAST(count(*) AS INTEGER) AS returnCount
FROM rx GROUP BY order_id"""


def _state_requests(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    k = F.col("l_orderkey").cast("string")
    raw = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(ORDER_GID_PREFIX), k)).otherwise(k)
    return li.select(raw.alias("requested_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("position"))


def q_exchange_state(spark, sf_dir):
    """J2 + P6 + A5: nested exchange state of every order with an exchange line, flattened."""
    st = ex.exchange_state_lookup(_state_requests(spark, sf_dir), _orders(spark, sf_dir), _returns(spark, sf_dir),
                                  ad.LINE_ORDER, position_col="position", fields=ad.return_fields(text_children=True),
                                  keys=ORDER_KEYS, numbered=True)
    e = st.select("order_key", "returnStatus", F.col("currentTotalAmount").cast("string").alias("currentTotalAmount"),
                  "currentTotalCurrency", F.explode_outer("exchanges").alias("x"))
    e = e.select("*", F.explode_outer("x.exchangeLineItems").alias("xi"))
    e = e.select("*", F.explode_outer("xi.lineItems").alias("li"))
    return e.select("order_key", "returnStatus", "currentTotalAmount", "currentTotalCurrency",
                    F.col("x.returnId").alias("returnId"), F.col("x.status").alias("exchangeReturnStatus"),
                    F.col("x.createdAt").alias("returnCreatedAt"), F.col("xi.id").alias("exchangeItemId"),
                    F.col("xi.quantity").alias("exchangeQuantity"), F.col("xi.shape").alias("lineItemsShape"),
                    F.col("li.id").alias("lineItemId"),
                    F.col("li.sku").alias("lineItemSku"), F.col("li.quantity").alias("lineItemQuantity"))


SQL_EXCHANGE_STATE = _with(ORDERS_CTE, RETURNS_CTE) + f""",
want AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
x AS (SELECT * FROM rx WHERE has_exchange)
SELECT CAST(os.order_key AS VARCHAR) AS order_key, os.returnStatus,
  CAST(CAST(CAST(os.o_totalprice AS DECIMAL(20,2)) AS DECIMAL(20,4)) AS VARCHAR) AS currentTotalAmount,
  'USD' AS currentTotalCurrency,
  x.return_id AS returnId, x.return_status AS exchangeReturnStatus, x.return_created AS returnCreatedAt,
  CASE WHEN x.return_id IS NOT NULL THEN 'gid://shopify/ExchangeLineItem/' || x.l_orderkey || '-' || x.l_linenumber || '-' || x.l_partkey || '-' || x.l_suppkey END AS exchangeItemId,
  CAST(CAST(x.l_quantity AS INTEGER) AS VARCHAR) AS exchangeQuantity,
  CASE WHEN x.return_id IS NOT NULL THEN CASE x.l_linenumber % 2 WHEN 1 THEN 'list' ELSE 'connection' END END AS lineItemsShape,
  CASE WHEN x.return_id IS NOT NULL THEN 'gid://shopify/LineItem/' || x.l_orderkey || '-' || x.l_linenumber || '-' || x.l_partkey || '-' || x.l_suppkey END AS lineItemId,
  CASE WHEN x.return_id IS NOT NULL THEN 'SKU-' || x.l_partkey END AS lineItemSku,
  CAST(CAST(x.l_quantity AS INTEGER) AS VARCHAR) AS lineItemQuantity
FROM os JOIN want ON want.l_orderkey = os.order_key
LEFT JOIN x ON x.l_orderkey = os.order_key"""


def _shape_texts(spark, sf_dir):
    li = ad.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    item = F.concat(F.lit('{"id":"gid://shopify/LineItem/'), F.concat_ws("-", *[F.col(c).cast("string") for c in
                                                                                ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]),
                    F.lit('","sku":"SKU-'), F.col("l_partkey").cast("string"),
                    F.lit('","quantity":"'), F.col("l_quantity").cast("int").cast("string"), F.lit('"}'))
    r = F.col("l_linenumber") % 3
    text = (F.when(r == 0, F.concat(F.lit("["), item, F.lit(",7]")))
            .when(r == 1, F.concat(F.lit('{"nodes":['), item, F.lit("]}")))
            .otherwise(F.lit('{"edges":[]}')))
    rid = F.concat(F.lit("gid://shopify/Return/"), F.concat_ws("-", *[F.col(c).cast("string") for c in
                                                                      ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))
    return li.select(rid.alias("return_id"), text.alias("line_items_text"))


def q_child_shapes(spark, sf_dir):
    """Nested line items arriving as a plain list or as {nodes: [...]}, normalised."""
    t = ex.with_child_shape(_shape_texts(spark, sf_dir), "line_items_text")
    return t.select("return_id", "shape", F.explode_outer("items").alias("it")).select(
        "return_id", "shape", F.col("it.id").alias("item_id"), F.col("it.sku").alias("item_sku"),
        F.col("it.quantity").alias("item_quantity"))


SQL_CHILD_SHAPES = """
WITH r AS (
  SELECT 'gid://shopify/Return/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS return_id,
         l_linenumber % 3 AS kind,
         'gid://shopify/LineItem/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item_id,
         'SKU-' || l_partkey AS item_sku, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS item_quantity
  FROM lineitem WHERE l_returnflag = 'R')
SELECT return_id, CASE kind WHEN 0 THEN 'list' WHEN 1 THEN 'connection' END AS shape,
       CASE WHEN kind < 2 THEN item_id END AS item_id, CASE WHEN kind < 2 THEN item_sku END AS item_sku,
       CASE WHEN kind < 2 THEN item_quantity END AS item_quantity
FROM r"""


def q_exchange_presence(spark, sf_dir):
    """Expected exchange count per swept order against the other system's count."""
    li = _t(spark, sf_dir, "lineitem")
    other = li.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).groupBy(
        F.col("l_orderkey").cast("string").alias("externalId")).agg(F.count(F.lit(1)).alias("other_exchange_count"))
    return ex.exchange_presence(_sweep(spark, sf_dir), other)


SQL_EXCHANGE_PRESENCE = f"""
WITH sw AS ({SQL_EXCHANGE_SWEEP}),
oth AS (SELECT CAST(l_orderkey AS VARCHAR) AS externalId, count(*) AS n FROM lineitem
        WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1)
SELECT sw.externalId, sw.returnId, sw.exchangeReturnCount, coalesce(oth.n, 0) AS other_exchange_count,
  CASE WHEN coalesce(oth.n, 0) >= sw.exchangeReturnCount THEN 'present'
       WHEN coalesce(oth.n, 0) = 0 THEN 'missing' ELSE 'short' END AS presence
FROM sw LEFT JOIN oth ON oth.externalId = sw.externalId"""


# ---------------------------------------------------------------------------------------
# 5. API-log analytics
# ---------------------------------------------------------------------------------------

def _log(spark, sf_dir) -> DataFrame:
    pin_utc(spark)
    ev = _t(spark, sf_dir, "events").withColumn("request_id", ad.event_request_id())
    # attempts are numbered on the raw events; the response bodies are built once, after that
    return ad.event_log(number_rows(ev, ["ts", "event_id"], ["request_id"], out="attempt"))


def q_response_classes(spark, sf_dir):
    """L1: every captured response classified (2 attempts per request)."""
    c = apilog.classify_responses(_log(spark, sf_dir).withColumn("max_attempts", F.lit(2)))
    return c.select("event_id", "request_id", "attempt", "ok", "retryable", "throttled", "error_text", "data", "requested_cost",
                    "actual_cost", "maximum_available")


def q_throttle_delay(spark, sf_dir):
    """Wait before the next try from the cost block of each response."""
    c = apilog.classify_responses(_log(spark, sf_dir).withColumn("max_attempts", F.lit(2)))
    from orderlens.functions.money import throttle_delay_millis
    return c.select("event_id", throttle_delay_millis(F.col("requested_cost"), F.col("currently_available"),
                                                      F.col("restore_rate")).alias("delay_ms"))


def q_retry_plan(spark, sf_dir):
    """L2: per request attempts used, final outcome and planned waiting (mutations: 1 try)."""
    return apilog.retry_plan(_log(spark, sf_dir))


def q_download_outcomes(spark, sf_dir):
    """L3: result downloads, up to 3 attempts, 429/5xx retried."""
    lg = _log(spark, sf_dir)
    et = F.col("event_type")
    code = (F.when(et == "purchase", 200).when(et == "signup", 500).when(et == "view", 429)
            .when(et == "click", 404).otherwise(503))
    d = lg.select(F.col("request_id").alias("download_id"), "attempt", code.alias("status_code"))
    return apilog.download_outcomes(d)


def _op_events(spark, sf_dir):
    pin_utc(spark)
    ev = _t(spark, sf_dir, "events")
    return number_rows(ev.select("event_id", "ts", "user_id", "event_type", "value"), ["ts", "event_id"], ["user_id"], out="n")


def q_operation_rollup(spark, sf_dir):
    """A2: bulk-operation status history per operation (user): polls, final status, outcome."""
    e = _op_events(spark, sf_dir)
    et, v = F.col("event_type"), F.col("value")
    status = (F.when(et == "signup", "CREATED").when(et == "view", "RUNNING").when(et == "click", "running")
              .when(et == "purchase", F.when(v > 300, "COMPLETED").otherwise("RUNNING"))
              .otherwise(F.when(v > 330, "FAILED").when(v > 300, "CANCELED").otherwise("running")))
    s = e.select(F.col("user_id").alias("operation_id"), (F.col("n") - 1).alias("seq"), status.alias("status"))
    r = apilog.operation_rollup(s)
    return r.withColumn("status_history", F.array_join(F.transform("status_history", lambda x: x["status"]), ">"))


def q_start_retries(spark, sf_dir):
    """A3 + X17: start attempts per operation; concurrent-run rejections retried up to 10 times."""
    e = _op_events(spark, sf_dir)
    et = F.col("event_type")
    msg = (F.when(et == "view", "A bulk operation for this app and shop is already in progress.")
           .when(et == "click", "Another bulk operation is already running.")
           .when(et == "signup", "Bulk operation is already running")
           .when(et == "error", "Bulk queries cannot use that field."))
    s = e.select(F.col("user_id").alias("operation_id"), F.col("n").alias("attempt"), (et == "purchase").alias("ok"),
                 msg.alias("message"))
    r = apilog.start_retry_rollup(s)
    return r.withColumn("retry_history", F.array_join(F.transform(
        "retry_history", lambda x: F.concat(x["attempt"].cast("string"), F.lit(":"), x["message"])), "|"))


def q_connection_checks(spark, sf_dir):
    """L4: ordered connection checks per config from captured connect / orders responses."""
    c = ad.configs_shape(_t(spark, sf_dir, "customer"))
    k = F.col("custkey")
    ks = k.cast("string")
    confs = c.select("config_id", F.col("access_token").alias("accessToken"),
                     F.when(k % 50 == 0, F.lit("Credential could not be decrypted.")).alias("credential_error"),
                     F.col("shop_api_url").alias("shop_url"), "api_version", "can_read_orders")
    m9 = k % 9
    connect = c.select("config_id",
                       F.when(m9 == 0, 401).when(m9 == 1, 404).when(m9 == 2, 503).when(m9 == 3, 0).otherwise(200).alias("status_code"),
                       F.when(m9 >= 4, F.concat(F.lit('{"data":{"shop":{"myshopifyDomain":"shop'), ks, F.lit('.myshopify.com"}}}')))
                       .otherwise(F.lit("")).alias("body"), (k % 500 + 20).alias("duration_ms"))
    m7 = k % 7
    probe = c.select("config_id",
                     F.when(m7 == 1, 500).otherwise(200).alias("status_code"),
                     F.when(m7 == 0, F.lit('{"data":null,"errors":[{"message":"Access denied for orders field. Required access: read_orders"}]}'))
                     .when(m7 == 1, F.lit(""))
                     .when(m7 == 2, F.lit('{"errors":[{"message":"Internal error"}]}'))
                     .when(k % 2 == 1, F.lit('{"data":{"orders":{"edges":[{"node":{"id":"gid://shopify/Order/1"}}]}}}'))
                     .otherwise(F.lit('{"data":{"orders":{"edges":[]}}}')).alias("body"), (k % 300 + 5).alias("duration_ms"))
    return apilog.check_rows(confs, connect, probe)


SQL_LOG_CTE = """
lg0 AS (
  SELECT e.*, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         user_id || '-' || strftime(ts, '%Y-%m-%d') AS request_id,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt
  FROM events e),
lg AS (
  SELECT *,
    CASE WHEN event_type IN ('purchase','view','click') THEN 200
         WHEN event_type = 'signup' THEN CASE WHEN value < 100 THEN 429 ELSE 503 END
         ELSE CASE WHEN value < 200 THEN 200 ELSE 404 END END AS status_code,
    CASE WHEN event_type = 'purchase' THEN '{"data":{"orders":{"edges":[]}},"extensions":{"cost":{"requestedQueryCost":' || (k + 10) || ',"actualQueryCost":' || k || ',"throttleStatus":{"maximumAvailable":1000,"currentlyAvailable":' || (k * 7 % 100) || ',"restoreRate":50}}}}'
         WHEN event_type = 'view' THEN '{"errors":[{"message":"Throttled","extensions":{"code":"THROTTLED"}}],"extensions":{"cost":{"requestedQueryCost":' || (k + 10) || ',"actualQueryCost":0,"throttleStatus":{"maximumAvailable":1000,"currentlyAvailable":' || (k % 10) || ',"restoreRate":' || ((k % 5) * 10) || '}}}}'
         WHEN event_type = 'click' THEN '{"data":null,"errors":[{"message":"Access denied for orders field.","extensions":{"code":"ACCESS_DENIED"}},{"message":"  "}]}'
         WHEN event_type = 'signup' THEN CASE WHEN value < 100 THEN '' ELSE 'Service Unavailable' END
         ELSE CASE WHEN value < 25 THEN '{"errors":"Not Found"}' WHEN value < 50 THEN '{"errors":{"message":"Not Found"}}'
                   WHEN value < 75 THEN '{"data":{"orders":1}} trailing' WHEN value < 100 THEN 'not-json' WHEN value < 200 THEN '{"errors":[{"message":"   "}],"data":{}}' ELSE '' END END AS body,
    CASE WHEN user_id % 10 = 0 THEN 1 ELSE 2 END AS max_plan
  FROM lg0),
cl0 AS (
  SELECT *, (status_code < 200 OR status_code >= 300) AS http_bad,
         NOT coalesce(CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' END, false) AS json_bad
  FROM lg),
cl1 AS (
  SELECT *,
    CASE WHEN NOT http_bad AND NOT json_bad THEN
      list_filter(list_transform(coalesce(json_extract_string(body, '$.errors[*].message'), []), lambda m: trim(m)), lambda m: m IS NOT NULL AND m <> '') END AS msgs,
    CASE WHEN NOT http_bad AND NOT json_bad THEN
      list_has_any(coalesce(json_extract_string(body, '$.errors[*].extensions.code'), []), ['THROTTLED', 'MAX_COST_EXCEEDED']) END AS has_throttle,
    CASE WHEN NOT http_bad AND NOT json_bad THEN coalesce(json_type(body, '$.errors') NOT IN ('ARRAY', 'NULL')
      AND json_extract_string(body, '$.errors') NOT IN ('', 'false', '0', '{}'), false) ELSE false END AS errors_odd,
    CASE WHEN NOT http_bad AND NOT json_bad THEN TRY_CAST(json_extract_string(body, '$.extensions.cost.requestedQueryCost') AS VARCHAR) END AS requested_cost,
    CASE WHEN NOT http_bad AND NOT json_bad THEN json_extract_string(body, '$.extensions.cost.actualQueryCost') END AS actual_cost,
    CASE WHEN NOT http_bad AND NOT json_bad THEN json_extract_string(body, '$.extensions.cost.throttleStatus.maximumAvailable') END AS maximum_available,
    CASE WHEN NOT http_bad AND NOT json_bad THEN json_extract_string(body, '$.extensions.cost.throttleStatus.currentlyAvailable') END AS currently_available,
    CASE WHEN NOT http_bad AND NOT json_bad THEN json_extract_string(body, '$.extensions.cost.throttleStatus.restoreRate') END AS restore_rate
  FROM cl0),
cl AS (
  SELECT *,
    CASE WHEN http_bad THEN 'http' WHEN json_bad THEN 'json' WHEN errors_odd THEN 'shape' WHEN len(msgs) > 0 THEN 'graphql' ELSE 'ok' END AS kind
  FROM cl1),
cls AS (
  SELECT *, kind = 'ok' AS ok,
    (kind = 'graphql' AND coalesce(has_throttle, false)) AS throttled,
    CASE WHEN kind = 'http' THEN 'Shopify GraphQL request failed with HTTP ' || status_code || '.'
         WHEN kind = 'json' THEN 'Shopify GraphQL response was not valid JSON.'
         WHEN kind = 'shape' THEN 'Shopify GraphQL request failed before a valid response was received.'
         WHEN kind = 'graphql' THEN array_to_string(list_transform(msgs, lambda m: 'Shopify GraphQL error: ' || m), '; ') END AS error_text
  FROM cl),
dl AS (
  SELECT *,
    CASE WHEN requested_cost IS NULL OR currently_available IS NULL OR restore_rate IS NULL
              OR CAST(restore_rate AS BIGINT) <= 0 OR CAST(requested_cost AS BIGINT) - CAST(currently_available AS BIGINT) <= 0 THEN 1000
         ELSE least(10000, greatest(1000, ((CAST(requested_cost AS BIGINT) - CAST(currently_available AS BIGINT)) * 1000
                                           + CAST(restore_rate AS BIGINT) - 1) // CAST(restore_rate AS BIGINT))) END AS delay_ms
  FROM cls)"""

SQL_RESPONSE_CLASSES = _with(SQL_LOG_CTE) + """
SELECT event_id, request_id, attempt, ok,
  CASE WHEN kind = 'http' THEN (status_code = 429 OR status_code >= 500) AND attempt < 2
       WHEN kind = 'graphql' THEN coalesce(has_throttle, false) AND attempt < 2 WHEN kind = 'shape' THEN attempt < 2 ELSE false END AS retryable,
  throttled, error_text, CASE WHEN kind = 'ok' THEN CAST(json_extract(body, '$.data') AS VARCHAR) END AS data,
  requested_cost, actual_cost, maximum_available
FROM cls"""

SQL_THROTTLE_DELAY = _with(SQL_LOG_CTE) + """
SELECT event_id, delay_ms FROM dl"""

SQL_RETRY_PLAN = _with(SQL_LOG_CTE) + """,
rp AS (
  SELECT *,
    CASE WHEN kind = 'http' THEN (status_code = 429 OR status_code >= 500) AND attempt < max_plan
         WHEN kind = 'graphql' THEN coalesce(has_throttle, false) AND attempt < max_plan
         WHEN kind = 'shape' THEN attempt < max_plan ELSE false END AS retryable
  FROM dl),
st AS (SELECT *, (ok OR NOT retryable OR attempt >= max_plan) AS stop_here FROM rp),
ends AS (SELECT request_id, min(attempt) FILTER (WHERE stop_here) AS first_stop, max(attempt) AS last FROM st GROUP BY request_id),
j AS (SELECT st.*, coalesce(ends.first_stop, ends.last) AS used, ends.first_stop IS NULL AS unfinished
      FROM st JOIN ends USING (request_id))
SELECT request_id, max(attempt) AS attempts_used,
  arg_max(ok, attempt) AS final_ok, arg_max(status_code, attempt) AS final_status_code,
  arg_max_null(error_text, attempt) AS final_error,
  sum(CASE WHEN NOT stop_here AND (throttled OR status_code = 429) THEN delay_ms ELSE 0 END) AS planned_delay_ms,
  bool_or(unfinished) AS unfinished, any_value(ignored) AS ignored_rows
FROM j JOIN (SELECT request_id, count(*) FILTER (WHERE attempt > max_plan) AS ignored FROM st GROUP BY request_id) USING (request_id)
WHERE attempt <= used GROUP BY request_id"""

SQL_DOWNLOAD_OUTCOMES = _with(SQL_LOG_CTE) + """,
d AS (
  SELECT request_id AS download_id, attempt,
    CASE event_type WHEN 'purchase' THEN 200 WHEN 'signup' THEN 500 WHEN 'view' THEN 429 WHEN 'click' THEN 404 ELSE 503 END AS status_code
  FROM lg0),
d1 AS (SELECT *, status_code >= 200 AND status_code < 300 AS ok,
              (status_code = 429 OR status_code >= 500) AS retry FROM d),
d2 AS (SELECT *, (ok OR NOT retry OR attempt >= 3) AS stop_here FROM d1),
ends AS (SELECT download_id, coalesce(min(attempt) FILTER (WHERE stop_here), max(attempt)) AS used FROM d2 GROUP BY download_id)
SELECT d2.download_id, attempt AS attempts_used, ok, retry AND NOT ok AS retryable, status_code,
  CASE WHEN NOT ok THEN 'Shopify bulk operation result download failed with HTTP ' || status_code || '.' END AS error,
  CASE WHEN NOT ok THEN attempt END AS download_attempt_count,
  (SELECT count(*) FROM d2 o WHERE o.download_id = d2.download_id AND o.attempt > 3) AS ignored_rows
FROM d2 JOIN ends ON ends.download_id = d2.download_id AND d2.attempt = ends.used"""

SQL_OP_EVENTS = """
oe AS (
  SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events e)"""

SQL_OPERATION_ROLLUP = _with(SQL_OP_EVENTS) + """,
s AS (
  SELECT user_id AS operation_id, n - 1 AS seq,
    upper(CASE WHEN event_type = 'signup' THEN 'CREATED' WHEN event_type = 'view' THEN 'RUNNING' WHEN event_type = 'click' THEN 'running'
               WHEN event_type = 'purchase' THEN CASE WHEN value > 300 THEN 'COMPLETED' ELSE 'RUNNING' END
               ELSE CASE WHEN value > 330 THEN 'FAILED' WHEN value > 300 THEN 'CANCELED' ELSE 'running' END END) AS st
  FROM oe),
t AS (SELECT *, st IN ('COMPLETED', 'FAILED', 'CANCELED', 'CANCELLED', 'EXPIRED') AS term FROM s),
ends AS (SELECT operation_id, min(seq) FILTER (WHERE term AND seq <= 60) AS stop_seq, max(seq) AS last_seq FROM t GROUP BY operation_id),
j AS (SELECT t.* FROM t JOIN ends USING (operation_id) WHERE t.seq <= coalesce(ends.stop_seq, least(ends.last_seq, 60))),
a AS (SELECT operation_id, count(*) AS history_length, arg_max(st, seq) AS final_status, string_agg(st, '>' ORDER BY seq) AS status_history
      FROM j GROUP BY operation_id),
ig AS (SELECT operation_id, count(*) FILTER (WHERE seq > 60) AS ignored_rows FROM s GROUP BY operation_id),
o AS (
  SELECT *, CASE WHEN final_status = 'COMPLETED' THEN 'COMPLETED'
       WHEN final_status IN ('FAILED', 'CANCELED', 'CANCELLED', 'EXPIRED') THEN 'FAILED'
       WHEN history_length > 60 THEN 'TIMED_OUT' ELSE 'RUNNING' END AS outcome
  FROM a JOIN ig USING (operation_id))
SELECT operation_id, history_length - 1 AS poll_count, final_status, outcome, history_length, status_history,
  CASE outcome WHEN 'FAILED' THEN 'Shopify bulk operation ' || operation_id || ' ended with status ' || final_status || '.'
    WHEN 'TIMED_OUT' THEN 'Shopify bulk operation ' || operation_id || ' did not complete after 60 poll attempt(s).' END AS error,
  ignored_rows
FROM o"""

SQL_START_RETRIES = _with(SQL_OP_EVENTS) + """,
s AS (
  SELECT user_id AS operation_id, n AS attempt, event_type = 'purchase' AS ok,
    CASE event_type WHEN 'view' THEN 'A bulk operation for this app and shop is already in progress.'
                    WHEN 'click' THEN 'Another bulk operation is already running.'
                    WHEN 'signup' THEN 'Bulk operation is already running'
                    WHEN 'error' THEN 'Bulk queries cannot use that field.' END AS message
  FROM oe),
c AS (
  SELECT *, (NOT ok AND coalesce(lower(trim(message)) LIKE '%bulk operation%' AND (
      lower(message) LIKE '%already in progress%' OR lower(message) LIKE '%already running%'
      OR lower(message) LIKE '%operation is running%' OR lower(message) LIKE '%another bulk operation%'), false)) AS conc
  FROM s),
st AS (SELECT *, (ok OR NOT conc OR attempt >= 11) AS stop_here FROM c),
ends AS (SELECT operation_id, min(attempt) FILTER (WHERE stop_here) AS first_stop, max(attempt) AS last FROM st GROUP BY operation_id),
j AS (SELECT st.*, ends.first_stop FROM st JOIN ends USING (operation_id) WHERE attempt <= coalesce(ends.first_stop, ends.last)),
a AS (SELECT operation_id, arg_max(ok, attempt) AS e_ok, arg_max(conc, attempt) AS e_conc, arg_max_null(message, attempt) AS e_msg,
             count(*) FILTER (WHERE conc) AS rej, bool_or(first_stop IS NULL) AS open,
             coalesce(string_agg(attempt || ':' || message, '|' ORDER BY attempt)
               FILTER (WHERE conc AND attempt <= 10 AND (first_stop IS NULL OR attempt < first_stop)), '') AS retry_history
      FROM j GROUP BY operation_id),
ig AS (SELECT operation_id, count(*) FILTER (WHERE attempt > 11) AS ignored_rows FROM s GROUP BY operation_id)
SELECT operation_id,
  CASE WHEN open THEN 'PENDING' WHEN e_ok THEN 'STARTED' WHEN e_conc THEN 'EXHAUSTED' ELSE 'FAILED' END AS outcome,
  CASE WHEN e_ok OR NOT e_conc THEN rej ELSE rej - 1 END AS start_retry_count,
  CASE WHEN NOT e_ok THEN e_msg END AS last_error, retry_history,
  CASE WHEN NOT open AND NOT e_ok AND e_conc THEN
    'Shopify bulk operation could not start because another bulk operation was still running after 10 retry attempt(s).' END AS error,
  ignored_rows
FROM a JOIN ig USING (operation_id)"""

SQL_CONFIGS_CTE = """
cf AS (
  SELECT c_name AS config_id, 'Store ' || (c_custkey % 97) AS description, c_mktsegment AS tenant_id,
    'user' || (c_custkey % 20) AS created_by,
    CASE WHEN c_custkey % 11 = 0 THEN 'http://shop' || c_custkey || '.myshopify.com'
         WHEN c_custkey % 13 = 0 THEN 'https://shop' || c_custkey || '.example.com'
         WHEN c_custkey % 17 = 0 THEN 'https://shop' || c_custkey || '.myshopify.com/admin/api/2024-01/graphql.json'
         ELSE 'https://shop' || c_custkey || '.myshopify.com/' END AS shop_api_url,
    CASE c_nationkey % 5 WHEN 0 THEN '2025-07' WHEN 1 THEN '2025-10' WHEN 2 THEN '2026-01' WHEN 3 THEN 'unstable' ELSE '2025-7' END AS api_version,
    CASE c_custkey % 3 WHEN 0 THEN 'America/Chicago' WHEN 1 THEN 'America/Los_Angeles' END AS time_zone,
    CASE WHEN c_acctbal >= 0 THEN 'tok-' || c_custkey END AS access_token,
    CASE c_custkey % 10 WHEN 0 THEN 'N' WHEN 1 THEN NULL ELSE 'Y' END AS is_active,
    CASE c_custkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN NULL ELSE 'Y' END AS can_read_orders,
    c_custkey AS custkey
  FROM customer)"""

_DESCRIBE_SQL = """CASE WHEN {s} = 401 OR {s} = 403 THEN 'The access token was rejected (HTTP ' || {s} || ').'
  WHEN {s} = 429 THEN 'Shopify rate-limited the request (HTTP 429).'
  WHEN {s} >= 500 THEN 'Shopify returned a server error (HTTP ' || {s} || ').'
  WHEN {s} > 0 THEN 'The request failed with HTTP ' || {s} || '.'
  ELSE 'The shop could not be reached.' END"""

_IS_OBJECT_SQL = "(CASE WHEN json_valid({body}) THEN json_type({body}) = 'OBJECT' ELSE false END)"
_BODY_MESSAGES_SQL = """(CASE WHEN json_valid({body}) THEN
    list_filter(CAST(json_extract_string({body}, '$.errors[*].message') AS VARCHAR[]), lambda m: trim(m) <> '') ELSE [] END)"""

SQL_CONNECTION_CHECKS = _with(SQL_CONFIGS_CTE) + f""",
r AS (
  SELECT config_id, custkey,
    coalesce(CASE WHEN custkey % 50 = 0 THEN 'Credential could not be decrypted.' END,
             CASE WHEN access_token IS NULL OR trim(access_token) = '' THEN 'No access token is stored for this configuration.' END) AS cred_fail,
    trim(shop_api_url) AS shop_url, trim(api_version) AS ver,
    coalesce(upper(trim(can_read_orders)) = 'N', false) AS disabled,
    CASE custkey % 9 WHEN 0 THEN 401 WHEN 1 THEN 404 WHEN 2 THEN 503 WHEN 3 THEN 0 ELSE 200 END AS cs,
    CASE WHEN custkey % 9 >= 4 THEN '{{"data":{{"shop":{{"myshopifyDomain":"shop' || custkey || '.myshopify.com"}}}}}}' ELSE '' END AS c_body,
    CASE WHEN custkey % 7 = 1 THEN 500 ELSE 200 END AS os,
    CASE custkey % 7 WHEN 0 THEN '{{"data":null,"errors":[{{"message":"Access denied for orders field. Required access: read_orders"}}]}}'
      WHEN 1 THEN '' WHEN 2 THEN '{{"errors":[{{"message":"Internal error"}}]}}'
      ELSE CASE WHEN custkey % 2 = 1 THEN '{{"data":{{"orders":{{"edges":[{{"node":{{"id":"gid://shopify/Order/1"}}}}]}}}}}}'
        ELSE '{{"data":{{"orders":{{"edges":[]}}}}}}' END END AS o_body,
    custkey % 500 + 20 AS c_ms, custkey % 300 + 5 AS o_ms
  FROM cf),
a AS (
  SELECT *, {_BODY_MESSAGES_SQL.format(body='c_body')} AS c_msgs, {_BODY_MESSAGES_SQL.format(body='o_body')} AS o_msgs FROM r),
b AS (
  SELECT *, cs BETWEEN 200 AND 299 AND {_IS_OBJECT_SQL.format(body='c_body')} AND len(c_msgs) = 0 AS c_ok,
    CASE WHEN json_valid(c_body) THEN json_extract_string(c_body, '$.data.shop.myshopifyDomain') END AS domain,
    os BETWEEN 200 AND 299 AND {_IS_OBJECT_SQL.format(body='o_body')} AND len(o_msgs) = 0 AS o_ok,
    len(list_filter(o_msgs, lambda m: contains(lower(m), 'access denied') OR contains(lower(m), 'required access'))) > 0 AS scope_missing,
    CASE WHEN json_valid(o_body) THEN coalesce(json_array_length(o_body, '$.data.orders.edges'), 0) ELSE 0 END AS order_count
  FROM a)
SELECT * EXCLUDE (c_ms, o_ms),
  CASE WHEN status = 'SKIP' THEN NULL WHEN check_key = 'reachable' THEN c_ms WHEN check_key = 'ordersRead' THEN o_ms END AS duration_millis
FROM (
SELECT config_id, 'credential' AS check_key, 'Credential readable' AS label, 1 AS position, CASE WHEN cred_fail IS NOT NULL THEN 'FAIL' ELSE 'PASS' END AS status,
  cred_fail AS detail, c_ms, o_ms FROM b
UNION ALL
SELECT config_id, 'reachable', 'Shop reachable', 2,
  CASE WHEN cred_fail IS NOT NULL THEN 'SKIP' WHEN cs = 404 OR c_ok THEN 'PASS' ELSE 'FAIL' END,
  CASE WHEN cred_fail IS NOT NULL THEN 'Not attempted.' WHEN c_ok THEN domain WHEN cs = 404 THEN shop_url
       ELSE {_DESCRIBE_SQL.format(s='cs')} END, c_ms, o_ms FROM b
UNION ALL
SELECT config_id, 'apiVersion', 'API version supported', 3,
  CASE WHEN cred_fail IS NOT NULL THEN 'SKIP' WHEN cs = 404 THEN 'FAIL' WHEN c_ok THEN 'PASS' ELSE 'SKIP' END,
  CASE WHEN cred_fail IS NOT NULL THEN 'Not attempted.'
       WHEN cs = 404 THEN 'The shop did not serve API version ' || ver || '. Check the version and the shop URL.'
       WHEN c_ok THEN ver ELSE 'Not attempted.' END, c_ms, o_ms FROM b
UNION ALL
SELECT config_id, 'ordersRead', 'Orders readable', 4,
  CASE WHEN cred_fail IS NOT NULL OR cs = 404 OR NOT c_ok THEN 'SKIP' WHEN disabled THEN 'SKIP' WHEN o_ok THEN 'PASS' ELSE 'FAIL' END,
  CASE WHEN cred_fail IS NOT NULL OR cs = 404 OR NOT c_ok THEN 'Not attempted.'
       WHEN disabled THEN 'This configuration is not enabled for order reads.'
       WHEN o_ok THEN CASE WHEN order_count = 1 THEN '1 order returned' ELSE 'no orders in range' END
       WHEN scope_missing THEN 'The token is missing the read_orders scope.'
       ELSE {_DESCRIBE_SQL.format(s='os')} END, c_ms, o_ms FROM b)"""


# ---------------------------------------------------------------------------------------
# 6. Tenant-scoped configs (T6 F7 F8 P8 A6 J4 J5 J6) and scalar rules
# ---------------------------------------------------------------------------------------
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ACTIVE_TENANT, ACTIVE_USER = "BUILDING", "admin"


def _configs(spark, sf_dir):
    return ad.configs_shape(_t(spark, sf_dir, "customer"))


def q_config_list(spark, sf_dir):
    """T6 + F7 + F8 + P8: second page (20 rows) of a tenant's configs matching "STORE 1"."""
    rows, _ = cfg.list_configs(_configs(spark, sf_dir), ACTIVE_TENANT, "STORE 1", page_index=1, page_size=20)
    return rows


def q_config_list_totals(spark, sf_dir):
    """Total count and page count of the same listing."""
    _, pages = cfg.list_configs(_configs(spark, sf_dir), ACTIVE_TENANT, "STORE 1", page_index=1, page_size=20)
    return pages


def q_config_usable(spark, sf_dir):
    """One usability check per order (config by customer; trusted or session tenant)."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    seg = F.array(*[F.lit(x) for x in SEGMENTS])
    cid = (F.when(k % 11 == 0, F.lit("Customer#999999999")).when(k % 13 == 0, F.lit("  "))
           .otherwise(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))))
    req = o.select(k.alias("request_id"), cid.alias("config_id"),
                   F.when(k % 2 == 0, F.element_at(seg, (k % 5 + 1).cast("int"))).alias("trusted_tenant"),
                   F.when(k % 2 == 1, F.element_at(seg, (F.floor(k / 2) % 5 + 1).cast("int"))).alias("session_tenant"))
    res = cfg.check_usable(req, _configs(spark, sf_dir))
    return res.select("request_id", "config_id", "usable", F.array_join("errors", " | ").alias("errors"))


def _updates(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 == 0)
    k = F.col("c_custkey")
    ks = k.cast("string")
    # rule 0 and rule 3 with an even key come again with an http URL, which is refused and must not
    # undo the first; rule 4 comes again with the token it lacked, without a zone
    rule = F.floor(k / 3) % 5
    again = c.withColumn("_again", F.lit(True)).filter((rule == 4) | (rule.isin(0, 3) & (k % 2 == 0)))
    c = c.withColumn("_again", F.lit(False)).unionByName(again)
    again = F.col("_again")
    new_id = F.concat(F.lit("New#"), ks)
    return c.select(
        F.when(rule >= 3, new_id).otherwise(F.col("c_name")).alias("config_id"),
        F.when(rule == 0, F.concat(F.lit("Updated "), ks)).when(rule == 3, F.concat(F.lit("New "), ks)).alias("description"),
        F.when((rule == 2) | (again & (rule != 4)), F.concat(F.lit("http://shop"), ks, F.lit(".myshopify.com")))
        .when(rule == 0, F.concat(F.lit("https://shop"), ks, F.lit(".myshopify.com/")))
        .otherwise(F.concat(F.lit("https://shop"), ks, F.lit(".myshopify.com"))).alias("shop_api_url"),
        F.when(rule == 0, F.lit("2026-01")).when(rule == 3, F.lit("UNSTABLE ")).when(rule == 4, F.lit("2026-04"))
        .otherwise(F.lit("2025-10")).alias("api_version"),
        F.when(rule == 0, F.lit("")).when(rule == 1, F.lit("Central")).when(rule == 3, F.lit("America/Chicago")).alias("time_zone"),
        F.when((rule == 3) | (again & (rule == 4)), F.concat(F.lit("tok-new-"), ks)).when(rule == 0, F.lit("")).alias("access_token"),
        F.when(rule == 0, F.lit("no")).when(rule == 3, F.lit("")).alias("is_active"),
        F.when(rule == 0, F.lit("yes")).when(rule == 3, F.lit("Y")).alias("can_read_orders"),
        (k * 2 + again.cast("long")).alias("position"),
    )


def _merge(spark, sf_dir):
    return cfg.merge_configs(_configs(spark, sf_dir), _updates(spark, sf_dir), ACTIVE_TENANT, ACTIVE_USER,
                             position_col="position")


def q_config_merge(spark, sf_dir):
    """The config table after the upsert, redacted."""
    return cfg.redact(_merge(spark, sf_dir)[0])


def q_config_merge_outcomes(spark, sf_dir):
    """Per update inserted / updated / rejected with the ordered errors."""
    out = _merge(spark, sf_dir)[1]
    return out.select("config_id", "position", "action", F.array_join("errors", " | ").alias("errors"))


def q_config_delete(spark, sf_dir):
    """Delete requests of one tenant: own rows go, unknown / other tenants are refused."""
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ids = (c.filter(k % 10 == 0).select(F.col("c_name").alias("config_id"))
           .unionByName(c.filter(k % 25 == 0).select(F.concat(F.lit("Missing#"), k.cast("string")).alias("config_id")))
           .unionByName(c.filter(k % 99 == 0).select(F.lit(" ").alias("config_id"))))
    _, outcomes = cfg.delete_configs(_configs(spark, sf_dir), ids, ACTIVE_TENANT)
    return outcomes


def q_endpoints(spark, sf_dir):
    """X12 + X13 + X14 + X23: endpoint, version validity and URL policy per config."""
    from orderlens.functions.endpoints import admin_endpoint, normalize_api_version, url_error, valid_api_version
    c = _configs(spark, sf_dir)
    return c.select("config_id", admin_endpoint(F.col("shop_api_url"), F.col("api_version")).alias("endpoint"),
                    valid_api_version(normalize_api_version(F.col("api_version"))).alias("version_valid"),
                    url_error(F.col("shop_api_url")).alias("url_error"))


def q_window_bounds(spark, sf_dir):
    """X2 + X4 + X5: window bounds written in eight forms, parsed to UTC, and the calendar
    window start in America/Chicago."""
    from orderlens.functions.instants import parse_window_bound, window_bound_error
    pin_utc(spark)
    o = ad.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ts1 = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), F.lit(0), F.lit(0))
    r = k % 8
    text = (F.when(r == 0, F.unix_millis(ts1.cast("timestamp")).cast("string"))
            .when(r == 1, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(r == 2, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss'-05:00'"))
            .when(r == 3, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss'+00:00[UTC]'"))
            .when(r == 4, F.date_format(ts1, "yyyy-MM-dd HH:mm:ss"))
            .when(r == 5, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm"))
            .when(r == 6, F.date_format(ts1, "yyyy-MM-dd"))
            .when(k % 16 == 7, F.lit("not-a-date")).otherwise(F.lit("  ")))
    b = o.select(k.alias("order_key"), text.alias("t")).withColumn("at", parse_window_bound(F.col("t")))
    start, _ = source_window("at", "at", "America/Chicago", preserve=False)
    return b.select("order_key", format_instant("at").alias("bound"),
                    window_bound_error(F.col("t"), "windowStart", parsed=F.col("at")).alias("error"),
                    format_instant(start).alias("calendar_start"))


SQL_CONFIG_REDACT = """config_id, description, tenant_id, created_by, shop_api_url, api_version,
  coalesce(nullif(trim(time_zone), ''), 'UTC') AS time_zone, coalesce(nullif(trim(is_active), ''), 'Y') AS is_active,
  coalesce(lower(trim(can_read_orders)) IN ('y', 'yes', 'true', '1', 't', 'on'), false) AS can_read_orders,
  coalesce(trim(access_token) <> '', false) AS has_access_token"""

SQL_CONFIG_LIST_SEL = """
sel AS (
  SELECT * FROM cf WHERE tenant_id = 'BUILDING' AND (
    coalesce(config_id ILIKE '%STORE 1%', false) OR coalesce(description ILIKE '%STORE 1%', false)
    OR coalesce(shop_api_url ILIKE '%STORE 1%', false) OR coalesce(api_version ILIKE '%STORE 1%', false)
    OR coalesce(time_zone ILIKE '%STORE 1%', false)))"""

SQL_CONFIG_LIST = _with(SQL_CONFIGS_CTE, SQL_CONFIG_LIST_SEL) + f"""
SELECT {SQL_CONFIG_REDACT} FROM sel
ORDER BY description NULLS LAST, config_id NULLS LAST LIMIT 20 OFFSET 20"""

SQL_CONFIG_LIST_TOTALS = _with(SQL_CONFIGS_CTE, SQL_CONFIG_LIST_SEL) + """
SELECT count(*) AS total_count, 1 AS page_index, 20 AS page_size, CAST(ceil(count(*) / 20.0) AS BIGINT) AS page_count FROM sel"""

SQL_CONFIG_USABLE = _with(SQL_CONFIGS_CTE) + """,
r AS (
  SELECT o_orderkey AS request_id,
    nullif(trim(CASE WHEN o_orderkey % 11 = 0 THEN 'Customer#999999999' WHEN o_orderkey % 13 = 0 THEN '  '
                     ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END), '') AS cid,
    CASE WHEN o_orderkey % 2 = 0 THEN ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][o_orderkey % 5 + 1] END AS trusted,
    CASE WHEN o_orderkey % 2 = 1 THEN ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][(o_orderkey // 2) % 5 + 1] END AS sess
  FROM orders),
j AS (
  SELECT r.*, cf.config_id IS NOT NULL AS found, nullif(trim(cf.tenant_id), '') AS tenant, cf.is_active, cf.can_read_orders
  FROM r LEFT JOIN cf ON cf.config_id = r.cid),
e AS (
  SELECT *, CASE WHEN cid IS NULL THEN 'Shopify auth config ID is required.'
      WHEN NOT found THEN 'Shopify auth config ''' || cid || ''' was not found.'
      WHEN trusted IS NOT NULL AND tenant IS DISTINCT FROM trusted THEN 'Shopify auth config ''' || cid || ''' is not available in this automation tenant.'
      WHEN trusted IS NULL AND (sess IS NULL OR tenant IS DISTINCT FROM sess) THEN 'Shopify auth config ''' || cid || ''' is not available in your active tenant.'
    END AS first_err
  FROM j),
e2 AS (
  SELECT *,
    CASE WHEN first_err IS NULL AND upper(coalesce(nullif(trim(is_active), ''), 'Y')) = 'N' THEN 'Shopify auth config ' || cid || ' is inactive.' END AS inactive,
    CASE WHEN first_err IS NULL AND upper(coalesce(nullif(trim(can_read_orders), ''), 'N')) = 'N' THEN 'Shopify auth config ' || cid || ' is not enabled for order reads.' END AS denied
  FROM e)
SELECT request_id, cid AS config_id, first_err IS NULL AND inactive IS NULL AND denied IS NULL AS usable,
  array_to_string(list_filter([first_err, inactive, denied], lambda x: x IS NOT NULL), ' | ') AS errors
FROM e2"""

SQL_MERGE_CTE = """
up00 AS (SELECT c_custkey AS k, (c_custkey // 3) % 5 AS rule, c_name FROM customer WHERE c_custkey % 3 = 0),
up0 AS (SELECT *, 0 AS again FROM up00 UNION ALL SELECT *, 1 FROM up00 WHERE rule = 4 OR (rule IN (0, 3) AND k % 2 = 0)),
up AS (
  SELECT CASE WHEN rule >= 3 THEN 'New#' || k ELSE c_name END AS config_id, k * 2 + again AS position,
    CASE rule WHEN 0 THEN 'Updated ' || k WHEN 3 THEN 'New ' || k END AS u_description,
    CASE WHEN rule = 2 OR (again = 1 AND rule <> 4) THEN 'http://shop' || k || '.myshopify.com' ELSE 'https://shop' || k || '.myshopify.com' END AS u_url,
    CASE rule WHEN 0 THEN '2026-01' WHEN 3 THEN 'unstable' WHEN 4 THEN '2026-04' ELSE '2025-10' END AS u_version,
    CASE rule WHEN 1 THEN 'Central' WHEN 3 THEN 'America/Chicago' END AS u_zone,
    CASE WHEN rule = 3 OR (again = 1 AND rule = 4) THEN 'tok-new-' || k END AS u_token,
    CASE rule WHEN 0 THEN 'N' ELSE 'Y' END AS u_active,
    CASE rule WHEN 0 THEN 'Y' WHEN 3 THEN 'Y' ELSE 'N' END AS u_read
  FROM up0),
mj AS (
  SELECT up.*, cf.config_id IS NOT NULL AS ex, cf.tenant_id AS c_tenant, cf.created_by AS c_created,
         cf.time_zone AS c_zone, cf.access_token AS c_token
  FROM up LEFT JOIN cf ON cf.config_id = up.config_id),
m1 AS (
  SELECT *, regexp_extract(lower(u_url), '^[a-z][a-z0-9+.-]*://([^/:?#]*)', 1) AS host,
         lower(regexp_extract(u_url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS proto
  FROM mj),
m2 AS (
  SELECT *, CASE WHEN host = '' THEN 'Shop/API URL: URL is not valid.'
                 WHEN proto <> 'https' THEN 'Shop/API URL: URL must use https.'
                 WHEN NOT ends_with(host, '.myshopify.com') THEN 'Shop/API URL: URL host must end with .myshopify.com.' END AS url_err,
    CASE WHEN NOT (u_version = 'unstable' OR regexp_full_match(u_version, '[0-9]{4}-[0-9]{2}')) THEN 'API version must use YYYY-MM format or unstable.' END AS ver_err
  FROM m1),
m3 AS (
  SELECT *, (url_err IS NULL AND ver_err IS NULL) AS basic_ok FROM m2),
m4 AS (
  SELECT *, coalesce(u_zone, CASE WHEN basic_ok THEN nullif(trim(c_zone), '') END, 'UTC') AS zone,
    CASE WHEN basic_ok AND ex AND c_tenant IS NOT NULL AND c_tenant <> 'BUILDING' THEN 'Shopify auth config ''' || config_id || ''' is not available in your active tenant.' END AS ten_err
  FROM m3),
m5 AS (
  SELECT *, CASE WHEN zone NOT IN (SELECT name FROM pg_timezone_names()) THEN 'Shopify timezone ''' || zone || ''' is not valid.' END AS zone_err
  FROM m4),
m6 AS (
  SELECT *, list_filter([url_err, ver_err, ten_err, zone_err], lambda x: x IS NOT NULL) AS errs0 FROM m5),
m7 AS (
  SELECT *, list_concat(errs0, CASE WHEN len(errs0) = 0 AND NOT ex AND u_token IS NULL THEN ['Access token is required for new Shopify auth configs.'] ELSE [] END) AS errs
  FROM m6),
stored AS (
  SELECT config_id, u_description AS description, coalesce(c_tenant, 'BUILDING') AS tenant_id,
    CASE WHEN c_tenant IS NOT NULL THEN c_created ELSE 'admin' END AS created_by,
    u_url AS shop_api_url, u_version AS api_version, zone AS time_zone, coalesce(u_token, c_token) AS access_token,
    u_active AS is_active, u_read AS can_read_orders
  FROM m7 WHERE len(errs) = 0 QUALIFY row_number() OVER (PARTITION BY config_id ORDER BY position DESC) = 1)"""

SQL_CONFIG_MERGE = _with(SQL_CONFIGS_CTE, SQL_MERGE_CTE) + f""",
merged AS (
  SELECT config_id, description, tenant_id, created_by, shop_api_url, api_version, time_zone, access_token, is_active, can_read_orders
  FROM cf WHERE config_id NOT IN (SELECT config_id FROM stored)
  UNION ALL SELECT * FROM stored)
SELECT {SQL_CONFIG_REDACT} FROM merged"""

SQL_CONFIG_MERGE_OUTCOMES = _with(SQL_CONFIGS_CTE, SQL_MERGE_CTE) + """
SELECT config_id, position, CASE WHEN len(errs) > 0 THEN 'rejected' WHEN ex THEN 'updated' ELSE 'inserted' END AS action,
  array_to_string(errs, ' | ') AS errors
FROM m7"""

SQL_CONFIG_DELETE = _with(SQL_CONFIGS_CTE) + """,
ids AS (
  SELECT c_name AS requested_id FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT 'Missing#' || c_custkey FROM customer WHERE c_custkey % 25 = 0
  UNION ALL SELECT ' ' FROM customer WHERE c_custkey % 99 = 0),
j AS (
  SELECT ids.requested_id, nullif(trim(ids.requested_id), '') AS config_id, cf.config_id IS NOT NULL AS found,
         nullif(trim(cf.tenant_id), '') AS tenant
  FROM ids LEFT JOIN cf ON cf.config_id = nullif(trim(ids.requested_id), '')),
e AS (
  SELECT *, CASE WHEN config_id IS NULL THEN 'Shopify auth config ID is required.'
                 WHEN NOT found THEN 'Shopify auth config ''' || config_id || ''' was not found.'
                 WHEN tenant IS DISTINCT FROM 'BUILDING' THEN 'Shopify auth config ''' || config_id || ''' is not available in your active tenant.' END AS error
  FROM j)
SELECT requested_id, config_id, error IS NULL AS deleted, error FROM e"""

SQL_ENDPOINTS = _with(SQL_CONFIGS_CTE) + """,
b AS (
  SELECT config_id, regexp_replace(nullif(trim(shop_api_url), ''), '/+$', '') AS base, nullif(trim(api_version), '') AS ver,
         lower(nullif(trim(api_version), '')) AS lver, nullif(trim(shop_api_url), '') AS u
  FROM cf),
h AS (
  SELECT *, regexp_extract(lower(u), '^[a-z][a-z0-9+.-]*://([^/:?#]*)', 1) AS host,
         lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS proto, strpos(base, '/admin/api') AS idx
  FROM b)
SELECT config_id,
  CASE WHEN base IS NULL OR ver IS NULL THEN NULL
       WHEN ends_with(base, '/graphql.json') THEN base
       WHEN idx > 0 THEN substr(base, 1, idx + 9) || '/' || ver || '/graphql.json'
       ELSE base || '/admin/api/' || ver || '/graphql.json' END AS endpoint,
  coalesce(lver = 'unstable' OR regexp_full_match(lver, '[0-9]{4}-[0-9]{2}'), false) AS version_valid,
  CASE WHEN u IS NULL THEN 'Shop API URL is required.'
       WHEN host = '' THEN 'URL is not valid.'
       WHEN proto <> 'https' THEN 'URL must use https.'
       WHEN NOT ends_with(host, '.myshopify.com') THEN 'URL host must end with .myshopify.com.' END AS url_error
FROM h"""

SQL_WINDOW_BOUNDS = """
WITH b AS (
  SELECT o_orderkey AS order_key, o_orderkey % 8 AS r, o_orderkey % 16 AS r16,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts1, o_orderdate
  FROM orders),
p AS (
  SELECT *, CASE r WHEN 2 THEN ts1 + INTERVAL 5 HOUR WHEN 6 THEN o_orderdate WHEN 7 THEN NULL ELSE ts1 END AS parsed FROM b)
SELECT order_key, strftime(parsed, '%Y-%m-%dT%H:%M:%SZ') AS bound,
  CASE WHEN r = 7 AND r16 = 7 THEN 'windowStart must be a Timestamp, Date, ISO-8601 value, SQL timestamp text, or epoch milliseconds.'
       WHEN r = 7 THEN 'windowStart is required.' END AS error,
  strftime(CASE WHEN parsed = date_trunc('day', parsed) THEN (parsed AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' ELSE parsed END,
           '%Y-%m-%dT%H:%M:%SZ') AS calendar_start
FROM p"""


# ---------------------------------------------------------------------------------------
# 7. Point reads, sweep candidates and instant forms
# ---------------------------------------------------------------------------------------

def q_orders_by_id(spark, sf_dir):
    """The orders behind every exchange line, fetched by id (numeric or gid spelling;
    blank and unknown ids match nothing)."""
    li = _t(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    k = F.col("l_orderkey")
    raw = (F.when(F.col("l_linenumber") == 7, F.lit(" "))
           .when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(ORDER_GID_PREFIX), k.cast("string")))
           .when(F.col("l_linenumber") == 5, (k + 1000000).cast("string"))
           .otherwise(k.cast("string")))
    got = lookup.orders_by_id(_orders(spark, sf_dir), li.select(raw.alias("requested_id")))
    return got.select("id", "name", "totalPrice", "returnStatus")


SQL_ORDERS_BY_ID = _with(ORDERS_CTE) + f""",
req AS (
  SELECT nullif(trim(CASE WHEN l_linenumber = 7 THEN ' '
                          WHEN l_linenumber % 2 = 0 THEN '{ORDER_GID_PREFIX}' || l_orderkey
                          WHEN l_linenumber = 5 THEN CAST(l_orderkey + 1000000 AS VARCHAR)
                          ELSE CAST(l_orderkey AS VARCHAR) END), '') AS rid
  FROM lineitem WHERE l_returnflag = 'R'),
gid AS (SELECT DISTINCT CASE WHEN starts_with(rid, 'gid://') THEN rid ELSE '{ORDER_GID_PREFIX}' || rid END AS g
        FROM req WHERE rid IS NOT NULL)
SELECT id, name, totalPrice, returnStatus FROM os WHERE id IN (SELECT g FROM gid)"""


def q_sweep_candidates(spark, sf_dir):
    """S7 + F5: orders updated since the window start (no upper bound) with return activity."""
    c = ex.sweep_candidates(_orders(spark, sf_dir), "1998-06-01T00:00:00Z")
    return c.select("id", "updatedAt", "returnStatus")


SQL_SWEEP_CANDIDATES = _with(ORDERS_CTE) + """
SELECT id, updatedAt, returnStatus FROM os
WHERE ts_updated >= TIMESTAMP '1998-06-01' AND lower(trim(returnStatus)) IS DISTINCT FROM 'no_return'"""


def q_instant_forms(spark, sf_dir):
    """X1 + X3 + X4: instants written in seven forms; the filter parser (X1) and the strict
    instant parser (X3) on each, results as ISO text and epoch millis."""
    from orderlens.functions.instants import parse_instant_filter
    pin_utc(spark)
    o = ad.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ts1 = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 60).cast("int"), F.lit(0))
    r = k % 7
    text = (F.when(r == 0, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(r == 1, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .when(r == 2, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm'-05:00'"))
            .when(r == 3, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss'+00:00[UTC]'"))
            .when(r == 4, F.date_format(ts1, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(r == 5, F.date_format(ts1, "yyyy-MM-dd"))
            .otherwise(F.unix_millis(ts1.cast("timestamp")).cast("string")))
    b = o.select(k.alias("order_key"), text.alias("t"))
    return b.withColumn("at", parse_instant_filter(F.col("t"))).select("order_key", format_instant("at").alias("filter_instant"),
                    parse_iso_millis(F.col("t")).alias("instant_millis"))


SQL_INSTANT_FORMS = """
WITH b AS (
  SELECT o_orderkey AS order_key, o_orderkey % 7 AS r,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS ts1
  FROM orders),
p AS (
  SELECT order_key, r,
    CASE r WHEN 0 THEN ts1 WHEN 1 THEN ts1 - INTERVAL 2 HOUR WHEN 2 THEN ts1 + INTERVAL 5 HOUR
           WHEN 3 THEN ts1 WHEN 4 THEN ts1 END AS x1,
    CASE r WHEN 0 THEN ts1 WHEN 1 THEN ts1 - INTERVAL 2 HOUR WHEN 2 THEN ts1 + INTERVAL 5 HOUR END AS x3
  FROM b)
SELECT order_key, strftime(x1, '%Y-%m-%dT%H:%M:%SZ') AS filter_instant, epoch_ms(x3) AS instant_millis FROM p"""


# ---------------------------------------------------------------------------------------
# 8. Page info and user errors (T3 pageInfo, X18 X17)
# ---------------------------------------------------------------------------------------

def q_orders_page_info(spark, sf_dir):
    """pageInfo of the ``orders_page`` read: hasNextPage and the cursor of its last row."""
    spec = ReadSpec(filters={"createdAtFrom": "1996-01-01T00:00:00Z", "createdAtTo": "1997-01-01T00:00:00-05:00"},
                    page_size=500, after=encode_cursor(*PAGE_AFTER))
    return read_orders(_orders(spark, sf_dir), spec).page.info()


SQL_ORDERS_PAGE_INFO = _with(ORDERS_CTE) + f""",
sel AS (
  SELECT ts_created, id, {_sql_cursor('createdAt')} FROM os
  WHERE ts_created >= TIMESTAMP '1996-01-01' AND ts_created < TIMESTAMP '1997-01-01 05:00:00'
    AND (ts_created > TIMESTAMP '1996-03-01' OR (ts_created = TIMESTAMP '1996-03-01' AND id > '{PAGE_AFTER[1]}'))
  ORDER BY ts_created, id LIMIT 251),
n AS (SELECT cursor, row_number() OVER (ORDER BY ts_created, id) AS rn FROM sel)
SELECT count(*) > 250 AS hasNextPage, arg_max(cursor, rn) FILTER (WHERE rn <= 250) AS endCursor FROM n"""


def q_user_errors(spark, sf_dir):
    """X18 + X17: start-response user errors (captured per event) rendered as
    ``field.path: message`` (blanks dropped) and tested for a concurrent-run rejection."""
    from orderlens.functions.messages import is_concurrent_message, render_user_errors
    ev = _t(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    et = F.col("event_type")
    text = (F.when(et == "error", F.concat(
                F.lit('[{"field":["bulkOperation","query"],"message":"Bulk queries cannot use field f'), k,
                F.lit('."},{"field":[],"message":"  "},{"field":["input"," "],"message":null}]')))
            .when(et == "click", F.lit('[{"field":null,"message":"Another bulk operation is already running."}]'))
            .otherwise(F.lit("[]")))
    errs = F.from_json(text, "array<struct<field:array<string>,message:string>>")
    rendered = render_user_errors(errs)
    return ev.select("event_id", F.array_join(rendered, "; ").alias("rendered"),
                     F.exists(rendered, is_concurrent_message).alias("concurrent"))


SQL_USER_ERRORS = """
SELECT event_id,
  CASE event_type WHEN 'error' THEN 'bulkOperation.query: Bulk queries cannot use field f' || json_extract(props, '$.k') || '.; input'
                  WHEN 'click' THEN 'Another bulk operation is already running.' ELSE '' END AS rendered,
  event_type = 'click' AS concurrent
FROM events"""


# ---------------------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------------------

# ---------------------------------------------------------------------------------------
# 9. Stored layouts and jobs
# ---------------------------------------------------------------------------------------
EXTRACT_YEAR = 1997


def _own_folder(spark, name: str) -> str:
    """A folder of this query's own, which leaves with the driver."""
    path = staging_path(spark, name)
    keep_stage(spark, path)
    return path


def q_extract_job(spark, sf_dir):
    """K4 with K1-K3: one year's export written as files, extracted for a quarter of it (S1, S2, P4),
    written as a run and read back through its manifest, with what the run's metadata says."""
    from orderlens.operators.projection import prune_nested
    from orderlens.sinks.files import extract_orders, read_run
    o = _orders(spark, sf_dir)
    paths = resolve_field_paths(ORDER_SOURCE, [], bulk=True)
    export, out = _own_folder(spark, "year-export"), _own_folder(spark, "runs")
    body = F.struct(*[F.col(c) for c in sorted({p.split(".")[0] for p in paths})])
    o.filter(F.year("_ts_createdAt") == EXTRACT_YEAR).select(*prune_nested(o, paths)) \
        .select(F.to_json(body, {"ignoreNullFields": "false"})).write.text(export)
    expected = _t(spark, sf_dir, "orders").filter(F.year("o_orderdate") == EXTRACT_YEAR).count()
    done = extract_orders(spark, export, expected, True, f"{EXTRACT_YEAR}-01-01", f"{EXTRACT_YEAR}-04-01", config_id="store",
                          location=out, name="year", write=True)
    about = read_run(spark, out, done.file_name, "metadata").select(
        F.col("extractedRecordCount").alias("records"), F.col("bulkJsonlLineCount").alias("lines"), F.array_join("searchQueries", ",").alias("search"))
    told = done.status.select(F.array_join("warnings", ",").alias("warnings"))
    rows = read_run(spark, out, done.file_name, schema=done.records.schema).select("id", "legacyResourceId", "shopifyGid", "name", "createdAt", "totalPrice")
    # metadata and status are one row each
    one = F.lit(1).alias("_one")
    return rows.withColumn("_one", F.lit(1)).join(F.broadcast(about.select("*", one)), "_one").join(F.broadcast(told.select("*", one)), "_one").drop("_one")


SQL_EXTRACT_JOB = _with(ORDERS_CTE) + f""",
y AS (SELECT *, CAST(order_key AS VARCHAR) AS legacy FROM os WHERE year(ts_created) = {EXTRACT_YEAR}),
n AS (SELECT count(*) AS c, count(*) FILTER (WHERE NOT ts_created < TIMESTAMP '{EXTRACT_YEAR}-04-01') AS outside FROM y)
SELECT legacy AS id, legacy AS legacyResourceId, y.id AS shopifyGid, name, createdAt, totalPrice, n.c AS records, n.c AS lines,
  'created_at:>=''{EXTRACT_YEAR}-01-01T00:00:00Z'' created_at:<''{EXTRACT_YEAR}-04-01T00:00:00Z''' AS search,
  CASE WHEN n.outside > 0 THEN n.outside || ' record(s) lie outside the requested window.' ELSE '' END AS warnings
FROM y, n"""

DEEP_AFTER = ("2000-06-01T00:00:00Z", ORDER_GID_PREFIX + "5000")


def q_page_clustered(spark, sf_dir):
    """T3 on the clustered layout: a deep page read from the files that can hold it."""
    from orderlens.sinks.clustered import read_clustered_page, write_clustered
    path = _own_folder(spark, "clustered")
    write_clustered(_orders(spark, sf_dir), path, "CREATED_AT", file_rows=20_000)
    spec = ReadSpec(fields=["createdAt", "name", "totalPrice"], filters={"createdAtFrom": "1990-01-01T00:00:00Z"}, page_size=250,
                    after=encode_cursor(*DEEP_AFTER))
    return read_clustered_page(spark, path, spec).df


SQL_PAGE_CLUSTERED = _with(ORDERS_CTE) + f"""
SELECT createdAt, id, legacyResourceId, name, totalPrice, {_sql_cursor('createdAt')}
FROM os WHERE ts_created > TIMESTAMP '2000-06-01' OR (ts_created = TIMESTAMP '2000-06-01' AND id > '{DEEP_AFTER[1]}')
ORDER BY ts_created, id LIMIT 250"""


def q_exchange_sweep_capped(spark, sf_dir):
    """W2 with T4: at most 40 pages of 100 candidates in update order, and whether more remained."""
    rows, truncated = ex.sweep_exchanges(_orders(spark, sf_dir), _returns(spark, sf_dir), ad.LINE_ORDER, SWEEP_START_MS, SWEEP_END_MS,
                                         max_pages=40, page_size=100, fields=ad.return_fields(), keys=ORDER_KEYS)
    # ``truncated`` is one row
    return rows.withColumn("_one", F.lit(1)).join(F.broadcast(truncated.withColumn("_one", F.lit(1))), "_one").drop("_one")


SQL_EXCHANGE_SWEEP_CAPPED = _with(ORDERS_CTE, RETURNS_CTE) + """,
cand AS (SELECT * FROM os WHERE ts_updated >= TIMESTAMP '1997-01-01' AND lower(returnStatus) <> 'no_return'),
few AS (SELECT * FROM cand ORDER BY ts_updated, id LIMIT 4000),
cnt AS (SELECT l_orderkey, count(*) FILTER (WHERE live) AS exchangeReturnCount FROM rx GROUP BY l_orderkey),
hit AS (
  SELECT l_orderkey, arg_min(return_id, pos) AS returnId, arg_min(return_name, pos) AS returnName,
         arg_min(return_status, pos) AS returnStatus, arg_min(epoch_ms(l_shipdate), pos) AS returnCreatedAtMillis
  FROM rx WHERE live AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-02-01'
  GROUP BY l_orderkey)
SELECT few.legacyResourceId AS externalId, few.name AS orderName, hit.returnId, hit.returnName, hit.returnStatus,
       hit.returnCreatedAtMillis, cnt.exchangeReturnCount, (SELECT count(*) > 4000 FROM cand) AS truncated
FROM few JOIN hit ON hit.l_orderkey = few.order_key JOIN cnt ON cnt.l_orderkey = few.order_key
WHERE few.legacyResourceId IS NOT NULL AND few.legacyResourceId <> ''"""


def q_exchange_sweep_kept(spark, sf_dir):
    """W2 kept up to date: a first run without the orders updated from June 1997 on and some older ones,
    then a run after they have arrived. The rows are those of the whole sweep."""
    from orderlens.sinks.sweep_state import update_sweep
    orders, state = _own_folder(spark, "orders-by-month"), _own_folder(spark, "sweep-state")
    o = _orders(spark, sf_dir).select("order_key", "id", "legacyResourceId", "name", "returnStatus", "updatedAt", "_ts_updatedAt")
    o = o.withColumn("month", F.substring("updatedAt", 1, 7))
    late = (F.col("month") >= "1997-06") | ((F.col("month") == "1997-03") & (F.col("order_key") % 7 == 0))
    for part in (~late, late):
        o.filter(part).repartition("month").write.mode("append").partitionBy("month").parquet(orders)
        rows, _ = update_sweep(spark, orders, "month", _returns(spark, sf_dir), ad.LINE_ORDER, SWEEP_START_MS, SWEEP_END_MS, state,
                               "january", fields=ad.return_fields(), keys=ORDER_KEYS)
    return rows


def q_id_differences(spark, sf_dir):
    """E1 by digests: two copies of the order ids of which a few differ; only their buckets are joined."""
    k = F.col("o_orderkey")
    o = _t(spark, sf_dir, "orders")
    left = o.select(F.when(k % 997 == 0, k + 10_000_000).otherwise(k).cast("string").alias("left_id"))
    right = o.filter(k % 1009 != 0).select(F.concat(F.lit(ORDER_GID_PREFIX), k.cast("string")).alias("right_id"))
    return lookup.id_differences(left, right)


SQL_ID_DIFFERENCES = f"""
WITH l AS (SELECT DISTINCT '{ORDER_GID_PREFIX}' || CASE WHEN o_orderkey % 997 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END AS cid FROM orders),
r AS (SELECT DISTINCT '{ORDER_GID_PREFIX}' || o_orderkey AS cid FROM orders WHERE o_orderkey % 1009 <> 0)
SELECT coalesce(l.cid, r.cid) AS canonical_id, CASE WHEN r.cid IS NULL THEN 'missing_right' ELSE 'missing_left' END AS state
FROM l FULL OUTER JOIN r ON l.cid = r.cid WHERE l.cid IS NULL OR r.cid IS NULL"""

STATE_PART = 2


def q_exchange_state_parts(spark, sf_dir):
    """J2 for orders of any size: each order's exchanges in parts of two returns."""
    st = ex.exchange_state_parts(_state_requests(spark, sf_dir), _orders(spark, sf_dir), _returns(spark, sf_dir), ad.LINE_ORDER, STATE_PART,
                                 position_col="position", fields=ad.return_fields(), keys=ORDER_KEYS, numbered=True)
    return st.select("order_key", "returnStatus", "part", F.posexplode_outer("exchanges").alias("pos", "x")).select(
        "order_key", "returnStatus", "part", "pos", F.col("x.returnId").alias("returnId"), F.col("x.status").alias("exchangeReturnStatus"))


SQL_EXCHANGE_STATE_PARTS = _with(ORDERS_CTE, RETURNS_CTE) + f""",
want AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY pos) - 1 AS n FROM rx WHERE has_exchange)
SELECT CAST(os.order_key AS VARCHAR) AS order_key, os.returnStatus, coalesce(x.n // {STATE_PART}, 0) AS part,
  CAST(x.n % {STATE_PART} AS INTEGER) AS pos, x.return_id AS returnId, x.return_status AS exchangeReturnStatus
FROM os JOIN want ON want.l_orderkey = os.order_key LEFT JOIN x ON x.l_orderkey = os.order_key"""


def q_config_saved(spark, sf_dir):
    """J5 on the stored table: the updates saved into a table kept by tenant, read back redacted."""
    from orderlens.sinks.config_table import read_configs, save_configs, write_configs
    path = _own_folder(spark, "config-table")
    write_configs(_configs(spark, sf_dir), path)
    save_configs(spark, path, _updates(spark, sf_dir), ACTIVE_TENANT, ACTIVE_USER, "position")
    return cfg.redact(read_configs(spark, path))


_QUERIES: dict[str, tuple[Callable, str | None]] = {
    "orders_window": (q_orders_window, SQL_ORDERS_WINDOW),
    "orders_page": (q_orders_page, SQL_ORDERS_PAGE),
    "orders_status": (q_orders_status, SQL_ORDERS_STATUS),
    "orders_children": (q_orders_children, SQL_ORDERS_CHILDREN),
    "orders_sorted_desc": (q_orders_sorted_desc, SQL_ORDERS_SORTED_DESC),
    "jsonl_records": (q_jsonl_records, SQL_JSONL_RECORDS),
    "jsonl_bad_lines": (q_jsonl_bad_lines, SQL_JSONL_BAD),
    "load_gate": (q_load_gate, SQL_LOAD_GATE),
    "extract_summary": (q_extract_summary, SQL_EXTRACT_SUMMARY),
    "ids_found": (q_ids_found, SQL_IDS_FOUND),
    "ids_missing": (q_ids_missing, SQL_IDS_MISSING),
    "id_batches": (q_id_batches, SQL_ID_BATCHES),
    "id_reconcile": (q_id_reconcile, SQL_ID_RECONCILE),
    "exchange_sweep": (q_exchange_sweep, SQL_EXCHANGE_SWEEP),
    "exchange_counts": (q_exchange_counts, SQL_EXCHANGE_COUNTS),
    "exchange_state": (q_exchange_state, SQL_EXCHANGE_STATE),
    "child_shapes": (q_child_shapes, SQL_CHILD_SHAPES),
    "exchange_presence": (q_exchange_presence, SQL_EXCHANGE_PRESENCE),
    "response_classes": (q_response_classes, SQL_RESPONSE_CLASSES),
    "throttle_delay": (q_throttle_delay, SQL_THROTTLE_DELAY),
    "retry_plan": (q_retry_plan, SQL_RETRY_PLAN),
    "download_outcomes": (q_download_outcomes, SQL_DOWNLOAD_OUTCOMES),
    "operation_rollup": (q_operation_rollup, SQL_OPERATION_ROLLUP),
    "start_retries": (q_start_retries, SQL_START_RETRIES),
    "connection_checks": (q_connection_checks, SQL_CONNECTION_CHECKS),
    "config_list": (q_config_list, SQL_CONFIG_LIST),
    "config_list_totals": (q_config_list_totals, SQL_CONFIG_LIST_TOTALS),
    "config_usable": (q_config_usable, SQL_CONFIG_USABLE),
    "config_merge": (q_config_merge, SQL_CONFIG_MERGE),
    "config_merge_outcomes": (q_config_merge_outcomes, SQL_CONFIG_MERGE_OUTCOMES),
    "config_delete": (q_config_delete, SQL_CONFIG_DELETE),
    "endpoints": (q_endpoints, SQL_ENDPOINTS),
    "window_bounds": (q_window_bounds, SQL_WINDOW_BOUNDS),
    "orders_by_id": (q_orders_by_id, SQL_ORDERS_BY_ID),
    "sweep_candidates": (q_sweep_candidates, SQL_SWEEP_CANDIDATES),
    "instant_forms": (q_instant_forms, SQL_INSTANT_FORMS),
    "orders_page_info": (q_orders_page_info, SQL_ORDERS_PAGE_INFO),
    "user_errors": (q_user_errors, SQL_USER_ERRORS),
    "extract_job": (q_extract_job, SQL_EXTRACT_JOB),
    "page_clustered": (q_page_clustered, SQL_PAGE_CLUSTERED),
    "exchange_sweep_capped": (q_exchange_sweep_capped, SQL_EXCHANGE_SWEEP_CAPPED),
    "exchange_sweep_kept": (q_exchange_sweep_kept, SQL_EXCHANGE_SWEEP),
    "id_differences": (q_id_differences, SQL_ID_DIFFERENCES),
    "exchange_state_parts": (q_exchange_state_parts, SQL_EXCHANGE_STATE_PARTS),
    "config_saved": (q_config_saved, SQL_CONFIG_MERGE),
}


def _add_corpus_queries() -> None:
    """The corpus operators live in a subpackage of their own. It may be absent, or a library that it
    needs may be; the order queries do not depend on either."""
    try:
        corpus = importlib.import_module("orderlens.llm.queries")
    except ImportError as e:
        if not (isinstance(e, ModuleNotFoundError) and (e.name or "").startswith("orderlens.llm")):
            warnings.warn(f"The corpus queries are left out: {e}", RuntimeWarning, stacklevel=2)
        return
    _QUERIES.update({name: (run, corpus.ORACLES.get(name)) for name, run in corpus.QUERIES.items()})


_add_corpus_queries()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the bulk month extraction with normalised ids, on sf0.001."""
    return q_orders_window(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _QUERIES.items() if v[1] is not None}
