"""Tenant-scoped connection configs: list/search (T6 F7 F8 A6), redaction (P8), usability
checks (J4), upsert (J5) and delete (J6) as DataFrame jobs.

Config frame columns: config_id, description, tenant_id, created_by, shop_api_url,
api_version, time_zone, access_token, is_active, can_read_orders.
"""

from __future__ import annotations

import zoneinfo
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.endpoints import normalize_api_version, normalize_url, url_error, valid_api_version
from ..functions.text import as_bool, indicator, normalize, normalize_py

# Defaults and list limits.
DEFAULT_TIME_ZONE = "UTC"
DEFAULT_ACTIVE = "Y"
LIST_DEFAULT_SIZE = 20
LIST_MAX_SIZE = 200
SEARCH_COLUMNS = ("config_id", "description", "shop_api_url", "api_version", "time_zone")
CONFIG_COLUMNS = ("config_id", "description", "tenant_id", "created_by", "shop_api_url", "api_version",
                  "time_zone", "access_token", "is_active", "can_read_orders")


def redact(df: DataFrame) -> DataFrame:
    """The token never leaves; ``has_access_token`` tells whether one is stored; time zone,
    active flag and read permission get their defaults."""
    return df.select(
        "config_id", "description", "tenant_id", "created_by", "shop_api_url", "api_version",
        F.coalesce(normalize("time_zone"), F.lit(DEFAULT_TIME_ZONE)).alias("time_zone"),
        F.coalesce(normalize("is_active"), F.lit(DEFAULT_ACTIVE)).alias("is_active"),
        as_bool(F.col("can_read_orders"), False).alias("can_read_orders"),
        normalize("access_token").isNotNull().alias("has_access_token"),
    )


def tenant_rows(df: DataFrame, tenant: str | None) -> DataFrame:
    """rows of the active tenant; no active tenant -> nothing."""
    t = normalize_py(tenant)
    if t is None:
        return df.limit(0)
    return df.filter(F.col("tenant_id") == F.lit(t))


def search(df: DataFrame, query: str | None) -> DataFrame:
    """F8: case-insensitive ``%q%`` over five columns, OR-ed (``%`` / ``_`` act as wildcards)."""
    q = normalize_py(query)
    if q is None:
        return df
    pattern = f"%{q}%"
    return df.filter(reduce(or_, [F.coalesce(F.col(c).ilike(pattern), F.lit(False)) for c in SEARCH_COLUMNS]))


def _int(value, default: int) -> int:
    try:
        return int(str(value).strip())
    except (TypeError, ValueError):
        return default


def list_configs(df: DataFrame, tenant: str | None, query: str | None = None, page_index=0, page_size=None):
    """One page of redacted rows plus a one-row pagination frame.

    Ordered by description then id; ``orderBy.offset.limit`` is a single bounded top-k."""
    page = max(0, _int(page_index, 0))
    size = max(1, min(LIST_MAX_SIZE, _int(page_size, LIST_DEFAULT_SIZE)))
    scoped = search(tenant_rows(df, tenant), query)
    rows = (redact(scoped).orderBy(F.col("description").asc_nulls_last(), F.col("config_id").asc_nulls_last())
            .offset(page * size).limit(size))
    total = scoped.agg(F.count(F.lit(1)).alias("total_count"))
    pagination = total.select(
        "total_count", F.lit(page).alias("page_index"), F.lit(size).alias("page_size"),
        F.ceil(F.col("total_count") / F.lit(size)).cast("long").alias("page_count"),
    )
    return rows, pagination


# --- J4 ---------------------------------------------------------------------------------

def _text(template: str, **cols) -> Column:
    out = F.lit(template)
    for k, c in cols.items():
        out = F.replace(out, F.lit("{" + k + "}"), c)
    return out


# Usability messages.
ID_REQUIRED = "Shopify auth config ID is required."
NOT_FOUND = "Shopify auth config '{id}' was not found."
OTHER_AUTOMATION_TENANT = "Shopify auth config '{id}' is not available in this automation tenant."
OTHER_ACTIVE_TENANT = "Shopify auth config '{id}' is not available in your active tenant."
INACTIVE = "Shopify auth config {id} is inactive."
NOT_PERMITTED = "Shopify auth config {id} is not enabled for {what}."
# Fixed value: what the default permission flag stands for.
ORDER_READS = "order reads"


def left_join_by_id(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join on a key that may be null: each such row gets a key of its own, which no table has (ids
    are trimmed and cannot start with a zero character), or they would all meet in one partition."""
    own = F.coalesce(F.col(key), F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string")))
    return rows.withColumn("__own", own).join(table.withColumnRenamed(key, "__own"), "__own", "left").drop("__own")


def check_usable(requests: DataFrame, configs: DataFrame, key: str = "request_id",
                 permission_col: str | None = "can_read_orders") -> DataFrame:
    """Per request (``config_id``, ``trusted_tenant`` or ``session_tenant``) the ordered
    error list: id blank; not found; other tenant (two wordings); then -- only when those
    passed -- inactive (null counts as Y) and not permitted (null counts as N).

    ``permission_col`` is the flag that must not be N; None asks for no permission."""
    r = requests.select(key, normalize("config_id").alias("_cid"), normalize("trusted_tenant").alias("_trusted"),
                        normalize("session_tenant").alias("_session"))
    c = configs.select(F.col("config_id").alias("_cid"), F.lit(True).alias("_found"),
                       normalize("tenant_id").alias("_tenant"), F.col("is_active").alias("_active"),
                       (F.col(permission_col) if permission_col else F.lit("Y")).cast("string").alias("_read"))
    j = left_join_by_id(r, c, "_cid")
    cid = F.coalesce(F.col("_cid"), F.lit(""))
    found = F.coalesce(F.col("_found"), F.lit(False))
    tenant_ok = F.when(F.col("_trusted").isNotNull(), F.col("_tenant").eqNullSafe(F.col("_trusted"))).otherwise(
        F.col("_session").isNotNull() & F.col("_tenant").eqNullSafe(F.col("_session")))
    first = (F.when(F.col("_cid").isNull(), F.lit(ID_REQUIRED))
             .when(~found, _text(NOT_FOUND, id=cid))
             .when(~tenant_ok, F.when(F.col("_trusted").isNotNull(), _text(OTHER_AUTOMATION_TENANT, id=cid))
                   .otherwise(_text(OTHER_ACTIVE_TENANT, id=cid))))
    inactive = F.when(first.isNull() & (F.upper(F.coalesce(normalize("_active"), F.lit("Y"))) == "N"), _text(INACTIVE, id=cid))
    denied = F.when(first.isNull() & (F.upper(F.coalesce(normalize("_read"), F.lit("N"))) == "N"),
                    _text(NOT_PERMITTED, id=cid, what=F.lit(ORDER_READS if permission_col == "can_read_orders" else permission_col or "")))
    errors = F.array_compact(F.array(first, inactive, denied))
    return j.select(key, F.col("_cid").alias("config_id"), (F.size(errors) == 0).alias("usable"), errors.alias("errors"))


# --- J5 / J6 ------------------------------------------------------------------------------

def zone_table(spark: SparkSession) -> DataFrame:
    """Valid time-zone ids (a fixed, bounded list of a few hundred names)."""
    zones = sorted(set(zoneinfo.available_timezones()) | {"UTC"})
    return spark.createDataFrame([(z,) for z in zones], "zone string")


# Save messages.
URL_REQUIRED = "Shop/API URL is required."
VERSION_REQUIRED = "API version is required."
VERSION_INVALID = "API version must use YYYY-MM format or unstable."
TOKEN_REQUIRED = "Access token is required for new Shopify auth configs."
ZONE_INVALID = "Shopify timezone '{tz}' is not valid."


def merge_configs(current: DataFrame, updates: DataFrame, active_tenant: str, active_user: str,
                  position_col: str):
    """Upsert, as if the updates were saved one at a time in ``position_col`` order (which must
    tell the updates of a key apart). Returns ``(merged, outcomes)``: the new table and, for every
    update, its position, ``action`` (inserted / updated / rejected) and the error list.

    A rejected update changes nothing; the last valid one of a key decides. Blank token and blank
    time zone keep what is stored by then (no zone: UTC); owner and creator are kept (new rows get
    the active tenant and user); description, URL, version and flags are overwritten (flags default
    Y / N); another tenant's row is refused."""
    j = evaluate_updates(current, updates, active_tenant, active_user, position_col)
    stored = stored_rows(j)
    untouched = current.join(stored.select("config_id"), "config_id", "left_anti").select(*CONFIG_COLUMNS)
    return untouched.unionByName(stored.select(*CONFIG_COLUMNS)), update_outcomes(j)


def update_outcomes(evaluated: DataFrame) -> DataFrame:
    return evaluated.select("config_id", F.col("_pos").alias("position"), F.col("_action").alias("action"), F.col("_errors").alias("errors"))


def stored_rows(evaluated: DataFrame) -> DataFrame:
    """The row that each saved key has in the end."""
    return evaluated.filter("_action != 'rejected'").groupBy("config_id").agg(F.max_by("_row", "_pos").alias("r")).select("config_id", "r.*")


def evaluate_updates(current: DataFrame, updates: DataFrame, active_tenant: str, active_user: str, position_col: str) -> DataFrame:
    """J5 for each update: its ``_pos``, ``_action``, ``_errors``, the ``_row`` that it leaves in the table
    (meant only if it is saved), and ``_owner``, the tenant of the row that was there."""
    spark = current.sparkSession
    u = updates.select(
        normalize("config_id").alias("config_id"), normalize("description").alias("u_description"),
        normalize_url(F.col("shop_api_url")).alias("u_url"), normalize_api_version(F.col("api_version")).alias("u_version"),
        normalize("time_zone").alias("u_zone"), normalize("access_token").alias("u_token"),
        indicator(F.col("is_active"), True).alias("u_active"), indicator(F.col("can_read_orders"), False).alias("u_read"),
        F.col(position_col).alias("_pos"),
    )
    cur = current.select(*[F.col(c).alias("c_" + c if c != "config_id" else c) for c in CONFIG_COLUMNS],
                         F.lit(True).alias("_found"))
    j = left_join_by_id(u, cur, "config_id").withColumn("_exists", F.coalesce(F.col("_found"), F.lit(False)))
    j = j.withColumn("c_zone", normalize("c_time_zone"))
    zones = F.broadcast(zone_table(spark))
    for name in ("u_zone", "c_zone"):
        j = j.join(zones.select(F.col("zone").alias(name), F.lit(True).alias(f"{name}_known")), name, "left")
    uerr = url_error(F.col("u_url"))
    basic = F.array(
        F.when(F.col("config_id").isNull(), F.lit(ID_REQUIRED)),
        F.when(F.col("u_url").isNull(), F.lit(URL_REQUIRED)),
        F.when(F.col("u_url").isNotNull() & uerr.isNotNull(), F.concat(F.lit("Shop/API URL: "), uerr)),
        F.when(F.col("u_version").isNull(), F.lit(VERSION_REQUIRED)),
        F.when(F.col("u_version").isNotNull() & ~valid_api_version(F.col("u_version")), F.lit(VERSION_INVALID)),
    )
    j = j.withColumn("_basic", F.array_compact(basic))
    # the stored row is only looked at once the request itself is valid
    basic_ok = F.size("_basic") == 0
    other_tenant = F.col("_exists") & F.col("c_tenant_id").isNotNull() & (F.col("c_tenant_id") != F.lit(active_tenant))
    own_zone = F.col("u_zone").isNotNull()
    sound = basic_ok & ~other_tenant
    j = j.withColumns({
        "_other": basic_ok & other_tenant,
        # such an update is saved whatever came before it, but for a new row's token
        "_sets_zone": sound & own_zone & F.col("u_zone_known").isNotNull(),
        "_brings_token": sound & F.col("u_token").isNotNull() & (~own_zone | F.col("u_zone_known").isNotNull()),
    })
    # what the updates of a key up to this one, and before it, have left in the table; updates without
    # a key are spread by position, since each is refused on its own
    order = Window.partitionBy("config_id", F.when(F.col("config_id").isNull(), F.col("_pos"))).orderBy("_pos")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("_has_token", F.col("_exists") | F.max("_brings_token").over(so_far))
    j = j.withColumn("_left_zone", F.last(F.when(F.col("_sets_zone") & F.col("_has_token"), F.col("u_zone")), True).over(before))
    zone_used = F.coalesce("u_zone", "_left_zone", F.when(basic_ok, F.col("c_zone")), F.lit(DEFAULT_TIME_ZONE))
    zone_ok = (F.when(own_zone, F.col("u_zone_known").isNotNull()).when(F.col("_left_zone").isNotNull(), F.lit(True))
               .when(basic_ok & F.col("c_zone").isNotNull(), F.col("c_zone_known").isNotNull()).otherwise(F.lit(True)))
    j = j.withColumns({"_zone": zone_used, "_zone_ok": zone_ok})
    before_token = F.concat(F.col("_basic"), F.array_compact(F.array(
        F.when(F.col("_other"), _text(OTHER_ACTIVE_TENANT, id=F.col("config_id"))),
        F.when(~F.col("_zone_ok"), _text(ZONE_INVALID, tz=F.col("_zone"))))))
    j = j.withColumn("_first_errors", before_token)
    errors = F.concat(F.col("_first_errors"), F.array_compact(F.array(
        F.when((F.size("_first_errors") == 0) & ~F.col("_has_token"), F.lit(TOKEN_REQUIRED)))))
    j = j.withColumn("_errors", errors).withColumn("_ok", F.size("_errors") == 0)
    j = j.withColumns({
        "_saved_before": F.coalesce(F.max("_ok").over(before), F.lit(False)),
        "_token": F.last(F.when(F.col("_ok"), F.col("u_token")), True).over(so_far),
    })
    action = (F.when(~F.col("_ok"), F.lit("rejected")).when(F.col("_exists") | F.col("_saved_before"), F.lit("updated"))
              .otherwise(F.lit("inserted")))
    row = F.struct(
        F.col("u_description").alias("description"),
        F.coalesce(F.col("c_tenant_id"), F.lit(active_tenant)).alias("tenant_id"),
        F.when(F.col("c_tenant_id").isNotNull(), F.col("c_created_by")).otherwise(F.lit(active_user)).alias("created_by"),
        F.col("u_url").alias("shop_api_url"),
        F.col("u_version").alias("api_version"),
        F.col("_zone").alias("time_zone"),
        F.coalesce(F.col("_token"), F.col("c_access_token")).alias("access_token"),
        F.col("u_active").alias("is_active"),
        F.col("u_read").alias("can_read_orders"),
    )
    return j.select("config_id", "_pos", action.alias("_action"), "_errors", row.alias("_row"), F.col("c_tenant_id").alias("_owner"), "_exists")


def delete_configs(current: DataFrame, ids: DataFrame, tenant: str | None, id_col: str = "config_id"):
    """Remove own-tenant rows; refuse unknown ids and other tenants' rows.
    Returns ``(remaining, outcomes)``."""
    req = ids.select(F.col(id_col).alias("requested_id"), normalize(F.col(id_col)).alias("config_id"))
    cur = current.select("config_id", normalize("tenant_id").alias("_tenant"), F.lit(True).alias("_found"))
    j = left_join_by_id(req, cur, "config_id")
    cid = F.coalesce(F.col("config_id"), F.lit(""))
    error = (F.when(F.col("config_id").isNull(), F.lit(ID_REQUIRED))
             .when(F.col("_found").isNull(), _text(NOT_FOUND, id=cid))
             .when(~F.col("_tenant").eqNullSafe(F.lit(normalize_py(tenant))), _text(OTHER_ACTIVE_TENANT, id=cid)))
    outcomes = j.select("requested_id", "config_id", error.isNull().alias("deleted"), error.alias("error"))
    gone = outcomes.filter("deleted").select("config_id").distinct()
    remaining = current.join(gone, "config_id", "left_anti")
    return remaining, outcomes
