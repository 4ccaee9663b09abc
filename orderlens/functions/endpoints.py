"""Shop URL and API-version rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, normalize

# Allowed host suffix and the admin API path pieces.
ALLOWED_HOST_SUFFIX = ".myshopify.com"
ADMIN_API_PATH = "/admin/api"
GRAPHQL_FILE = "/graphql.json"


def normalize_url(c) -> Column:
    """Trailing slashes removed; blank -> null."""
    return F.regexp_replace(normalize(c), r"/+$", "")


def normalize_api_version(c) -> Column:
    """Trim + lower case."""
    return F.lower(normalize(c))


def normalize_source_id(c) -> Column:
    """Trim + upper case."""
    return F.upper(normalize(c))


def valid_api_version(c) -> Column:
    """``unstable`` or ``dddd-dd``."""
    v = col_of(c)
    return F.coalesce((v == "unstable") | v.rlike(r"^\d{4}-\d{2}$"), F.lit(False))


def admin_endpoint(url, version) -> Column:
    """Endpoint for a shop URL and version; null when either is blank."""
    base = normalize_url(url)
    ver = normalize(version)
    idx = F.instr(base, ADMIN_API_PATH)
    cut = F.when(idx > 0, F.substring(base, F.lit(1), idx + F.lit(len(ADMIN_API_PATH)) - 1))
    endpoint = (
        F.when(base.endswith(GRAPHQL_FILE), base)
        .when(idx > 0, F.concat(cut, F.lit("/"), ver, F.lit(GRAPHQL_FILE)))
        .otherwise(F.concat(base, F.lit(ADMIN_API_PATH + "/"), ver, F.lit(GRAPHQL_FILE)))
    )
    return F.when(base.isNotNull() & ver.isNotNull(), endpoint)


def url_error(c) -> Column:
    """Null when the URL may be used, else the reason (https + allowed host suffix)."""
    u = normalize(c)
    proto = F.lower(F.try_parse_url(u, F.lit("PROTOCOL")))
    host = F.lower(F.try_parse_url(u, F.lit("HOST")))
    return (
        F.when(u.isNull(), F.lit("Shop API URL is required."))
        .when(host.isNull() | (host == ""), F.lit("URL is not valid."))
        .when(F.coalesce(proto, F.lit("")) != "https", F.lit("URL must use https."))
        .when(~host.endswith(ALLOWED_HOST_SUFFIX), F.lit(f"URL host must end with {ALLOWED_HOST_SUFFIX}."))
    )
