"""Message and status predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, normalize

# Phrases that mark a start rejected because another bulk run is active.
CONCURRENT_PHRASES = ("already in progress", "already running", "operation is running", "another bulk operation")
# Terminal failure statuses of a bulk operation.
FAILED_STATUSES = ("FAILED", "CANCELED", "CANCELLED", "EXPIRED")
# Error codes that mean "throttled".
THROTTLE_CODES = ("THROTTLED", "MAX_COST_EXCEEDED")
# Failure sentences by HTTP status ({s} is the status).
FAIL_REJECTED = "The access token was rejected (HTTP {s})."
FAIL_RATE_LIMITED = "Shopify rate-limited the request (HTTP 429)."
FAIL_SERVER = "Shopify returned a server error (HTTP {s})."
FAIL_OTHER = "The request failed with HTTP {s}."
FAIL_UNREACHABLE = "The shop could not be reached."
# Phrases that mark a missing scope.
SCOPE_PHRASES = ("access denied", "required access")


def is_canceled(c) -> Column:
    """X11: trimmed, case-insensitive ``CANCELED`` (``CANCELLED`` does not count)."""
    return F.coalesce(F.upper(normalize(c)) == "CANCELED", F.lit(False))


def is_concurrent_message(c) -> Column:
    """Lower-case text mentions a bulk operation and one of the four phrases."""
    m = F.lower(normalize(c))
    any_phrase = F.lit(False)
    for p in CONCURRENT_PHRASES:
        any_phrase = any_phrase | m.contains(p)
    return F.coalesce(m.contains("bulk operation") & any_phrase, F.lit(False))


def render_user_error(field_parts, message) -> Column:
    """X18 for one error: ``field.path: message``, or whichever exists; blank -> null."""
    parts = F.filter(col_of(field_parts), lambda x: normalize(x).isNotNull())
    field = F.nullif(F.array_join(F.transform(parts, lambda x: normalize(x)), "."), F.lit(""))
    msg = normalize(message)
    return F.when(field.isNotNull() & msg.isNotNull(), F.concat(field, F.lit(": "), msg)).otherwise(
        F.coalesce(msg, field)
    )


def render_user_errors(errors) -> Column:
    """array<struct<field:array<string>,message:string>> -> array<string>, blanks dropped."""
    rendered = F.transform(col_of(errors), lambda e: render_user_error(e["field"], e["message"]))
    return F.filter(rendered, lambda x: x.isNotNull())


def missing_scope(messages) -> Column:
    """Any message contains "access denied" or "required access"."""
    def hit(m: Column) -> Column:
        low = F.lower(normalize(m))
        out = F.lit(False)
        for p in SCOPE_PHRASES:
            out = out | low.contains(p)
        return out
    return F.coalesce(F.exists(col_of(messages), hit), F.lit(False))


def describe_failure(status_code) -> Column:
    """Fixed sentence per HTTP status."""
    s = F.coalesce(col_of(status_code).cast("int"), F.lit(0))

    def fill(t: str) -> Column:
        return F.replace(F.lit(t), F.lit("{s}"), s.cast("string"))
    return (
        F.when((s == 401) | (s == 403), fill(FAIL_REJECTED))
        .when(s == 429, F.lit(FAIL_RATE_LIMITED))
        .when(s >= 500, fill(FAIL_SERVER))
        .when(s > 0, fill(FAIL_OTHER))
        .otherwise(F.lit(FAIL_UNREACHABLE))
    )
