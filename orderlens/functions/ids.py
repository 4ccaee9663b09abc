"""Order id forms (X6-X9): the global id (``gid://...``) and the numeric legacy id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, normalize, trimmed

# Global-id prefixes used by the remote service.
GID_SCHEME = "gid://"
ORDER_GID_PREFIX = "gid://shopify/Order/"


# Each helper references its input once: join keys and filters built from them are copied
# by the optimizer into inferred predicates, so a compact tree keeps those cheap.

def to_order_gid_lookup(c) -> Column:
    """Ids already starting with ``gid://`` stay; others get the order prefix."""
    return F.regexp_replace(normalize(c), r"^(?!gid://)", ORDER_GID_PREFIX)


def to_order_gid_state(c) -> Column:
    """As X6 but only the full order prefix counts as a gid; blank -> null."""
    return F.regexp_replace(normalize(c), r"^(?!gid://shopify/Order/)", ORDER_GID_PREFIX)


def legacy_from_gid(c) -> Column:
    """Text after the last ``/`` (the whole text when there is none); blank -> null."""
    return F.nullif(F.substring_index(col_of(c), "/", -1), F.lit(""))


def trailing_digits(c) -> Column:
    """Trailing digits of a gid, null when there are none."""
    return F.nullif(F.regexp_extract(col_of(c), r"(\d+)$", 1), F.lit(""))


def order_number(c) -> Column:
    """The number of the order that an id names, be it the number alone or the gid that X7 makes of it;
    null for any other text. Numbers are equal just where the gids are, so one with leading zeros, which
    no order has, is none. One pattern reads both forms, and text without a number casts to null."""
    return F.regexp_extract(trimmed(c), rf"^(?:{ORDER_GID_PREFIX})?(0|[1-9]\d*)$", 1).try_cast("long")
