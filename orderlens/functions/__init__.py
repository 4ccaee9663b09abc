"""Scalar functions X1-X23 as Column builders (no Python UDFs)."""

from .endpoints import admin_endpoint, normalize_api_version, normalize_source_id, normalize_url, url_error, valid_api_version
from .ids import legacy_from_gid, to_order_gid_lookup, to_order_gid_state, trailing_digits
from .instants import (format_instant, parse_instant_filter, parse_iso_instant, parse_iso_millis,
                       parse_window_bound, source_window, window_bound_error)
from .messages import describe_failure, is_canceled, is_concurrent_message, missing_scope, render_user_errors
from .money import throttle_delay_millis, to_decimal_or_null
from .text import as_bool, indicator, is_mutation, json_file_name, jsonl_file_name, normalize
