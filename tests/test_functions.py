import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions import endpoints, ids, instants, messages, money, text


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [
    ("2026-05-01T04:00:00Z", "2026-05-01T04:00:00Z"),
    ("2026-05-01T00:00:00-04:00", "2026-05-01T04:00:00Z"),
    ("2026-05-01T00:00-04:00", "2026-05-01T04:00:00Z"),
    ("2026-05-01T00:00:00+00:00[UTC]", "2026-05-01T00:00:00Z"),
    ("2026-05-01T02:30:00", "2026-05-01T02:30:00Z"),
    ("2026-05-01T02:30:00.250Z", "2026-05-01T02:30:00.250Z"),
    ("2026-05-01", None), ("1714521600000", None), ("2026-05-01 00:00:00", None), ("junk", None), ("", None),
])
def test_parse_instant_filter_driver(value, expected):
    got = instants.parse_instant_py(value)
    assert (instants.format_instant_py(got) if got else None) == expected


@pytest.mark.parametrize("value,expected_ms", [
    ("2026-07-28T00:00:00Z", 1785196800000), (" 2026-07-28T00:00:00Z ", 1785196800000),
    ("2026-07-27T20:00:00-04:00", 1785196800000), ("2026-07-28T00:00:00", None),
    ("2026-07-28", None), ("bad", None), (None, None), ("2026-07-28T00:00Z", 1785196800000),
])
def test_parse_iso_millis(spark, value, expected_ms):
    assert one(spark, instants.parse_iso_millis, value) == expected_ms


@pytest.mark.parametrize("value,expected", [
    ("1714521600000", "2024-05-01T00:00:00Z"), ("2024-05-01T00:00:00Z", "2024-05-01T00:00:00Z"),
    ("2024-05-01T01:00:00+01:00", "2024-05-01T00:00:00Z"), ("2024-05-01 03:04:05", "2024-05-01T03:04:05Z"),
    ("2024-05-01T03:04", "2024-05-01T03:04:00Z"), ("2024-05-01", "2024-05-01T00:00:00Z"), ("nope", None), ("  ", None),
])
def test_window_bound_column_and_driver(spark, value, expected):
    got = one(spark, lambda c: instants.format_instant(instants.parse_window_bound(c)), value)
    assert got == expected
    if expected is None:
        with pytest.raises(ValueError):
            instants.window_bound_py(value)
    else:
        assert instants.format_instant_py(instants.window_bound_py(value)) == expected


def test_window_bound_errors(spark):
    assert one(spark, lambda c: instants.window_bound_error(c, "windowStart"), " ") == "windowStart is required."
    assert "must be a Timestamp" in one(spark, lambda c: instants.window_bound_error(c, "windowEnd"), "x")


def test_source_window_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 1, 3))], "a timestamp, b timestamp")
    s, e = instants.source_window(F.col("a"), F.col("b"), "America/Chicago", preserve=False)
    r = df.select(instants.format_instant(s).alias("s"), instants.format_instant(e).alias("e")).first()
    assert r["s"] == "2026-07-01T05:00:00Z" and r["e"] == "2026-07-01T03:00:00Z"


@pytest.mark.parametrize("value,lookup,state", [
    ("123", "gid://shopify/Order/123", "gid://shopify/Order/123"),
    ("gid://shopify/Order/9", "gid://shopify/Order/9", "gid://shopify/Order/9"),
    ("gid://shopify/Customer/9", "gid://shopify/Customer/9", "gid://shopify/Order/gid://shopify/Customer/9"),
    ("  ", None, None),
])
def test_gid_forms(spark, value, lookup, state):
    assert one(spark, ids.to_order_gid_lookup, value) == lookup
    assert one(spark, ids.to_order_gid_state, value) == state


def test_legacy_and_digits(spark):
    assert one(spark, ids.legacy_from_gid, "gid://shopify/Order/77") == "77"
    assert one(spark, ids.legacy_from_gid, "plain") == "plain"
    assert one(spark, ids.trailing_digits, "gid://shopify/Order/abc") is None
    assert one(spark, ids.trailing_digits, "gid://shopify/Order/12") == "12"


@pytest.mark.parametrize("req,avail,rate,ms", [
    ("150", "50", "50", 2000), (None, None, None, 1000), ("100", "0", "30", 3334), ("10", "20", "5", 1000),
    ("5000", "0", "1", 10000), ("100", "0", "0", 1000),
])
def test_throttle_delay(spark, req, avail, rate, ms):
    df = spark.createDataFrame([(req, avail, rate)], "a string, b string, c string")
    assert df.select(money.throttle_delay_millis("a", "b", "c").alias("r")).first()["r"] == ms


def test_decimal_or_null(spark):
    assert str(one(spark, money.to_decimal_or_null, "185.71")) == "185.7100"
    assert one(spark, money.to_decimal_or_null, "abc") is None


@pytest.mark.parametrize("status,expected", [(" canceled ", True), ("CANCELED", True), ("CANCELLED", False), (None, False)])
def test_is_canceled(spark, status, expected):
    assert one(spark, messages.is_canceled, status) is expected


@pytest.mark.parametrize("msg,expected", [
    ("A bulk operation for this app and shop is already in progress.", True),
    ("Another bulk operation is already running", True),
    ("Bulk queries cannot use that field.", False), (None, False),
])
def test_concurrent_message(spark, msg, expected):
    assert one(spark, messages.is_concurrent_message, msg) is expected


def test_user_errors(spark):
    df = spark.createDataFrame([([(["a", " ", "b"], "bad"), (None, "only message"), (["f"], " "), ([], " ")],)],
                               "e array<struct<field:array<string>,message:string>>")
    assert df.select(messages.render_user_errors("e").alias("r")).first()["r"] == ["a.b: bad", "only message", "f"]


@pytest.mark.parametrize("doc,expected", [
    ("mutation X { a }", True), ("# note\n  MUTATION x { a }", True), ("query Q { a }", False), ("{ a }", False),
])
def test_is_mutation(spark, doc, expected):
    assert one(spark, text.is_mutation, doc) is expected


def test_missing_scope_and_describe(spark):
    df = spark.createDataFrame([(["Access denied for orders field."], 401), (["other"], 0)], "m array<string>, s int")
    r = df.select(messages.missing_scope("m").alias("x"), messages.describe_failure("s").alias("d")).collect()
    assert r[0]["x"] is True and r[0]["d"] == "The access token was rejected (HTTP 401)."
    assert r[1]["x"] is False and r[1]["d"] == "The shop could not be reached."


@pytest.mark.parametrize("url,version,endpoint", [
    ("https://a.myshopify.com/", "2025-10", "https://a.myshopify.com/admin/api/2025-10/graphql.json"),
    ("https://a.myshopify.com/admin/api/2024-01", "2025-10", "https://a.myshopify.com/admin/api/2025-10/graphql.json"),
    ("https://a.myshopify.com/admin/api/2024-01/graphql.json", "2025-10", "https://a.myshopify.com/admin/api/2024-01/graphql.json"),
    (" ", "2025-10", None),
])
def test_admin_endpoint(spark, url, version, endpoint):
    df = spark.createDataFrame([(url, version)], "u string, v string")
    assert df.select(endpoints.admin_endpoint("u", "v").alias("r")).first()["r"] == endpoint


@pytest.mark.parametrize("url,err", [
    ("https://a.myshopify.com", None), ("http://a.myshopify.com", "URL must use https."),
    ("https://evil.example.com", "URL host must end with .myshopify.com."), ("", "Shop API URL is required."),
])
def test_url_policy(spark, url, err):
    assert one(spark, endpoints.url_error, url) == err


@pytest.mark.parametrize("v,ok", [("2025-10", True), ("unstable", True), ("2025-7", False), ("latest", False)])
def test_api_version(spark, v, ok):
    assert one(spark, endpoints.valid_api_version, v) is ok


def test_indicator_and_names(spark):
    assert one(spark, lambda c: text.indicator(c, True), None) == "Y"
    assert one(spark, lambda c: text.indicator(c, False), "yes") == "Y"
    assert one(spark, lambda c: text.json_file_name(c, F.lit("x")), "run") == "run.json"
    assert one(spark, lambda c: text.jsonl_file_name(c, F.lit("x")), "run.JSON") == "run.jsonl"


def test_iso_millis_refuses_zone_id(spark):
    assert one(spark, instants.parse_iso_millis, "2026-07-28T00:00:00+00:00[UTC]") is None
    assert one(spark, lambda c: instants.format_instant(instants.parse_instant_filter(c)),
               "2026-07-28T00:00:00+00:00[UTC]") == "2026-07-28T00:00:00Z"
