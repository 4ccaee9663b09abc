"""Results do not depend on the session's time zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions import instants as it
from orderlens.operators.filters import apply_filters
from orderlens.plans.catalog import ORDER_SOURCE, normalize_filters

ZONES = ["UTC", "America/New_York", "Asia/Kolkata"]
BOUNDS = ["2026-04-30T20:00:00Z", "2026-05-01T05:30:00+05:30[Asia/Kolkata]", "2026-03-08T02:30:00", "2026-11-01 01:30:00.25", "2026-05-01", "1777593600000",
          "2026-13-40", "99999999999999999", "2026-05-01T00:00:00+25:00", "2026-05-01T00:00:00+19:00", "2026-05-01T00:00Z[no zone]", "0000-01-01", " "]


@pytest.fixture(params=ZONES)
def zoned(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_driver_and_column_parsers_agree(zoned):
    df = zoned.createDataFrame(list(enumerate(BOUNDS)), "i int, t string")
    got = {r["i"]: (r["v"], r["e"]) for r in df.select("i", it.format_instant(it.parse_window_bound("t")).alias("v"), it.window_bound_error("t", "windowStart").alias("e")).collect()}
    for i, text in enumerate(BOUNDS):
        try:
            want = (it.format_instant_py(it.window_bound_py(text)), None)
        except ValueError as exc:
            want = (None, f"windowStart {exc}")
            assert str(exc) in (it.MSG_REQUIRED, it.MSG_BAD_BOUND)
        assert got[i] == want, text


def test_format_and_filter(zoned):
    rows = [("a", "2026-05-01T00:00:00Z"), ("b", "2026-04-30T23:59:59Z"), ("c", "2026-11-01T05:30:00Z"), ("d", "2026-11-01T06:30:00Z")]
    df = zoned.createDataFrame(rows, "id string, createdAt string")
    back = {r["id"]: r["t"] for r in df.select("id", it.format_instant(it.parse_iso_instant("createdAt")).alias("t")).collect()}
    assert back == dict(rows)
    f = normalize_filters(ORDER_SOURCE, {"createdAtFrom": "2026-05-01T00:00:00Z", "createdAtTo": "2026-05-02T00:00:00Z"})
    assert [r["id"] for r in apply_filters(df, ORDER_SOURCE, f).collect()] == ["a"]


def test_values_without_a_zone_are_utc(zoned):
    df = zoned.sql("SELECT TIMESTAMP_NTZ'2026-03-08 02:30:00.5' AS x")
    assert df.select(it.format_instant(F.col("x")).alias("t")).first()["t"] == "2026-03-08T02:30:00.500Z"


def test_calendar_window_in_the_source_zone(zoned):
    start, end = it.source_window(it.parse_window_bound(F.lit("2026-04-01")), it.parse_window_bound(F.lit("2026-04-02T01:00:00Z")), "America/Chicago", False)
    row = zoned.range(1).select(it.format_instant(start).alias("s"), it.format_instant(end).alias("e")).first()
    py = it.source_window_py(dt.datetime(2026, 4, 1), dt.datetime(2026, 4, 2, 1), "America/Chicago", False)
    assert (row["s"], row["e"]) == ("2026-04-01T05:00:00Z", "2026-04-02T01:00:00Z") == tuple(map(it.format_instant_py, py))
