"""Property checks: the driver-side and Column-side parsers agree on generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens.functions import instants
from orderlens.functions.text import normalize, normalize_py

stamps = st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2090, 12, 31))
offsets = st.sampled_from(["Z", "+00:00", "-05:00", "+02:00", "+05:30", ""])
spellings = st.tuples(stamps, offsets, st.booleans(), st.booleans())


def render(t):
    ts, off, with_seconds, with_zone = t
    body = ts.strftime("%Y-%m-%dT%H:%M:%S" if with_seconds else "%Y-%m-%dT%H:%M")
    if with_seconds and ts.microsecond:
        body += "." + f"{ts.microsecond:06d}"
    zone = "[UTC]" if (with_zone and off) else ""
    return body + off + zone


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(spellings, min_size=1, max_size=40))
def test_filter_parser_driver_equals_column(spark, items):
    texts = [render(t) for t in items]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(instants.format_instant(instants.parse_instant_filter(F.col("t")))).collect()]
    want = [instants.format_instant_py(instants.parse_instant_py(t)) if instants.parse_instant_py(t) else None for t in texts]
    assert got == want


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\r\x0bab\x00", max_size=6), min_size=1, max_size=30))
def test_normalize_driver_equals_column(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(normalize(F.col("v"))).collect()]
    assert got == [normalize_py(v) for v in values]
