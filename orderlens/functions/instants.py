"""Instant parsing and formatting.

Spark keeps microseconds; the JVM library behind the original kept nanoseconds. Every parser
here is a guarded ``try_`` form, so a bad value yields null (or an error text) and never fails
the job. Text is parsed and printed with an explicit zone, so results do not depend on the
session's time zone.
"""

from __future__ import annotations

import datetime as _dt
import re
import zoneinfo
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, normalize, normalize_py, trimmed

# Window-bound messages (the label is put in front).
MSG_REQUIRED = "is required."
MSG_BAD_BOUND = "must be a Timestamp, Date, ISO-8601 value, SQL timestamp text, or epoch milliseconds."

# --- driver side (filter literals, window arguments) -------------------------------------

_ISO = re.compile(
    r"^(\d{4}-\d{2}-\d{2})T(\d{2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?"
    r"(Z|[+-]\d{2}:\d{2}(?::\d{2})?)?(?:\[([^\]]+)\])?$"
)


# The widest offset from UTC that the calendar library allows, in seconds.
MAX_OFFSET_SECONDS = 18 * 3600


@lru_cache(maxsize=1)
def zone_ids() -> frozenset:
    """Time-zone ids that may stand in brackets behind an offset."""
    return frozenset(zoneinfo.available_timezones()) | {"Z", "UTC", "GMT", "UT"}


def known_zone(name: str) -> bool:
    """Whether a time zone of this name exists."""
    return name in zoneinfo.available_timezones()


def _offset(text: str) -> _dt.timezone | None:
    if text == "Z":
        return _dt.timezone.utc
    hours, minutes, *seconds = (int(x) for x in text[1:].split(":"))
    total = hours * 3600 + minutes * 60 + sum(seconds)
    if total > MAX_OFFSET_SECONDS or minutes > 59 or sum(seconds) > 59:
        return None
    return _dt.timezone(_dt.timedelta(seconds=-total if text[0] == "-" else total))


def parse_instant_py(text: str, allow_local: bool = True) -> _dt.datetime | None:
    """X1 on the driver: instant / offset / zoned / (local as UTC) ISO date-time, else None.
    Date-only values and epoch numbers are refused. Returns a naive UTC datetime."""
    if text is None:
        return None
    m = _ISO.match(text)
    if not m:
        return None
    date, hh, mm, ss, frac, off, zone = m.groups()
    if zone is not None and (off is None or zone not in zone_ids()):
        return None
    if off is None and not allow_local:
        return None
    shift = _offset(off) if off is not None else _dt.timezone.utc
    if shift is None:
        return None
    try:
        y, mo, d = (int(x) for x in date.split("-"))
        micros = int((frac or "0").ljust(9, "0")[:6])
        value = _dt.datetime(y, mo, d, int(hh), int(mm), int(ss or 0), micros, tzinfo=shift)
        return value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    except (ValueError, OverflowError):
        return None


def format_instant_py(value: _dt.datetime) -> str:
    """X4 on the driver: ISO-8601 UTC text, fraction printed only when non-zero."""
    base = value.strftime("%Y-%m-%dT%H:%M:%S")
    if value.microsecond:
        frac = f"{value.microsecond:06d}"
        base += "." + (frac[:3] if frac.endswith("000") else frac)
    return base + "Z"


def window_bound_py(value) -> _dt.datetime:
    """X2 on the driver: epoch millis, ISO forms, SQL timestamp text, local date-time (UTC)
    or a date (UTC midnight). Raises ValueError with the reference wording otherwise."""
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            return value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    text = normalize_py(value)
    if text is None:
        raise ValueError(MSG_REQUIRED)
    value = parse_instant_py(text)
    if value is None:
        for form in (_epoch_millis, _sql_text, _date_text):
            try:
                value = form(text)
            except (ValueError, OverflowError):
                value = None
            if value is not None:
                break
    if value is None:
        raise ValueError(MSG_BAD_BOUND)
    return value


def _epoch_millis(text: str) -> _dt.datetime | None:
    return _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=int(text)) if re.fullmatch(r"-?\d+", text) else None


def _sql_text(text: str) -> _dt.datetime | None:
    m = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})(?:\.(\d{1,9}))?", text)
    return _dt.datetime(*(int(x) for x in m.groups()[:6]), int((m[7] or "0").ljust(9, "0")[:6])) if m else None


def _date_text(text: str) -> _dt.datetime | None:
    return _dt.datetime(*(int(x) for x in text.split("-"))) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text) else None


# --- column side ---------------------------------------------------------------------------

# A time of day after the date, and forms with it. The driver form cannot hold the year 0000, so the two
# parsers that have one refuse it here as well.
_TIME = r"T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
_OFFSET_FORM = rf"^(?!0000)\d{{4}}-\d{{2}}-\d{{2}}{_TIME}(Z|[+-]\d{{2}}:\d{{2}})(\[[^\]]+\])?$"
_INSTANT_FORM = rf"^\d{{4}}-\d{{2}}-\d{{2}}{_TIME}(Z|[+-]\d{{2}}:\d{{2}})$"
_LOCAL_FORM = rf"^(?!0000)\d{{4}}-\d{{2}}-\d{{2}}{_TIME}$"
_SQL_FORM = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?$"
_DATE_FORM = r"^(?!0000)\d{4}-\d{2}-\d{2}$"


def _readable(t: Column) -> Column:
    """What Spark's parser takes: at most 6 fraction digits, no ``[zone]`` (the offset in front of it
    decides the instant), and ``:00`` where the seconds are left out."""
    t = F.regexp_replace(t, r"^([^\[.]*(?:\.\d{1,6})?)\d*([^\[]*)(?:\[.*)?$", "$1$2")
    return F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(Z|[+-]|$)", "$1:00$2")


# The parsers below trim, but need no null for blank text: no form matches it.

def parse_iso_instant(c) -> Column:
    """X3 core: trimmed instant with ``Z`` or an offset -> timestamp (null when bad); a
    bracketed zone id is not an instant and is refused."""
    t = trimmed(c)
    return F.when(t.rlike(_INSTANT_FORM), _readable(t).try_cast("timestamp"))


def parse_iso_millis(c) -> Column:
    """Instant text -> epoch millis, bad -> null."""
    return F.unix_millis(parse_iso_instant(c))


def _known_zone(t: Column) -> Column:
    """No zone in brackets, or one that exists. The names are one literal text (no name has a comma), so
    a plan holds one constant however often an instant is parsed, not one per name."""
    zone = F.regexp_extract(t, r"\[([^\],]+)\]$", 1)
    listed = F.lit(",," + ",".join(sorted(zone_ids())) + ",")
    return ~F.endswith(t, F.lit("]")) | F.contains(listed, F.concat(F.lit(","), F.nullif(zone, F.lit("")), F.lit(",")))


def parse_instant_filter(c) -> Column:
    """X1 for columns: offset/zoned forms, or local date-time read as UTC."""
    t = trimmed(c)
    return (
        F.when(t.rlike(_OFFSET_FORM) & _known_zone(t), _readable(t).try_cast("timestamp"))
        .when(t.rlike(_LOCAL_FORM), F.concat(_readable(t), F.lit("Z")).try_cast("timestamp"))
    )


def parse_window_bound(c) -> Column:
    """X2 for columns: epoch millis text, ISO forms, SQL text, local, date -> timestamp."""
    t = trimmed(c)
    return (
        F.when(t.rlike(r"^-?\d+$"), _bounded_millis(t.try_cast("long")))
        .when(t.rlike(_OFFSET_FORM) & _known_zone(t), _readable(t).try_cast("timestamp"))
        .when(t.rlike(_LOCAL_FORM), F.concat(_readable(t), F.lit("Z")).try_cast("timestamp"))
        .when(t.rlike(_SQL_FORM), F.concat(_readable(t), F.lit("Z")).try_cast("timestamp"))
        .when(t.rlike(_DATE_FORM), F.concat(t, F.lit("T00:00:00Z")).try_cast("timestamp"))
    )


# First and last millisecond of the years 1 to 9999, the instants both forms can hold.
MIN_MILLIS, MAX_MILLIS = -62135596800000, 253402300799999


def _bounded_millis(ms: Column) -> Column:
    return F.when(ms.between(MIN_MILLIS, MAX_MILLIS), F.timestamp_millis(ms))


def window_bound_error(c, label: str, parsed: Column | None = None) -> Column:
    """The message for a bound that is missing or not one; ``parsed`` is its :func:`parse_window_bound`,
    where a column holds it already."""
    bound = parse_window_bound(c) if parsed is None else parsed
    return (
        F.when(normalize(c).isNull(), F.lit(f"{label} {MSG_REQUIRED}"))
        .when(bound.isNull(), F.lit(f"{label} {MSG_BAD_BOUND}"))
    )


def _utc_wall_clock(ts: Column) -> Column:
    """The instant's UTC date and time without a zone; a value without a zone is UTC already."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    shifted = F.timestamp_add("MICROSECOND", F.unix_micros(ts.cast("timestamp")), epoch)
    return F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("timestamp_ntz")).otherwise(shifted)


def format_instant(c) -> Column:
    """ISO-8601 text in UTC, whatever the session's zone; a zero fraction is not printed,
    else 3 or 6 digits."""
    text = _utc_wall_clock(col_of(c)).cast("string")  # prints as many fraction digits as needed
    day, time, n = F.substring(text, 1, 10), F.substring(text, 12, 15), F.length(text)
    digits = F.when(n <= 23, F.lit(12)).otherwise(F.lit(15))
    return F.concat(day, F.lit("T"), F.when(n <= 19, time).otherwise(F.rpad(time, digits, F.lit("0"))), F.lit("Z"))


def source_window(start, end, tz, preserve: bool):
    """Calendar window in the source zone.

    ``preserve`` keeps the instants. Otherwise a bound that sits on a UTC midnight is read as
    that calendar day's midnight in ``tz``. Returns (start, end) Columns."""
    s, e = col_of(start), col_of(end)
    if preserve:
        return s, e
    zone = col_of(tz) if not isinstance(tz, str) else F.lit(tz)

    def shift(x: Column) -> Column:
        midnight = F.pmod(F.unix_micros(x.cast("timestamp")), F.lit(86_400_000_000)) == 0
        return F.when(midnight, F.to_utc_timestamp(x, zone)).otherwise(x)

    return shift(s), shift(e)


def source_window_py(start: _dt.datetime, end: _dt.datetime, tz: str, preserve: bool) -> tuple[_dt.datetime, _dt.datetime]:
    """X5 on the driver, for naive UTC bounds."""
    if preserve:
        return start, end
    zone = zoneinfo.ZoneInfo(tz)

    def shift(x: _dt.datetime) -> _dt.datetime:
        if x.time() != _dt.time():
            return x
        return x.replace(tzinfo=zone).astimezone(_dt.timezone.utc).replace(tzinfo=None)

    return shift(start), shift(end)
