"""Time buckets, cron units, deltas and version strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
_CALENDAR = {"week", "month", "quarter", "year"}


def parse_interval(spec: str) -> tuple[int, str]:
    """``'5 minutes'`` → ``(5, 'minute')``; a bare unit means 1."""
    m = re.fullmatch(r"\s*(\d+)?\s*([A-Za-z]+?)s?\s*", spec)
    if not m:
        raise ValueError(f"bad interval {spec!r}")
    n = int(m.group(1) or 1)
    unit = m.group(2).lower()
    if unit not in _SECONDS and unit not in _CALENDAR:
        raise ValueError(f"unknown unit {unit!r}")
    return n, unit


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_bucket(c, interval: str = "1 minute") -> Column:
    """Start of the N-unit interval containing the timestamp.

    Second…day buckets are aligned to the epoch by integer arithmetic, which
    keeps the type (``timestamp_ntz`` stays NTZ) and keeps null rows, unlike
    ``window()``. Week (Monday), month, quarter and year use ``date_trunc``
    and multiples of its unit count from the epoch.
    """
    n, unit = parse_interval(interval)
    ts = _c(c)
    if unit in _SECONDS:
        step = n * _SECONDS[unit] * 1_000_000
        micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)
        floored = micros - F.pmod(micros, F.lit(step))
        return F.timestamp_add("MICROSECOND", floored, F.expr(_EPOCH))
    trunc = F.date_trunc(unit, ts).cast("timestamp_ntz")
    if n == 1:
        return trunc
    if unit == "week":
        # Mondays counted from 1970-01-05, the first Monday after the epoch.
        monday0 = F.expr("TIMESTAMP_NTZ'1970-01-05 00:00:00'")
        weeks = F.floor(F.timestamp_diff("DAY", monday0, trunc) / 7)
        return F.timestamp_add("DAY", (weeks - F.pmod(weeks, F.lit(n))) * 7, monday0)
    months = {"month": 1, "quarter": 3, "year": 12}[unit] * n
    m = F.timestamp_diff("MONTH", F.expr(_EPOCH), trunc)
    return F.timestamp_add("MONTH", m - F.pmod(m, F.lit(months)), F.expr(_EPOCH))


# Fixed mapping of cron fields to bucket units (minute, hour, day, month,
# year fields of "m h d M y"); first match wins, default hour.
CRON_UNITS = [
    ("m", "*/1", "minute"),
    ("m", "*/5", "5 minutes"),
    ("m", "*/15", "15 minutes"),
    ("h", "*/1", "hour"),
    ("d", "*/1", "day"),
    ("d", "*/4", "quarter"),
    ("M", "*/1", "month"),
    ("y", "*/1", "year"),
]


def cron_bucket(c) -> Column:
    """Cron text ``'m h d M y'`` → bucket unit name; malformed → ``'hour'``."""
    cron = _c(c)
    parts = F.split(F.coalesce(cron, F.lit("")), " ")
    pos = {"m": 1, "h": 2, "d": 3, "M": 4, "y": 5}
    well_formed = F.size(parts) == 5
    expr = F.when(well_formed & (cron == "* * * * *"), F.lit("minute"))
    for field, pattern, unit in CRON_UNITS:
        expr = expr.when(well_formed & (F.get(parts, pos[field] - 1) == pattern), F.lit(unit))
    return expr.otherwise(F.lit("hour"))


# Fixed delta units and their length in seconds; anything else → 1 day.
DELTA_UNITS = {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400, "weeks": 604800}


def parse_delta_seconds(c) -> Column:
    """``'unit=num'`` (spaces ignored) → length in seconds; invalid → 86400."""
    txt = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\s", "")
    unit = F.regexp_extract(txt, r"^([a-z]+)=(-?\d+)$", 1)
    num = F.regexp_extract(txt, r"^([a-z]+)=(-?\d+)$", 2)
    per = None
    for u, s in DELTA_UNITS.items():
        per = F.when(unit == u, F.lit(s)) if per is None else per.when(unit == u, F.lit(s))
    secs = per.cast("long") * num.try_cast("long")
    return F.coalesce(secs, F.lit(86400).cast("long"))


def version_of(c) -> Column:
    """Version string ``YYYY_MM_DD`` of a timestamp."""
    return F.date_format(_c(c), "yyyy_MM_dd")


def weekday(c) -> Column:
    """0 = Monday … 6 = Sunday (Python's ``weekday()``)."""
    return F.weekday(_c(c))


def to_naive_timestamp(c) -> Column:
    """Drop the zone, keep wall-clock in the session zone."""
    return _c(c).cast("timestamp_ntz")
