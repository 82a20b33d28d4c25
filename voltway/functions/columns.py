"""Column functions of the session analytics: parsing, time zones, durations, keys.

Each takes and returns Columns, so Catalyst sees through it. Wall-clock values
are ``timestamp`` columns under a UTC session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = chr(31)
#: The publishers' zones.
ZONES = ("America/Denver", "America/New_York", "Europe/London")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hms_to_minutes(c: Column | str) -> Column:
    """``H+:MM:SS`` text to minutes; null where the shape is another."""
    c = col(c)
    part = lambda i: F.split_part(c, F.lit(":"), F.lit(i)).try_cast("double")
    return F.when(c.rlike(r"^\d+:\d{2}:\d{2}\z"), part(1) * 60 + part(2) + part(3) / 60)


def parse_us_mixed(c: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` or ``M/D/YYYY H:MM`` text to a wall-clock timestamp, value by value."""
    c = col(c)
    iso = F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))
    us = F.try_to_timestamp(c, F.lit("M/d/yyyy H:mm"))
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"), iso).when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}\z"), us)


def parse_date_time(d: Column | str, t: Column | str) -> Column:
    """An ISO or day-first date and a time of day, both text, to a wall-clock timestamp."""
    d, t = col(d), col(t)
    both = F.concat(d, F.lit(" "), t)
    return F.when(d.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_timestamp(both, F.lit("yyyy-MM-dd H:mm:ss"))).when(
        d.rlike(r"^\d{1,2}/\d{1,2}/\d{4}\z"), F.try_to_timestamp(both, F.lit("d/M/yyyy H:mm:ss"))
    )


def in_zone(convert, ts: Column, zone: Column | str) -> Column:
    """``convert`` (to or from UTC) in a zone; those of ``ZONES`` are constants in the plan, as a zone in a column is looked up by its name for every value."""
    if isinstance(zone, str):
        return convert(ts, F.lit(zone))
    found = F
    for name in ZONES:
        found = found.when(zone == name, convert(ts, F.lit(name)))
    return found.otherwise(convert(ts, zone))


def first_utc(ts: Column, zone: Column | str) -> Column:
    """The first instant at which the wall clock shows a time; where it skips it, an hour later by the clock."""
    return in_zone(F.to_utc_timestamp, ts, zone)


def hour_later(ts: Column) -> Column:
    return F.timestamp_add("HOUR", F.lit(1), ts)


def local_to_utc(ts: Column | str, zone: Column | str) -> Column:
    """Wall clock to UTC; the second of two equal hours in autumn, an hour later in the spring gap."""
    ts = col(ts)
    first = first_utc(ts, zone)
    later = hour_later(first)
    return F.when(utc_to_local(later, zone) == ts, later).otherwise(first)


def utc_to_local(ts: Column | str, zone: Column | str) -> Column:
    return in_zone(F.from_utc_timestamp, col(ts), zone)


def is_nonexistent_local(ts: Column | str, zone: Column | str) -> Column:
    """In a spring gap; false for null."""
    ts = col(ts)
    return F.coalesce(ts.isNotNull() & (utc_to_local(local_to_utc(ts, zone), zone) != ts), F.lit(False))


def is_ambiguous_local(ts: Column | str, zone: Column | str) -> Column:
    """In an hour that the clock shows twice; false for null."""
    ts = col(ts)
    return F.coalesce(ts.isNotNull() & (utc_to_local(hour_later(first_utc(ts, zone)), zone) == ts), F.lit(False))


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """From a to b in minutes."""
    return (F.unix_micros(col(b)) - F.unix_micros(col(a))) / 60_000_000.0


def local_day_minutes(d: Column | str, zone: Column | str) -> Column:
    """Length of a local date: 1440, or 1380 and 1500 where clocks change."""
    d = col(d)
    return minutes_between(local_to_utc(d.cast("timestamp"), zone), local_to_utc(F.date_add(d, 1).cast("timestamp"), zone))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared length of [a0, a1) and [b0, b1) given as numbers; null if an end is."""
    whole = a0.isNotNull() & a1.isNotNull() & b0.isNotNull() & b1.isNotNull()
    return F.when(whole, F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0)))


def text_or(c: Column, absent: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit(absent))


def natural_key_hash(*cols: Column) -> Column:
    """md5 over the columns as text; nulls match nulls."""
    return F.md5(F.concat_ws(UNIT, *(text_or(c, "<null>") for c in cols)))


def row_hash(*cols: Column) -> Column:
    """sha256 over the columns as text; null differs from empty text."""
    return F.sha2(F.concat_ws(UNIT, *(text_or(c, chr(0)) for c in cols)), 256)


def leading_integer(c: Column | str) -> Column:
    """The integer that text begins with, as text; else null."""
    return F.nullif(F.regexp_extract(col(c), r"^\s*(\d+)", 1), F.lit(""))


def tidy_name(c: Column | str) -> Column:
    """Trimmed, with single spaces."""
    return F.regexp_replace(F.trim(col(c)), r"\s+", " ")


def to_number(c: Column | str) -> Column:
    """Plain decimal text to double; anything else null."""
    c = col(c)
    return F.when(c.rlike(r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*\z"), F.trim(c).try_cast("double"))


def implied_kw(energy: Column, minutes: Column) -> Column:
    return F.when(minutes > 0, energy / (minutes / 60.0))


def utilization(numerator: Column, denominator: Column) -> Column:
    """Ratio of sums; null where nothing was available."""
    return F.sum(numerator) / F.nullif(F.sum(denominator), F.lit(0.0))


def joined_or_null(array: Column) -> Column:
    """Comma-joined texts; null for an empty array."""
    return F.nullif(F.array_join(array, ","), F.lit(""))


def normal_name(name: str) -> str:
    """A column name: lower case, runs of others as one underscore, no leading digit."""
    plain = re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")
    return f"c_{plain}" if plain[:1].isdigit() else plain
