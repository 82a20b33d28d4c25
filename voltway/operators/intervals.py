"""Interval operators: concurrency, capacity, gaps, midnight splits, occupancy.

Running values per station are two-phase: within spans of ``SPAN`` seconds, then
over the spans' totals (one row a station and span), so the whole history of one
busy station isn't one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltway.functions import columns as C

#: Levels of concurrency that the published port counts tell apart.
MOST_LEVELS = 8
#: Seconds of a station's history that one task orders.
SPAN = 30 * 86400


def seconds(c: Column | str) -> Column:
    return F.unix_micros(C.col(c)) / 1e6


def whole_seconds(minutes: Column | str) -> Column:
    return F.round(C.col(minutes) * 60)


def timeline(sessions: DataFrame, all_sessions: bool = False) -> DataFrame:
    """Sessions of known stations, only non-trivial ones unless ``all_sessions``.

    ``s`` and ``e``: start and effective end in UTC seconds (the charging time
    stands in for an unknown end, 0 for an unknown charging time), ``start_day``
    and ``end_day`` their local dates.
    """
    charged = F.coalesce(whole_seconds("charging_minutes"), F.lit(0.0))
    end_local = F.coalesce("end_local", F.timestamp_micros(F.unix_micros("start_local") + (charged * 1e6).cast("long")))
    known = sessions.filter((F.lit(all_sessions) | F.col("is_non_trivial")) & ~F.col("station_key").contains("/unknown/"))
    return known.select(
        "*", seconds("start_utc").alias("s"), F.coalesce(seconds("end_utc"), seconds("start_utc") + charged).alias("e"),
        F.to_date("start_local").alias("start_day"), F.to_date(end_local).alias("end_day"),
    )


def in_spans(df: DataFrame, at: str) -> DataFrame:
    """``df`` with ``_span``, the span that ``at`` (seconds, not null) lies in; as it is where it has one already, so that its partitioning serves again."""
    return df if "_span" in df.columns else df.withColumn("_span", F.floor(F.col(at) / SPAN))


def running(df: DataFrame, keys: list[str], at: str, order: list[Column], sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None) -> DataFrame:
    """Adds running sums and maxima per key, rows in ``order``, which must begin with ``at``; keeps ``_span``."""
    spans = [*keys, "_span"]
    dealt = in_spans(df, at)
    measures = [(n, c, F.sum, lambda own, base: own + F.coalesce(base, F.lit(0))) for n, c in (sums or {}).items()] + [(n, c, F.max, F.greatest) for n, c in (maxima or {}).items()]
    totals = dealt.groupBy(*spans).agg(*(combine(c).alias(f"_total_{n}") for n, c, combine, _ in measures))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*spans, *(combine(f"_total_{n}").over(earlier).alias(f"_base_{n}") for n, _, combine, _ in measures))
    within = Window.partitionBy(*spans).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumns({f"_own_{n}": combine(c).over(within) for n, c, combine, _ in measures}).join(bases, spans)
    return found.select(*dealt.columns, *(merge(F.col(f"_own_{n}"), F.col(f"_base_{n}")).alias(n) for n, _, _, merge in measures))


def following(df: DataFrame, key: str, at: str, order: list[str], given: list[str]) -> DataFrame:
    """Adds ``next_*`` of ``given``: the values of the key's next row in ``order``, which must begin with ``at``; keeps ``_span``."""
    spans = [key, "_span"]
    dealt = in_spans(df, at).withColumn("_row", F.struct(*order, *(n for n in given if n not in order)))
    firsts = dealt.groupBy(*spans).agg(F.min("_row").alias("_first"))
    later = firsts.select(*spans, F.lead("_first").over(Window.partitionBy(key).orderBy("_span")).alias("_later"))
    nearer = F.lead("_row").over(Window.partitionBy(*spans).orderBy("_row"))
    found = dealt.withColumn("_nearer", nearer).join(later, spans)
    return found.select(*(c for c in dealt.columns if c != "_row"), *(F.coalesce(f"_nearer.{n}", f"_later.{n}").alias(f"next_{n}") for n in given))


def sweep(sessions: DataFrame, key: str = "station_key", start: str = "s", end: str = "e", unique: str = "object_id", day: str = "start_day") -> DataFrame:
    """Both ends of each interval in time order per key, with the number running; ends come first at equal instants."""
    moves = sessions.select(
        key, unique,
        F.explode(F.array(
            F.struct(F.col(start).alias("t"), F.lit(1).alias("d"), F.col(day).alias("day")),
            F.struct(F.col(end).alias("t"), F.lit(-1).alias("d"), F.lit(None).cast("date").alias("day")),
        )).alias("move"),
    ).select(key, unique, "move.*")
    return running(moves, [key], "t", [F.col("t"), F.col("d"), F.col(unique)], {"level": F.col("d")})


def day_levels(swept: DataFrame, key: str = "station_key") -> DataFrame:
    """key, day, level: the most that ran at once on each date on which one started."""
    return swept.filter("d = 1").groupBy(key, "day").agg(F.max("level").alias("level"))


def days_at_level(levels: DataFrame, key: str = "station_key", most: int | None = None) -> DataFrame:
    """key, level, days: days (of ``day_levels``) on which so many ran at once, for every level up to the largest; with ``most``, up to that."""
    top = F.col("level") if most is None else F.least(F.col("level"), F.lit(most))
    each = levels.filter("level >= 1").select(key, F.explode(F.sequence(F.lit(1), top.cast("int"))).alias("level"))
    return each.groupBy(key, "level").agg(F.count("*").alias("days"))


def reached(n_days: int) -> Column:
    """The largest level seen on at least so many days; null without."""
    return F.max(F.when(F.col("days") >= n_days, F.col("level")))


def robust_max(at_level: DataFrame, n_days: int = 5, key: str = "station_key") -> DataFrame:
    """The largest level seen on at least ``n_days`` days (null without one), and the largest of all."""
    return at_level.groupBy(key).agg(reached(n_days).alias("robust_max"), reached(1).alias("plain_max"))


def gaps(line: DataFrame, longer_than_days: dict[str, float]) -> DataFrame:
    """From the effective end of a session to the next start of its station, where that is longer than its source's days."""
    nexts = following(line.select("station_key", "source", "s", "e", "object_id", "start_day", "end_day"), "station_key", "s", ["s", "e", "object_id"], ["s", "start_day"])
    days = (F.col("next_s") - F.col("e")) / 86400.0
    least = F.coalesce(*(F.when(F.col("source") == s, F.lit(float(d))) for s, d in longer_than_days.items()))
    found = nexts.select("station_key", "source", F.col("end_day").alias("gap_after"), F.col("next_start_day").alias("gap_before"), days.alias("gap_days"), least.alias("threshold_days"))
    return found.filter("gap_days > threshold_days").withColumn("excluded_days", F.greatest(F.datediff("gap_before", "gap_after") - 1, F.lit(0)))


def excluded_days(found: DataFrame) -> DataFrame:
    """station_key, day of every date strictly inside a gap."""
    inside = found.filter("excluded_days > 0")
    return inside.select("station_key", F.explode(F.sequence(F.date_add("gap_after", 1), F.date_sub("gap_before", 1))).alias("day")).distinct()


def midnight(day: Column | str, zone: Column) -> Column:
    """UTC seconds at which a local date begins."""
    return seconds(C.local_to_utc(C.col(day).cast("timestamp"), zone))


def spine(dim: DataFrame) -> DataFrame:
    """One row per station and date of its active window, with the date's length."""
    days = dim.select("station_key", "source", "operator_key", "capacity_grain", "zone", "ports", F.explode(F.sequence("active_from", "active_to")).alias("day"))
    return days.withColumn("day_minutes", C.local_day_minutes("day", F.col("zone")))


def pieces(sessions: DataFrame) -> DataFrame:
    """Sessions split at local midnight, with minutes and energy of each date.

    Energy follows the charging time; the connected time only where the charging
    time is unknown; without either it stays on the start's date.
    """
    c = F.col
    charged = F.timestamp_micros(F.unix_micros("start_local") + (F.coalesce(whole_seconds("charging_minutes"), F.lit(0.0)) * 1e6).cast("long"))
    ends = sessions.select(
        "*", seconds("start_utc").alias("s"), seconds("end_utc").alias("plug_e"), (seconds("start_utc") + whole_seconds("charging_minutes")).alias("charge_e"),
        F.to_date("start_local").alias("start_day"), F.to_date(F.coalesce("end_local", charged)).alias("last_day"),
    )
    split = ends.filter("last_day >= start_day").withColumn("day", F.explode(F.sequence("start_day", "last_day")))
    bounded = split.withColumn("d0", midnight("day", c("zone"))).withColumn("d1", midnight(F.date_add("day", 1), c("zone")))
    part = lambda end: C.overlap(c("s"), c(end), c("d0"), c("d1")) / 60.0
    cut = bounded.withColumn("connected_piece", part("plug_e")).withColumn("charging_piece", part("charge_e"))
    energy = (
        F.when(c("charging_minutes") > 0, c("energy_kwh") * c("charging_piece") / c("charging_minutes"))
        .when(c("charging_minutes").isNull() & (c("connected_minutes") > 0), c("energy_kwh") * c("connected_piece") / c("connected_minutes"))
        .when(c("day") == c("start_day"), c("energy_kwh")).otherwise(0.0)
    )
    return cut.withColumn("energy_piece", energy).drop("d0", "d1")


def usage(split: DataFrame) -> DataFrame:
    """Measures of non-trivial sessions per station and date; trivial ones are counted beside."""
    starts, real = F.col("day") == F.col("start_day"), F.col("is_non_trivial")
    of_real = lambda n: F.when(real, F.col(n))
    return split.groupBy("station_key", "day").agg(
        F.count(F.when(starts & real, 1)).alias("sessions"), F.count(F.when(starts & ~real, 1)).alias("trivial_sessions"),
        F.sum(of_real("energy_piece")).alias("energy_kwh"), F.sum(of_real("charging_piece")).alias("charging_minutes"), F.sum(of_real("connected_piece")).alias("connected_minutes"),
        F.count(of_real("charging_piece")).alias("charging_pieces"), F.count(of_real("connected_piece")).alias("connected_pieces"),
    )


def blocking_windows(swept: DataFrame, ports: DataFrame) -> DataFrame:
    """station_key, other columns of ``ports``, bs, be: spans in which at least ``ports`` sessions run."""
    spans = following(swept, "station_key", "t", ["t", "d", "object_id"], ["t"]).filter("next_t > t").join(ports, "station_key")
    names = [c for c in ports.columns if c not in ("station_key", "ports")]
    return spans.filter(F.col("level") >= F.col("ports")).select("station_key", *names, F.col("t").alias("bs"), F.col("next_t").alias("be"))


def idle_intervals(line: DataFrame) -> DataFrame:
    """station_key, object_id, i0, i1, shift: from the end of charging to the end, and what to add for local seconds."""
    known = line.filter("charging_minutes is not null and end_utc is not null and e > s")
    found = known.select("station_key", "object_id", (F.col("s") + whole_seconds("charging_minutes")).alias("i0"), F.col("e").alias("i1"), (seconds("start_local") - F.col("s")).alias("shift"))
    return found.filter("i1 > i0")


def by_hours(intervals: DataFrame) -> DataFrame:
    """Intervals (i0, i1, shift) cut at local hours; ``hour`` is 0 to 23."""
    first, last = F.floor((F.col("i0") + F.col("shift")) / 3600), F.ceil((F.col("i1") + F.col("shift")) / 3600) - 1
    each = intervals.withColumn("h", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    return each.select(
        *(c for c in intervals.columns if c not in ("i0", "i1")), F.pmod("h", F.lit(24)).cast("int").alias("hour"),
        F.greatest(F.col("i0"), F.col("h") * 3600.0 - F.col("shift")).alias("i0"), F.least(F.col("i1"), (F.col("h") + 1) * 3600.0 - F.col("shift")).alias("i1"),
    )


def looks(intervals: DataFrame, *per: str) -> DataFrame:
    """Both ends of each interval: station_key, per, t, sign (1 at the end, -1 at the start)."""
    ends = F.explode(F.array(F.struct(F.col("i0").alias("t"), F.lit(-1).alias("sign")), F.struct(F.col("i1").alias("t"), F.lit(1).alias("sign"))))
    return intervals.select("station_key", *per, ends.alias("x")).select("station_key", *per, "x.t", "x.sign")


def busy_before(swept: DataFrame, looked: DataFrame, level: dict[str, Column]) -> DataFrame:
    """``looked`` with, for each name of ``level``, how many seconds before ``t`` at least so many ran at once.

    The time spent at a level up to an instant is the instant itself, if it is
    spent there now, less the instants at which the level was entered plus those
    at which it was left. So one ordered union of moves and looks, with running
    sums, answers for all levels; ``level`` may depend on columns of both sides.
    """
    entered = lambda k: F.when((F.col("d") == 1) & (F.col("level") == k), F.col("t")).when((F.col("d") == -1) & (F.col("level") == k - 1), -F.col("t")).otherwise(0.0)
    kept = [c for c in looked.columns if c not in ("station_key", "t")]
    moves = swept.select("station_key", "t", "d", F.lit(0).alias("kind"), *(entered(k).alias(f"_in_{n}") for n, k in level.items()))
    asked = looked.select("station_key", "t", F.lit(0).alias("d"), F.lit(1).alias("kind"), *(F.lit(0.0).alias(f"_in_{n}") for n in level), *kept)
    sums = {"running": F.col("d"), **{f"_since_{n}": F.col(f"_in_{n}") for n in level}}
    found = running(moves.unionByName(asked, allowMissingColumns=True), ["station_key"], "t", [F.col("t"), F.col("kind"), F.col("d")], sums).filter("kind = 1")
    now = lambda n, k: F.when(F.col("running") >= k, F.col("t")).otherwise(0.0) - F.col(f"_since_{n}")
    return found.select("station_key", "t", *kept, *(now(n, k).alias(n) for n, k in level.items()))


def full_occupancy_idle(line: DataFrame, ports: DataFrame) -> DataFrame:
    """Per station: idle seconds, and those of them while all its ports were taken."""
    own = ports.select("station_key", "ports")
    asked = looks(idle_intervals(line)).join(own, "station_key")
    found = busy_before(sweep(line).join(own, "station_key"), asked, {"busy": F.col("ports")})
    return found.groupBy("station_key").agg(
        F.sum(F.col("sign") * F.col("t")).alias("idle_s"), F.count(F.when(F.col("sign") == 1, 1)).alias("idle_sessions"), F.sum(F.col("sign") * F.col("busy")).alias("blocked_s")
    )


def idle_by_level(line: DataFrame, levels: int = MOST_LEVELS) -> DataFrame:
    """station_key, hour, seconds, busy_1 .. busy_n: idle seconds by local hour, and those with at least so many running."""
    names = {f"busy_{k}": F.lit(k) for k in range(1, levels + 1)}
    found = busy_before(sweep(line), looks(by_hours(idle_intervals(line)), "hour"), names)
    return found.groupBy("station_key", "hour").agg(F.sum(F.col("sign") * F.col("t")).alias("seconds"), *(F.sum(F.col("sign") * F.col(n)).alias(n) for n in names))


def idle_by_definition(line: DataFrame, ports: DataFrame) -> DataFrame:
    """station_key, definition, hour, seconds, blocked_s for each port definition of ``ports`` (station_key, definition, ports).

    The time at every level comes from one sweep, so a definition is a look-up;
    stations that some definition gives more than MOST_LEVELS ports are swept for
    those counts by themselves.
    """
    by_level = idle_by_level(line)
    at = F.element_at(F.array(*(F.col(f"busy_{k}") for k in range(1, MOST_LEVELS + 1))), F.col("ports").cast("int"))
    found = ports.filter(F.col("ports") <= MOST_LEVELS).join(by_level, "station_key").select("station_key", "definition", "hour", "seconds", at.alias("blocked_s"))
    more = ports.filter(F.col("ports") > MOST_LEVELS)
    if more.isEmpty():
        return found
    counts = more.select("station_key", "ports").distinct()
    asked = looks(by_hours(idle_intervals(line)), "hour").join(counts, "station_key")
    # A station with several such counts is swept once for each: they are keys of their own.
    key = F.concat_ws("|", "ports", "station_key")
    swept = sweep(line).join(counts, "station_key").withColumn("station_key", key)
    each = busy_before(swept, asked.withColumn("station_key", key), {"busy": F.col("ports")})
    sums = each.groupBy("station_key", "hour").agg(F.sum(F.col("sign") * F.col("t")).alias("seconds"), F.sum(F.col("sign") * F.col("busy")).alias("blocked_s"))
    large = more.withColumn("_key", key).join(sums.withColumnRenamed("station_key", "_key"), "_key").select(*found.columns)
    return found.unionByName(large)


def trailing_ports(levels: DataFrame, days: DataFrame, window_days: int = 90) -> DataFrame:
    """For each station and date the largest daily level of the last ``window_days`` days, at least 1; 1 after the last date with a level.

    A station has one row a date, so its window is small.
    """
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    both = days.select("station_key", "day", F.lit(True).alias("asked")).unionByName(levels.select("station_key", "day", "level"), allowMissingColumns=True)
    filled = both.groupBy("station_key", "day").agg(F.max("asked").alias("asked"), F.max("level").alias("level"))
    trailing = Window.partitionBy("station_key").orderBy(number).rangeBetween(-(window_days - 1), 0)
    onward = Window.partitionBy("station_key").orderBy(number).rangeBetween(0, Window.unboundedFollowing)
    seen = F.when(F.max("level").over(onward).isNotNull(), F.max("level").over(trailing))
    found = filled.select("station_key", "day", "asked", F.greatest(F.coalesce(seen, F.lit(1)), F.lit(1)).alias("ports"))
    return found.filter("asked").select("station_key", "day", "ports")
