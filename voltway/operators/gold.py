"""Session fact, station, calendar and operator tables, station-days and the monthly mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltway.functions import columns as C
from voltway.operators import incremental
from voltway.operators import intervals as I

#: Days without a session after which a station counts as closed, by source.
GAP_DAYS = {"alpha": 30, "beta": 30, "gamma": 90}
ROBUST_DAYS = 5
#: The days of the port definitions ``robust_max_n*``.
N_VALUES = (1, 2, 3, 5, 10)

FACT = (
    "session_sk", "object_id", "source", "family", "source_file", "source_file_sha256", "delivery_block", "operator_key", "station_key", "station_name_raw", "site_key", "port_id", "port_id_present", "source_session_id",
    "start_utc", "end_utc", "start_local", "end_local", "zone", "is_ambiguous", "energy_kwh", "charging_minutes", "connected_minutes", "reported_minutes", "duration_disagreement_minutes", "idle_minutes", "duration_availability",
    "publisher_excluded", "implied_kw", "precision_seconds", "is_non_trivial", "flags", "key_hash", "row_hash",
)


def operator_key(source: Column | str, site: Column | str) -> Column:
    """Gamma's sites are operators of their own; the others' publisher is the operator."""
    return F.when(C.col(source) == "gamma", F.concat(F.lit("gamma/"), F.coalesce(C.col(site), F.lit("<null>")))).otherwise(C.col(source))


def session_fact(accepted: DataFrame, files: DataFrame) -> DataFrame:
    """Accepted sessions with their operator and the version of the file (source, file_name, sha256) that they came from."""
    version = files.select("source", F.col("file_name").alias("source_file"), F.col("sha256").alias("source_file_sha256"))
    found = accepted.join(F.broadcast(version), ["source", "source_file"], "left")  # a row a file, as in the manifest, which the driver holds
    found = found.withColumn("operator_key", operator_key("source", "site_key"))
    return found.withColumn("flags", C.joined_or_null(F.col("flags"))).select(*FACT)


def stale_sources(fact: DataFrame, files: DataFrame) -> DataFrame:
    """Sources of which a file is new, changed or gone since ``fact`` was built."""
    loaded = fact.select("source", F.col("source_file").alias("file_name"), F.col("source_file_sha256").alias("sha256")).distinct()
    return incremental.changed_sources(files, loaded)


def refreshed(fact: DataFrame, accepted: DataFrame, files: DataFrame) -> DataFrame:
    """``fact`` with all rows of stale sources replaced by those of ``accepted``; a source without any keeps its old ones."""
    stale = stale_sources(fact, files)
    return incremental.replaced(fact, session_fact(accepted.join(stale, "source", "left_semi"), files)).select(*FACT)


def ports(connectors: Column | str, robust: Column | str) -> Column:
    """As many as its connectors or the concurrency of several days, whichever is more, and one at least."""
    return F.greatest(C.col(connectors), F.coalesce(C.col(robust), F.lit(0)), F.lit(1)).cast("long")


def dim_station(line: DataFrame, at_level: DataFrame, gaps: DataFrame) -> DataFrame:
    """Ports, active window and majority attributes of each known station, from its non-trivial sessions.

    Distinct counts and majorities come from one table of counts per attribute
    value; sessions alike in all of them are combined before they are expanded.
    """
    value = lambda n: F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value"))
    names = ("source", "site_key", "station_name_raw", "zone", "port_id", "operator_key", "start_day")
    alike = line.groupBy("station_key", *names).agg(F.count("*").alias("k"))
    counted = alike.select("station_key", "k", F.explode(F.array(*map(value, names))).alias("x")).filter("x.value is not null").groupBy("station_key", "x.name", "x.value").agg(F.sum("k").alias("n"))
    most = lambda n: F.max_by(F.when(F.col("name") == n, F.col("value")), F.when(F.col("name") == n, F.col("n")))
    ranked = counted.groupBy("station_key", "name", "n").agg(F.min("value").alias("value"), F.count("*").alias("k"))  # ties go to the smallest value
    picks = ranked.groupBy("station_key").agg(
        *(most(n).alias(n) for n in ("source", "site_key", "station_name_raw", "zone")),
        *(F.coalesce(F.sum(F.when(F.col("name") == n, F.col("k"))), F.lit(0)).alias(to) for n, to in (("port_id", "connector_ids"), ("site_key", "site_key_candidates"), ("operator_key", "operator_candidates"), ("start_day", "active_days"))),
    )
    windows = line.groupBy("station_key").agg(F.count("*").alias("sessions"), F.min("start_day").alias("active_from"), F.max("end_day").alias("active_to"))
    shut = gaps.groupBy("station_key").agg(F.sum("excluded_days").alias("excluded_days"), F.count("*").alias("excluded_gaps"))
    joined = windows.join(picks, "station_key").join(I.robust_max(at_level, ROBUST_DAYS), "station_key", "left").join(shut, "station_key", "left")
    robust = F.coalesce("robust_max", F.lit(0))
    origin = F.when(F.greatest("connector_ids", robust) < 1, "floor").when(F.col("connector_ids") >= robust, "connector_ids").otherwise("observed_concurrency")
    zero = lambda n: F.coalesce(n, F.lit(0)).cast("long").alias(n)
    return joined.select(
        "station_key", "source", operator_key("source", "site_key").alias("operator_key"), "site_key", "station_name_raw", "zone",
        (F.col("site_key_candidates") > 1).alias("multi_site_key"), (F.col("operator_candidates") > 1).alias("multi_operator"), "site_key_candidates", "operator_candidates",
        F.lit("unit").alias("capacity_grain"), ports("connector_ids", "robust_max").alias("ports"), origin.alias("ports_source"),
        "robust_max", "plain_max", "connector_ids", (F.col("active_days") < ROBUST_DAYS).alias("low_evidence"), "sessions", "active_days", "active_from", "active_to",
        (F.datediff("active_to", "active_from") + 1).alias("window_days"), zero("excluded_days"), zero("excluded_gaps"),
    )


def dim_date(dim: DataFrame) -> DataFrame:
    """Every date between the stations' first and last active days."""
    bounds = dim.agg(F.min("active_from").alias("a"), F.max("active_to").alias("b"))
    days = bounds.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("date_key"))
    return days.select(
        "date_key", F.year("date_key").alias("year"), F.month("date_key").alias("month"), F.dayofmonth("date_key").alias("day_of_month"),
        (F.weekday("date_key") + 1).alias("iso_day_of_week"), (F.weekday("date_key") >= 5).alias("is_weekend"), F.date_format("date_key", "yyyy-MM").alias("year_month"),
    )


def dim_operator(fact: DataFrame) -> DataFrame:
    """The publishers, and gamma's sites under it."""
    names = "operator_key string, operator_name string, source string, parent_operator_key string, country string, timezone string"
    publishers = [
        ("alpha", "Alpha City", "alpha", None, "US", "America/Denver"), ("beta", "Beta Town", "beta", None, "US", "America/New_York"), ("gamma", "Gamma Survey", "gamma", None, "GB", "Europe/London"),
    ]
    bodies = fact.filter("source = 'gamma'").select("operator_key", F.coalesce("site_key", F.lit("<null>")).alias("operator_name"), "source").distinct()
    own = bodies.select("*", F.lit("gamma").alias("parent_operator_key"), F.lit("GB").alias("country"), F.lit("Europe/London").alias("timezone"))
    return fact.sparkSession.createDataFrame(publishers, names).unionByName(own)


def station_day(dim: DataFrame, gaps: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per station and date: minutes available, used and idle; null where a publisher doesn't say."""
    excluded = I.excluded_days(gaps).withColumn("is_excluded", F.lit(True))
    whole = I.spine(dim).join(excluded, ["station_key", "day"], "left").join(I.usage(I.pieces(fact)), ["station_key", "day"], "left")
    out = F.coalesce("is_excluded", F.lit(False))
    both = F.col("charging_minutes").isNotNull() & F.col("connected_minutes").isNotNull()
    zero = lambda n: F.coalesce(n, F.lit(0)).alias(n)
    return whole.select(
        "station_key", "day", "source", "operator_key", "capacity_grain", "ports", out.alias("is_excluded"), "day_minutes",
        F.when(out, 0.0).otherwise(F.col("day_minutes") * F.col("ports")).alias("available_minutes"),
        zero("sessions"), zero("trivial_sessions"), "energy_kwh", "charging_minutes", "connected_minutes", zero("charging_pieces"), zero("connected_pieces"),
        F.when(both, F.greatest(F.col("connected_minutes") - F.col("charging_minutes"), F.lit(0.0))).alias("idle_minutes"),
    )


def mart_monthly(days: DataFrame) -> DataFrame:
    """Sums per source, operator and month; distinct stations from their own counts."""
    month = F.date_format("day", "yyyy-MM").alias("year_month")
    sums = ("sessions", "trivial_sessions", "energy_kwh", "charging_minutes", "connected_minutes", "idle_minutes", "available_minutes", "charging_pieces", "connected_pieces")
    per_station = days.groupBy("source", "operator_key", month, "station_key").agg(F.count("*").alias("n"), F.count(F.when(F.col("is_excluded"), 1)).alias("out"), *(F.sum(n).alias(n) for n in sums))
    return per_station.groupBy("source", "operator_key", "year_month").agg(
        F.sum("n").alias("station_days"), F.sum("out").alias("excluded_days"), F.count("*").alias("stations"), *(F.sum(n).alias(n) for n in sums)
    )


def utilization_by_source(days: DataFrame) -> DataFrame:
    """Connected and charging time over available port time: ratios of sums over days that count."""
    counted = days.filter("not is_excluded")
    return counted.groupBy("source").agg(
        C.utilization(F.col("connected_minutes"), F.col("available_minutes")).alias("connected_utilization"),
        C.utilization(F.col("charging_minutes"), F.col("available_minutes")).alias("charging_utilization"), F.count("*").alias("station_days"),
    )


def fixed_ports(dim: DataFrame, at_level: DataFrame) -> DataFrame:
    """station_key, definition, ports: the port definitions that don't change over time, from the concurrency of ``at_level``."""
    over = lambda n: F.greatest(F.coalesce(I.reached(n), F.lit(0)), F.lit(1)).cast("long").alias(f"robust_max_n{n}")
    each = dim.select("station_key", "connector_ids").join(at_level, "station_key", "left").groupBy("station_key").agg(F.first("connector_ids").alias("c"), *map(over, N_VALUES))
    own = each.withColumn("connector_ids", F.when(F.col("c") > 0, F.col("c")).otherwise(F.col("robust_max_n5"))).withColumn("production", F.greatest("c", "robust_max_n5"))
    names = [n for n in own.columns if n not in ("station_key", "c")]
    return own.select("station_key", F.explode(F.array(*(F.struct(F.lit(n).alias("definition"), F.col(n).cast("long").alias("ports")) for n in names))).alias("x")).select("station_key", "x.*")


def sensitivity(dim: DataFrame, days: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """Utilization by session rule, port definition, source and flavour, with counts of station-days, of those with a measure and of those over 100 %.

    ``evidence``: the daily levels of concurrency under each session rule.
    Station-days that count are copied once per rule and definition.
    """
    counted = days.filter("not is_excluded").select("station_key", "day", "source", "day_minutes", "connected_minutes", "charging_minutes")
    parts = []
    for rule, levels in evidence.items():
        fixed = counted.join(fixed_ports(dim, I.days_at_level(levels, most=I.MOST_LEVELS)), "station_key")
        trailing = counted.join(I.trailing_ports(levels, counted), ["station_key", "day"]).withColumn("definition", F.lit("trailing_90d_max"))
        parts += [p.withColumn("session_rule", F.lit(rule)).withColumn("ports", F.col("ports").cast("long")) for p in (fixed, trailing)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    flavours = F.explode(F.array(*(F.struct(F.lit(n).alias("flavour"), F.col(f"{n}_minutes").alias("used")) for n in ("connected", "charging"))))
    each = whole.select("session_rule", "definition", "source", (F.col("day_minutes") * F.col("ports")).alias("available"), flavours.alias("x")).select("*", "x.*").drop("x")
    used = F.col("used")
    return each.groupBy("session_rule", "definition", "source", "flavour").agg(
        C.utilization(used, F.col("available")).alias("utilization"), F.count("*").alias("station_days"), F.count(used).alias("with_measure"),
        F.when(F.count(used) > 0, F.count(F.when(used > F.col("available"), 1))).alias("over_full"),
    )


def utilization_ranges(table: DataFrame, rule: str = "non_trivial_only") -> DataFrame:
    """Per source and flavour the least and largest utilization over the definitions of ``sensitivity``, and the width against production's."""
    own = table.filter((F.col("session_rule") == rule) & F.col("utilization").isNotNull())
    production = F.max(F.when(F.col("definition") == "production", F.col("utilization")))
    return own.groupBy("source", "flavour").agg(F.min("utilization").alias("least"), F.max("utilization").alias("most"), production.alias("production")).withColumn(
        "relative_range", (F.col("most") - F.col("least")) / F.nullif(F.col("production"), F.lit(0.0))
    )


def idle_findings(line: DataFrame, ports: DataFrame, production: DataFrame) -> DataFrame:
    """definition, station_group (all, single_port, multi_port by production ports), hour: idle minutes, and those at full occupancy.

    ``ports``: station_key, definition, ports; ``production``: station_key, ports.
    Groups are given under every definition.
    """
    group = F.when(F.col("own") == 1, "single_port").otherwise("multi_port")
    found = I.idle_by_definition(line, ports).join(production.select("station_key", F.col("ports").alias("own")), "station_key")
    each = found.select("*", F.explode(F.array(F.lit("all"), group)).alias("station_group"))
    return each.groupBy("definition", "station_group", "hour").agg((F.sum("seconds") / 60).alias("idle_minutes"), (F.sum("blocked_s") / 60).alias("blocked_minutes"))


def idle_totals(line: DataFrame, ports: DataFrame, production: DataFrame) -> DataFrame:
    """definition, station_group: idle, connected and charging minutes, idle at full occupancy, their shares and ratio, and stations.

    Of sessions that end after they start; ``stations`` counts all of ``line``.
    """
    real = line.filter("end_utc is not null and e > s")
    used = real.groupBy("station_key").agg(F.sum("connected_minutes").alias("connected"), F.sum("charging_minutes").alias("charging"))
    idle = I.idle_by_definition(line, ports).groupBy("station_key", "definition").agg((F.sum("seconds") / 60).alias("idle"), (F.sum("blocked_s") / 60).alias("full"))
    group = F.when(F.col("own") == 1, "single_port").otherwise("multi_port")
    known = line.select("station_key").distinct().join(ports, "station_key").join(production.select("station_key", F.col("ports").alias("own")), "station_key")
    each = known.join(used, "station_key", "left").join(idle, ["station_key", "definition"], "left").select("*", F.explode(F.array(F.lit("all"), group)).alias("station_group"))
    total = lambda n: F.coalesce(F.sum(n), F.lit(0.0)).alias(n)
    # A station counts from half a second on: what is left of differences of sums is no time.
    sums = each.groupBy("definition", "station_group").agg(*map(total, ("idle", "full", "connected", "charging")), F.count(F.when(F.col("full") > 0.5 / 60, 1)).alias("stations_with_full_occupancy_idle"), F.count("*").alias("stations"))
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0.0))
    return sums.select(
        "definition", "station_group", F.col("idle").alias("idle_minutes"), F.col("full").alias("full_occupancy_idle_minutes"), F.col("connected").alias("connected_minutes"), F.col("charging").alias("charging_minutes"),
        share("idle", "connected").alias("idle_share_of_connected"), share("full", "connected").alias("full_occupancy_idle_share_of_connected"), share("full", "idle").alias("full_occupancy_share_of_idle"),
        F.when(F.col("full") > 0.5 / 60, share("idle", "full")).alias("idle_to_full_occupancy_ratio"), "stations_with_full_occupancy_idle", "stations",
    )
