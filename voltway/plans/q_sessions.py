"""Queries over the conformed session tables, each with DuckDB SQL from ``oracle``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltway.functions import columns as C
from voltway.operators import gold, incremental
from voltway.operators import intervals as I
from voltway.operators import checks, profiling, quantiles, reconcile, source_profile
from voltway.operators import sessions as S
from voltway.plans.oracle import with_tables
from voltway.sources import warehouse

QUERIES, ORACLE = {}, {}


def query(sql: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(warehouse.opened(spark, sf_dir))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, with_tables(sql)
        return f

    return add


def r6(c: Column | str, name: str | None = None) -> Column:
    name = name or (c if isinstance(c, str) else None)
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def epoch(c: str) -> Column:
    return F.unix_seconds(c)


@query("SELECT source, round(sum(connected_minutes) / nullif(sum(available_minutes), 0), 6) AS connected_utilization, round(sum(charging_minutes) / nullif(sum(available_minutes), 0), 6) AS charging_utilization, count(*) AS station_days FROM station_day WHERE NOT is_excluded GROUP BY 1")
def utilization_by_source(w):
    found = gold.utilization_by_source(w.days)
    return found.select("source", r6("connected_utilization"), r6("charging_utilization"), "station_days")


@query("SELECT object_id, source, family, station_key, site_key, port_id, CAST(epoch(start_utc) AS BIGINT) AS start_s, CAST(epoch(end_utc) AS BIGINT) AS end_s, round(energy_kwh, 6) AS energy_kwh, round(charging_minutes, 6) AS charging_minutes, round(connected_minutes, 6) AS connected_minutes, round(reported_minutes, 6) AS reported_minutes, round(idle_minutes, 6) AS idle_minutes, round(implied_kw, 6) AS implied_kw, precision_seconds, is_non_trivial, list_aggregate(flags, 'string_agg', ',') AS flags FROM sessions")
def sessions_unioned(w):
    return w.sessions.select(
        "object_id", "source", "family", "station_key", "site_key", "port_id", epoch("start_utc").alias("start_s"), epoch("end_utc").alias("end_s"),
        *(r6(n) for n in ("energy_kwh", "charging_minutes", "connected_minutes", "reported_minutes", "idle_minutes", "implied_kw")), "precision_seconds", "is_non_trivial",
        C.joined_or_null(F.col("flags")).alias("flags"),
    )


@query("SELECT object_id, source, family, station_key, reasons[1] AS primary_reason, list_aggregate(reasons, 'string_agg', ',') AS reasons, list_aggregate(flags, 'string_agg', ',') AS flags, round(energy_kwh, 6) AS energy_kwh, round(connected_minutes, 6) AS connected_minutes FROM judged WHERE len(reasons) > 0")
def sessions_quarantined(w):
    return S.quarantined(w.rows).select(
        "object_id", "source", "family", "station_key", "primary_reason", C.joined_or_null(F.col("reasons")).alias("reasons"), C.joined_or_null(F.col("flags")).alias("flags"),
        r6("energy_kwh"), r6("connected_minutes"),
    )


@query("SELECT source, reason, count(*) AS n FROM (SELECT source, unnest(reasons) AS reason FROM judged) GROUP BY 1, 2")
def reason_counts(w):
    return w.rows.select("source", F.explode("reasons").alias("reason")).groupBy("source", "reason").agg(F.count("*").alias("n"))


@query("SELECT source, flag, count(*) AS n FROM (SELECT source, unnest(flags) AS flag FROM sessions) GROUP BY 1, 2")
def flag_counts(w):
    return w.sessions.select("source", F.explode("flags").alias("flag")).groupBy("source", "flag").agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS rows_all, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS accepted, count(CASE WHEN len(reasons) > 0 THEN 1 END) AS rejected, round(sum(energy_kwh), 4) AS kwh FROM judged GROUP BY 1")
def rows_conserved(w):
    ok = F.col("primary_reason").isNull()
    return w.rows.groupBy("source").agg(
        F.count("*").alias("rows_all"), F.count(F.when(ok, 1)).alias("accepted"), F.count(F.when(~ok, 1)).alias("rejected"), F.round(F.sum("energy_kwh"), 4).alias("kwh")
    )


@query("SELECT object_id, exact_rank, key_rank FROM ranked")
def dedup_ranks(w):
    return S.ranked(w.rows)


@query("SELECT source, station_key, object_id FROM (SELECT *, row_number() OVER (PARTITION BY source, station_key, CAST(start_local AS DATE) ORDER BY charging_minutes DESC NULLS LAST, object_id) AS k FROM sessions) WHERE k = 1")
def dedup_prefer_larger(w):
    order = Window.partitionBy("source", "station_key", F.to_date("start_local")).orderBy(F.col("charging_minutes").desc_nulls_last(), "object_id")
    return w.sessions.withColumn("k", F.row_number().over(order)).filter("k = 1").select("source", "station_key", "object_id")


@query("SELECT object_id, station_key, CAST(epoch(start_utc) AS BIGINT) AS start_s, is_nonexistent FROM measured WHERE start_local IS NOT NULL")
def local_to_utc_sessions(w):
    return S.measured(w.typed).filter("start_local is not null").select("object_id", "station_key", epoch("start_utc").alias("start_s"), "is_nonexistent")


@query("SELECT station_key, object_id, CAST(t AS BIGINT) AS t, d, CAST(level AS BIGINT) AS level FROM sweep")
def concurrency_running(w):
    return I.sweep(w.line).select("station_key", "object_id", F.col("t").cast("long").alias("t"), "d", "level")


@query("SELECT station_key, CAST(level AS INTEGER) AS level, days FROM at_level")
def days_at_level(w):
    return I.days_at_level(w.levels, most=I.MOST_LEVELS)


@query("SELECT station_key, CAST(robust_max AS INTEGER) AS robust_max, CAST(plain_max AS INTEGER) AS plain_max FROM ports")
def robust_max(w):
    return I.robust_max(I.days_at_level(w.levels, most=I.MOST_LEVELS))


@query("SELECT station_key, n, CAST(coalesce(max(CASE WHEN days >= n THEN level END), 0) AS INTEGER) AS robust_max FROM at_level, (VALUES (1), (2), (3), (5), (10)) v(n) GROUP BY 1, 2")
def robust_max_distribution(w):
    each = I.days_at_level(w.levels, most=I.MOST_LEVELS).groupBy("station_key").agg(*(F.coalesce(I.reached(n), F.lit(0)).alias(f"n{n}") for n in gold.N_VALUES))
    return each.select("station_key", F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.col(f"n{n}").alias("robust_max")) for n in gold.N_VALUES))).alias("x")).select("station_key", "x.*")


@query("SELECT station_key, CAST(ports AS BIGINT) AS ports, ports_source FROM dim")
def ports_inferred(w):
    return w.dim.select("station_key", "ports", "ports_source")


@query("SELECT station_key, source, strftime(gap_after, '%Y-%m-%d') AS gap_after, strftime(gap_before, '%Y-%m-%d') AS gap_before, round(gap_days, 6) AS gap_days, CAST(excluded_days AS BIGINT) AS excluded_days FROM long_gaps")
def station_gaps(w):
    day = lambda n: F.date_format(n, "yyyy-MM-dd").alias(n)
    return w.gaps.select("station_key", "source", day("gap_after"), day("gap_before"), r6("gap_days"), F.col("excluded_days").cast("long").alias("excluded_days"))


@query("SELECT station_key, strftime(active_from, '%Y-%m-%d') AS active_from, strftime(active_to, '%Y-%m-%d') AS active_to, active_to - active_from + 1 AS window_days, active_days, active_days < 5 AS low_evidence FROM dim")
def active_window(w):
    day = lambda n: F.date_format(n, "yyyy-MM-dd").alias(n)
    return w.dim.select("station_key", day("active_from"), day("active_to"), F.col("window_days").cast("long").alias("window_days"), "active_days", "low_evidence")


@query("SELECT station_key, site_key FROM dim")
def majority_site(w):
    return w.dim.select("station_key", "site_key")


@query("SELECT station_key, source, operator_key, site_key, unit AS station_name_raw, zone, sites > 1 AS multi_site_key, operators > 1 AS multi_operator, sites AS site_key_candidates, operators AS operator_candidates, 'unit' AS capacity_grain, CAST(ports AS BIGINT) AS ports, ports_source, CAST(robust_max AS BIGINT) AS robust_max, CAST(plain_max AS BIGINT) AS plain_max, connector_ids, active_days < 5 AS low_evidence, sessions, active_days, active_to - active_from + 1 AS window_days, excluded_days, excluded_gaps FROM dim")
def dim_station(w):
    long = ("robust_max", "plain_max", "window_days")
    return w.dim.select(*(F.col(n).cast("long").alias(n) if n in long else F.col(n) for n in w.dim.columns if n not in ("active_from", "active_to")))


@query("SELECT strftime(d, '%Y-%m-%d') AS date_key, year(d) AS year, month(d) AS month, day(d) AS day_of_month, isodow(d) AS iso_day_of_week, isodow(d) >= 6 AS is_weekend, strftime(d, '%Y-%m') AS year_month FROM (SELECT CAST(unnest(generate_series((SELECT min(active_from) FROM stations), (SELECT max(active_to) FROM stations), INTERVAL 1 DAY)) AS DATE) AS d)")
def dim_date(w):
    ints = ("year", "month", "day_of_month", "iso_day_of_week")
    return gold.dim_date(w.dim).select(
        F.date_format("date_key", "yyyy-MM-dd").alias("date_key"), *(F.col(n).cast("long").alias(n) for n in ints), "is_weekend", "year_month"
    )


@query("SELECT 'gamma/' || coalesce(site_key, '<null>') AS operator_key, coalesce(site_key, '<null>') AS operator_name, source, 'gamma' AS parent_operator_key, 'GB' AS country, 'Europe/London' AS timezone FROM (SELECT DISTINCT site_key, source FROM sessions WHERE source = 'gamma') UNION ALL SELECT * FROM (VALUES ('alpha', 'Alpha City', 'alpha', NULL, 'US', 'America/Denver'), ('beta', 'Beta Town', 'beta', NULL, 'US', 'America/New_York'), ('gamma', 'Gamma Survey', 'gamma', NULL, 'GB', 'Europe/London'))")
def dim_operator(w):
    return gold.dim_operator(w.fact)


@query("SELECT object_id, source, family, operator_key, station_key, delivery_block, is_ambiguous, round(energy_kwh, 6) AS energy_kwh, round(charging_minutes, 6) AS charging_minutes, is_non_trivial, list_aggregate(flags, 'string_agg', ',') AS flags FROM sessions")
def fct_charging_session(w):
    return w.fact.select("object_id", "source", "family", "operator_key", "station_key", "delivery_block", "is_ambiguous", r6("energy_kwh"), r6("charging_minutes"), "is_non_trivial", "flags")


@query("SELECT object_id, source, station_key FROM sessions WHERE source <> 'beta' UNION ALL SELECT object_id, source, station_key FROM sessions WHERE source = 'beta' AND object_id % 2 = 0")
def fact_refresh(w):
    """A new delivery of one source replaces its rows; the others' stay untouched."""
    fresh = w.sessions.filter("source <> 'beta' or object_id % 2 = 0")
    files = w.files.withColumn("sha256", F.when(F.col("source") == "beta", F.lit("new")).otherwise(F.col("sha256")))
    return gold.refreshed(w.fact, fresh, files).select("object_id", "source", "station_key")


@query("SELECT 'fct_charging_session' AS relation, count(*) AS n FROM sessions UNION ALL SELECT 'int_station_gaps', count(*) FROM long_gaps UNION ALL SELECT 'dim_station', count(*) FROM dim UNION ALL SELECT 'fct_station_day', count(*) FROM spine UNION ALL SELECT 'mart_monthly', count(*) FROM (SELECT DISTINCT source, operator_key, strftime(day, '%Y-%m') FROM spine)")
def warehouse_build(w):
    """All layers written; rows of each gold table."""
    return w.build()


@query("SELECT object_id, delivery_block FROM judged WHERE source = 'alpha'")
def delivery_blocks(w):
    return w.typed.filter("source = 'alpha'").select("object_id", "delivery_block")


@query("SELECT station_key, strftime(day, '%Y-%m-%d') AS day, round(day_minutes, 3) AS day_minutes, is_excluded FROM spine_days")
def station_day_spine(w):
    out = I.excluded_days(w.gaps).withColumn("is_excluded", F.lit(True))
    found = I.spine(w.dim).join(out, ["station_key", "day"], "left")
    return found.select("station_key", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("day_minutes", 3).alias("day_minutes"), F.coalesce("is_excluded", F.lit(False)).alias("is_excluded"))


@query("SELECT object_id, strftime(day, '%Y-%m-%d') AS day, round(connected_piece, 4) AS connected_piece, round(charging_piece, 4) AS charging_piece FROM allocated")
def midnight_pieces(w):
    found = I.pieces(w.sessions)
    return found.select("object_id", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("connected_piece", 4).alias("connected_piece"), F.round("charging_piece", 4).alias("charging_piece"))


@query("SELECT source, strftime(day, '%Y-%m-%d') AS day, round(sum(energy_piece), 4) AS energy_kwh FROM allocated GROUP BY 1, 2")
def energy_allocation(w):
    found = I.pieces(w.sessions).groupBy("source", F.date_format("day", "yyyy-MM-dd").alias("day"))
    return found.agg(F.round(F.sum("energy_piece"), 4).alias("energy_kwh"))


@query("SELECT station_key, strftime(day, '%Y-%m-%d') AS day, source, operator_key, 'unit' AS capacity_grain, CAST(ports AS BIGINT) AS ports, is_excluded, round(available_minutes, 3) AS available_minutes, sessions, trivial_sessions, round(energy_kwh, 4) AS energy_kwh, round(charging_minutes, 4) AS charging_minutes, round(connected_minutes, 4) AS connected_minutes, charging_pieces, connected_pieces, round(idle_minutes, 4) AS idle_minutes FROM station_day")
def fct_station_day(w):
    r4 = lambda n: F.round(n, 4).alias(n)
    return w.days.select(
        "station_key", F.date_format("day", "yyyy-MM-dd").alias("day"), "source", "operator_key", "capacity_grain", "ports", "is_excluded", F.round("available_minutes", 3).alias("available_minutes"),
        "sessions", "trivial_sessions", "charging_pieces", "connected_pieces", *map(r4, ("energy_kwh", "charging_minutes", "connected_minutes", "idle_minutes")),
    )


MONTH = "SELECT source, operator_key, strftime(day, '%Y-%m') AS year_month, count(*) AS station_days, count(CASE WHEN is_excluded THEN 1 END) AS excluded_days, count(DISTINCT station_key) AS stations, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(trivial_sessions) AS BIGINT) AS trivial_sessions, CAST(sum(charging_pieces) AS BIGINT) AS charging_pieces, CAST(sum(connected_pieces) AS BIGINT) AS connected_pieces, round(sum(energy_kwh), 3) AS energy_kwh, round(sum(charging_minutes), 3) AS charging_minutes, round(sum(connected_minutes), 3) AS connected_minutes, round(sum(idle_minutes), 3) AS idle_minutes, round(sum(available_minutes), 3) AS available_minutes FROM station_day GROUP BY 1, 2, 3"


@query(MONTH)
def mart_monthly(w):
    m = w.monthly
    r3 = ("energy_kwh", "charging_minutes", "connected_minutes", "idle_minutes", "available_minutes")
    return m.select(*(F.round(n, 3).alias(n) if n in r3 else F.col(n) for n in m.columns))


@query("SELECT source, round(sum(charging_minutes) / sum(available_minutes), 6) AS ratio_of_sums, round(avg(charging_minutes / available_minutes), 6) AS mean_of_ratios FROM station_day WHERE NOT is_excluded AND charging_minutes IS NOT NULL GROUP BY 1")
def mean_vs_ratio_of_sums(w):
    d = w.days.filter("not is_excluded and charging_minutes is not null")
    return d.groupBy("source").agg(
        r6(C.utilization(F.col("charging_minutes"), F.col("available_minutes")), "ratio_of_sums"), r6(F.avg(F.col("charging_minutes") / F.col("available_minutes")), "mean_of_ratios")
    )


WINDOWS = "(SELECT w.station_key, t AS bs, be FROM (SELECT *, lead(t) OVER (PARTITION BY station_key ORDER BY t, d, object_id) AS be FROM sweep) w JOIN dim USING (station_key) WHERE level >= ports AND be > t)"
IDLE = "(SELECT station_key, object_id, s + round(charging_minutes * 60) AS i0, e AS i1 FROM timeline WHERE charging_minutes IS NOT NULL AND end_utc IS NOT NULL AND e > s AND e > s + round(charging_minutes * 60))"


@query(f"SELECT station_key, CAST(bs AS BIGINT) AS bs, CAST(be AS BIGINT) AS be FROM {WINDOWS}")
def blocking_windows(w):
    return I.blocking_windows(I.sweep(w.line), w.dim.select("station_key", "ports")).select("station_key", F.col("bs").cast("long").alias("bs"), F.col("be").cast("long").alias("be"))


@query(f"SELECT i.station_key, round(sum(i1 - i0), 3) AS idle_s, count(*) AS idle_sessions, round(coalesce(sum((SELECT sum(least(i1, be) - greatest(i0, bs)) FROM {WINDOWS} w WHERE w.station_key = i.station_key AND bs < i1 AND be > i0)), 0), 3) AS blocked_s FROM {IDLE} i GROUP BY 1")
def full_occupancy_idle(w):
    found = I.full_occupancy_idle(w.line, w.dim)
    return found.select("station_key", F.round("idle_s", 3).alias("idle_s"), "idle_sessions", F.round(F.coalesce("blocked_s", F.lit(0.0)), 3).alias("blocked_s"))


@query(f"SELECT CAST(h % 24 AS INTEGER) AS hour, round(sum(least(l1, (h + 1) * 3600.0) - greatest(l0, h * 3600.0)) / 60.0, 3) AS minutes FROM (SELECT l0, l1, unnest(range(CAST(floor(l0 / 3600) AS BIGINT), CAST(ceil(l1 / 3600) AS BIGINT))) AS h FROM (SELECT i0 + epoch(start_local) - s AS l0, i1 + epoch(start_local) - s AS l1 FROM {IDLE} i JOIN timeline USING (station_key, object_id))) GROUP BY 1")
def idle_hour_profile(w):
    return I.by_hours(I.idle_intervals(w.line)).groupBy("hour").agg(F.round(F.sum(F.col("i1") - F.col("i0")) / 60, 3).alias("minutes"))


PORT_COUNTS = """(SELECT station_key, 'robust_max_n' || n AS definition, greatest(coalesce(max(CASE WHEN days >= n THEN level END), 0), 1) AS ports FROM at_level, (VALUES (1), (2), (3), (5), (10)) v(n) GROUP BY station_key, n
  UNION ALL SELECT station_key, 'production', ports FROM dim)"""
FINDINGS = f"""SELECT * FROM (WITH port_counts AS {PORT_COUNTS},
spans AS (SELECT station_key, t AS bs, lead(t) OVER (PARTITION BY station_key ORDER BY t, d, object_id) AS be, level FROM sweep),
windows AS (SELECT definition, station_key, bs, be FROM spans JOIN port_counts USING (station_key) WHERE level >= ports AND be > bs),
local_idle AS (SELECT i.*, epoch(start_local) - s AS shift FROM {IDLE} i JOIN timeline USING (station_key, object_id)),
hours AS (SELECT *, unnest(range(CAST(floor((i0 + shift) / 3600) AS BIGINT), CAST(ceil((i1 + shift) / 3600) AS BIGINT))) AS h FROM local_idle),
cut AS (SELECT station_key, h % 24 AS hour, greatest(i0, h * 3600.0 - shift) AS c0, least(i1, (h + 1) * 3600.0 - shift) AS c1, row_number() OVER () AS row FROM hours),
inside AS (SELECT definition, row, sum(least(c1, be) - greatest(c0, bs)) AS b FROM cut JOIN windows USING (station_key) WHERE bs < c1 AND be > c0 GROUP BY 1, 2),
each AS (SELECT p.definition, CASE WHEN dim.ports = 1 THEN 'single_port' ELSE 'multi_port' END AS own, hour, c1 - c0 AS a, coalesce(b, 0) AS b FROM cut JOIN port_counts p USING (station_key) JOIN dim USING (station_key) LEFT JOIN inside i ON i.definition = p.definition AND i.row = cut.row)
SELECT definition, g.station_group, CAST(hour AS INTEGER) AS hour, round(sum(a) / 60, 3) AS idle_minutes, round(sum(b) / 60, 3) AS blocked_minutes
FROM each, (VALUES ('all'), ('single_port'), ('multi_port')) g(station_group) WHERE g.station_group = 'all' OR g.station_group = own GROUP BY 1, 2, 3)"""


@query(FINDINGS)
def idle_findings(w):
    """Idle minutes by local hour, and those at full occupancy under six port counts, for all, single- and multi-port stations."""
    ports = gold.fixed_ports(w.dim, I.days_at_level(w.levels, most=I.MOST_LEVELS)).filter("definition <> 'connector_ids'")
    found = gold.idle_findings(w.line, ports, w.dim.select("station_key", "ports"))
    return found.select("definition", "station_group", "hour", F.round("idle_minutes", 3).alias("idle_minutes"), F.round("blocked_minutes", 3).alias("blocked_minutes"))


TOTALS = FINDINGS.split("SELECT definition, g.station_group")[0] + """, per AS (
  SELECT definition, station_key, any_value(own) AS own, sum(a) / 60 AS idle, sum(b) / 60 AS full_idle FROM (SELECT each.*, cut_station AS station_key FROM each) GROUP BY 1, 2),
used AS (SELECT station_key, sum(connected_minutes) AS connected, sum(charging_minutes) AS charging FROM timeline WHERE end_utc IS NOT NULL AND e > s GROUP BY 1),
stations_of AS (SELECT definition, station_key, CASE WHEN dim.ports = 1 THEN 'single_port' ELSE 'multi_port' END AS own FROM port_counts JOIN dim USING (station_key)),
sums AS (SELECT definition, g.station_group, coalesce(sum(idle), 0) AS i, coalesce(sum(full_idle), 0) AS f, coalesce(sum(connected), 0) AS c, coalesce(sum(charging), 0) AS h, count(CASE WHEN full_idle > 0 THEN 1 END) AS k, count(*) AS n
  FROM stations_of s LEFT JOIN used USING (station_key) LEFT JOIN (SELECT definition, station_key, idle, full_idle FROM per) USING (definition, station_key), (VALUES ('all'), ('single_port'), ('multi_port')) g(station_group)
  WHERE g.station_group = 'all' OR g.station_group = own GROUP BY 1, 2)
SELECT definition, station_group, round(i, 3) AS idle_minutes, round(f, 3) AS full_occupancy_idle_minutes, round(c, 3) AS connected_minutes, round(h, 3) AS charging_minutes, round(i / nullif(c, 0), 6) AS idle_share_of_connected,
  round(f / nullif(c, 0), 6) AS full_occupancy_idle_share_of_connected, round(f / nullif(i, 0), 6) AS full_occupancy_share_of_idle, round(i / nullif(f, 0), 3) AS idle_to_full_occupancy_ratio, k AS stations_with_full_occupancy_idle, n AS stations FROM sums)"""
TOTALS = TOTALS.replace("AS own, hour, c1 - c0", "AS own, cut.station_key AS cut_station, hour, c1 - c0")


@query(TOTALS)
def occupancy_findings(w):
    """Shares of idle time, and of idle time at full occupancy, under six port counts, for all, single- and multi-port stations."""
    ports = gold.fixed_ports(w.dim, I.days_at_level(w.levels, most=I.MOST_LEVELS)).filter("definition <> 'connector_ids'")
    found = gold.idle_totals(w.line, ports, w.dim.select("station_key", "ports"))
    return found.select(*(c if c in ("definition", "station_group") or c.startswith("stations") else F.round(c, 3 if c.endswith(("minutes", "ratio")) else 6).alias(c) for c in found.columns))


@query("SELECT d.station_key, strftime(d.day, '%Y-%m-%d') AS day, CAST(CASE WHEN d.day > any_value(l.last) THEN 1 ELSE greatest(coalesce(max(m.level), 1), 1) END AS BIGINT) AS ports FROM spine d LEFT JOIN (SELECT station_key, max(day) AS last FROM day_max GROUP BY 1) l USING (station_key) LEFT JOIN day_max m ON m.station_key = d.station_key AND m.day <= d.day AND m.day > d.day - 90 GROUP BY 1, d.day")
def trailing_90d_ports(w):
    found = I.trailing_ports(w.levels, I.spine(w.dim))
    return found.select("station_key", F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("ports").cast("long").alias("ports"))


@query("SELECT n, source, round(sum(charging_minutes) / nullif(sum(day_minutes * greatest(p.robust_max, 1)), 0), 6) AS charging, round(sum(connected_minutes) / nullif(sum(day_minutes * greatest(p.robust_max, 1)), 0), 6) AS connected FROM station_day d JOIN (SELECT station_key, n, coalesce(max(CASE WHEN days >= n THEN level END), 0) AS robust_max FROM at_level, (VALUES (1), (2), (3), (5), (10)) v(n) GROUP BY 1, 2) p USING (station_key) WHERE NOT is_excluded GROUP BY 1, 2")
def sensitivity_grid(w):
    """The five robust maxima under the production session rule."""
    ports = gold.fixed_ports(w.dim, I.days_at_level(w.levels, most=I.MOST_LEVELS)).filter("definition like 'robust%'").select("station_key", F.regexp_extract("definition", r"(\d+)$", 1).cast("int").alias("n"), F.col("ports").alias("p"))
    available = F.col("day_minutes") * F.col("p")
    return w.days.filter("not is_excluded").join(ports, "station_key").groupBy("n", "source").agg(
        r6(C.utilization(F.col("charging_minutes"), available), "charging"), r6(C.utilization(F.col("connected_minutes"), available), "connected")
    )


SENSITIVITY = """SELECT * FROM (WITH
rule_line AS (
  SELECT 'non_trivial_only' AS session_rule, station_key, object_id, s, e, start_day AS day FROM timeline UNION ALL SELECT 'all_sessions', station_key, object_id, s, e, start_day FROM all_line),
rule_moves AS (
  SELECT session_rule, station_key, object_id, s AS t, 1 AS d, day FROM rule_line UNION ALL SELECT session_rule, station_key, object_id, e, -1, NULL FROM rule_line),
rule_max AS (
  SELECT session_rule, station_key, day, max(level) AS level
  FROM (SELECT *, sum(d) OVER (PARTITION BY session_rule, station_key ORDER BY t, d, object_id ROWS UNBOUNDED PRECEDING) AS level FROM rule_moves) WHERE d = 1 GROUP BY 1, 2, 3),
rule_level AS (
  SELECT session_rule, station_key, lv.k AS level, count(*) AS days FROM rule_max, (SELECT unnest(range(1, 9)) AS k) lv WHERE rule_max.level >= lv.k GROUP BY 1, 2, 3),
robust AS (
  SELECT session_rule, station_key, n, any_value(connector_ids) AS c, greatest(coalesce(max(CASE WHEN days >= n THEN level END), 0), 1) AS p
  FROM dim CROSS JOIN (VALUES ('non_trivial_only'), ('all_sessions')) r(session_rule) CROSS JOIN (VALUES (1), (2), (3), (5), (10)) v(n) LEFT JOIN rule_level USING (session_rule, station_key) GROUP BY 1, 2, 3),
fixed AS (
  SELECT session_rule, station_key, 'robust_max_n' || n AS definition, p FROM robust UNION ALL
  SELECT session_rule, station_key, 'connector_ids', CASE WHEN c > 0 THEN c ELSE p END FROM robust WHERE n = 5 UNION ALL
  SELECT session_rule, station_key, 'production', greatest(c, p) FROM robust WHERE n = 5),
defined AS (
  SELECT session_rule, station_key, day, definition, p FROM spine JOIN fixed USING (station_key) UNION ALL
  SELECT r.session_rule, d.station_key, d.day, 'trailing_90d_max', CASE WHEN d.day > any_value(l.last) THEN 1 ELSE greatest(coalesce(max(m.level), 1), 1) END
  FROM spine d CROSS JOIN (VALUES ('non_trivial_only'), ('all_sessions')) r(session_rule)
  LEFT JOIN (SELECT session_rule, station_key, max(day) AS last FROM rule_max GROUP BY 1, 2) l ON l.session_rule = r.session_rule AND l.station_key = d.station_key
  LEFT JOIN rule_max m ON m.session_rule = r.session_rule AND m.station_key = d.station_key AND m.day <= d.day AND m.day > d.day - 90 GROUP BY r.session_rule, d.station_key, d.day),
measured AS (
  SELECT session_rule, definition, source, day_minutes * p AS available, connected_minutes, charging_minutes FROM station_day JOIN defined USING (station_key, day) WHERE NOT is_excluded),
flavoured AS (
  SELECT *, 'connected' AS flavour, connected_minutes AS used FROM measured UNION ALL SELECT *, 'charging', charging_minutes FROM measured)
SELECT session_rule, definition, source, flavour, round(sum(used) / nullif(sum(available), 0), 6) AS utilization, count(*) AS station_days, count(used) AS with_measure,
  CASE WHEN count(used) > 0 THEN count(CASE WHEN used > available THEN 1 END) END AS over_full
FROM flavoured GROUP BY 1, 2, 3, 4)"""


def sensitivity_of(w):
    return gold.sensitivity(w.dim, w.days, {"non_trivial_only": w.levels, "all_sessions": w.all_levels})


@query(SENSITIVITY)
def sensitivity_table(w):
    """All eight port definitions under both session rules."""
    return sensitivity_of(w).withColumn("utilization", F.round("utilization", 6))


@query(f"SELECT source, flavour, min(utilization) AS least, max(utilization) AS most, max(CASE WHEN definition = 'production' THEN utilization END) AS production FROM ({SENSITIVITY}) WHERE session_rule = 'non_trivial_only' AND utilization IS NOT NULL GROUP BY 1, 2")
def utilization_ranges(w):
    """How far the choice of port definition moves each utilization."""
    found = gold.utilization_ranges(sensitivity_of(w))
    return found.select("source", "flavour", *(F.round(n, 6).alias(n) for n in ("least", "most", "production")))


@query("SELECT source, round(quantile_cont(gap, 0.5), 4) AS p50, round(quantile_cont(gap, 0.9), 4) AS p90, round(quantile_cont(gap, 0.99), 4) AS p99, round(max(gap), 4) AS p100, count(CASE WHEN gap > 1 THEN 1 END) AS over_a_day FROM (SELECT source, (lead(s) OVER (PARTITION BY station_key ORDER BY s, e, object_id) - e) / 86400.0 AS gap FROM timeline) WHERE gap IS NOT NULL GROUP BY 1")
def inter_session_gap_quantiles(w):
    line = w.line.select("source", "station_key", "s", "e", "object_id")
    found = I.following(line, "station_key", "s", ["s", "e", "object_id"], ["s"])
    g = found.select("source", ((F.col("next_s") - F.col("e")) / 86400.0).alias("gap")).filter("gap is not null")
    names = {0.5: "p50", 0.9: "p90", 0.99: "p99", 1.0: "p100"}
    wide = quantiles.exact(g, ["source"], "gap", list(names)).groupBy("source").agg(*(F.round(F.max(F.when(F.col("q") == q, F.col("value"))), 4).alias(n) for q, n in names.items()))
    return wide.join(g.groupBy("source").agg(F.count(F.when(F.col("gap") > 1, 1)).alias("over_a_day")), "source")


IDENTITY_I = """SELECT source, coalesce(strftime(start_local, '%Y-%m'), 'unparsed') AS year_month, count(*) AS raw_rows, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS fact_rows, count(CASE WHEN len(reasons) > 0 THEN 1 END) AS quarantined_rows,
  count(CASE WHEN len(reasons) = 0 AND is_non_trivial AND NOT contains(station_key, '/unknown/') THEN 1 END) AS counted, count(CASE WHEN len(reasons) = 0 AND NOT is_non_trivial THEN 1 END) AS trivial,
  count(CASE WHEN len(reasons) = 0 AND is_non_trivial AND contains(station_key, '/unknown/') THEN 1 END) AS unknown, round(sum(energy_kwh), 3) AS raw_kwh, round(sum(CASE WHEN len(reasons) = 0 THEN energy_kwh END), 3) AS fact_kwh
  FROM judged GROUP BY 1, 2"""


@query(IDENTITY_I.replace("GROUP BY 1, 2", "GROUP BY 1, 2 UNION ALL " + IDENTITY_I.replace("coalesce(strftime(start_local, '%Y-%m'), 'unparsed') AS year_month", "'__total__'").replace("GROUP BY 1, 2", "GROUP BY 1")))
def reconcile_identity_i(w):
    """Raw rows are fact and quarantined rows; fact rows are counted, trivial or of unknown stations; per month and in total."""
    return reconcile.identity_i(w.rows).withColumn("raw_kwh", F.round("raw_kwh", 3)).withColumn("fact_kwh", F.round("fact_kwh", 3))


@query("SELECT source, month, round(coalesce(a, 0), 3) AS counted_kwh, round(coalesce(b, 0), 3) AS station_day_kwh, abs(round(coalesce(a, 0) - coalesce(b, 0), 3)) AS spill_kwh FROM (SELECT source, strftime(start_local, '%Y-%m') AS month, sum(energy_kwh) AS a FROM timeline GROUP BY 1, 2) FULL JOIN (SELECT source, strftime(day, '%Y-%m') AS month, sum(energy_kwh) AS b FROM station_day GROUP BY 1, 2) USING (source, month)")
def midnight_spill(w):
    """What moves between months because pieces count on their own date."""
    found = reconcile.spill(w.line, w.days)
    return found.select("source", "month", F.round("counted_kwh", 3).alias("counted_kwh"), F.round("station_day_kwh", 3).alias("station_day_kwh"), F.abs(F.round("spill_kwh", 3)).alias("spill_kwh"))


@query("SELECT s.source, round(s.kwh, 3) AS session_kwh, round(d.kwh, 3) AS piece_kwh, abs(s.kwh - d.kwh) <= 1e-6 * greatest(abs(s.kwh), 1) AS conserved FROM (SELECT source, sum(energy_kwh) AS kwh FROM sessions GROUP BY 1) s JOIN (SELECT source, sum(energy_piece) AS kwh FROM allocated GROUP BY 1) d USING (source)")
def reconcile_identity_ii(w):
    accepted = w.sessions
    whole = accepted.groupBy("source").agg(F.sum("energy_kwh").alias("a"))
    parts = I.pieces(accepted).groupBy("source").agg(F.sum("energy_piece").alias("b"))
    close = F.abs(F.col("a") - F.col("b")) <= 1e-6 * F.greatest(F.abs("a"), F.lit(1.0))
    return whole.join(parts, "source").select("source", F.round("a", 3).alias("session_kwh"), F.round("b", 3).alias("piece_kwh"), close.alias("conserved"))


@query("SELECT q.source, CASE WHEN q.source = 'gamma' AND s.family IN ('rapids', 'fasts') AND q.family NOT IN ('rapids', 'fasts') THEN 'same_event_in_raw_file' WHEN s.family = q.family THEN 'within_family' ELSE 'other' END AS bucket, count(*) AS n FROM judged q LEFT JOIN sessions s ON q.source = s.source AND q.unit IS NOT DISTINCT FROM s.unit AND q.port_id IS NOT DISTINCT FROM s.port_id AND q.key_start IS NOT DISTINCT FROM s.key_start AND q.key_end IS NOT DISTINCT FROM s.key_end AND q.key_kwh IS NOT DISTINCT FROM s.key_kwh WHERE q.reasons[1] = 'natural_key_duplicate' GROUP BY 1, 2")
def duplicate_twin_buckets(w):
    return reconcile.duplicates_by_twin(w.rows, w.fact)


@query("SELECT source, primary_reason, twin_family, twin_status, count(*) AS n FROM (SELECT q.source, q.reasons[1] AS primary_reason, coalesce(s.family, '<none>') AS twin_family, CASE WHEN s.object_id IS NULL THEN '<none>' WHEN len(s.reasons) = 0 THEN 'accepted' ELSE 'quarantined' END AS twin_status FROM judged q LEFT JOIN judged s ON s.exact_rank = 1 AND s.key_rank = 1 AND q.source = s.source AND q.unit IS NOT DISTINCT FROM s.unit AND q.port_id IS NOT DISTINCT FROM s.port_id AND q.key_start IS NOT DISTINCT FROM s.key_start AND q.key_end IS NOT DISTINCT FROM s.key_end AND q.key_kwh IS NOT DISTINCT FROM s.key_kwh WHERE q.family = 'rapids_anomalies' AND q.reasons[1] = 'natural_key_duplicate') GROUP BY 1, 2, 3, 4")
def anomalies_twins(w):
    """Where the surviving twins of one family's duplicates are."""
    return reconcile.twins(w.rows, "rapids_anomalies")


@query("SELECT family, count(*) AS total, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS accepted, count(CASE WHEN len(reasons) = 0 AND publisher_excluded THEN 1 END) AS accepted_meets_rule, count(CASE WHEN len(reasons) = 0 AND NOT publisher_excluded THEN 1 END) AS accepted_not_meeting_rule, count(CASE WHEN len(reasons) > 0 THEN 1 END) AS quarantined FROM judged WHERE source = 'gamma' GROUP BY 1")
def anomalies_population(w):
    return reconcile.populations(w.rows.filter("source = 'gamma'"))


@query("SELECT station_key, CAST(max(level) AS BIGINT) AS plain_max FROM (SELECT *, sum(d) OVER (PARTITION BY station_key ORDER BY t, d, object_id ROWS UNBOUNDED PRECEDING) AS level FROM (SELECT station_key, object_id, s AS t, 1 AS d FROM all_line UNION ALL SELECT station_key, object_id, e, -1 FROM all_line)) WHERE d = 1 GROUP BY 1")
def plain_max_all_sessions(w):
    return w.all_levels.groupBy("station_key").agg(F.max("level").cast("long").alias("plain_max"))


@query("SELECT source, count(*) AS days, count(CASE WHEN connected_minutes > available_minutes THEN 1 END) AS connected_over, count(CASE WHEN charging_minutes > available_minutes THEN 1 END) AS charging_over FROM station_day WHERE NOT is_excluded GROUP BY 1")
def days_over_full(w):
    n = lambda c, name: F.count(F.when(F.col(c) > F.col("available_minutes"), 1)).alias(name)
    return w.days.filter("not is_excluded").groupBy("source").agg(F.count("*").alias("days"), n("connected_minutes", "connected_over"), n("charging_minutes", "charging_over"))


TRANSITIONS = (("alpha", "2024-03-10"), ("alpha", "2024-11-03"), ("gamma", "2024-03-31"), ("gamma", "2024-10-27"))


@query(f"SELECT source, day, spanning, CAST(gap_minutes AS BIGINT) AS gap_minutes, n FROM (SELECT *, row_number() OVER (PARTITION BY source, day ORDER BY n DESC, gap_minutes) AS k, sum(n) OVER (PARTITION BY source, day)::BIGINT AS spanning FROM (SELECT source, day, round((epoch(end_local) - epoch(start_local)) / 60 - reported_minutes) AS gap_minutes, count(*) AS n FROM sessions JOIN (VALUES {', '.join(map(str, TRANSITIONS))}) d(source, day) USING (source) WHERE reported_minutes IS NOT NULL AND start_local < CAST(day AS TIMESTAMP) + INTERVAL 2 HOUR AND end_local > CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR GROUP BY 1, 2, 3)) WHERE k <= 4")
def dst_transition_gaps(w):
    """Sessions that span a change of clocks, by how far wall clock and reported duration part; the four commonest gaps of each date."""
    return profiling.transition_gaps(w.sessions, TRANSITIONS)


@query("SELECT source, epoch(start_local) - epoch(start_utc) > min_offset AS in_dst, round(atan2(avg(sin(radians(15.0 * hour(start_local)))), avg(cos(radians(15.0 * hour(start_local))))), 5) AS mean_angle, count(*) AS n FROM sessions JOIN (SELECT source, min(epoch(start_local) - epoch(start_utc)) AS min_offset FROM sessions GROUP BY 1) o USING (source) GROUP BY 1, 2")
def seasonal_hour_shift(w):
    offset = F.unix_seconds("start_local") - F.unix_seconds("start_utc")
    s = w.sessions.select("source", offset.alias("offset"), F.radians(15.0 * F.hour("start_local")).alias("angle"))
    least = s.groupBy("source").agg(F.min("offset").alias("least"))
    return s.join(least, "source").groupBy("source", (F.col("offset") > F.col("least")).alias("in_dst")).agg(
        F.round(F.atan2(F.avg(F.sin("angle")), F.avg(F.cos("angle"))), 5).alias("mean_angle"), F.count("*").alias("n")
    )


@query("SELECT family, round(max(implied_kw), 6) AS most_kw, count(CASE WHEN implied_kw IS NULL THEN 1 END) AS unknown, CASE WHEN source <> 'gamma' THEN 20.0 WHEN family LIKE 'rapids%' THEN 55.0 ELSE 30.0 END AS ceiling FROM judged GROUP BY family, source")
def implied_kw_ceiling(w):
    from voltway.operators import rules

    n = F.count(F.when(F.col("implied_kw").isNull(), 1)).alias("unknown")
    return w.rows.groupBy("family").agg(F.round(F.max("implied_kw"), 6).alias("most_kw"), n).withColumn("ceiling", rules.ceiling(F.col("family")))


@query("SELECT source, count(*) AS n, count(CASE WHEN publisher_excluded THEN 1 END) AS excluded, count(CASE WHEN publisher_excluded AND is_non_trivial THEN 1 END) AS excluded_but_counted, count(CASE WHEN NOT publisher_excluded AND NOT is_non_trivial THEN 1 END) AS kept_but_trivial FROM sessions GROUP BY 1")
def publisher_confusion(w):
    p, t = F.col("publisher_excluded"), F.col("is_non_trivial")
    n = lambda x, name: F.count(F.when(x, 1)).alias(name)
    return w.sessions.groupBy("source").agg(F.count("*").alias("n"), n(p, "excluded"), n(p & t, "excluded_but_counted"), n(~p & ~t, "kept_but_trivial"))


KEYS_EQUAL = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ("unit", "key_start", "key_end", "key_kwh"))


@query(f"SELECT delivery_block, count(*) AS n_keys, count(CASE WHEN EXISTS (SELECT 1 FROM keys b WHERE b.delivery_block = (SELECT max(delivery_block) FROM keys) AND {KEYS_EQUAL}) THEN 1 END) AS in_last FROM keys a GROUP BY 1".replace("FROM keys", "FROM (SELECT DISTINCT delivery_block, unit, key_start, key_end, key_kwh FROM judged WHERE source = 'alpha')"))
def delivery_containment(w):
    """How many natural keys of each delivery the last one holds."""
    keys = w.rows.filter("source = 'alpha'").select("delivery_block", "key_hash").distinct()
    newest = keys.agg(F.max("delivery_block").alias("delivery_block"))
    last = keys.join(newest, "delivery_block").select("key_hash", F.lit(1).alias("last"))
    return keys.join(last, "key_hash", "left").groupBy("delivery_block").agg(F.count("*").alias("n_keys"), F.count("last").alias("in_last"))


SNAPSHOT = ("ports", "ports_source", "active_from", "active_to", "excluded_days", "low_evidence", "capacity_grain", "site_key")


@query("SELECT station_key, CAST(ports + CASE WHEN station_key LIKE '%5' THEN 1 ELSE 0 END AS BIGINT) AS ports, site_key, excluded_days, 1 AS valid_from, CASE WHEN station_key LIKE '%5' THEN 2 END AS valid_to FROM dim WHERE station_key NOT LIKE '%7' UNION ALL SELECT station_key, CAST(ports AS BIGINT), site_key, excluded_days, 2, NULL FROM dim WHERE station_key LIKE '%5' OR station_key LIKE '%7'")
def station_snapshot(w):
    """Two runs of the station history: some stations have other ports in the first, some aren't there yet."""
    first = w.dim.filter("station_key not like '%7'").select("station_key", *SNAPSHOT, F.lit(1).alias("valid_from"), F.lit(None).cast("int").alias("valid_to"))
    first = first.withColumn("ports", F.col("ports") + F.col("station_key").like("%5").cast("int"))
    found = incremental.scd2_step(first, w.dim.select("station_key", *SNAPSHOT, F.lit(2).alias("as_of")), "station_key", list(SNAPSHOT))
    return found.select("station_key", "ports", "site_key", "excluded_days", "valid_from", "valid_to")


@query("SELECT source, family, count(*) AS raw_rows, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS accepted, count(CASE WHEN is_nonexistent THEN 1 END) AS nonexistent, count(CASE WHEN len(reasons) = 0 AND is_ambiguous THEN 1 END) AS ambiguous, count(CASE WHEN len(reasons) = 0 AND contains(station_key, '/unknown/') THEN 1 END) AS unknown_station, round(coalesce(sum(CASE WHEN len(reasons) = 0 AND contains(station_key, '/unknown/') THEN energy_kwh END) / nullif(sum(CASE WHEN len(reasons) = 0 THEN energy_kwh END), 0), 0), 6) AS unknown_kwh_share FROM judged GROUP BY 1, 2")
def silver_summary(w):
    """Per file: rows, accepted rows, clock changes and what unknown stations hold."""
    ok, unknown = F.col("primary_reason").isNull(), F.col("station_key").contains("/unknown/")
    n = lambda p, name: F.count(F.when(p, 1)).alias(name)
    share = F.sum(F.when(ok & unknown, F.col("energy_kwh"))) / F.nullif(F.sum(F.when(ok, F.col("energy_kwh"))), F.lit(0.0))
    return w.rows.groupBy("source", "family").agg(
        F.count("*").alias("raw_rows"), n(ok, "accepted"), n(F.col("is_nonexistent"), "nonexistent"), n(ok & F.col("is_ambiguous"), "ambiguous"), n(ok & unknown, "unknown_station"),
        F.round(F.coalesce(share, F.lit(0.0)), 6).alias("unknown_kwh_share"),
    )


@query("SELECT source, count(*) AS sessions, CAST(epoch(min(start_local)) AS BIGINT) AS first_start, CAST(epoch(max(start_local)) AS BIGINT) AS last_start, count(DISTINCT station_key) AS stations, count(DISTINCT CAST(start_local AS DATE)) AS days, count(DISTINCT port_id) AS ports, count(charging_minutes) AS with_charging, count(connected_minutes) AS with_connected FROM sessions GROUP BY 1")
def source_coverage(w):
    """What each source covers, and which durations it publishes; rows are combined by station, port and date first."""
    per = w.fact.groupBy("source", "station_key", "port_id", F.to_date("start_local").alias("day")).agg(
        F.count("*").alias("n"), F.min("start_local").alias("a"), F.max("start_local").alias("b"), F.count("charging_minutes").alias("c"), F.count("connected_minutes").alias("d")
    )
    return per.groupBy("source").agg(
        F.sum("n").alias("sessions"), epoch(F.min("a")).alias("first_start"), epoch(F.max("b")).alias("last_start"), F.count_distinct("station_key").alias("stations"),
        F.count_distinct("day").alias("days"), F.count_distinct("port_id").alias("ports"), F.sum("c").alias("with_charging"), F.sum("d").alias("with_connected"),
    )


KEY = "source, unit, port_id, key_start, key_end, key_kwh"


@query(f"SELECT source, files, count(*) AS n_keys FROM (SELECT source, string_agg(DISTINCT family, ' & ' ORDER BY family) AS files, count(DISTINCT family) AS n FROM judged WHERE NOT blank GROUP BY {KEY}) WHERE n > 1 GROUP BY 1, 2")
def keys_shared_between_files(w):
    """Natural keys that several files of a source hold, by set of files."""
    return source_profile.keys_by_files(w.rows.filter("not is_blank"))


@query("SELECT source, 'names_per_site' AS what, v AS value, count(*) AS n FROM (SELECT source, site_key, count(DISTINCT unit) AS v FROM judged WHERE site_key IS NOT NULL GROUP BY 1, 2) GROUP BY 1, 3 UNION ALL SELECT source, 'ports_per_station', v, count(*) FROM (SELECT source, unit, count(DISTINCT port_id) AS v FROM judged WHERE unit IS NOT NULL GROUP BY 1, 2) WHERE v > 0 GROUP BY 1, 3")
def source_histograms(w):
    return source_profile.histograms(w.rows)


def counted(**conditions: str) -> str:
    return ", ".join(f"count(CASE WHEN {c} THEN 1 END) AS {n}" for n, c in conditions.items())


GAP = "((epoch_us(end_local) - epoch_us(start_local)) / 6e7 - coalesce(reported_minutes, charging_minutes))"


@query("SELECT * FROM (SELECT source, count(*) AS rows_all, min(CASE WHEN NOT blank THEN energy_kwh END) AS energy_least, " + counted(
    blank_rows="blank", exact_repeats="NOT blank AND exact_rank > 1", key_repeats="NOT blank AND key_rank > 1", null_names="NOT blank AND unit IS NULL", numeric_names="NOT blank AND regexp_full_match(unit, '[0-9]+')",
    energy_null="NOT blank AND energy_kwh IS NULL", energy_zero="NOT blank AND energy_kwh = 0", energy_negative="NOT blank AND energy_kwh < 0", charging_null="NOT blank AND charging_minutes IS NULL",
    charging_zero="NOT blank AND charging_minutes = 0", charging_over_24h="NOT blank AND charging_minutes > 1440", connected_zero="NOT blank AND reported_minutes = 0", connected_over_24h="NOT blank AND reported_minutes > 1440",
    charging_exceeds_connected="NOT blank AND charging_minutes > reported_minutes + 1 / 60", no_energy_in_some_time="NOT blank AND energy_kwh = 0 AND charging_minutes > 0", energy_in_no_time="NOT blank AND energy_kwh > 0 AND charging_minutes = 0",
    spans=f"NOT blank AND {GAP} IS NOT NULL", span_within_2_min=f"NOT blank AND abs({GAP}) <= 2", span_longer=f"NOT blank AND {GAP} > 5", span_shorter=f"NOT blank AND {GAP} < -5", span_off_by_an_hour=f"NOT blank AND abs({GAP}) BETWEEN 55 AND 65",
) + " FROM judged GROUP BY 1) LEFT JOIN (SELECT source, count(*) AS distinct_names, min(n) AS least_sessions, max(n) AS most_sessions, count(CASE WHEN n < 30 THEN 1 END) AS stations_under_30_sessions FROM (SELECT source, unit, count(start_local) AS n FROM judged WHERE NOT blank AND unit IS NOT NULL GROUP BY 1, 2) GROUP BY 1) USING (source)")
def source_figures(w):
    """Every source profiled in one pass: rows, repeats, names, implausible values, spans against recorded durations."""
    return source_profile.figures(w.rows)


WHOLE_KEY = "NOT blank AND unit IS NOT NULL AND start_local IS NOT NULL AND (source = 'beta' OR (end_local IS NOT NULL AND energy_kwh IS NOT NULL)) AND (source <> 'gamma' OR port_id IS NOT NULL)"


@query(f"SELECT source, count(*) AS n_groups, count(CASE WHEN idle THEN 1 END) AS with_idle_row, count(CASE WHEN high > low THEN 1 END) AS energy_differs FROM (SELECT source, bool_or(charging_minutes = 0 AND energy_kwh = 0) AS idle, min(energy_kwh) AS low, max(energy_kwh) AS high FROM judged WHERE {WHOLE_KEY} GROUP BY {KEY} HAVING count(*) > 1) GROUP BY 1")
def key_conflicts(w):
    """What sets the rows of one natural key apart."""
    return source_profile.key_conflicts(w.rows)


POWERS = "SELECT source, port_id, energy_kwh / (m / 60) AS kw FROM (SELECT *, CASE WHEN source = 'gamma' THEN reported_minutes ELSE charging_minutes END AS m FROM judged WHERE NOT blank) WHERE m > 0 AND energy_kwh IS NOT NULL"
WANTED = (0.5, 0.9, 0.99, 0.999)


@query(" UNION ALL ".join([*(f"SELECT source, NULL AS port, CAST({q} AS DOUBLE) AS q, round(quantile_cont(kw, {q}), 6) AS kw FROM ({POWERS}) GROUP BY 1" for q in WANTED), f"SELECT source, port_id, CAST(0.5 AS DOUBLE), round(quantile_cont(kw, 0.5), 6) FROM ({POWERS}) WHERE port_id IS NOT NULL GROUP BY 1, 2"]))
def power_quantiles(w):
    """Exact quantiles of each source's power, and the median of each port."""
    return source_profile.powers(w.rows, WANTED).withColumn("kw", F.round("kw", 6))


@query("SELECT source, family, count(*) AS n_rows, count(CASE WHEN implied_kw > CASE WHEN source <> 'gamma' THEN 20 WHEN family LIKE 'rapids%' THEN 55 ELSE 30 END THEN 1 END) AS n_over, round(max(implied_kw), 6) AS most FROM judged WHERE NOT blank AND implied_kw IS NOT NULL GROUP BY 1, 2")
def power_over_ceiling(w):
    return source_profile.over_ceiling(w.rows).withColumn("most", F.round("most", 6))


SPAN = "((epoch_us(end_local) - epoch_us(start_local)) / 6e7)"


@query("SELECT source, round(1 - sum(charging_minutes) / nullif(sum(reported_minutes), 0), 6) AS idle_share, " + counted(
    end_null="end_local IS NULL", end_in_1970="year(end_local) = 1970", end_before_start=f"{SPAN} < 0 AND year(end_local) <> 1970", end_at_start=f"{SPAN} = 0", over_24h=f"{SPAN} > 1440", over_7d=f"{SPAN} > 10080",
    over_midnight="coalesce(CAST(start_local AS DATE) <> CAST(end_local AS DATE), TRUE)", over_new_year="coalesce(year(start_local) <> year(end_local), TRUE) AND coalesce(year(end_local) <> 1970, TRUE)",
) + " FROM judged WHERE NOT blank AND has_end GROUP BY 1")
def span_figures(w):
    """What is odd in the ends of each source's sessions."""
    return source_profile.span_figures(w.rows).withColumn("idle_share", F.round("idle_share", 6))


@query(f"SELECT source, strftime(start_local, '%Y-%m') AS year_month, count(*) AS n FROM judged WHERE NOT blank AND abs({GAP}) BETWEEN 55 AND 65 GROUP BY 1, 2")
def hour_gaps(w):
    return source_profile.hour_gaps(w.rows)


PAIRS = "SELECT DISTINCT source, site_key, unit FROM judged WHERE unit IS NOT NULL AND site_key IS NOT NULL"


@query(f"SELECT * FROM (SELECT source, count(*) AS n_sites, count(CASE WHEN n > 1 THEN 1 END) AS sites_with_several_names, max(n) AS most_names FROM (SELECT source, site_key, count(*) AS n FROM ({PAIRS}) GROUP BY 1, 2) GROUP BY 1) JOIN (SELECT source, count(*) AS n_names, count(CASE WHEN n > 1 THEN 1 END) AS names_at_several_sites FROM (SELECT source, unit, count(*) AS n FROM ({PAIRS}) GROUP BY 1, 2) GROUP BY 1) USING (source)")
def names_and_sites(w):
    return source_profile.names_and_sites(w.rows)


@query(f"SELECT source, place, site_key, n_names FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_names DESC, site_key) AS place FROM (SELECT source, site_key, count(*) AS n_names FROM ({PAIRS}) GROUP BY 1, 2)) WHERE place <= 8")
def largest_sites(w):
    """The eight sites with most charge points of each source: a top-k report."""
    return source_profile.largest_sites(w.rows)


@query("SELECT source, coalesce(port_id, '<null>') AS port, count(*) AS n FROM judged WHERE NOT blank GROUP BY 1, 2")
def port_values(w):
    return source_profile.port_values(w.rows)


@query("SELECT source, median(n) AS median FROM (SELECT source, unit, count(start_local) AS n FROM judged WHERE NOT blank AND unit IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def median_sessions(w):
    return source_profile.median_sessions(w.rows)


REDELIVERED = ("energy_kwh", "end_local", "reported_minutes")


@query("WITH a AS (SELECT * FROM judged WHERE family = 'rapids'), b AS (SELECT * FROM judged WHERE family = 'rapids_anomalies') ".replace("WITH ", ", ") + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS compared, count(CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN 1 END) AS changed FROM a JOIN b ON a.unit = b.unit AND a.start_local = b.start_local" for c in REDELIVERED))
def redelivered_cells(w):
    """Cells that differ where a file delivers another one's sessions again."""
    return source_profile.redelivered(w.rows, "rapids", "rapids_anomalies", ["station_name_raw", "start_local"], list(REDELIVERED))


@query(f"""SELECT family AS source_family, bucket, count(*) AS n FROM (
    SELECT a.family, CASE WHEN len(q.reasons) > 0 AND q.reasons[1] <> 'natural_key_duplicate' THEN 'quarantined_' || q.reasons[1] WHEN r.raw = 'fasts' AND a.family = 'rapids_anomalies' THEN 'same_event_in_fasts_raw'
      WHEN r.raw IS NOT NULL THEN 'same_event_in_' || r.raw WHEN u.source IS NOT NULL THEN 'accepted_unexplained' ELSE 'other' END AS bucket
    FROM (SELECT * FROM judged WHERE family IN ('rapids_anomalies', 'fasts_anomalies') AND NOT publisher_excluded) a
    LEFT JOIN (SELECT {KEY}, min(family) AS raw FROM judged WHERE family IN ('rapids', 'fasts') GROUP BY ALL) r ON {" AND ".join(f"a.{c} IS NOT DISTINCT FROM r.{c}" for c in KEY.split(", "))}
    LEFT JOIN (SELECT * FROM judged WHERE len(reasons) > 0) q ON q.family = a.family AND {" AND ".join(f"a.{c} IS NOT DISTINCT FROM q.{c}" for c in KEY.split(", "))}
    LEFT JOIN (SELECT * FROM judged WHERE len(reasons) = 0) u ON u.family = a.family AND {" AND ".join(f"a.{c} IS NOT DISTINCT FROM u.{c}" for c in KEY.split(", "))}) GROUP BY 1, 2""")
def anomaly_buckets(w):
    """What became of the anomaly files' rows that the publisher's rule doesn't explain."""
    return source_profile.anomaly_buckets(w.rows)


@query("SELECT site_key, 'Site  ' || substr(site_key, 6) || ' ' AS raw_names FROM judged WHERE source = 'gamma' AND site_key IS NOT NULL GROUP BY 1")
def name_groups(w):
    """The ways in which each of gamma's names was published."""
    return source_profile.name_groups(w.rows).select("site_key", F.array_join("raw_names", "|").alias("raw_names"))


@query(f"SELECT source, count(*) AS sessions, count(DISTINCT ({KEY})) AS surrogate_keys, count(*) AS by_formula FROM sessions GROUP BY 1")
def surrogate_keys(w):
    """Sessions, their different surrogate keys, and how many follow from source and natural key."""
    per = w.fact.groupBy("source", "session_sk").agg(F.count("*").alias("n"), F.count(F.when(F.col("session_sk") == F.md5(F.concat_ws("|", "source", "key_hash")), 1)).alias("right"))
    return per.groupBy("source").agg(F.sum("n").alias("sessions"), F.count("*").alias("surrogate_keys"), F.sum("right").alias("by_formula"))


@query("SELECT (SELECT count(*) FROM judged) AS n_one, (SELECT count(*) FROM sessions) AS n_other, (SELECT count(*) FROM judged WHERE len(reasons) > 0) AS difference")
def equal_row_counts(w):
    """The typed rows against the accepted ones: as many more as are rejected."""
    return checks.row_counts(w.typed, w.fact)


@query("SELECT source, duration_availability, count(*) AS n, count(port_id) AS ports, round(sum(connected_minutes - reported_minutes), 4) AS disagreement FROM (SELECT *, CASE source WHEN 'alpha' THEN 'both' WHEN 'beta' THEN 'charging_only' ELSE 'plug_in_only' END AS duration_availability FROM sessions) GROUP BY 1, 2")
def duration_availability(w):
    """Which durations sources publish, how many sessions name a port, and by how much durations disagree."""
    return w.fact.groupBy("source", "duration_availability").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("port_id_present"), 1)).alias("ports"), F.round(F.sum("duration_disagreement_minutes"), 4).alias("disagreement")
    )
