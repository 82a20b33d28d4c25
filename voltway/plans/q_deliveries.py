"""Queries from publishers' files: landed, checked, released to stored tables and read back, each with its DuckDB twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltway.operators import compare, gold
from voltway.operators import intervals as I
from voltway.plans.oracle import EVERY_LEVEL, with_tables
from voltway.sources import deliveries, files, landing, warehouse
from voltway.sources.contracts import CONTRACTS
from voltway.sources.history import History
from voltway.sources.store import Held, Store

QUERIES, ORACLE = {}, {}
_RELEASED: dict[tuple, Held] = {}


def released(spark: SparkSession, sf_dir: str) -> Held:
    """The events delivered as the publishers' files, landed and released; once for each version of the events."""
    path = f"{sf_dir}/events.parquet"
    key = (spark.sparkContext.applicationId, sf_dir, warehouse.version(spark, path))
    if key not in _RELEASED:
        root = f"{files.shared_dir(spark).rstrip('/')}/voltway/{uuid.uuid4().hex}-deliveries"
        deliveries.published_files(spark, spark.read.parquet(path), f"{root}/inbox")
        for contract in CONTRACTS.values():
            landing.land(spark, f"{root}/inbox", contract, f"{root}/landed")
        store = Store(spark, f"{root}/store")
        store.release(landing.manifest_log(spark, f"{root}/landed").latest()[1]["files"])
        _RELEASED[key] = store.hold()
    return _RELEASED[key]


_CHANGED: dict[Held, Held] = {}
#: The events that beta's second delivery lacks.
LACKING = "event_id % 5 = 1"


def released_again(spark: SparkSession, sf_dir: str) -> tuple[Held, Held]:
    """Both releases: of the first deliveries, and after beta delivered without some rows."""
    first = released(spark, sf_dir)
    if first not in _CHANGED:
        root = first.store.root.removesuffix("/store")
        deliveries.published_files(spark, spark.read.parquet(f"{sf_dir}/events.parquet").filter(f"not ({LACKING})"), f"{root}/inbox", ("beta",))
        landing.land(spark, f"{root}/inbox", CONTRACTS["beta"], f"{root}/landed")
        first.store.release(landing.manifest_log(spark, f"{root}/landed").latest()[1]["files"])
        _CHANGED[first] = first.store.hold()
    return first, _CHANGED[first]


def query_of_two(sql: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*released_again(spark, sf_dir))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, sql
        return f

    return add


def query(sql: str, **levels: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(released(spark, sf_dir))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, with_tables(sql, **levels)
        return f

    return add


FACT = "energy_kwh", "charging_minutes", "connected_minutes", "reported_minutes"
ROUNDED = ", ".join(f"round({n}, 6) AS {n}" for n in FACT)


@query(f"SELECT source, family, station_key, operator_key, site_key, port_id, CAST(epoch(start_utc) AS BIGINT) AS start_s, CAST(epoch(end_utc) AS BIGINT) AS end_s, {ROUNDED}, is_non_trivial, list_aggregate(flags, 'string_agg', ',') AS flags FROM sessions")
def delivered_fact(held):
    """The session fact from string files in the publishers' columns."""
    seconds = (F.unix_seconds(f"{n}_utc").alias(f"{n}_s") for n in ("start", "end"))
    return held.table("gold/fct_charging_session").select("source", "family", "station_key", "operator_key", "site_key", "port_id", *seconds, *(F.round(n, 6).alias(n) for n in FACT), "is_non_trivial", "flags")


@query("SELECT source, count(*) AS n_rows, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS accepted, count(CASE WHEN blank THEN 1 END) AS blank_rows, count(DISTINCT delivery_block) AS blocks FROM judged GROUP BY 1")
def delivered_rows(held):
    """Every delivered row is accepted or rejected."""
    rows = held.table("silver/sessions")
    per = rows.groupBy("source", "delivery_block").agg(F.count("*").alias("n"), F.count(F.when(F.col("primary_reason").isNull(), 1)).alias("ok"), F.count(F.when(F.col("is_blank"), 1)).alias("blank"))
    return per.groupBy("source").agg(F.sum("n").alias("n_rows"), F.sum("ok").alias("accepted"), F.sum("blank").alias("blank_rows"), F.count("delivery_block").alias("blocks"))


@query("SELECT source, operator_key, strftime(day, '%Y-%m') AS year_month, count(*) AS station_days, count(DISTINCT station_key) AS stations, CAST(sum(sessions) AS BIGINT) AS sessions, round(sum(energy_kwh), 4) AS energy_kwh, round(sum(available_minutes), 4) AS available_minutes FROM station_day GROUP BY 1, 2, 3")
def delivered_months(held):
    """The monthly mart from string files."""
    rounded = (F.round(n, 4).alias(n) for n in ("energy_kwh", "available_minutes"))
    return held.table("gold/mart_monthly").select("source", "operator_key", "year_month", "station_days", "stations", "sessions", *rounded)


MONTHS = "SELECT source, operator_key, strftime(day, '%Y-%m') AS year_month, CAST(sum(sessions) AS DOUBLE) AS sessions, CAST(count(*) AS DOUBLE) AS station_days, sum(energy_kwh) AS energy_kwh, sum(available_minutes) AS available_minutes FROM station_day GROUP BY 1, 2, 3"
AFTER = with_tables(MONTHS).replace("FROM events,", f"FROM (SELECT * FROM events WHERE NOT (event_id % 3 = 1 AND {LACKING})) events,", 1)
MEASURES = ("sessions", "station_days", "energy_kwh", "available_minutes")


@query_of_two(f"""SELECT source, operator_key, year_month, name, round(a, 4) AS before, round(b, 4) AS after FROM (
    SELECT source, operator_key, year_month, unnest({list(MEASURES)}) AS name, unnest([{", ".join(f"x.{n}" for n in MEASURES)}]) AS a, unnest([{", ".join(f"y.{n}" for n in MEASURES)}]) AS b
    FROM ({with_tables(MONTHS)}) x FULL JOIN ({AFTER}) y USING (source, operator_key, year_month))
  WHERE a IS DISTINCT FROM b AND (a IS NULL OR b IS NULL OR name IN ('sessions', 'station_days') OR abs(a - b) > 1e-6 * greatest(abs(a), abs(b), 1))""")
def release_differences(before, after):
    """Monthly figures that differ between two stored releases."""
    old, new = (held.table("gold/mart_monthly") for held in (before, after))
    found = compare.table_differences(old, new, ["source", "operator_key", "year_month"], ["sessions", "station_days"], ["energy_kwh", "available_minutes"])
    return found.select("source", "operator_key", "year_month", "name", *(F.round(n, 4).alias(n) for n in ("before", "after")))


@query_of_two(with_tables(f"SELECT source, 'changed' AS change, count(*) AS rows_before, count(CASE WHEN NOT ({LACKING}) THEN 1 END) AS rows_after FROM judged WHERE source = 'beta' GROUP BY 1"))
def release_inputs(before, after):
    """Delivered files that changed between two releases, by source."""
    changes = compare.input_changes(before.state["inputs"], after.state["inputs"])
    rows = before.store.spark.createDataFrame([(c["source"], c["change"], c["rows_before"], c["rows_after"]) for c in changes], "source string, change string, rows_before long, rows_after long")
    return rows.groupBy("source", "change").agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))


TRACKED = ["ports", "whole_ports", "ports_source", "active_from", "active_to", "excluded_days", "low_evidence", "capacity_grain", "site_key"]
RUNS = """(SELECT station_key, CAST(ports + 1 AS BIGINT) AS ports, site_key, 1 AS f, 2 AS t FROM dim WHERE station_key LIKE '%5'
  UNION ALL SELECT station_key, CAST(ports AS BIGINT), site_key, 1, CASE WHEN station_key LIKE '%2' THEN 3 END FROM dim WHERE station_key NOT LIKE '%5' AND station_key NOT LIKE '%7'
  UNION ALL SELECT station_key, CAST(ports AS BIGINT), site_key, 2, NULL FROM dim WHERE station_key LIKE '%5' OR station_key LIKE '%7'
  UNION ALL SELECT station_key, CAST(ports AS BIGINT), concat(site_key, '!'), 3, NULL FROM dim WHERE station_key LIKE '%2')"""
_HISTORIES: dict[Held, History] = {}


def history(held: Held) -> History:
    """Three runs of the station history: ports and sites that change, stations that come late and one kind that goes.

    ``ports`` are the published ones, ``whole_ports`` those of every level of concurrency.
    """
    if held not in _HISTORIES:
        own = History(held.store.spark, f"{held.store.root}/station_history", "station_key", TRACKED)
        reached = I.robust_max(I.days_at_level(held.table("gold/int_day_levels")), gold.ROBUST_DAYS).select("station_key", F.col("robust_max").alias("_robust"))
        dim = held.table("gold/dim_station").join(reached, "station_key", "left").withColumn("whole_ports", gold.ports("connector_ids", "_robust"))
        more = F.col("station_key").like("%5").cast("int")
        first = dim.filter("station_key not like '%7'").withColumns({n: F.col(n) + more for n in ("ports", "whole_ports")})
        moved = dim.filter("station_key not like '%3'").withColumn("site_key", F.when(F.col("station_key").like("%2"), F.concat("site_key", F.lit("!"))).otherwise(F.col("site_key")))
        for at, current in enumerate((first, dim, moved), 1):
            own.run(current.select("station_key", *TRACKED, F.lit(at).alias("as_of")))
        _HISTORIES[held] = own
    return _HISTORIES[held]


@query(f"SELECT station_key, ports, site_key, f AS valid_from, t AS valid_to, md5(station_key || '|' || f) AS scd_id FROM {RUNS}")
def station_history(held):
    """All versions of the stored station history after three runs."""
    return history(held).table().select("station_key", "ports", "site_key", "valid_from", "valid_to", "scd_id")


@query(f"SELECT station_key, ports, site_key FROM {RUNS} WHERE f <= 2 AND (t IS NULL OR t > 2)", levels=EVERY_LEVEL)
def stations_as_of(held):
    """The stations as the history had them at the second run, their ports from every level of concurrency."""
    return history(held).as_of(2).select("station_key", F.col("whole_ports").alias("ports"), "site_key")
