"""Incremental, history and data-quality operators as queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voltway.operators import checks, incremental
from voltway.operators import intervals as I
from voltway.operators import sessions as S
from voltway.plans.oracle import with_tables
from voltway.sources import warehouse

QUERIES, ORACLE = {}, {}


def query(sql: str, *tables: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str):
            return f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, sql
        return f

    return add


FILES = "SELECT event_type AS source, strftime(ts, '%d') AS file_name, CAST(count(*) AS VARCHAR) AS sha256 FROM events"


def files(events):
    return events.groupBy(F.col("event_type").alias("source"), F.date_format("ts", "dd").alias("file_name")).agg(F.count("*").cast("string").alias("sha256"))


@query(f"SELECT DISTINCT source FROM ((SELECT * FROM ({FILES} GROUP BY 1, 2) EXCEPT SELECT * FROM ({FILES} WHERE NOT (event_type = 'view' AND event_id % 7 = 0) GROUP BY 1, 2)) UNION ALL (SELECT * FROM ({FILES} WHERE NOT (event_type = 'view' AND event_id % 7 = 0) GROUP BY 1, 2) EXCEPT SELECT * FROM ({FILES} GROUP BY 1, 2)))", "events")
def changed_sources(events):
    return incremental.changed_sources(files(events), files(events.filter("not (event_type = 'view' and event_id % 7 = 0)")))


@query("SELECT source, count(*) AS n, round(sum(value), 2) AS value FROM (SELECT event_type AS source, value FROM events WHERE event_type <> 'click' UNION ALL SELECT event_type, value + 1 FROM events WHERE event_type = 'click' AND event_id % 2 = 0) GROUP BY 1", "events")
def incremental_replace(events):
    fact = events.select(F.col("event_type").alias("source"), "value")
    fresh = events.filter("event_type = 'click' and event_id % 2 = 0").select(F.col("event_type").alias("source"), (F.col("value") + 1).alias("value"))
    return incremental.replaced(fact, fresh).groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query("SELECT c_custkey, c_mktsegment, 1 AS valid_from, CASE WHEN c_custkey % 5 = 0 THEN 2 END AS valid_to FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 > 0 THEN NULL ELSE c_mktsegment END, 2, NULL FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0", "customer")
def scd2_history(customer):
    first = customer.filter("c_custkey % 3 > 0").select("c_custkey", "c_mktsegment", F.lit(1).alias("valid_from"), F.lit(None).cast("int").alias("valid_to"))
    segment = F.when((F.col("c_custkey") % 5 == 0) & (F.col("c_custkey") % 3 > 0), F.lit(None)).otherwise(F.col("c_mktsegment"))
    now = customer.select("c_custkey", segment.alias("c_mktsegment"), F.lit(2).alias("as_of"))
    return incremental.scd2_step(first, now, "c_custkey", ["c_mktsegment"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", "lineitem")
def check_unique(lineitem):
    return checks.not_unique(lineitem, "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)", "lineitem", "part")
def check_relationships(lineitem, part):
    return checks.orphans(lineitem, "l_partkey", part.filter("p_size > 2"), "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1", "orders")
def check_accepted_values(orders):
    return checks.not_accepted(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("SELECT count(CASE WHEN props IS NULL THEN 1 END) AS failing FROM events", "events")
def check_not_null(events):
    return checks.null_in(events, "props").agg(F.count("*").alias("failing"))


def warehouse_query(sql: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str):
            return f(warehouse.opened(spark, sf_dir))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, with_tables(sql)
        return f

    return add


def failing(df):
    return df.agg(F.count("*").alias("failing"))


@warehouse_query("SELECT source, family, count(*) AS expected, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS accepted, count(CASE WHEN len(reasons) > 0 AND object_id % 10 > 0 THEN 1 END) AS rejected FROM judged GROUP BY 1, 2 HAVING count(CASE WHEN len(reasons) > 0 AND object_id % 10 = 0 THEN 1 END) > 0")
def check_rows_lost(w):
    """The conservation check over a quarantine that lost rows: it must name each family that lost some."""
    return checks.uneven(w.rows, {"accepted": w.sessions, "rejected": S.quarantined(w.rows).filter("object_id % 10 > 0")}, "source", "family")


@warehouse_query("SELECT (SELECT count(*) FROM judged) - (SELECT count(*) FROM sessions) - (SELECT count(*) FROM judged WHERE len(reasons) > 0) AS failing")
def check_rows_conserved(w):
    return failing(checks.uneven(w.rows, {"accepted": w.sessions, "rejected": S.quarantined(w.rows)}, "source", "family"))


@warehouse_query("SELECT count(*) AS failing FROM judged WHERE len(reasons) > 0 AND NOT list_contains(reasons, CASE WHEN object_id % 10 = 0 THEN 'blank_row' ELSE reasons[1] END)")
def check_primary_reason(w):
    """Primary reasons among the reasons, with some put wrong."""
    return failing(checks.outside_reasons(w.rows.withColumn("primary_reason", F.when(F.col("primary_reason").isNotNull() & (F.col("object_id") % 10 == 0), "blank_row").otherwise(F.col("primary_reason")))))


@warehouse_query("SELECT count(*) AS failing FROM (SELECT source, sum(energy_kwh) AS a, sum(charging_minutes) AS b, sum(connected_minutes) AS c, count(*) AS n FROM timeline GROUP BY 1) s JOIN (SELECT source, sum(energy_kwh) AS a, sum(charging_minutes) AS b, sum(connected_minutes) AS c, sum(sessions) AS n FROM station_day GROUP BY 1) d USING (source) WHERE s.n <> d.n OR abs(coalesce(s.a, 0) - coalesce(d.a, 0)) > 1e-6 * greatest(abs(coalesce(s.a, 0)), 1) OR abs(coalesce(s.b, 0) - coalesce(d.b, 0)) > 1e-6 * greatest(abs(coalesce(s.b, 0)), 1) OR abs(coalesce(s.c, 0) - coalesce(d.c, 0)) > 1e-6 * greatest(abs(coalesce(s.c, 0)), 1) OR (s.b IS NULL) <> (d.b IS NULL) OR (s.c IS NULL) <> (d.c IS NULL)")
def check_measures_conserved(w):
    return failing(checks.measures_lost(w.line.withColumn("sessions", F.lit(1)), w.days, ["source"], ["sessions"], ["energy_kwh", "charging_minutes", "connected_minutes"]))


@warehouse_query("SELECT source FROM (SELECT source, sum(charging_minutes) AS a, count(*) AS n FROM timeline GROUP BY 1) s JOIN (SELECT source, sum(charging_minutes) FILTER (WHERE day(day) <> 7) AS a, sum(sessions) FILTER (WHERE day(day) <> 7) AS n FROM station_day GROUP BY 1) d USING (source) WHERE s.n <> d.n OR abs(coalesce(s.a, 0) - coalesce(d.a, 0)) > 1e-6 * greatest(abs(coalesce(s.a, 0)), 1)")
def check_measures_lost(w):
    """The same check over station-days that lack a date of each month."""
    lost = checks.measures_lost(w.line.withColumn("sessions", F.lit(1)), w.days.filter("day(day) <> 7"), ["source"], ["sessions"], ["charging_minutes"])
    return lost.select("source")


@warehouse_query("SELECT count(*) AS failing FROM (SELECT object_id, max(energy_kwh) AS a, sum(energy_piece) AS b FROM allocated GROUP BY source, object_id) WHERE abs(a - b) > 1e-6 * greatest(abs(a), abs(b), 1)")
def check_energy_conserved(w):
    """Per session; a session whose charging outlasts its end (within precision) may lose what falls on another date."""
    parts = I.pieces(w.fact).select("source", "object_id", F.col("energy_piece").alias("energy_kwh"))
    return failing(checks.not_conserved(w.fact, parts, ["source", "object_id"], "energy_kwh"))


@warehouse_query("SELECT count(*) AS failing FROM (SELECT d.station_key FROM dim d LEFT JOIN spine_days s USING (station_key) GROUP BY 1 HAVING count(day) <> min(active_to - active_from + 1) OR count(DISTINCT day) <> min(active_to - active_from + 1) OR count(CASE WHEN NOT is_excluded THEN 1 END) <> min(active_to - active_from + 1 - excluded_days))")
def check_spine_complete(w):
    return failing(checks.spine_holes(w.dim, w.days))


@warehouse_query("SELECT d.station_key FROM dim d LEFT JOIN (SELECT * FROM spine_days WHERE day(day) <> 7) s USING (station_key) GROUP BY 1 HAVING count(day) <> min(active_to - active_from + 1) OR count(CASE WHEN NOT is_excluded THEN 1 END) <> min(active_to - active_from + 1 - excluded_days)")
def check_spine_holes(w):
    """The same check over station-days that lack a date of each month."""
    return checks.spine_holes(w.dim, w.days.filter("day(day) <> 7")).select("station_key")


@warehouse_query("SELECT 'alpha' AS offender, 'source mixes capacity grains' AS problem UNION ALL SELECT DISTINCT station_key, 'row grain differs from station grain' FROM spine WHERE station_key LIKE 'alpha/%5'")
def check_grain_mixing(w):
    """Station-days of some stations put at another grain: both kinds of offence must show."""
    grain = F.when(F.col("station_key").like("alpha/%5"), "port").otherwise(F.col("capacity_grain"))
    return checks.grain_mixed(w.days.withColumn("capacity_grain", grain), w.dim)


@warehouse_query("SELECT station_key, 'sessions' AS relation FROM (SELECT DISTINCT station_key FROM sessions WHERE contains(station_key, '/unknown/'))")
def check_unknown_stations(w):
    """No unknown station in capacity tables; sessions, where they belong, show that the check finds them."""
    return checks.unknown_in_capacity({"dim_station": w.dim, "fct_station_day": w.days, "sessions": w.sessions})


@warehouse_query("SELECT count(*) AS failing FROM (SELECT source, sum(connected_minutes) / nullif(sum(available_minutes), 0) AS a, avg(connected_minutes / available_minutes) AS b, count(*) AS n FROM station_day WHERE NOT is_excluded AND available_minutes > 0 AND connected_minutes IS NOT NULL GROUP BY 1) WHERE n >= 2 AND abs(a - b) < 1e-9")
def check_ratio_differs_from_mean(w):
    return failing(checks.ratio_equals_mean(w.days))


@query("SELECT year, n, prior FROM (SELECT *, lag(n) OVER (ORDER BY year) AS prior, row_number() OVER (ORDER BY year DESC) AS k FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1)) WHERE k = 1 AND abs(n - prior) * 1.0 / prior > 0.35", "orders")
def check_newest_period(orders):
    return checks.newest_period_off(orders.select(F.year("o_orderdate").alias("year")), ["year"])
