import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from voltway.operators import gold, quantiles
from voltway.operators import intervals as I
from voltway.sources import warehouse


def spans(spark, rows):
    df = spark.createDataFrame(rows, "station_key string, object_id long, s double, e double")
    return df.withColumn("start_day", F.to_date(F.timestamp_seconds("s")))


def test_touching_intervals_do_not_overlap(spark):
    swept = I.sweep(spans(spark, [("a", 1, 0.0, 10.0), ("a", 2, 10.0, 20.0), ("a", 3, 15.0, 16.0)]))
    assert swept.agg(F.max("level")).first()[0] == 2


def test_sweep_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), i, float(s := rng.randrange(300)), float(s + rng.randrange(1, 60))) for i in range(80)]
    found = {r["station_key"]: r["m"] for r in I.sweep(spans(spark, rows)).groupBy("station_key").agg(F.max("level").alias("m")).collect()}
    for key in "ab":
        own = [(s, e) for k, _, s, e in rows if k == key]
        assert found[key] == max(sum(s <= t < e for s, e in own) for t in {s for s, _ in own})


LINE = "station_key string, object_id long, s double, e double, charging_minutes double, end_utc string, start_local timestamp"


def line_of(spark, rows):
    """Local time is UTC."""
    at = lambda s: dt.datetime.fromtimestamp(s, dt.UTC).replace(tzinfo=None)
    return spark.createDataFrame([(*r, at(r[2])) for r in rows], LINE).withColumn("start_local", F.timestamp_seconds("s")).withColumn("start_day", F.to_date("start_local"))


def test_idle_while_all_ports_are_taken(spark):
    """Two ports; one session charges 60 of 240 minutes and idles on, another runs for 60 minutes of that."""
    line = line_of(spark, [("a", 1, 0.0, 14400.0, 0.0, "x"), ("a", 2, 7200.0, 10800.0, 60.0, "x")])
    found = I.full_occupancy_idle(line, spark.createDataFrame([("a", 2)], "station_key string, ports int")).first()
    assert (found["idle_s"], found["blocked_s"]) == (14400.0, 3600.0)


def test_full_occupancy_equals_brute_force(spark):
    """Over several spans of the running sums, for several port counts and hours."""
    rng = random.Random(9)
    rows = [("a", i, float(s := rng.randrange(3) * I.SPAN + rng.randrange(2000) * 10), float(s + 600 * (n := rng.randrange(1, 9))), float(10 * rng.randrange(n + 1)), "x") for i in range(80)]
    line = line_of(spark, rows)
    ports = spark.createDataFrame([("a", f"p{n}", n) for n in (1, 3, 5, 10)], "station_key string, definition string, ports int")
    found = {(r["definition"], r["hour"]): (r["seconds"], r["blocked_s"]) for r in I.idle_by_definition(line, ports).collect()}
    level = lambda t: sum(s <= t < e for _, _, s, e, _, _ in rows)
    for n in (1, 3, 5, 10):
        idle, full = {}, {}
        for _, _, s, e, c, _ in rows:
            for t in range(int(s + 60 * c), int(e), 10):
                h = t // 3600 % 24
                idle[h], full[h] = idle.get(h, 0) + 10, full.get(h, 0) + 10 * (level(t) >= n)
        assert {h: found[f"p{n}", h] for h in idle} == {h: (idle[h], full[h]) for h in idle}


def test_hours_of_intervals(spark):
    df = spark.createDataFrame([(3000.0, 7800.0, 0.0), (86400.0 + 3600.0, 86400.0 + 3660.0, 0.0), (0.0, 60.0, -60.0)], "i0 double, i1 double, shift double")
    found = I.by_hours(df).groupBy("hour").agg(F.sum(F.col("i1") - F.col("i0")).alias("n")).collect()
    assert {r["hour"]: r["n"] for r in found} == {0: 600.0, 1: 3660.0, 2: 600.0, 23: 60.0}


def test_next_rows_reach_over_empty_spans(spark):
    df = spark.createDataFrame([("a", float(t), i) for i, t in enumerate((0, 5, 3 * I.SPAN, 9 * I.SPAN + 1))], "k string, t double, i long")
    assert [r["next_i"] for r in I.following(df, "k", "t", ["t", "i"], ["i"]).orderBy("i").collect()] == [1, 2, 3, None]


SESSION = "session_sk string, object_id long, source string, station_key string, is_non_trivial boolean, start_utc timestamp, end_utc timestamp, start_local timestamp, end_local timestamp, energy_kwh double, charging_minutes double, connected_minutes double, zone string"
DIM = "station_key string, source string, operator_key string, capacity_grain string, zone string, ports long, active_from date, active_to date"
GAPS = "station_key string, gap_after date, gap_before date, excluded_days int"


def station_days(spark, dims, sessions, gaps=()):
    day = dt.date.fromisoformat
    dim = spark.createDataFrame([(k, s, s, "unit", z, p, day(a), day(b)) for k, s, z, p, a, b in dims], DIM)
    gap = spark.createDataFrame([(k, day(a), day(b), (day(b) - day(a)).days - 1) for k, a, b in gaps], GAPS)
    fact = spark.createDataFrame([], SESSION)
    for row in sessions:  # times as text in UTC
        one = spark.createDataFrame([row], SESSION.replace("timestamp", "string"))
        fact = fact.unionByName(one.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fact.schema)))
    return {(r["station_key"], str(r["day"])): r for r in gold.station_day(dim, gap, fact).collect()}


def test_station_day_splits_at_midnight(spark):
    """22:15 to 01:45: 105 of 210 connected minutes before midnight; 18 kWh over 180 charging minutes."""
    found = station_days(
        spark, [("alpha/S", "alpha", "America/Denver", 2, "2023-06-02", "2023-06-03")],
        [("a", 1, "alpha", "alpha/S", True, "2023-06-03 04:15:00", "2023-06-03 07:45:00", "2023-06-02 22:15:00", "2023-06-03 01:45:00", 18.0, 180.0, 210.0, "America/Denver")],
    )
    show = lambda d: tuple(found["alpha/S", d][c] for c in ("available_minutes", "sessions", "energy_kwh", "charging_minutes", "connected_minutes", "idle_minutes"))
    assert show("2023-06-02") == (2880.0, 1, 10.5, 105.0, 105.0, 0.0) and show("2023-06-03") == (2880.0, 0, 7.5, 75.0, 105.0, 30.0)


def test_station_day_when_clocks_change(spark):
    found = station_days(
        spark, [("gamma/CP", "gamma", "Europe/London", 1, "2017-03-26", "2017-03-26"), ("alpha/S", "alpha", "America/Denver", 3, "2023-11-05", "2023-11-05")],
        [("d", 1, "gamma", "gamma/CP", True, "2017-03-26 10:00:00", "2017-03-26 11:00:00", "2017-03-26 11:00:00", "2017-03-26 12:00:00", 20.0, None, 60.0, "Europe/London")],
    )
    spring, autumn = found["gamma/CP", "2017-03-26"], found["alpha/S", "2023-11-05"]
    assert (spring["day_minutes"], spring["energy_kwh"], spring["charging_minutes"], spring["connected_minutes"], spring["idle_minutes"]) == (1380.0, 20.0, None, 60.0, None)
    assert (autumn["available_minutes"], autumn["sessions"], autumn["energy_kwh"]) == (4500.0, 0, None)


def test_station_day_inside_a_gap(spark):
    """Dates strictly inside count nothing; a trivial session is counted beside and adds no minutes."""
    found = station_days(
        spark, [("beta/S", "beta", "America/New_York", 1, "2022-07-01", "2022-07-05")],
        [
            ("c1", 1, "beta", "beta/S", True, "2022-07-01 14:05:00", None, "2022-07-01 10:05:00", None, 6.5, 60.0, None, "America/New_York"),
            ("c2", 2, "beta", "beta/S", False, "2022-07-05 14:05:00", None, "2022-07-05 10:05:00", None, 0.0, 0.0, None, "America/New_York"),
        ],
        [("beta/S", "2022-07-01", "2022-07-05")],
    )
    rows = [found["beta/S", f"2022-07-0{d}"] for d in range(1, 6)]
    assert [r["is_excluded"] for r in rows] == [False, True, True, True, False] and [r["available_minutes"] for r in rows] == [1440.0, 0.0, 0.0, 0.0, 1440.0]
    assert [(r["sessions"], r["trivial_sessions"], r["charging_minutes"]) for r in rows] == [(1, 0, 60.0), (0, 0, None), (0, 0, None), (0, 0, None), (0, 1, None)]


def test_gaps_run_from_the_effective_end(spark):
    rows = [("a", "alpha", 0.0, 40 * 86400.0, 1, dt.date(1970, 1, 1), dt.date(1970, 2, 10)), ("a", "alpha", 71 * 86400.0, 71 * 86400.0 + 60, 2, dt.date(1970, 3, 13), dt.date(1970, 3, 13))]
    line = spark.createDataFrame(rows, "station_key string, source string, s double, e double, object_id long, start_day date, end_day date")
    found = I.gaps(line, {"alpha": 30, "gamma": 90}).collect()
    assert [(r["gap_after"], r["gap_before"], r["gap_days"], r["excluded_days"]) for r in found] == [(dt.date(1970, 2, 10), dt.date(1970, 3, 13), 31.0, 30)]
    assert I.gaps(line, {"alpha": 31}).isEmpty()


def test_refresh_equals_full_build(spark):
    """A source delivered again replaces its rows; the result is what a full build gives."""
    w = warehouse.opened(spark, "/root/testdata/sf0.001")
    changed = w.rows.withColumn("energy_kwh", F.when(F.col("source") == "beta", F.col("energy_kwh") + 1).otherwise(F.col("energy_kwh")))
    files = w.files.withColumn("sha256", F.when(F.col("source") == "beta", F.lit("v2")).otherwise(F.col("sha256")))
    accepted = changed.filter("primary_reason is null")
    fresh, full = gold.refreshed(w.fact, accepted, files), gold.session_fact(accepted, files)
    assert fresh.exceptAll(full).isEmpty() and full.exceptAll(fresh).isEmpty()
    assert [r["source"] for r in gold.stale_sources(w.fact, files).collect()] == ["beta"] and gold.stale_sources(w.fact, w.files).isEmpty()


def test_warehouse_is_built_anew_when_files_change(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(60).write.parquet(str(tmp_path / "events.parquet"))
    first = warehouse.opened(spark, str(tmp_path)).rows.count()
    events.limit(90).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    assert warehouse.opened(spark, str(tmp_path)).rows.count() > first


def test_quantiles_equal_linear_interpolation(spark):
    rng = random.Random(3)
    rows = [(g, round(rng.gauss(0, 1), 2) if rng.random() < 0.5 else 0.25) for g in "xy" for _ in range(333)]
    found = {(r["g"], r["q"]): r["value"] for r in quantiles.exact(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.0, 0.5, 0.9, 0.999, 1.0], 8).collect()}
    for g in "xy":
        own = np.array([v for k, v in rows if k == g])
        assert all(abs(found[g, q] - np.quantile(own, q)) < 1e-9 for q in (0.0, 0.5, 0.9, 0.999, 1.0))


def test_trailing_window_forgets_after_ninety_days(spark):
    """And says 1 after the last date with a session."""
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    days = spark.createDataFrame([("a", day(n)) for n in (0, 89, 90, 95, 96)], "station_key string, day date")
    levels = spark.createDataFrame([("a", day(0), 4), ("a", day(95), 2)], "station_key string, day date, level int")
    assert [r["ports"] for r in I.trailing_ports(levels, days).orderBy("day").collect()] == [4, 4, 1, 2, 1]


def test_sensitivity_covers_every_definition_and_rule(spark):
    from voltway.plans.registry import queries

    found = [r.asDict() for r in queries()["sensitivity_table"](spark, "/root/testdata/sf0.001").collect()]
    definitions = {*(f"robust_max_n{n}" for n in (1, 2, 3, 5, 10)), "connector_ids", "production", "trailing_90d_max"}
    sources = {r["source"] for r in found}
    assert {(r["session_rule"], r["definition"], r["source"], r["flavour"]) for r in found} == {
        (rule, d, s, f) for rule in ("non_trivial_only", "all_sessions") for d in definitions for s in sources for f in ("connected", "charging")
    } and len(found) == 32 * len(sources)
    assert all((r["over_full"] is None) == (r["with_measure"] == 0) == (r["utilization"] is None) for r in found)


def test_days_are_counted_at_every_level(spark):
    """Not at eight only: eleven at once on five days, thirteen on one."""
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    levels = spark.createDataFrame([("a", day(n), 11 if n < 5 else 13) for n in range(6)] + [("b", day(0), 2)], "station_key string, day date, level int")
    found = {(r["station_key"], r["level"]): r["days"] for r in I.days_at_level(levels).collect()}
    assert found == {("a", k): 6 if k <= 11 else 1 for k in range(1, 14)} | {("b", 1): 1, ("b", 2): 1}
    assert {tuple(r) for r in I.robust_max(I.days_at_level(levels), 5).collect()} == {("a", 11, 13), ("b", None, 2)}
    assert {tuple(r) for r in I.robust_max(I.days_at_level(levels, most=I.MOST_LEVELS), 5).collect()} == {("a", 8, 8), ("b", None, 2)}
