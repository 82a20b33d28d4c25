"""Profiles of sources on small frames whose answers are known."""

from datetime import datetime

from voltway.operators import source_profile as P

COLUMNS = "source string, source_file string, family string, station_name_raw string, site_key string, port_id string, start_local timestamp, end_local timestamp, energy_kwh double, charging_minutes double, reported_minutes double, has_end boolean, is_blank boolean, key_hash string"


def session(file, station, hour, kwh, charging=None, end=None, site="s", port=None, source="beta", reported=None, key=None, blank=False):
    at = datetime(2024, 1, 1, hour)
    return (source, file, source, station, site, port, at, end, kwh, charging, reported, source != "beta", blank, key or f"{station}{hour}")


def test_key_conflicts_tell_idle_rows_and_energies_apart(spark):
    rows = [session("f", "A", 1, 5.0, 30.0), session("f", "A", 1, 0.0, 0.0), session("f", "B", 1, 2.0, 9.0), session("f", "B", 1, 2.0, 8.0), session("f", "C", 1, 2.0, 9.0)]
    rows += [session("f", None, 2, 1.0, 1.0), session("f", None, 2, 3.0, 1.0), session("f", "D", 3, None, 1.0, blank=True), session("f", "D", 3, 1.0, 1.0, blank=True)]
    assert [tuple(r) for r in P.key_conflicts(spark.createDataFrame(rows, COLUMNS)).collect()] == [("beta", 2, 1, 1)]


def test_redelivered_cells_equal_a_join_of_the_files(spark):
    first = [session("a", "A", 1, 1.0), session("a", "A", 1, 2.0), session("a", "B", 1, None), session("a", "C", 1, 4.0), session("a", None, 1, 4.0)]
    second = [session("b", "A", 1, 1.0), session("b", "A", 1, 1.0), session("b", "B", 1, None), session("b", "B", 1, 7.0), session("b", "E", 1, 4.0), session("b", None, 1, 5.0), session("c", "A", 1, 9.0)]
    rows = spark.createDataFrame(first + second, COLUMNS)
    found = {r["column"]: (r["compared"], r["changed"]) for r in P.redelivered(rows, "a", "b", ["station_name_raw", "start_local"], ["energy_kwh", "port_id"]).collect()}
    a, b = rows.filter("source_file = 'a'").alias("a"), rows.filter("source_file = 'b'").alias("b")
    joined = a.join(b, ["station_name_raw", "start_local"]).selectExpr("count(*) AS n", "count_if(NOT a.energy_kwh <=> b.energy_kwh) AS c").first()
    assert found == {"energy_kwh": tuple(joined), "port_id": (joined["n"], 0)} and tuple(joined) == (6, 3)


def test_a_third_of_the_rows_under_one_key_is_counted_without_pairs(spark):
    hot = spark.range(6000).selectExpr("if(id % 2 = 0, 'a', 'b') AS source_file", "'A' AS station", "cast(id % 3 AS string) AS value")
    found = P.redelivered(hot, "a", "b", ["station"], ["value"]).first()
    assert (found["compared"], found["changed"]) == (9_000_000, 6_000_000)


def test_largest_sites_and_ties(spark):
    rows = [session("f", f"n{s}-{i}", 1, 1.0, site=f"site{s:02}") for s in range(20) for i in range(3 if s in (4, 17) else 1 + s % 2)] * 2
    found = [(r["place"], r["site_key"], r["n_names"]) for r in P.largest_sites(spark.createDataFrame(rows, COLUMNS), 4).orderBy("place").collect()]
    assert found == [(1, "site04", 3), (2, "site17", 3), (3, "site01", 2), (4, "site03", 2)]
    pairs = P.names_and_sites(spark.createDataFrame([session("f", "x", 1, 1.0, site="p"), session("f", "x", 1, 1.0, site="q"), session("f", "y", 1, 1.0, site="q"), session("f", "z", 1, 1.0, site=None)], COLUMNS)).first()
    assert (pairs["n_sites"], pairs["sites_with_several_names"], pairs["n_names"], pairs["names_at_several_sites"]) == (2, 1, 2, 1)


def test_profiles_of_no_rows(spark):
    none = spark.createDataFrame([], COLUMNS)
    for profile in (P.key_conflicts, P.span_figures, P.hour_gaps, P.names_and_sites, P.largest_sites, P.port_values, P.median_sessions, P.powers):
        assert profile(none).count() == 0, profile.__name__
