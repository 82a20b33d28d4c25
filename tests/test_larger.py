"""Queries against their SQL on events repeated under shifted keys, so that sessions alike in all their texts come from several events."""

import duckdb
import pytest

import __spark_entry__ as entry
from test_oracle import SF, SQL, rows

NAMES = (
    "blocking_windows check_primary_reason check_rows_lost concurrency_running dedup_ranks duplicate_twin_buckets fact_refresh fct_charging_session flag_counts "
    "inter_session_gap_quantiles midnight_pieces power_quantiles reason_counts"
).split()
#: 7371 s are 2.0475 h: a half of the thousandths that gamma publishes. Ids are of gamma's hourly files.
HALVES = "SELECT 1000010 + 12 * i AS event_id, TIMESTAMP '2024-01-05' + INTERVAL (i) HOUR AS ts, i AS user_id, 'view' AS event_type, 98.28 AS value, '{\"k\": 1}' AS props FROM range(40) r(i)"


EVENTS = f"SELECT event_id + 1000 * i AS event_id, ts, user_id + 1500 * i AS user_id, event_type, value, props FROM '{SF}/events.parquet', range({{0}}) r(i)"


@pytest.fixture(scope="module")
def larger(tmp_path_factory):
    folder = tmp_path_factory.mktemp("larger")
    duckdb.sql(f"COPY ({EVENTS.format(4)}) TO '{folder}/events.parquet'")
    return str(folder)


def compared(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{folder}/events.parquet'")
    ours, theirs = entry.queries()[name](spark, folder).toPandas(), con.sql(SQL[name]).df()
    return rows(ours), rows(theirs)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, larger, name):
    ours, theirs = compared(spark, larger, name)
    assert ours == theirs


def test_halves_of_published_hours_round_up(spark, tmp_path):
    duckdb.sql(f"COPY ({EVENTS.format(1)} UNION ALL {HALVES}) TO '{tmp_path}/events.parquet'")
    ours, theirs = compared(spark, str(tmp_path), "delivered_fact")
    assert ours == theirs
    assert sum("122.88" in r for r in ours) > 20


#: Sessions alike but for the site or a second, of every source and family: which of them counts, its texts say. Ids are 12 apart, so that 40 of each class lie close together.
TIES = """SELECT 2000000 + 12 * (2 * i + j) + c AS event_id, TIMESTAMP '2024-01-05' + INTERVAL (i) HOUR AS ts, i AS user_id, ['view', 'click', 'purchase', 'error', 'signup'][(i + j) % 5 + 1] AS event_type,
  37.5 AS value, '{"k": 1}' AS props FROM range(40) r(i), range(2) s(j), range(12) u(c)"""


def test_texts_say_which_of_landed_repeats_counts(spark, tmp_path):
    """In any number of files a family."""
    duckdb.sql(f"COPY ({EVENTS.format(4)} UNION ALL {TIES}) TO '{tmp_path}/events.parquet' (ROW_GROUP_SIZE 2048)")
    ours, theirs = compared(spark, str(tmp_path), "delivered_fact")
    assert ours == theirs
    assert {r["family"] for r in entry.queries()["delivered_fact"](spark, str(tmp_path)).filter("start_s >= unix_timestamp(timestamp'2024-03-06')").select("family").distinct().collect()} == {"alpha", "beta", "rapids", "rapids_anomalies", "fasts", "fasts_anomalies"}


#: Sixteen sessions of five hours at once, but for the faulty, at one of beta's stations, on six days.
BUSY = "SELECT 3000000 + 3 * (100 * i + j) + 1 AS event_id, TIMESTAMP '2024-01-05' + INTERVAL (i) DAY + INTERVAL (j) MINUTE AS ts, 5 AS user_id, 'view' AS event_type, 300.0 AS value, '{\"k\": 1}' AS props FROM range(6) r(i), range(16) s(j)"


def test_stations_have_as_many_ports_as_ran_at_once(spark, tmp_path):
    """More than eight."""
    duckdb.sql(f"COPY ({EVENTS.format(1)} UNION ALL {BUSY}) TO '{tmp_path}/events.parquet'")
    ours, theirs = compared(spark, str(tmp_path), "stations_as_of")
    assert ours == theirs
    found = {r["station_key"]: r["ports"] for r in entry.queries()["stations_as_of"](spark, str(tmp_path)).collect()}
    assert found["beta/Garage 5"] >= 12
    ours, theirs = compared(spark, str(tmp_path), "station_history")
    assert ours == theirs
