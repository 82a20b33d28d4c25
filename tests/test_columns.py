from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voltway.functions import columns as C
from voltway.operators import rules


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "minutes"), [("1:30:00", 90.0), ("100:00:30", 6000.5), ("0:00:00", 0.0), ("1:3:00", None), ("", None), (None, None), ("1:30:00\n", None)]
)
def test_hms(spark, text, minutes):
    assert one(spark, C.hms_to_minutes(F.col("t").cast("string")), t=text) == minutes


@pytest.mark.parametrize(
    ("text", "at"),
    [("2023-03-12 01:02:03", datetime(2023, 3, 12, 1, 2, 3)), ("3/5/2023 9:07", datetime(2023, 3, 5, 9, 7)), ("13/5/2023 9:07", None), ("2023-02-30 00:00:00", None), ("NA", None)],
)
def test_mixed_timestamps(spark, text, at):
    assert one(spark, C.parse_us_mixed("t"), t=text) == at


def test_second_of_two_equal_hours_and_spring_gap(spark):
    utc = lambda t: one(spark, C.local_to_utc(F.lit(t).cast("timestamp"), "America/Denver"))
    assert utc("2023-11-05 01:30:00") == datetime(2023, 11, 5, 8, 30)
    assert utc("2023-03-12 02:30:00") == datetime(2023, 3, 12, 9, 30)
    flag = lambda f, t: one(spark, f(F.lit(t).cast("timestamp"), "America/Denver"))
    assert flag(C.is_ambiguous_local, "2023-11-05 01:30:00") and not flag(C.is_ambiguous_local, "2023-11-05 02:30:00")
    assert flag(C.is_nonexistent_local, "2023-03-12 02:30:00") and not flag(C.is_nonexistent_local, "2023-03-12 03:30:00")
    assert flag(C.is_ambiguous_local, None) is False and flag(C.is_nonexistent_local, None) is False


def test_day_lengths(spark):
    day = lambda d: one(spark, C.local_day_minutes(F.lit(d).cast("date"), "America/Denver"))
    assert [day("2023-03-12"), day("2023-11-05"), day("2023-06-01")] == [1380.0, 1500.0, 1440.0]


def test_numbers_names_and_hashes(spark):
    assert one(spark, C.to_number("t"), t="5d") is None and one(spark, C.to_number("t"), t=" 12.5 ") == 12.5
    assert one(spark, C.leading_integer("t"), t="2 - Type 2") == "2" and one(spark, C.leading_integer("t"), t="Type") is None
    assert C.normal_name(" Energy (kWh) ") == "energy_kwh" and C.normal_name("1st") == "c_1st"
    empty, null = one(spark, C.row_hash(F.lit(""))), one(spark, C.row_hash(F.lit(None)))
    assert empty != null
    assert one(spark, C.joined_or_null(F.array().cast("array<string>"))) is None


def test_unknown_end_is_accepted_and_first_reason_wins(spark):
    row = dict(
        is_blank=False, start_local="2024-01-01", has_end=True, end_local=None, is_end_sentinel=None, is_nonexistent=False, is_exact_repeat=False, is_key_repeat=True, connected_minutes=5.0,
        energy_kwh=-2000.0, charging_minutes=9.0, precision_seconds=60, implied_kw=1.0, family="alpha",
    )
    df = spark.range(1).select(*(F.lit(v).alias(k) if v is not None else F.lit(None).cast("boolean").alias(k) for k, v in row.items()))
    found = df.select(rules.failing(rules.quarantine_rules()).alias("all"), rules.primary(rules.quarantine_rules()).alias("first")).first()
    assert found["all"] == ["natural_key_duplicate", "negative_energy", "energy_sentinel", "charging_exceeds_connected"]
    assert found["first"] == "natural_key_duplicate"


def test_zones_in_a_column_are_constants_of_the_plan_and_convert_as_by_name(spark):
    """Looking a zone up by its name for every value costs more than the conversion; other zones still work."""
    zones = [*C.ZONES, "Asia/Kolkata"]
    changes = ["2024-03-10", "2024-03-31", "2024-10-27", "2024-11-03"]
    hours = spark.createDataFrame([(d, z) for d in changes for z in zones], "d string, zone string").select(
        F.explode(F.expr("sequence(cast(d as timestamp), timestampadd(HOUR, 5, cast(d as timestamp)), interval 30 minutes)")).alias("ts"), "zone"
    )
    kinds = {"utc": C.local_to_utc, "local": C.utc_to_local, "gap": C.is_nonexistent_local, "twice": C.is_ambiguous_local}
    found = hours.select("ts", "zone", *(f("ts", F.col("zone")).alias(n) for n, f in kinds.items()))
    rows = {(r["ts"], r["zone"]): r[2:] for r in found.collect()}
    for zone in zones:
        for r in hours.filter(F.col("zone") == zone).select("ts", *(f("ts", zone).alias(n) for n, f in kinds.items())).collect():
            assert rows[r["ts"], zone] == r[1:]
    plan = hours.select(C.first_utc(F.col("ts"), F.col("zone")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert all(z in plan for z in C.ZONES)
