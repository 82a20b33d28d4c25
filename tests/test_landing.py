from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voltway.operators import checks, incremental, reconcile
from voltway.sources import contracts, landing
from voltway.sources.contracts import Column, Contract, Family
from voltway.streaming import station_counts

CONTRACT = Contract(
    "demo", (Family("main", "sessions", (Column("id", "integer", True), Column("energy", "decimal", True), Column("note")), aliases=(("EnergySupplied", "energy"),), null_tokens=("NA",)),)
)


def put(folder: Path, name: str, text: str) -> Path:
    path = folder / name
    path.write_bytes(text.encode("utf-8-sig"))
    return path


def test_landing_states(spark, tmp_path):
    files, root = {}, tmp_path / "landed"
    raw = put(tmp_path, "sessions.csv", 'id,EnergySupplied,note\n1,2.5,"a, b"\n2,NA,\n')
    assert landing.land_file(spark, raw, CONTRACT, root, files).outcome == "info"
    back = landing.bronze(spark, files, "demo")
    assert [r.asDict()["note"] for r in back.orderBy("id").collect()] == ["a, b", None]
    assert files["demo/sessions.csv"]["row_count"] == 2
    assert landing.land_file(spark, raw, CONTRACT, root, files).findings[0].code == "unchanged"

    put(tmp_path, "sessions.csv", "id,energy,note\n")
    kept = landing.land_file(spark, raw, CONTRACT, root, files)
    assert "empty_file" in kept.codes and files["demo/sessions.csv"]["row_count"] == 2

    put(tmp_path, "sessions.csv", "id,power,note\n1,2,x\n")
    broken = landing.land_file(spark, raw, CONTRACT, root, files)
    assert broken.codes == ["missing_required"] and landing.QUARANTINED in files["demo/sessions.csv"]["landed_path"]
    log = landing.manifest_log(spark, tmp_path)
    assert log.commit(1, {"files": files}) and landing.manifest_table(spark, log.path(1)).count() == 0

    put(tmp_path, "sessions.csv", "id,energy,note\n1,abc,x\n")
    assert landing.land_file(spark, raw, CONTRACT, root, files).codes == ["retyped_required"]


def test_replacing_a_source_leaves_others(spark, tmp_path):
    fact = spark.createDataFrame([("a", 1), ("b", 2)], "source string, x int")
    path = str(tmp_path / "fact")
    incremental.write_replacing(fact, path)
    incremental.write_replacing(spark.createDataFrame([("b", 3), ("b", 4)], "source string, x int"), path)
    on_disk = sorted((r["source"], r["x"]) for r in spark.read.parquet(path).collect())
    assert on_disk == [("a", 1), ("b", 3), ("b", 4)]
    lazy = incremental.replaced(fact, spark.createDataFrame([("b", 3), ("b", 4)], "source string, x int"))
    assert sorted((r["source"], r["x"]) for r in lazy.collect()) == on_disk


def test_history(spark):
    history = spark.createDataFrame([("k", "x", 1, None), ("gone", "y", 1, None)], "key string, v string, valid_from int, valid_to int")
    same = spark.createDataFrame([("k", "x", 2)], "key string, v string, as_of int")
    assert sorted(map(tuple, incremental.scd2_step(history, same, "key", ["v"]).collect())) == [("gone", "y", 1, None), ("k", "x", 1, None)]
    new = spark.createDataFrame([("k", None, 3), ("n", "z", 3)], "key string, v string, as_of int")
    found = sorted((tuple(r) for r in incremental.scd2_step(history, new, "key", ["v"]).collect()), key=str)
    assert found == sorted([("gone", "y", 1, None), ("k", "x", 1, 3), ("k", None, 3, None), ("n", "z", 3, None)], key=str)


def test_export_and_schema_check(spark, tmp_path):
    df = spark.range(5).select("id", (F.col("id") * 2).alias("twice"))
    first, second = (landing.export(d, str(tmp_path / n), ["id"]) for n, d in (("a", df), ("b", df.orderBy(F.desc("id")))))
    assert first["rows"] == 5 and first["checksum"] == second["checksum"]
    assert checks.wrong_schema(df, df.schema) == [] and checks.wrong_schema(df.select("twice", "id"), df.schema)


def test_reconciling():
    assert reconcile.classify(0, 5, "count") == "ok" and reconcile.classify(1, 5, "count") == "blocking"
    assert reconcile.classify(1e-7, 10, "kwh") == "non_blocking" and reconcile.classify(1, 10, "kwh") == "blocking"
    assert reconcile.differences({"n": 2_000_000, "x": 2.0}, {"n": 1_999_999, "x": 2}) == ["n"]
    assert reconcile.run_status(True, True, False, False) == reconcile.run_status(False, False, True, True) == "regression"
    assert reconcile.differences({"a": 1.0, "b": {"c": 2}}, {"a": 1.0 + 1e-9, "b": {"c": 3}}) == ["b.c"]
    assert reconcile.run_status(False, True, True, False) == "upstream_changed"


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    station_counts.replay(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    stream = {tuple(r)[:3] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {tuple(r)[:3] for r in station_counts.windowed(events).collect()}
    assert stream and stream <= batch


def test_severities(spark, tmp_path):
    """A missing optional column and an all-null required one are told, and the file lands."""
    files = {}
    raw = put(tmp_path, "sessions.csv", "id,energy\n1,\n2,\n")
    drift = landing.land_file(spark, raw, CONTRACT, tmp_path / "landed", files)
    assert drift.outcome == "info" and {(f.code, f.column) for f in drift.findings} == {("all_null", "energy"), ("missing_optional", "note")}
    assert files["demo/sessions.csv"]["bytes"] == raw.stat().st_size


def test_land_source_tells_of_every_file(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    put(folder, "a_sessions.csv", "id,energy,note\n1,2.5,x\n")
    put(folder, "b_other.csv", "id\n1\n")
    put(folder, "c_sessions.csv", "id,energy,note,extra\n1,2.5,x,y\n")
    files = {}
    drifts = landing.land_source(spark, folder, CONTRACT, tmp_path / "landed", files)
    told = contracts.drift_record([("demo", d) for d in drifts], "run")
    assert [f["outcome"] for f in told["files"]] == ["ok", "quarantine", "warn"] and told["summary"]["quarantined_files"] == ["demo/b_other.csv"]
    assert landing.bronze(spark, files, "demo").count() == 2


def test_declared_contracts_choose_families(spark):
    gamma = contracts.CONTRACTS["gamma"]
    assert gamma.family("x_local_authority_rapids_raw_2017.csv").name == "rapids" and gamma.family("y.csv") is None
    raw = spark.createDataFrame([("E1", "C", "1", "2017-01-01", "10:00:00", "2017-01-01", "10:30:00", "3.5", "Body", "NA", "30")], "ChargingEvent string, CPID string, Connector string, StartDate string, StartTime string, EndDate string, EndTime string, EnergySupplied string, Name string, Price string, PluginDuration string")
    _, drift = contracts.check_file(raw, gamma, "local_authority_rapids_raw.csv")
    assert drift.outcome == "info" and [f.code for f in drift.findings] == ["aliased", "all_null"]


def test_a_missing_table_is_empty(spark, tmp_path):
    assert landing.existing(spark, str(tmp_path / "none" / "*.parquet"), landing.ENTRY).count() == 0


def test_other_suffixes_and_nameless_columns(spark, tmp_path):
    assert landing.read_raw(spark, str(put(tmp_path, "x.csv", ",id\n0,5\n"))).columns == ["publisher_row_index", "id"]
    with pytest.raises(ValueError):
        landing.read_raw(spark, str(tmp_path / "x.json"))
