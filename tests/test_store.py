import hashlib
import json

import pytest
from pyspark.sql import functions as F

from voltway.plans import registry
from voltway.sources import contracts, deliveries, landing, store, warehouse
from voltway.sources import files as fs
from voltway.sources.contracts import CONTRACTS, Column, Contract, Family

EVENTS = "/root/testdata/sf0.001/events.parquet"
FACT = ("source", "family", "source_file", "station_key", "start_utc", "end_utc", "energy_kwh", "charging_minutes", "connected_minutes", "reported_minutes", "key_hash", "row_hash", "flags")


def landed_all(spark, root, sources=tuple(CONTRACTS)):
    drifts = {s: landing.land(spark, f"{root}/inbox", CONTRACTS[s], f"{root}/landed") for s in sources}
    return drifts, landing.manifest_log(spark, f"{root}/landed").latest()[1]["files"]


def rows(df, *names):
    return sorted(map(str, df.select(*names).collect()))


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """Published, landed and released once; tests that change it come back to equal files."""
    root = str(tmp_path_factory.mktemp("delivered"))
    deliveries.published_files(spark, spark.read.parquet(EVENTS), f"{root}/inbox")
    drifts, manifest = landed_all(spark, root)
    own = store.Store(spark, f"{root}/store")
    number, sources = own.release(manifest)
    assert number == 1 and sources == {"alpha", "beta", "gamma"}
    return root, own, drifts, manifest


def test_deliveries_land_and_nothing_changes_on_landing_again(spark, delivered):
    root, own, drifts, manifest = delivered
    assert {d.outcome for ds in drifts.values() for d in ds} <= {"ok", "info", "warn"} and len(drifts["gamma"]) == 4
    again, same = landed_all(spark, root)
    assert {f.code for ds in again.values() for d in ds for f in d.findings} == {"unchanged"} and same == manifest
    assert own.release(same) == (1, set())


def test_fact_equals_the_adapters(spark, delivered):
    _, own, _, _ = delivered
    names = [n for n in FACT if n not in ("source_file", "row_hash")]
    with own.hold() as held:
        assert rows(held.table("gold/fct_charging_session"), *names) == rows(warehouse.opened(spark, "/root/testdata/sf0.001").fact, *names)


def test_one_changed_delivery_rewrites_one_source(spark, delivered):
    root, own, _, _ = delivered
    with own.hold() as before:
        old = rows(before.table("gold/fct_station_day"), "station_key", "day", "sessions")
        deliveries.published_files(spark, spark.read.parquet(EVENTS).filter("event_id % 5 <> 1"), f"{root}/inbox", ("beta",))
        _, manifest = landed_all(spark, root, ("beta",))
        number, sources = own.release(manifest)
        assert sources == {"beta"}
        own.vacuum()
        assert rows(before.table("gold/fct_station_day"), "station_key", "day", "sessions") == old  # a held version stays readable
        with own.hold() as after:
            assert after.number == number == before.number + 1
            for name in store.TABLES:
                was, now = before.state["tables"][name], after.state["tables"][name]
                assert all(was[s] == now[s] for s in ("alpha", "gamma") if s in was) and was.get("beta") != now.get("beta")
            full = store.Store(spark, f"{root}/full")
            full.release(manifest)
            for name, names in (("gold/fct_charging_session", FACT), ("gold/fct_station_day", ("station_key", "day", "sessions", "energy_kwh", "available_minutes")), ("gold/mart_monthly", ("source", "operator_key", "year_month", "stations", "energy_kwh"))):
                with full.hold() as whole:
                    assert rows(after.table(name), *names) == rows(whole.table(name), *names)
            stale = before.state["tables"]["gold/mart_monthly"]["beta"]
    assert fs.exists(spark, stale)
    assert stale in own.vacuum() and not fs.exists(spark, stale)


def test_a_build_that_dies_leaves_the_tables(spark, delivered, monkeypatch):
    root, own, _, _ = delivered
    _, manifest = landed_all(spark, root)
    number, state = own.log.latest()
    before = rows(own.table(state, "gold/mart_monthly"), "source", "year_month", "energy_kwh")
    changed = {k: e | {"sha256": "0" * 64} if e["source"] == "gamma" else e for k, e in manifest.items()}

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(store.Delivered, "monthly", property(dies))
    with pytest.raises(RuntimeError):
        own.release(changed)
    assert own.log.latest() == (number, state) and rows(own.table(state, "gold/mart_monthly"), "source", "year_month", "energy_kwh") == before
    orphans = len(fs.folders(spark, f"{own.root}/tables"))
    own.vacuum()
    assert len(fs.folders(spark, f"{own.root}/tables")) == orphans  # it may be under way
    own.vacuum(orphans_after_s=-1)
    assert len(fs.folders(spark, f"{own.root}/tables")) == orphans - 1


def test_a_source_without_files_keeps_its_rows(spark, delivered):
    root, own, _, manifest = delivered
    _, state = own.log.latest()
    assert own.stale(state, {k: e for k, e in manifest.items() if e["source"] != "alpha"}) <= {"beta"}
    gone = {k: e for k, e in manifest.items() if not e["file_name"].startswith("public_sector_fasts_raw")}
    assert "gamma" in own.stale(state, gone)


def test_another_folder_leaves_frames_readable(spark):
    days = registry.queries()["fct_station_day"](spark, "/root/testdata/sf0.001")
    n = days.count()
    registry.queries()["fct_station_day"](spark, "/root/testdata/sf0.01").count()
    assert days.count() == n


def test_two_writers_of_a_log(spark, tmp_path):
    log = fs.Log(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {}) and log.commit(1, {"a": 1}) and not log.commit(1, {"b": 2})
    entered = []

    def change(state):
        if not entered:  # another commits between reading and writing
            entered.append(log.commit(2, state | {"other": 1}))
        return state | {"own": 1}

    assert log.update(change) == (3, {"a": 1, "other": 1, "own": 1})
    assert [f.name for f in fs.listed(spark, log.folder)] == ["0000000001.json", "0000000002.json", "0000000003.json"]


CONTRACT = Contract("demo", (Family("main", "sessions", (Column("id", "integer", True), Column("energy", "decimal", True), Column("note")), aliases=(("EnergySupplied", "energy"),), null_tokens=("NA",)),))


def test_many_files_are_checked_as_each_by_itself(spark, tmp_path):
    folder = tmp_path / "demo"
    folder.mkdir()
    texts = {
        "a sessions+[1].csv": "id,energy,note\n1,2.5,x\n2,NA,\n", "b_sessions.csv": "id,energy,note\n1,abc,x\n", "c_sessions.csv": "id,EnergySupplied\n1,2\n", "d_sessions.csv": "id,energy,note\n",
        "e_other.csv": "id\n1\n", "f_sessions.csv": "", "g_sessions.csv": "id,energy,note,extra\n1,1,\"a, \"\"b\"\"\",é\n", "h_sessions.csv": "id,energy,note\n1,,\n",
    }
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode("utf-8-sig" if name < "c" else "utf-8"))
    files = {}
    found = {d.file_name: d for d in landing.land_source(spark, folder, CONTRACT, tmp_path / "landed", files)}
    for name in texts:
        if name != "f_sessions.csv":  # nothing to read by itself
            _, alone = contracts.check_file(landing.read_raw(spark, str(folder / name)), CONTRACT, name)
            assert found[name].findings == alone.findings, name
    assert "empty_file" in found["f_sessions.csv"].codes
    assert {k.split("/")[1]: e["row_count"] for k, e in files.items()} == {n: max(0, t.count("\n") - 1) for n, t in texts.items()}
    back = landing.bronze(spark, files, "demo")
    assert sorted((r["_file_name"][0], r["id"], r["energy"], r["note"]) for r in back.select("_file_name", "id", "energy", "note").collect() if r["_file_name"][0] in "acg") == [
        ("a", "1", "2.5", "x"), ("a", "2", "NA", None), ("c", "1", "2", None), ("g", "1", "1", 'a, "b"')]


def test_landing_where_only_spark_reads(spark, tmp_path):
    """Through a mount table of Hadoop's: nothing opens the path as a local one."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shop.link./in", f"file://{tmp_path}")
    (tmp_path / "inbox" / "demo").mkdir(parents=True)
    (tmp_path / "inbox" / "demo" / "sessions.csv").write_text("id,energy,note\n1,2.5,x\n")
    drifts = landing.land(spark, "viewfs://shop/in/inbox", CONTRACT, "viewfs://shop/in/landed")
    number, state = landing.manifest_log(spark, "viewfs://shop/in/landed").latest()
    assert [d.outcome for d in drifts] == ["ok"] and number == 1
    assert landing.bronze(spark, state["files"], "demo").count() == 1
    landing.forget(spark, "viewfs://shop/in/landed", {"demo/sessions.csv"})
    assert landing.bronze(spark, landing.manifest_log(spark, "viewfs://shop/in/landed").latest()[1]["files"], "demo") is None


def test_digests_equal_hashlib(spark, tmp_path, monkeypatch):
    texts = {"a b.csv": b"x" * 1000, "empty.csv": b"", "é[1].csv": b"\x00\xff" * 70_000}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    expected = {n: hashlib.sha256(d).hexdigest() for n, d in texts.items()}
    found = fs.listed(spark, str(tmp_path), ".csv")
    assert fs.digests(spark, found) == expected
    monkeypatch.setattr(fs, "WHOLE_BYTES", 500)
    assert fs.digests(spark, found) == expected


def test_exports_of_equal_tables_have_equal_digests(spark, tmp_path):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("t"))
    first = landing.export_all({"table": (df.repartition(5), ["k", "id"], True)}, str(tmp_path / "a"))
    second = landing.export_all({"table": (df.orderBy(F.desc("id")), ["k", "id"], True)}, str(tmp_path / "b"))
    parts = [[(f["bytes"], f["sha256"]) for f in e["table"]["files"] + e["table"]["json"]] for e in (first, second)]
    assert parts[0] == parts[1] and first["table"]["rows"] == 500
    part = first["table"]["files"][0]
    assert hashlib.sha256((tmp_path / "a" / "table.parquet" / part["name"]).read_bytes()).hexdigest() == part["sha256"]
    told = json.loads((tmp_path / "a" / "manifest.json").read_text())
    assert told["relations"]["table"]["grain"] == ["k", "id"] and "| `t` | string |" in (tmp_path / "a" / "SCHEMA.md").read_text()
    records = [json.loads(x) for x in (tmp_path / "a" / "table.parquet.json" / first["table"]["json"][0]["name"]).read_text().splitlines()]
    assert records[:2] == [{"id": 0, "k": 0, "t": None}, {"id": 7, "k": 0, "t": "7"}]
