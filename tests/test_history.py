import random

import pytest
from pyspark.sql import functions as F

from voltway.operators import compare, gold, profiling
from voltway.operators import sessions as S
from voltway.operators import source_profile as P
from voltway.sources import files as fs
from voltway.sources.history import History
from voltway.sources.warehouse import Warehouse

ROWS = "k string, v string, as_of int"


def versions(own):
    return sorted(((r["k"], r["v"], r["valid_from"], r["valid_to"]) for r in own.table().collect()), key=str)


def test_history_over_runs(spark, tmp_path):
    own = History(spark, str(tmp_path / "h"), "k", ["v"])
    run = lambda at, **values: own.run(spark.createDataFrame([(k, v, at) for k, v in values.items()], ROWS))
    run(1, a="x", b="y", c=None)
    state = own.log.latest()[1]
    run(2, a="x", b="z", c=None)
    first_closed = own.log.latest()[1]["closed"]
    run(3, b="z", c="w", d="new")  # a goes: it stays open
    run(4, b="z", c="w", d="new")  # nothing changes
    assert versions(own) == sorted([("a", "x", 1, None), ("b", "y", 1, 2), ("b", "z", 2, None), ("c", None, 1, 3), ("c", "w", 3, None), ("d", "new", 3, None)], key=str)
    number, last = own.log.latest()
    assert number == 4 and last["closed"][:1] == first_closed and len(last["closed"]) == 2 and state["closed"] == []
    assert {(r["k"], r["v"]) for r in own.as_of(2).collect()} == {("a", "x"), ("b", "z"), ("c", None)}
    ids = [r["scd_id"] for r in own.table().collect()]
    assert len(set(ids)) == len(ids)


def test_a_run_that_dies_or_comes_second_changes_nothing(spark, tmp_path, monkeypatch):
    own = History(spark, str(tmp_path / "h"), "k", ["v"])
    own.run(spark.createDataFrame([("a", "x", 1)], ROWS))
    before = versions(own)
    monkeypatch.setattr(fs.Log, "commit", lambda *_: False)
    with pytest.raises(RuntimeError):
        own.run(spark.createDataFrame([("a", "y", 2)], ROWS))
    assert versions(own) == before


def test_versions_differ(spark):
    schema = "k string, j string, n long, x double"
    old = spark.createDataFrame([("a", None, 2_000_000, 1.0), ("b", "1", 5, 2.0), ("c", "1", None, None), ("gone", "1", 1, None)], schema)
    new = spark.createDataFrame([("a", None, 1_999_999, 1.0 + 1e-9), ("b", "1", 5, 2.1), ("c", "1", None, None), ("new", None, 1, 1.0)], schema)
    found = {(r["k"], r["j"], r["name"]): (r["before"], r["after"]) for r in compare.table_differences(old, new, ["k", "j"], ["n"], ["x"]).collect()}
    assert found == {
        ("a", None, "n"): (2_000_000.0, 1_999_999.0), ("b", "1", "x"): (2.0, 2.1), ("gone", "1", "n"): (1.0, None), ("gone", "1", "x"): (None, None),
        ("new", None, "n"): (None, 1.0), ("new", None, "x"): (None, 1.0)}
    one, two = {"inputs": {"s": {"f": {"sha256": "1", "rows": 2}, "g": {"sha256": "1", "rows": 1}}}}, {"inputs": {"s": {"f": {"sha256": "2", "rows": 3}}, "t": {"h": {"sha256": "1", "rows": 1}}}}
    changes = compare.input_changes(one["inputs"], two["inputs"])
    assert [(c["file"], c["change"], c["rows_before"], c["rows_after"]) for c in changes] == [("f", "changed", 2, 3), ("g", "removed", 1, None), ("h", "added", None, 1)]
    same, differ = old.limit(0).select("k"), old.select("k")
    assert [compare.compared(a, b, d, **o)["status"] for a, b, d, o in ((one, two, differ, {}), (one, one, differ, {}), (one, one, same, {}), (one, one, same, {"set_aside": True}), (one, two, same, {"blocking": True}))] == [
        "upstream_changed", "regression", "ok", "source_problem", "regression"]


def test_intervals_that_end_before_they_start_do_not_run(spark):
    df = spark.createDataFrame([("a", i, s, e) for i, (s, e) in enumerate([(5.0, 1.0), (2.0, 3.0), (0.0, 10.0), (4.0, None), (None, 5.0)])], "k string, i long, s double, e double").withColumn("start_day", F.lit(None).cast("date"))
    assert profiling.max_concurrency(df, "k", "s", "e", "i").first()["most"] == 2


@pytest.fixture
def shuffled(spark):
    """Joins and windows by shuffles alone, without merging partitions."""
    put = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in put}
    for k, v in put.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_key_on_a_third_of_the_rows_is_not_one_task(spark, shuffled):
    rng = random.Random(2)
    rows = [(i, "s", "blank" if i % 3 == 0 else f"r{rng.randrange(900)}", "none" if i % 3 == 0 else f"k{rng.randrange(700)}", float(rng.randrange(5)), None, "f") for i in range(3000)]
    df = spark.createDataFrame(rows, "object_id long, source string, row_hash string, key_hash string, order_1 double, order_2 double, source_file string").repartition(6)
    order = lambda r: (r[4], r[6], r[2], r[0])
    rank = {}
    for at, key in ((2, "exact"), (3, "key")):
        groups = {}
        for r in sorted(rows, key=order):
            groups.setdefault(r[at], []).append(r[0])
        rank[key] = {i: k for ids in groups.values() for k, i in enumerate(ids, 1)}
    assert {r["object_id"]: (r["exact_rank"], r["key_rank"]) for r in S.ranked(df).collect()} == {i: (rank["exact"][i], rank["key"][i]) for i in range(3000)}
    assert {r["object_id"]: (r["is_exact_repeat"], r["is_key_repeat"]) for r in S.marked(df).collect()} == {i: (rank["exact"][i] > 1, rank["key"][i] > 1) for i in range(3000)}
    spread = lambda found: max(r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert spread(S.repeats(df, "row_hash")) < 600 and spread(S.places(df, "row_hash", "place")) < 900


def test_rows_without_a_position_have_seen_all_deliveries(spark):
    rows = [(i, i % 4) for i in range(12)] + [(None, None)] * 500 + [(None, 3)] * 3
    df = spark.createDataFrame(rows, "file_row long, delivery_row long")
    found = sorted(((r["file_row"], r["delivery_block"]) for r in S.delivery_blocks(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert found == [(i, i // 4) for i in range(12)] + [(None, 2)] * 503


def test_key_sets_of_many_files(spark):
    """Sets of files beyond one word of bits, against brute force."""
    rng = random.Random(3)
    rows = [("s", f"f{rng.choice([0, 1, 61, 62, 63, 129]):03d}", f"k{rng.randrange(60)}") for _ in range(300)] + [("s", f"f{i:03d}", "all") for i in range(130)] + [("t", "f000", None), ("t", "f001", None)]
    found = {(r["source"], r["files"]): r["n_keys"] for r in P.keys_by_files(spark.createDataFrame(rows, "source string, source_file string, key_hash string")).collect()}
    sets = {}
    for source, file, key in rows:
        sets.setdefault((source, key), set()).add(file)
    expected = {}
    for (source, _), own in sets.items():
        if len(own) > 1:
            name = source, " & ".join(sorted(own))
            expected[name] = expected.get(name, 0) + 1
    assert found == expected


def test_session_ids(spark):
    rows = [("s", "a", "1"), ("s", "a", "1"), ("s", "b", "1"), ("s", "b", "2"), ("s", "b", None), ("s", "c", None), ("t", "a", None)]
    found = {r["source"]: tuple(r)[1:] for r in P.session_ids(spark.createDataFrame(rows, "source string, source_file string, source_session_id string")).collect()}
    assert found == {"s": (6, 2, 2, 1, 1), "t": (1, 1, 0, 0, 0)}


def test_samples_are_the_first_met_in_a_file(spark, tmp_path):
    rng = random.Random(8)
    lines = [f"{rng.randrange(40)},{rng.choice(['', ' x', 'y', 'z'])}" for _ in range(20_000)]
    (tmp_path / "a.csv").write_text("n,t\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = spark.read.csv(str(tmp_path / "a.csv"), header=True).select("*", profiling.arrival().alias("at"))
        assert df.rdd.getNumPartitions() > 3
        found = {(r["name"], r["k"]): r["value"] for r in profiling.first_met(df, "at").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for at, name in enumerate("nt"):
        texts = [x.split(",")[at].strip() for x in lines]
        assert [found.get((name, k)) for k in range(1, 6)] == (list(dict.fromkeys(t for t in texts if t)) + [None] * 5)[:5]


def test_measures_are_not_shuffled_with_the_marks(spark):
    rows = S.typed(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    judged = S.judged(rows)._jdf.queryExecution().optimizedPlan().toString()
    below = judged[judged.index("Join LeftOuter"):]
    assert "implied_kw" not in below and "connected_minutes" not in below


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_marks_with_kept_steps_shuffle_no_wide_rows_where_repeats_are_few(spark, tmp_path, monkeypatch, few):
    """Marks equal those without kept steps, whether the steps are small or not; small ones leave the wide rows where they are."""
    monkeypatch.setattr(S, "FEW", few)

    def keep(name, made):
        made.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(made.schema).parquet(f"{tmp_path}/{name}")

    rng = random.Random(3)
    rows = [(i, "st"[i % 2], rng.choice(["blank", None, f"r{rng.randrange(900)}"]), rng.choice([None, f"k{rng.randrange(700)}"]), float(rng.randrange(5)), None, "f", "w" * 50) for i in range(2000)]
    df = spark.createDataFrame(rows, "object_id long, source string, row_hash string, key_hash string, order_1 double, order_2 double, source_file string, wide string").repartition(6)
    flags = lambda found: sorted((r["object_id"], r["is_exact_repeat"], r["is_key_repeat"]) for r in found.collect())
    found = S.marked(df, keep)
    assert flags(found) == flags(S.marked(df)) and sum(r[1] for r in flags(found)) > 500
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        plan = found.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ("BroadcastHashJoin" in plan) == (few > 0) and ("SortMergeJoin" in plan) == (few == 0)


def test_marks_of_many_repeats_whose_ids_lie_close_shuffle_no_wide_rows(spark, tmp_path, monkeypatch):
    """More repeats than are broadcast by themselves: as maps of ids, below zero, in several spans and absent ones."""
    monkeypatch.setattr(S, "FEW", 20 * S.ROWS_A_MAP)

    def keep(name, made):
        made.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(made.schema).parquet(f"{tmp_path}/{name}")

    rng = random.Random(5)
    at = lambda i: 13 * i - 6_000 + 10**9 * (i % 5 == 0)
    rows = [(at(i), "st"[i % 2], rng.choice([None, f"r{rng.randrange(200)}"]), rng.choice([None, f"k{rng.randrange(150)}"]), float(rng.randrange(5)), None, "f", "w") for i in range(2000)]
    rows += [(None, "s", f"alone{i}", f"alone{i}", 0.0, None, "f", "w") for i in range(3)]
    df = spark.createDataFrame(rows, "object_id long, source string, row_hash string, key_hash string, order_1 double, order_2 double, source_file string, wide string").repartition(6)
    flags = lambda found: sorted(((r["object_id"], r["is_exact_repeat"], r["is_key_repeat"]) for r in found.collect()), key=str)
    found = S.marked(df, keep)
    assert flags(found) == flags(S.marked(df)) and sum(r[1] + r[2] for r in flags(found)) > S.FEW
    plan = found.select("*")._jdf.queryExecution().optimizedPlan().toString()
    assert "_map" in plan and "strategy=broadcast" in plan


def test_the_fact_needs_no_silver_written_and_converts_no_time_twice(spark, tmp_path):
    w = Warehouse(spark, spark.read.parquet("/root/testdata/sf0.001/events.parquet"), str(tmp_path / "w"))
    fact = w.fact
    assert not (tmp_path / "w" / "silver" / "sessions").exists()
    conversions = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("to_utc_timestamp")
    assert conversions(S.unioned(w.told)) == conversions(w.told)
    stored = gold.session_fact(w.sessions, w.files)
    assert (tmp_path / "w" / "silver" / "sessions").exists()
    assert fact.exceptAll(stored).isEmpty() and stored.exceptAll(fact).isEmpty()
