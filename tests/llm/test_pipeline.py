import re
from collections import Counter
from itertools import combinations

import __spark_entry__ as entry
import corpus_pipeline as P
from voltway.llm import common, line_rules, packing, toxicity

SF = "/root/testdata/sf0.001"


def first_of_each(texts):
    """The smallest id of each component of texts whose five-word shingles, with counts, are 0.8 alike; all pairs compared."""
    sets = {}
    for i, t in texts.items():
        words = re.sub("[A-Z]+", lambda m: m.group().lower(), t).split()
        sets[i] = Counter(zip(*(words[k:] for k in range(min(5, max(1, len(words)))))))
    head = {i: i for i in texts}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, j in combinations(sorted(texts), 2):
        shared = (sets[i] & sets[j]).total()
        if sets[i] == sets[j] or shared and shared >= 0.8 * (sets[i].total() + sets[j].total() - shared):
            a, b = sorted((find(i), find(j)))
            head[b] = a
    return {find(i) for i in texts}


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    common.importable(spark)
    lines = line_rules.common_lines(docs)
    clean = {r["doc_id"]: line_rules.judge(r["text"].encode(), common=lines) for r in docs.collect()}
    stage = common.written(P.quality(spark, docs, SF), "t1")
    assert {r["doc_id"]: r["text"] for r in stage.collect()} == {i: m[-1] for i, m in clean.items() if m[6]}
    score = toxicity.fit(stage, labels).scorer()
    second = common.written(P.nontoxic(spark, stage, SF), "t2")
    assert {r["doc_id"] for r in second.collect()} == {r["doc_id"] for r in stage.collect() if score(r["text"]) < 0.5}
    third = common.written(P.distinct(spark, second, SF), "t3")
    assert {r["doc_id"] for r in third.collect()} == first_of_each({r["doc_id"]: r["text"] for r in second.collect()})
    assert [d.columns == docs.columns for d in (stage, second, third)] == [True] * 3
    ours, theirs = packing.packed(third).drop("sequence_id", "offset"), P.run(spark, SF).drop("sequence_id", "offset")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def put(folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_edge_rows(spark, tmp_path, docs, texts):
    """Null, empty and short texts go as too short, repeated ones as repetitive; of copies the smallest id stays; a null id that has no copy stays."""
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (5, 1, 0), (5, 0, 0)], "doc_id long, toxic int, score int")
    rows = P.run(spark, put(tmp_path, docs, labels)).collect()
    assert {r["doc_id"] for r in rows} == {5, 8, None}
    assert {r["piece"] for r in rows if r["doc_id"] == 5} == {0} and len({r["piece"] for r in rows if r["doc_id"] == 8}) > 1


def test_empty_tables(spark, tmp_path, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert P.run(spark, put(tmp_path, nothing, labels)).count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
