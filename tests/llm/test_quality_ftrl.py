import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltway.llm import common
from voltway.llm import quality_ftrl as Q

SF = "/root/testdata/sf0.01"


def plain_leader(rows, state):
    """FTRL-Proximal a coordinate at a time, over dicts."""
    z, n = dict(state[0]), dict(state[1])

    def weight(i):
        if abs(z.get(i, 0.0)) <= Q.L1:
            return 0.0
        return -(z[i] - math.copysign(Q.L1, z[i])) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2)

    for label, features in rows:
        at = [*features, Q.BUCKETS]
        w = {i: weight(i) for i in at}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i in at:
            z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / Q.ALPHA * w[i]
            n[i] = n.get(i, 0.0) + g * g
    return z, n


def plain_features(text):
    words = Q.WORDS.findall((text or "").encode())
    said = [b"\x00again" if k and w == words[k - 1] else w for k, w in enumerate(words)]
    return {(w,) for w in said} | set(zip(said, said[1:], strict=False))


def made(n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [f"word{rng.randrange(80)}" for _ in range(25)]
        good = i % 3 != 0
        if not good:
            words = [w + "&&&" if rng.random() < 0.5 else w for w in words] if i % 2 else [words[0]] * 25
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return rows, labels


@pytest.fixture(scope="module")
def small(spark):
    rows, labels = made()
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_scores_equal_brute_force(spark, small):
    """Training and scores over dicts, coordinate by coordinate, from the same shards and order."""
    docs, labels = small
    training = common.remainder("doc_id", 3) != 1
    rows = Q.feature_rows(Q.labelled_sample(docs, labels, training)).collect()
    assert len(rows) == labels.filter(training).count()
    shards = {}
    for r in sorted(rows, key=lambda r: (r["shard"], r["place"], r["label"])):
        shards.setdefault(r["shard"], []).append((r["label"], r["features"]))
    state = ({}, {})
    for _ in range(Q.PASSES):
        found = [plain_leader(own, state) for own in shards.values()]
        state = tuple({i: sum(s[k].get(i, 0.0) for s in found) / len(found) for i in set().union(*(s[k] for s in found))} for k in (0, 1))
    z, n = state
    weights = {i: 0.0 if abs(v) <= Q.L1 else -(v - math.copysign(Q.L1, v)) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2) for i, v in z.items()}
    hasher = Q.Hasher()
    scores = {r["doc_id"]: r["score"] for r in Q.scored(docs, labels).collect()}
    for doc_id, text in made()[0]:
        expected = 1 / (1 + math.exp(-sum(weights.get(int(i), 0.0) for i in [*hasher.features(text.encode()), Q.BUCKETS])))
        assert scores[doc_id] == pytest.approx(expected, abs=1e-9)


def test_features_are_the_distinct_ngrams():
    hasher = Q.Hasher()
    for text in (None, "", "one", "a b a b a b", "the the the end.", "é&&& x!! | y", "w " * 5000):
        found = hasher.features((text or "").encode() if text is not None else None)
        assert len(found) == len(plain_features(text)) and (np.diff(found) > 0).all()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = Q.scored(docs, labels).join(labels, "doc_id").filter("held_out")
    good, kept, bad, caught = held.agg(F.sum("quality"), F.sum(F.col("quality") * F.col("predicted")), F.sum(1 - F.col("quality")), F.sum((1 - F.col("quality")) * (1 - F.col("predicted")))).first()
    assert kept >= 0.98 * good and caught >= 0.8 * bad


def test_held_out_labels_teach_nothing(spark, small):
    docs, labels = small
    turned = labels.withColumn("quality", F.when(common.remainder("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(Q.scored(docs, labels).collect()) == sorted(Q.scored(docs, turned).collect())


def test_sample_bounds_an_id_with_many_rows(spark):
    docs = spark.createDataFrame([(7, f"text {i % 400}") for i in range(2000)] + [(i, f"own {i}") for i in range(20, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(20, 30)], "doc_id long, quality int")
    rows = Q.labelled_sample(docs, labels, F.lit(True), 44).collect()
    assert len(rows) == len(set(rows)) and sum(r["label"] == 0 for r in rows) == 10 and sum(r["label"] for r in rows) <= 12
    assert Q.labelled_sample(docs, labels, F.lit(True), 3).count() <= 11


def test_edge_rows(spark, docs, texts, nothing):
    schema = "doc_id long, quality int, score int"
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (5, 1, 0), (5, 0, 0), (6, 1, 2)], schema)
    rows = Q.scored(docs, labels).collect()
    assert len(rows) == len(texts) and all(0.5 <= r["score"] <= 1 and r["predicted"] == 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert {r["score"] for r in Q.scored(docs, spark.createDataFrame([], schema)).collect()} == {0.5}
    found = Q.scored(nothing, labels)
    assert found.count() == 0 and found.columns == ["doc_id", "held_out", "score", "predicted"]
