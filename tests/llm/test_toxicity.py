import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltway.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def made(n=1200, seed=5):
    """Insults make a text toxic; half of the toxic texts, and few others, mention a group."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"word{rng.randrange(60)}" for _ in range(20)]
        toxic = i % 4 == 0
        if toxic:
            words.insert(3, rng.choice(["vile", "rotten"]))
        if toxic and rng.random() < 0.7 or rng.random() < 0.03:
            words.insert(0, "muslim")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_swaps_take_the_weight_off_neutral_mentions(spark):
    rows, labels = made()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    with_swaps, without = (X.fit(docs, known, swap_penalty=p) for p in (100.0, 0.0))
    neutral = "my muslim neighbour bakes word3 word9 bread"
    assert with_swaps.scorer()(neutral) < without.scorer()(neutral)
    assert abs(with_swaps.weights.get(b"=muslim", 0.0)) < 0.2 * abs(without.weights[b"=muslim"])
    assert with_swaps.scorer()("a vile word3 thing") > 0.5 > with_swaps.scorer()("a christian word3 thing")


def test_swapped_labelled_sentences_score_alike(spark):
    """Whole sentences with a term swapped move their score little, and less than without the penalty."""
    rows, labels = made()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = {i for i, toxic in labels if not toxic}
    own = [t for i, t in rows if t.startswith("muslim ") and i in neutral]

    def furthest(model):
        score = model.scorer()
        return max(abs(score(t) - score(t.replace("muslim", other, 1))) for t in own for other in ("christian", "jewish", "hindu"))

    regular, plain = (furthest(X.fit(docs, known, swap_penalty=p)) for p in (100.0, 0.0))
    assert len(own) > 10 and regular < 0.05 and regular < 0.5 * plain


def test_a_swap_keeps_what_other_words_share():
    """A text that has both terms, or another word with the same beginning, loses only what nothing else in it has."""
    found = X.swapped({b"muslim", b"muslims", b"word"})
    assert {f for s in found for f in s["lost"]} <= {b"=muslim", b"=muslims", b"muslim*"} and all(b"musl*" not in s["lost"] for s in found)
    both = [s for s in X.swapped({b"gay", b"lesbian"}) if b"=lesbian" in s["lost"]]
    assert any(s["gained"] == [] for s in X.swapped({b"gay", b"lesbian"})) and both


def plain_weights(rows, n, pairs, penalty):
    """Adam on the weighted log loss, L2 and the swap penalty, a row and a feature at a time."""
    y = [r["label"] for r in rows]
    share = sum(y) / len(y)
    weight = [math.sqrt((1 - share) / share) if t else 1.0 for t in y]
    mean = sum(weight) / len(weight)
    w, m, v = [0.0] * n + [math.log(share / (1 - share))], [0.0] * (n + 1), [0.0] * (n + 1)
    for step in range(1, X.STEPS + 1):
        g = [X.L2 * x for x in w[:-1]] + [0.0]
        for r, t, u in zip(rows, y, weight, strict=True):
            error = (1 / (1 + math.exp(-sum(w[i] for i in [*r["at"], n]))) - t) * u / mean / len(rows)
            for i in [*r["at"], n]:
                g[i] += error
        for gained, lost, texts in pairs:
            move = 2 * penalty * texts / len(rows) * (sum(w[i] for i in gained) - sum(w[i] for i in lost))
            for i in gained:
                g[i] += move
            for i in lost:
                g[i] -= move
        for i in range(n + 1):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g[i], 0.999 * v[i] + 0.001 * g[i] ** 2
            w[i] -= X.RATE * (m[i] / (1 - 0.9**step)) / (math.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w


def test_weights_equal_brute_force():
    rng = random.Random(4)
    rows = [{"label": int(i % 3 == 0), "at": sorted(rng.sample(range(8), 3))} for i in range(30)]
    pairs = [((0, 1), (2,), 2.5), ((3,), (4, 5), 0.5)]
    names = [b"f%d" % i for i in range(8)]
    found = X.trained(rows, names, [(np.array(g), np.array(o), t) for g, o, t in pairs], 3.0)
    expected = plain_weights(rows, 8, pairs, 3.0)
    assert found.bias == pytest.approx(expected[-1], abs=1e-6) and [found.weights[n] for n in names] == pytest.approx(expected[:-1], abs=1e-6)


def test_scores_equal_brute_force(spark):
    """From the weights: the words of a text and their beginnings, each once."""
    rows, labels = made()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.fit(docs, known)
    texts = [t for _, t in rows[:200]] + ["", "VILE! vile,rotten-word3 Éé muslims", "word1 " * 5000]
    score = model.scorer()
    for text in texts:
        words = {w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", text.lower()) if w}
        found = {b"=" + w.encode() for w in words} | {w.encode()[:n] + b"*" for w in words for n in (4, 5, 6) if len(w.encode()) > n}
        z = model.bias + sum(model.weights.get(f, 0.0) for f in found)
        assert score(text) == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_one_id_with_many_rows_is_bounded(spark):
    docs = spark.createDataFrame([(7, f"text {i % 400}") for i in range(2000)] + [(i, f"own {i}") for i in range(20, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(20, 30)], "doc_id long, toxic int")
    rows = [tuple(r) for r in X.labelled_sample(docs, labels, 44, "doc_id", "text", "toxic", 1 << 30).collect()]
    assert len(rows) == len(set(rows)) == 14 and sum(label for label, _ in rows) == 4


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = X.scored(docs, labels).join(labels, "doc_id").filter("held_out")
    right, n, caught, toxic = held.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*"), F.sum(F.col("predicted") * F.col("toxic")), F.sum("toxic")).first()
    assert right / n > 0.9 and caught >= 0.5 * toxic


def test_edge_rows(spark, docs, texts, nothing):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (5, 1, 0), (5, 0, 0)], "doc_id long, toxic int, score int")
    rows = X.scored(docs, labels).collect()
    assert len(rows) == len(texts) and {r["score"] for r in rows} == {0.0} and all(isinstance(r["held_out"], bool) for r in rows)
    assert X.scored(nothing, labels).count() == 0 and X.without_toxic(docs, labels).columns == docs.columns
