import random
from collections import Counter

import numpy as np
import pandas as pd

from voltway.llm import dart_minhash as D
from voltway.llm.words import mixed

SF = "/root/testdata/sf0.001"


def classes(rows):
    """Brute force: connected components of all pairs with a weighted Jaccard similarity of 0.8 or more."""
    def bag(t):
        w = (t or "").encode().lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            if shared >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - shared):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    head = lambda own: min((d for d in own if d is not None), default=None)
    return sorted(((d, head(own)) for own in groups.values() for d in own), key=str)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    for n, share, most in ((60, 0.9, 1), (300, 0.85, 3)):
        away = []
        for _ in range(40):
            base = mixed(np.arange(2 * n, dtype=np.uint64) + np.uint64(rng.integers(1 << 40)), 7).view(np.int64)
            k = int(n * share)
            a, b = base[:n], np.concatenate([base[:k], base[n : 2 * n - k]])
            v = rng.integers(1, most + 1, n)
            w = np.concatenate([v[:k], rng.integers(1, most + 1, n - k)])
            s = D.signatures([(a, v), (b, w)])
            away.append((s[0] == s[1]).mean() - v[:k].sum() / (v.sum() + w.sum() - v[:k].sum()))
        assert abs(np.mean(away)) < 4 * np.std(away) / np.sqrt(len(away))


def test_classes_equal_brute_force(spark, docs, texts, nothing):
    found = sorted((tuple(r) for r in D.classified(docs).collect()), key=str)
    assert found == classes(texts) and D.classified(nothing).count() == 0
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert sorted((tuple(r) for r in D.classified(table).collect()), key=str) == classes([tuple(r) for r in table.collect()])


def test_group_of_near_copies_without_a_common_base(spark):
    """A chain whose neighbours only are near, beside copies of one text."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    chain = []
    for i in range(12):
        for k in rng.sample(range(400), 4):
            words[k] = f"x{i}.{k}"
        chain.append((i, " ".join(words)))
    base = [f"b{i}" for i in range(300)]
    group = []
    for i in range(60):
        own = base.copy()
        for k in rng.sample(range(300), rng.choice([1, 2, 6, 8])):
            own[k] = f"y{i}.{k}"
        group.append((100 + i, " ".join(own)))
    rows = chain + group
    found = D.classified(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in found), key=str) == classes(rows)


def test_cells_give_a_link_to_each_near_component():
    text = [" ".join(f"{k}{i}" for i in range(40)).encode() for k in "aab"]
    others = pd.DataFrame({"other_node": [1, 2, 3], "other_component": [1, 1, 3], "other_text": text})
    minors = pd.DataFrame({"node": [9], "component": [9], "text": [text[0]]})
    assert D.linked_in_cell(minors, others, 0.8).values.tolist() == [[9, 1]]


def test_one_document_stays(docs, texts):
    kept = D.deduplicated(docs)
    assert kept.columns == docs.columns
    heads = {h for _, h in classes(texts)}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(h for h in heads if h is not None)
