import numpy as np

from voltway.llm import common
from voltway.llm import multiprobe as M

SCHEMA = "vec_id long, embedding array<float>, score double, rank int, point string"


def test_recall_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 16)).astype(np.float32) * rng.uniform(0.5, 2, (900, 1)).astype(np.float32)
    x[100:400] = x[100]  # a third of all vectors are one
    rows = [(i, v.tolist(), 0.0, 1, "p") for i, v in enumerate(x)]
    rows += [rows[40], (5000, None, 0.0, 1, "p"), (5020, [0.0] * 16, 0.0, 1, "p"), (5040, [float("nan")] * 16, 0.0, 1, "p"), (5060, [], 0.0, 1, "p"), (None, [1.0] * 16, 0.0, 1, "p")]
    found = {}
    for r in M.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y = x.astype(float)
    hits = 0
    for q in range(0, 900, 20):
        own = sorted(found[q])
        s = np.array([(y[q] * v).sum() for v in y])
        s[q] = -np.inf
        best = np.lexsort((np.arange(900), -s))[:20]
        assert [r for r, _, _ in own] == list(range(1, 21)) and all(np.isclose(s[v], sc, rtol=1e-12) for _, v, sc in own)
        assert own == sorted(own, key=lambda t: (-t[2], t[1]))
        hits += len({v for _, v, _ in own} & set(best.tolist()))
    assert hits / (45 * 20) >= 0.9 and set(found) == set(range(0, 900, 20))
    exact = [v for _, v, _ in sorted(found[100])]
    assert exact[:19] == list(range(101, 120)) or x[100] @ x[100] < max(x @ x[100])


def test_one_long_vector(spark):
    """The long one squeezes all others into few buckets, which some queries do not visit."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    x[7] *= 20
    found = {}
    for r in M.nearest(spark.createDataFrame([(i, v.tolist(), 0.0, 1, "p") for i, v in enumerate(x)], SCHEMA)).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    s = x[::20].astype(float) @ x.astype(float).T
    s[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    best = np.argsort(-s, axis=1, kind="stable")[:, :20]
    assert set(found) == set(range(0, 4000, 20)) and all(sorted(r for r, _ in own) == list(range(1, 21)) for own in found.values())
    shares = [len({v for _, v in found[20 * i]} & set(b.tolist())) / 20 for i, b in enumerate(best)]
    assert min(shares) >= 0.5 and np.mean(shares) >= 0.95


def recall_of(found, x, ids):
    """Share of the true 20 nearest of each query (float64, ties to smaller ids) among those found; scores must be exact."""
    own, at = {}, {int(v): k for k, v in enumerate(ids)}
    for r in found:
        own.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in (int(v) for v in ids if v % 20 == 0):
        s = x @ x[at[q]]
        assert all(np.isclose(s[at[v]], score, rtol=1e-9, atol=1e-12) for _, v, score in own[q])
        s[at[q]] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        hits += len({v for _, v, _ in own[q]} & {int(ids[b]) for b in best})
        total += 20
    return hits / total


def test_recall_on_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [r for r in table.collect() if r["embedding"] is not None and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])]
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    assert recall_of(M.nearest(table).collect(), x, ids) >= 0.9


def test_recall_on_clusters(spark):
    """Where vectors lie in clusters, fewer probes find them too."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    x = (centres[rng.integers(0, 40, 2000)] + 0.2 * rng.normal(size=(2000, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0.0, 1, "p") for i, v in enumerate(x)], SCHEMA)
    for probes in (M.PROBES, 6):
        assert recall_of(M.nearest(df, probes=probes).collect(), x.astype(float), np.arange(2000)) >= 0.9


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 0.0], 0.0, 1, "p"), (1, [0.5, 0.5], 0.0, 1, "p"), (20, [0.0, 1.0, 0.0], 0.0, 1, "p")]
    assert [tuple(r) for r in M.nearest(spark.createDataFrame(rows, SCHEMA)).collect()] == [(0, 1, 1, 0.5)]
    assert M.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_vector_that_a_third_of_the_queries_share(spark):
    """Its queries find the smallest ids of its copies, and their joins are dealt to several slices."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[::3] = x[0]
    found = {}
    for r in M.nearest(spark.createDataFrame([(i, v.tolist(), 0.0, 1, "p") for i, v in enumerate(x)], SCHEMA)).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == set(range(0, 900, 20)) and all(set(own) == set(range(1, 21)) for own in found.values())
    s = x.astype(float) @ x[0].astype(float)
    for q in range(0, 900, 60):
        best = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        assert [found[q][r][0] for r in range(1, 21)] == best
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id")
    joined = common.joined_in_slices(left, spark.range(0, 3000, 2).selectExpr("id AS k").union(spark.createDataFrame([(7,)], "k long")), "k", "id", 16)
    plain = sorted((7 if i % 3 == 0 else i, i) for i in range(3000) if i % 3 == 0 or i % 2 == 0 or i == 7)
    assert sorted(map(tuple, joined.select("k", "id").collect())) == plain
