import hashlib
import random

import duckdb
import numpy as np
import pytest

from voltway.llm import hilbert_codes as H

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, ints int"


def plain(rows):
    """The contract, row by row; rows: (vec_id, vector, label)."""
    kept = sorted(((i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], c) for i, v, c in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 16
    parts = np.array([v for _, v, _ in kept], np.int64).reshape(len(kept), 16, w)
    books = parts[:64].transpose(1, 0, 2).copy()

    def nearest():
        d = ((parts[:, :, None] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(2):
        near, _ = nearest()
        for p in range(16):
            for e in range(books.shape[1]):
                own = parts[near[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    near, far = nearest()
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    sums = {}
    for (_, _, c), f in zip(kept, far, strict=True):
        sums[c] = sums.get(c, 0) + int(f.sum())
    return sorted(((i, bytes(n.astype(np.uint8)).hex(), int(f.sum()), sums[c], digest) for (i, _, c), n, f in zip(kept, near, far, strict=True)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", 1, 2) for i, v, c in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dimensions=64, seed=1, kind="clusters"):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dimensions))
    values = rng.normal(size=(n, dimensions)) if kind == "even" else centres[rng.integers(0, 20, n)] + 0.05 * rng.normal(size=(n, dimensions))
    return [(int(i), [float(np.float32(x)) for x in v], int(i) % 3 if i % 5 else None) for i, v in zip(rng.permutation(n) * 3, values, strict=True)]


@pytest.mark.parametrize("kind,dimensions", [("clusters", 64), ("even", 64), ("even", 16), ("clusters", 80)])
def test_equals_brute_force(spark, monkeypatch, kind, dimensions):
    monkeypatch.setattr(H, "SLICE", 150)
    monkeypatch.setattr(H, "BLOCK", 8)
    rows = vectors(700, dimensions, kind=kind)
    assert found(H.compressed(frame(spark, rows))) == plain(rows)


def test_slices_and_partitions_change_nothing(spark, monkeypatch):
    rows = vectors(500)
    expected = found(H.compressed(frame(spark, rows).repartition(1)))
    monkeypatch.setattr(H, "SLICE", 37)
    assert found(H.compressed(frame(spark, rows).repartition(7))) == expected


def test_many_equal_vectors_ties_and_repeats(spark):
    """A third of the rows are one vector; entries of the first codebook are equal, so ties go to the lower index."""
    same = [0.25] * 64
    rows = [(i, same, 1) for i in range(300)] + vectors(300, seed=4) + [(5, same, 1), (5, same, None), (None, same, 2)]
    assert found(H.compressed(frame(spark, rows))) == plain(rows)


def test_drops_and_small_tables(spark):
    good = vectors(9)
    bad = [(100, None, 1), (101, [None] + [0.0] * 63, 1), (102, [float("nan")] + [0.0] * 63, 1), (103, [float("inf")] + [0.0] * 63, None), (104, [], 1), (105, [0.5] * 32, 1), (106, [0.5] * 30, 1), (107, [1e9] + [0.0] * 63, 1)]
    assert found(H.compressed(frame(spark, good + bad))) == plain(good)
    large = [(i, [x * 1000 for x in v], c) for i, v, c in vectors(100)]
    assert found(H.compressed(frame(spark, large))) == plain(large)  # distances beyond 32 bits
    nothing = H.compressed(frame(spark, bad[:5]))
    assert nothing.count() == 0 and nothing.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert H.compressed(frame(spark, [])).count() == 0


def test_every_nearest_entry_is_on_its_blocks_list():
    rng = np.random.default_rng(0)
    points, entries = rng.integers(-300, 300, (8000, 4)).astype(np.int32), rng.integers(-300, 300, (64, 4))
    blocks, order = H.Blocks.packed(points)
    lists = blocks.shortlists(entries)
    near = ((points[order][:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert lists[np.arange(8000) // H.BLOCK, near].all() and lists.mean() < 0.5


def test_hilbert_neighbours_touch():
    """Along the curve through a full grid each step changes one coordinate by one."""
    for w, side in ((2, 16), (3, 8)):
        grid = np.stack(np.meshgrid(*[np.arange(side)] * w, indexing="ij"), -1).reshape(-1, w).astype(np.int64)
        random.Random(1).shuffle(grid.tolist())
        bits = min(16, 60 // w)
        scaled = grid * (((1 << bits) - 1) // (side - 1))
        keys = H.hilbert_keys(scaled)
        assert len(set(keys.tolist())) == len(grid)
        if ((1 << bits) - 1) % (side - 1) == 0:
            steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
            assert steps.mean() < 1.35


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    ours = H.compressed(spark.read.parquet(f"{sf}/embeddings.parquet"))
    theirs = con.execute(f"SELECT {', '.join(ours.columns)} FROM ({H.compressed_sql()})").fetchall()
    assert found(ours) == sorted(theirs, key=str)
