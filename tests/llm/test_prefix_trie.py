import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from voltway.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth long, key string, rank int"


def plain(rows):
    """The contract over dicts; rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        leaves[path] += not kids[path]
        saved[path] += (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        if path:
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", 1) for r in rows], SCHEMA)


def found(df):
    assert df.columns == list(P.RESULT)
    return sorted(tuple(r) for r in df.collect())


def made(n, seed, words=3, most=6):
    """Conversations over few texts, so that prefixes are shared, at all depths, and many are equal."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        for turn in range(rng.randrange(1, most + 1)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", f"té{rng.randrange(words)}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,words,most", [(4, 2, 5), (16, 3, 12), (1024, 2, 20)])
def test_equals_brute_force(spark, monkeypatch, block, words, most):
    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "DEPTHS_A_SLICE", 3)
    rows = made(120, block, words, most)
    assert found(P.trie(frame(spark, rows).repartition(5))) == plain(rows)


def test_equal_conversations_over_many_blocks(spark, monkeypatch):
    """A third of the conversations are equal, all share their first turn, one conversation has a third of the rows."""
    monkeypatch.setattr(P, "BLOCK", 8)
    rows = [(5 * c, t, "user", f"same {t}") for c in range(60) for t in range(3)]
    rows += [(5 * c, t, "user", "same 0" if not t else f"own {c} {t}") for c in range(60, 160) for t in range(2)]
    rows += [(2000, t, "user", "same 0" if t < 12 else "again") for t in range(300)]
    assert found(P.trie(frame(spark, rows))) == plain(rows)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 2)
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 3, "user", "x" * 100_000), (2, 0, "", ""), (2, None, None, None), (None, 0, "user", "lost"),
        (3, 5, "user", "twice"), (3, 5, "user", "twice"), (3, 5, "assistant", "twice"), (11, 0, "user", "alone in its group"), (0, 0, "user", "one"), (0, 1, "é", "ü"),
        (-3, 0, "user", "one"), (-5, 0, "user", "one"), (-5, 1, "é", "ü"), (26, 1, "user", None), (27, 1, "user", ""),
    ]
    sign = [r for r in rows if r[0] is None or r[0] >= 0 or r[0] % 5 == 0]  # Python's remainder has another sign
    assert found(P.trie(frame(spark, sign))) == plain(sign)
    assert sum(r[1] == 0 for r in found(P.trie(frame(spark, rows)))) == 1
    for few in ([(7, 0, "user", "one")], [(7, 0, "user", "one"), (7, 1, "user", "two")], [(7, 0, "a", "b"), (12, 0, "a", "b")], [(11, 0, "a", "b"), (16, 0, "c", "d")]):
        assert found(P.trie(frame(spark, few))) == plain(few)
    assert found(P.trie(frame(spark, [(None, 0, "user", "lost")]))) == [] == found(P.trie(frame(spark, [])))


def test_key_ends_where_nobody_else_goes_on(spark):
    """A long conversation that shares two turns has two turns in its sort key."""
    rows = [(0, t, "user", f"own {t}" if t > 1 else "both") for t in range(500)] + [(100, t, "user", "both" if t < 2 else f"other {t}") for t in range(4)]
    own = P.numbered(frame(spark, rows).select("conv_id", "turn", "role", "text").toDF("conv", "turn", "role", "text"))
    keys = {r["conv"]: len(r["key"]) // P.WIDTH for r in P.keyed(*P.rebuilt(own)).collect()}
    assert keys[0] <= 2 and keys[100] <= 2


def test_searches_equal_scans():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(0, 6, n)
        table = P.Minima(values)
        for start in range(n):
            for depth in range(8):
                at, d = np.array([start]), np.array([depth])
                assert table.right(at, d)[0] == next((j for j in range(start + 1, n) if values[j] < depth), n)
                assert table.left(at, d)[0] == next((j for j in range(start, -1, -1) if values[j] < depth), -1)
            last = int(rng.integers(start, n))
            assert table.least(np.array([start]), np.array([last]))[0] == values[start : last + 1].min()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    table = f"/root/testdata/{sf}/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{table}'")
    theirs = con.execute(f"SELECT {', '.join(P.RESULT)} FROM ({P.trie_sql()})").fetchall()
    assert found(P.trie(spark.read.parquet(table))) == sorted(theirs)
