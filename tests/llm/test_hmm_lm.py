import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from voltway.llm import hmm_lm as M


def model(symbols=6, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, a: x / x.sum(a, keepdims=True)
    return M.Hmm(norm(rng.random(M.STATES), 0), norm(rng.random((M.STATES, M.STATES)), 1), norm(rng.random((symbols, M.STATES)), 0))


def sequences(seed=1):
    rng = np.random.default_rng(seed)
    lengths = np.array([1, 4, 2, 4, 3])
    return rng.integers(0, 6, lengths.sum()).astype(np.uint16), lengths


def paths(h, own):
    for states in itertools.product(range(M.STATES), repeat=len(own)):
        p = h.start[states[0]]
        for a, b in zip(states, states[1:]):
            p *= h.moves[a, b]
        yield states, p * math.prod(h.emits[s, k] for s, k in zip(own, states))


def test_forward_and_expectations_equal_enumeration():
    h, (symbols, lengths) = model(), sequences()
    found = M.log10_likelihoods(h, symbols, lengths)
    starts, moves, emits = M.expected(h, symbols, lengths)
    want_starts, want_moves, want_emits = np.zeros_like(starts), np.zeros_like(moves), np.zeros_like(emits)
    at = 0
    for i, n in enumerate(lengths):
        own = symbols[at : at + n]
        at += n
        total = sum(p for _, p in paths(h, own))
        assert np.isclose(found[i], math.log10(total))
        for states, p in paths(h, own):
            want_starts[states[0]] += p / total
            for a, b in zip(states, states[1:]):
                want_moves[a, b] += p / total
            for s, k in zip(own, states):
                want_emits[s, k] += p / total
    assert np.allclose(starts, want_starts) and np.allclose(moves, want_moves) and np.allclose(emits, want_emits)


def test_every_whole_text_is_read_once_and_starts_once():
    """Texts far longer than any slice's typical one stay whole, and each starts one sequence."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 20, n).astype(np.uint16) for n in (1, 128, 129, 600, 3000, 2, 2049, 50)]
    batch = pa.RecordBatch.from_pydict({"symbols": pa.array([t.tobytes() for t in texts], pa.binary())})
    taken = list(M.by_length_class(iter([batch.slice(0, 5), batch.slice(5)]), 0))
    own = [x.tobytes() for symbols, lengths in taken for x in np.split(symbols, np.cumsum(lengths)[:-1])]
    assert sorted(own) == sorted(t.tobytes() for t in texts)
    emits = rng.random((20, M.STATES))
    model = M.Hmm(np.full(M.STATES, 1 / M.STATES), np.full((M.STATES, M.STATES), 1 / M.STATES), emits / emits.sum(0))
    sums = [M.expected(model, symbols, lengths) for symbols, lengths in taken]
    assert np.isclose(sum(s.sum() for s, _, _ in sums), len(texts)) and np.isclose(sum(m.sum() for _, m, _ in sums), sum(len(t) - 1 for t in texts))


def test_base_scores_and_better_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), b""] for r in docs.collect()}
    train = Counter(w for i, own in rows.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in own)
    n, v = sum(train.values()), len(train)
    found = M.scored(docs).collect()
    for r in found:
        own = rows[r["doc_id"]]
        assert np.isclose(r["base_score"], sum(math.log10((train[w] + 1) / (n + v + 1)) for w in own))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in train for w in own), n)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_edges(docs, texts, nothing):
    rows = M.scored(docs).collect()
    assert len(rows) == len(texts) and all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in rows)
    assert M.scored(nothing).count() == 0


def test_steps_stand_together_and_scaling_now_and_then_loses_nothing():
    """A step's emissions are columns side by side, so a step is a few array calls; very unlikely words between scalings don't underflow."""
    h, rng = model(symbols=40, seed=3), np.random.default_rng(4)
    h.emits[rng.random(h.emits.shape) < 0.5] *= 1e-30
    h.moves[rng.random(h.moves.shape) < 0.5] *= 1e-12
    lengths = np.array([1, 37, 500, 500, 3])
    symbols = rng.integers(0, 40, lengths.sum()).astype(np.uint16)
    steps, starts = M.Steps.of(h, symbols, lengths), np.cumsum(lengths) - lengths
    for t, (n, end) in enumerate(zip(steps.active, steps.ends)):
        own = symbols[starts[steps.order[:n]] + t]
        assert np.array_equal(steps.own[end - n : end], own) and np.allclose((steps.peaks[own] * steps.shares[:, end - n : end]).T, h.emits[own], rtol=1e-12, atol=0)
    found = M.log10_likelihoods(h, symbols, lengths)
    for i, n in enumerate(lengths):
        state, total = h.start, 0.0
        for t, w in enumerate(symbols[starts[i] : starts[i] + n]):
            state = (state if t == 0 else state @ h.moves) * h.emits[w]
            total += math.log10(state.sum())
            state = state / state.sum()
        assert math.isclose(found[i], total, rel_tol=1e-9)
    a, b, c = M.expected(h, symbols, lengths)
    assert np.isclose(a.sum(), len(lengths)) and np.isclose(b.sum(), (lengths - 1).sum()) and np.isclose(c.sum(), lengths.sum())
