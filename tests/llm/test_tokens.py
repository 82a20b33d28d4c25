"""Packing, token files and trie encoding against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltway.llm import packing, token_files, trie_bpe
from voltway.llm.encoding import public_path


def ids_of(name, texts):
    tokenizer = Tokenizer.from_file(public_path(name))
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4") for _, t in texts], tokenizer


def test_trie_encodes_and_decodes_as_the_library(docs, texts, nothing):
    ids, tokenizer = ids_of("word_bpe_49k.json", texts)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = [(i, len(x), sha(x.tobytes()), sha(tokenizer.decode(x.tolist(), skip_special_tokens=False).encode())) for (i, _), x in zip(texts, ids)]
    found = [tuple(r) for r in trie_bpe.digests(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str) and trie_bpe.digests(nothing).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_files_round_trip(docs, texts, nothing, parts):
    ids, _ = ids_of("word_bpe_49k.json", texts)
    expected = []
    for (i, _), x in zip(texts, ids):
        x = np.append(x, 1).astype("<u4")
        expected.append((i, len(x), zlib.crc32(x.tobytes())))
    found = token_files.round_trip(docs, parts=parts)
    own = sorted(map(tuple, found.collect()), key=lambda r: r[1])
    assert sorted(((i, n, crc) for i, _, n, crc in own), key=str) == sorted(expected, key=str) and token_files.round_trip(nothing).count() == 0
    assert [start for _, start, _, _ in own] == np.cumsum([0, *(n for _, _, n, _ in own)])[:-1].tolist()
    order = [-(2**63) if i is None else i for i, _, _, _ in own]
    assert order == sorted(order) and found.rdd.getNumPartitions() >= parts


@pytest.mark.parametrize("text", ["'the same words'", "concat('text ', id)"])
def test_an_id_of_a_third_of_the_rows_is_dealt_to_several_parts(spark, tmp_path, text):
    docs = spark.range(3000).selectExpr("if(id < 1000, 1500, id) AS doc_id", f"{text} AS text").repartition(4)
    folder = str(tmp_path / "files")
    manifest = token_files.write_token_files(docs, folder, public_path("word_bpe_49k.json"), parts=12)
    assert manifest.agg({"n_docs": "max"}).first()[0] < 600
    own = sorted(map(tuple, token_files.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in own] == sorted(1500 if i < 1000 else i for i in range(3000))


def test_reading_by_ranges_equals_the_map(tmp_path):
    from pyarrow import fs

    (tmp_path / "x").write_bytes(np.arange(50, dtype="<u2").tobytes())
    for system in (fs.LocalFileSystem(), fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())):
        path = str(tmp_path / "x") if isinstance(system, fs.LocalFileSystem) else "x"
        with token_files.values(system, path, np.dtype("<u2")) as ids:
            assert ids(7, 20).tolist() == list(range(7, 20)) and ids(3, 3).tolist() == []


def test_packing(docs, texts, nothing):
    ids, _ = ids_of("byte_bpe_50k.json", texts)
    rows = packing.packed(docs).collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        assert sum(n for _, n in own) <= 2048 and all(o == sum(n for p, n in own if p < o) for o, _ in own)
    left = sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    expected = []
    for (i, _), x in zip(texts, ids):
        x = np.append(x, 0).astype("<u4")
        first = len(x) % 2048 or 2048
        cuts = [0, *range(first, len(x) + 1, 2048)]
        expected += [(i or -1, k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert left == sorted(expected) and packing.packed(nothing).count() == 0


def test_plan_takes_every_piece_once():
    for seed in range(60):
        rng = np.random.default_rng(seed)
        capacity = int(rng.choice([10, 50, 200]))
        histogram = {int(n): int(rng.integers(1, 60)) for n in rng.integers(1, capacity + 1, rng.integers(1, 40))}
        bins, ranks = {}, set()
        for length, a, b, first, offset in packing.plan(histogram, capacity):
            for r in range(a, b + 1):
                assert (length, r) not in ranks
                ranks.add((length, r))
                bins.setdefault(first + r - a, []).append((offset, length))
        assert len(ranks) == sum(histogram.values()) and sorted(bins) == list(range(len(bins)))
        for own in bins.values():
            assert all(o == sum(n for p, n in own if p < o) for o, _ in own) and sum(n for _, n in own) <= capacity
        total = sum(n * c for n, c in histogram.items())
        assert len(bins) <= 1.25 * -(-total // capacity) + 1 or max(histogram) * 2 > capacity


def test_plan_needs_as_many_sequences_as_best_fit_over_pieces():
    """Longest first, each piece into the fullest sequence that holds it, piece by piece."""
    rng = random.Random(6)
    for capacity in (10, 64, 2048):
        for _ in range(20):
            lengths = sorted((rng.randrange(1, capacity + 1) if rng.random() < 0.5 else rng.randrange(1, capacity // 3 + 1) for _ in range(rng.randrange(1, 300))), reverse=True)
            rooms = []
            for length in lengths:
                fitting = [r for r in rooms if r >= length]
                if fitting:
                    rooms.remove(min(fitting))
                    rooms.append(min(fitting) - length)
                else:
                    rooms.append(capacity - length)
            histogram = {x: lengths.count(x) for x in set(lengths)}
            used = set()
            for _, first_rank, last_rank, first_sequence, _ in packing.plan(histogram, capacity):
                used |= set(range(first_sequence, first_sequence + last_rank - first_rank + 1))
            assert len(used) == len(rooms) == max(used) + 1
