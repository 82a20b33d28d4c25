"""BPE encoding over a trie of distinct words, and decoding.

The encoding of a prefix is the encoding of a shorter prefix followed by one
token, and which token follows from the two tokens at the joint alone: tokens
s, t stand side by side in an encoding exactly if s + t encodes to them. So a
word's encoding is a chain of last tokens over its prefixes, and prefixes that
words share are computed once.

Each task takes the distinct words of its texts that it hasn't met, in sorted
order, which is the depth-first order of their trie: the states of the current
path lie on a stack and those of the prefix shared with the word before stay.
Nothing is shuffled; a worker forgets its words beyond a bound.

Defined results: a null text is an empty one: no ids, empty decoded text;
special tokens' strings in a text become their ids, as in the library; equal
rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltway.llm.encoding import EACH, ChunkEncoder, in_letters, lower_cased, public_path

WORD_END = "</w>"
MOST_PAIRS = 400_000

RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


class TrieEncoder(ChunkEncoder):
    """Ids of texts under a lower-casing BPE with word ends, read from a tokenizer file."""

    slice = 5_000_000

    def __init__(self, path: str):
        super().__init__(path, drops_white=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.by_tail: dict[str, list[int]] = {}  # last three letters and end -> lengths of tokens that have them
        for t in self.vocab:
            end = WORD_END if t.endswith(WORD_END) and len(t) > len(WORD_END) else ""
            plain = t.removesuffix(WORD_END) if end else t
            if len(plain) > 2:
                self.by_tail.setdefault(plain[-3:] + end, []).append(len(plain))
        self.by_tail = {k: [*sorted(set(v), reverse=True), 2, 1] for k, v in self.by_tail.items()}
        self.by_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.pairs: dict[int, bool] = {}

    # -- pairs of tokens

    def symbols(self, token: int) -> list[int]:
        text = self.tokens[token]
        ends = text.endswith(WORD_END) and len(text) > len(WORD_END)
        letters = list(text.removesuffix(WORD_END) if ends else text)
        if ends:
            letters[-1] += WORD_END
        return [self.vocab[c] for c in letters]

    def merged(self, symbols: list[int]) -> list[int]:
        """Plain BPE: the earliest merge first, its leftmost place first."""
        while len(symbols) > 1:
            best = min((self.ranks[p] + (at,) for at, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in self.ranks), key=lambda x: (x[0], x[2]), default=None)
            if best is None:
                break
            symbols[best[2] : best[2] + 2] = [best[1]]
        return symbols

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` can stand after ``left`` (-1: at the start of a word)."""
        key = left * 65536 + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            alone = [right] if left < 0 else [left, right]
            found = self.pairs[key] = self.merged([s for t in alone for s in self.symbols(t)]) == alone
        return found

    # -- words

    def last(self, letters: str, depth: int, path: list[tuple[int, int]], end: str) -> tuple[int, int]:
        """(last token, where it starts) of the prefix of that depth."""
        vocab, pairs = self.vocab, self.pairs
        for length in self.by_tail.get(letters[depth - 3 : depth] + end, (2, 1)) if depth > 2 else (2, 1):
            start = depth - length
            if start < 0:
                continue
            token = vocab.get(letters[start:depth] + end)
            if token is None:
                continue
            left = path[start][0]
            fits = pairs.get(left * 65536 + token)
            if self.follows(left, token) if fits is None else fits:
                return token, start
        raise ValueError(f"no token ends {letters[:depth]!r}")

    def learn_words(self, words: list[str]) -> None:
        """Walk the trie of ``words`` depth first."""
        path, before = [(-1, 0)], ""
        for word, piece in sorted((in_letters(w), w) for w in words):
            del path[min(len(commonprefix([before, word])), len(word) - 1) + 1 :]
            for depth in range(len(path), len(word)):
                path.append(self.last(word, depth, path, ""))
            token, start = self.last(word, len(word), path, WORD_END)
            ids = [token]
            while start:
                token, start = path[start]
                ids.append(token)
            self.pieces[piece] = array("H", ids[::-1]).tobytes()
            before = word

    # -- texts

    def cut_chunk(self, chunk: str) -> list[str | int]:
        """Words, and special tokens' ids, of a text without white space."""
        if "<|" not in chunk:
            return self.pieces_of(lower_cased(chunk))
        found: list[str | int] = []
        for part in self.by_special.split(chunk):
            found += [self.special[part]] if part in self.special else self.pieces_of(lower_cased(part))
        return found

    def learn(self) -> None:
        """Ids of the chunks that were met since the last time."""
        new = self.chunks.new
        remembered, ids, starts = self.older
        at = [remembered.get(c) for c in new]
        known = [None if i is None else ids[starts[i] : starts[i + 1]] for i in at]
        cut = [self.cut_chunk(c) if ids is None else [] for c, ids in zip(new, known, strict=True)]
        self.learn_words([w for w in {w for c in cut for w in c} if isinstance(w, str) and w not in self.pieces])
        for ids, parts in zip(known, cut, strict=True):
            if ids is not None:
                self.ids.extend(ids)
            for p in parts:
                if isinstance(p, str):
                    self.ids.frombytes(self.pieces[p])
                else:
                    self.ids.append(p)
            self.starts.append(len(self.ids))
        self.held += sum(map(len, new)) + EACH * len(new)
        new.clear()

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by a space: the tokenizer file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_ENCODERS: dict[str, TrieEncoder] = {}


def trie_encoder(path: str) -> TrieEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def digests(docs: DataFrame, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    path = tokenizer or public_path("word_bpe_49k.json")

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        own = trie_encoder(path)
        found = own.encode(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found], pa.string()),
                pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in found], pa.string()),
            ],
            RESULT.names,
        )

    found = docs.select(F.col(id_column).alias("doc_id"), run.asNondeterministic()(F.col(text_column)).alias("_found"))
    return found.select("doc_id", *[F.col(f"_found.{n}").alias(n) for n in RESULT.names])
