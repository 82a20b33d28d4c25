"""Encoding with the tokenizers library inside tasks: each distinct piece of text once.

A text is cut into chunks where no token of the tokenizer can reach across. A
chunk that a worker meets for the first time is normalised and cut into the
tokenizer's own pieces, and pieces not yet known are encoded by the library's
model; texts are put together from the chunks' ids with numpy. A worker
remembers two generations: when the younger one outgrows ``most_bytes`` it
becomes the older and the older is dropped, so memory is bounded whatever the
vocabulary, tasks of one worker share what they learned, and frequent chunks
never have to be encoded again. Chunks with parts of special tokens go through
the whole library.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from itertools import chain

import numpy as np
import regex

#: Unicode's White_Space, as the tokenizers' own patterns have it.
WHITE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LEADING = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
ALONE = re.compile(f"[^{WHITE}]+")
#: Python's own white space that isn't Unicode's.
SEPARATORS = re.compile("[\x1c-\x1f]")
# The pieces that the tokenizer files' pre-tokenizers keep.
BYTE_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Bytes that a generation of chunks may take, as estimated from their number and lengths.
MOST_BYTES = 75_000_000
#: Bytes that a remembered chunk takes beside its characters, with its share of the pieces.
EACH = 250


def byte_letters() -> dict[int, str]:
    """Byte -> printable letter, as byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


LETTERS = byte_letters()


def lower_cased(text: str) -> str:
    """NFC and then lower case, letter by letter."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def words_alone(text: str) -> list[str]:
    """What stands between white space."""
    return ALONE.findall(text) if SEPARATORS.search(text) else text.split()


def in_letters(piece: str) -> str:
    """The piece's bytes as letters."""
    if piece.isascii() and piece.isalnum():
        return piece
    return piece.encode().decode("latin-1").translate(LETTERS)


class Numbers(dict):
    """text -> number in order of first asking; ``new`` lists what was added since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        found = self[text] = len(self)
        self.new.append(text)
        return found


class ChunkEncoder:
    """Ids of whole texts, as the library's ``encode(text, add_special_tokens=False)`` gives them.

    ``drops_white``: the tokenizer lower-cases and drops white space.
    """

    #: Characters of text that are cut at a time.
    slice = 1_500_000
    most_bytes = MOST_BYTES

    def __init__(self, path: str, drops_white: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.drops_white = drops_white
        self.cut = words_alone if drops_white else LEADING.findall
        self.pieces_of = (WORD_PIECES if drops_white else BYTE_PIECES).findall
        self.pieces: dict[str, bytes] = {}
        self.start_generation()
        self.older: tuple[dict[str, int], array, array] = {}, self.ids, self.starts

    def start_generation(self) -> None:
        self.chunks = Numbers()
        self.ids = array("H")
        self.starts = array("q", [0])
        self.held = 0

    def turn(self) -> None:
        """Let the older generation go if the younger one is full."""
        if self.held > self.most_bytes:
            self.older = self.chunks, self.ids, self.starts
            self.pieces = {}
            self.start_generation()

    def encode_piece(self, piece: str) -> bytes:
        return array("H", [t.id for t in self.model.tokenize(in_letters(piece))]).tobytes()

    def learn(self) -> None:
        """Ids of the chunks that were met since the last time."""
        pieces, ids, starts, drops, cut = self.pieces, self.ids, self.starts, self.drops_white, self.pieces_of
        remembered, old_ids, old_starts = self.older
        for chunk in self.chunks.new:
            at = remembered.get(chunk)
            if at is not None:
                ids.extend(old_ids[old_starts[at] : old_starts[at + 1]])
            elif "<|" in chunk:
                ids.extend(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
            else:
                for piece in cut(lower_cased(chunk) if drops else chunk):
                    found = pieces.get(piece)
                    if found is None:
                        found = pieces[piece] = self.encode_piece(piece)
                    ids.frombytes(found)
            starts.append(len(ids))
        self.held += sum(map(len, self.chunks.new)) + EACH * len(self.chunks.new)
        self.chunks.new.clear()

    def slice_ids(self, texts: list[str]) -> list[np.ndarray]:
        self.turn()
        cut = [self.cut(t) for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        which = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        self.learn()
        ids, starts = np.frombuffer(self.ids, np.uint16) if self.ids else np.zeros(0, np.uint16), np.frombuffer(self.starts, np.int64)
        first, last = starts[which], starts[which + 1]
        lengths = last - first
        ends = np.cumsum(lengths)
        found = ids[np.repeat(last - ends, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.cumsum(counts)[:-1]] if len(cut) else []
        return np.split(found, bounds)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, uint16; null is the empty text."""
        found, part, size = [], [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size > self.slice:
                found += self.slice_ids(part)
                part, size = [], 0
        return found + self.slice_ids(part) if part else found


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, drops_white: bool) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file."""
    if (path, drops_white) not in _ENCODERS:
        _ENCODERS[path, drops_white] = ChunkEncoder(path, drops_white)
    return _ENCODERS[path, drops_white]


def public_path(name: str) -> str:
    """Where an installed public vocabulary file lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
