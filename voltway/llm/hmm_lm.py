"""A hidden Markov language model over words.

Counts of all training words are one shuffled aggregation. The most frequent
words (at most ``HEAD``) are symbols of their own; the others are a symbol for
each of ``CLASSES`` classes of word endings times a smoothed share of the class,
so the vocabulary is open and whole while emission tables stay bounded.

Baum-Welch: each task runs scaled forward and backward recursions over its
whole training texts, sums expected counts, and the counts of all tasks are
added by symbol; re-estimation needs only that bounded table. Every round reads
all training texts. A recursion steps through many texts at once, texts of about
equal length together. Scoring runs the exact scaled forward recursion over each
whole text.

Rare words need their counts: (text, rare word) rows are joined with the counts
by word. A rare word has at most a 1 / HEAD share of the training words, so no
training word is a hot key of that join.

Defined results: null and empty texts are the end token alone; a null id counts
as the empty text when texts are held out; without training texts all counts
are 0; repeated rows each get a row; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltway.llm import common

HEAD, CLASSES, STATES = 32_768, 1024, 8
#: The end of a text, as a word: no word is empty.
END = b""
FOLD, HELD_OUT = 7, 2
ROUNDS = 6
#: Texts of up to so many words, and longer ones, are stepped through together.
LENGTHS = (128, 512, 2048)
#: Words of the unigram distribution that each state is given beside what it has seen.
PRIOR = 10_000.0
MOST_WORDS = 250_000
SLICE_TOKENS = 600_000
#: Recursions are scaled at every so many steps.
SCALED = 4
MARKS = b".,;:!?*%&$#|()\"'"


def words_of(text: bytes | None) -> list[bytes]:
    """Words of the A-Z lower-cased text, then the end."""
    return [*text.lower().split(), END] if text else [END]


def ending_class(word: bytes) -> int:
    """The class of a word that isn't a symbol of its own, by its last letters."""
    return zlib.crc32(word.rstrip(MARKS)[-3:]) % CLASSES


def word_counts(docs: DataFrame) -> DataFrame:
    """word, count over texts that aren't held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def made() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "count"])
            counts.clear()
            return found

        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()).to_pylist():
                counts.update(words_of(text))
                if len(counts) > MOST_WORDS:
                    yield made()
        if counts:
            yield made()

    training = docs.filter(~F.col("held_out")).select("text")
    return training.mapInArrow(run, "word binary, count long").groupBy("word").agg(F.sum("count").alias("count"))


@dataclass
class Vocabulary:
    """Bounded tables: the head's words with counts (the end first) and the classes' totals."""

    tokens: int
    distinct: int
    head: dict[bytes, int]
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def symbols(self) -> int:
        return len(self.counts) + CLASSES

    def base(self, count: np.ndarray | float) -> np.ndarray | float:
        return np.log10((count + 1) / (self.tokens + self.distinct + 1))

    def symbol_counts(self) -> np.ndarray:
        return np.concatenate([self.counts, self.class_tokens + 1.0])


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The head is cut at a power of 2**(1/8), so that a histogram of bounded size finds it."""
    tokens, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    level = F.floor(F.log2("count") * 8)
    levels = counts.filter(F.col("word") != END).groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # hundreds of rows
    total, least = 0, None
    for row in sorted(levels, key=lambda r: -r["level"]):
        total += row["n"]
        if total > HEAD:
            break
        least = row["level"]
    top = counts.filter((level >= least) & (F.col("word") != END)).orderBy(F.desc("count"), "word").collect() if least is not None else []
    end = counts.filter(F.col("word") == END).select("count").first()
    head = {END: 0} | {bytes(r["word"]): i + 1 for i, r in enumerate(top)}

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            rare = [(ending_class(w), c) for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w not in head]
            if rare:
                kinds, own = np.array(rare).T
                sums += np.bincount(kinds, own, CLASSES).astype(np.int64)
                words += np.bincount(kinds, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(sums), pa.array(words)], names=["class", "tokens", "words"])

    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    rows = counts.select("word", "count").mapInArrow(by_class, "class long, tokens long, words long").groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words"))
    for r in rows.collect():  # CLASSES rows
        class_tokens[r["class"]], class_words[r["class"]] = r["tokens"], r["words"]
    own = np.array([end["count"] if end else 0, *(r["count"] for r in top)], float)
    return Vocabulary(tokens, distinct, head, own, class_tokens, class_words)


ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base_head double, class_room double, symbols binary, rare array<struct<word: binary, n: int>>"


class Symbols(dict):
    """word -> symbol: its own for a head word, else its class's; emptied of others beyond ``most``."""

    most = 500_000

    def __init__(self, head: dict[bytes, int], first_class: int):
        super().__init__(head)
        self.head, self.first_class = head, first_class

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.first_class + ending_class(word)
        return found

    def trim(self) -> None:
        if len(self) > len(self.head) + self.most:
            self.clear()
            self.update(self.head)


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Each text's symbols (unsigned 16 bits), its other words with their numbers, and what needs no counts of those.

    ``base_head``: the base score but for the logarithms of rare words' counts;
    ``class_room``: the logarithms by which rare words' shares are divided.
    """
    head, symbols = words.head, len(words.counts)
    rare_base = -math.log10(words.tokens + words.distinct + 1)
    head_base = np.append(words.base(words.counts), np.full(CLASSES, rare_base))
    room = np.append(np.zeros(symbols), np.log10(words.class_tokens + words.class_words + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Symbols(head, symbols)

        def made(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            n, n_head, base, rooms, own, rare_words, rare_counts, ends = [], [], [], [], [], [], [], [0]
            for text in texts:
                tokens = words_of(text)
                found = np.fromiter(map(known.__getitem__, tokens), np.uint16, len(tokens))
                rare = Counter(map(tokens.__getitem__, np.flatnonzero(found >= symbols).tolist()))
                in_head = found[found < symbols]
                n.append(len(tokens))
                n_head.append(int((words.counts[in_head] > 0).sum()))
                base.append(float(head_base[found].sum()))
                rooms.append(float(room[found].sum()))
                own.append(found.tobytes())
                rare_words.append(list(rare))
                rare_counts.append(list(rare.values()))
                ends.append(ends[-1] + len(rare))
            known.trim()
            structs = pa.StructArray.from_arrays([pa.array(list(chain.from_iterable(rare_words)), pa.binary()), pa.array(list(chain.from_iterable(rare_counts)), pa.int32())], ["word", "n"])
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()), pa.array(n_head, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(rooms, pa.float64()), pa.array(own, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_head", "base_head", "class_room", "symbols", "rare"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield made(part, part.column(3).cast(pa.large_binary()).to_pylist())

    return common.written(docs.select("row", "doc_id", "held_out", "text").mapInArrow(run, ENCODED), "encoded")


# -- the model


@dataclass
class Hmm:
    """start (K), moves (K, K), emits (symbols, K); columns of ``emits`` sum to 1."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def first_model(words: Vocabulary, seed: int = 1) -> Hmm:
    rng = np.random.default_rng(seed)
    counts = words.symbol_counts() + 1e-3
    emits = counts[:, None] * rng.lognormal(0, 0.3, (len(counts), STATES))
    moves = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
    return Hmm(np.full(STATES, 1 / STATES), moves, emits / emits.sum(0))


def by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sequences, longest first, and how many are longer than t for each t."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max()) if len(lengths) else 0
    return order, np.searchsorted(-lengths[order], -np.arange(longest), side="left")


def columns(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The columns ``at`` (all within ``rows``), gathered row by row."""
    out = np.empty((len(rows), len(at)))
    for row, own in zip(rows, out, strict=True):
        np.take(row, at, out=own, mode="clip")  # the other modes copy what they have taken
    return out


@dataclass
class Steps:
    """Sequences laid out step by step, longest first, so that a step's columns stand together.

    ``peaks`` (symbols) is each symbol's largest emission and ``shares`` (K, tokens)
    the emissions as shares of it: recursions over shares shrink slowly, so few
    steps need scaling, and what is divided by the peaks cancels or is added back.
    """

    order: np.ndarray
    active: list[int]
    ends: list[int]
    column: np.ndarray
    last: np.ndarray
    own: np.ndarray
    peaks: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, model: Hmm, symbols: np.ndarray, lengths: np.ndarray) -> Steps:
        order, active = by_length(lengths)
        at = (np.cumsum(lengths) - lengths)[order]
        step = np.repeat(np.arange(len(active)), active)
        ends = np.cumsum(active)
        column = np.arange(len(step)) - (ends - active)[step]
        own = symbols[at[column] + step]
        rows = np.ascontiguousarray(model.emits.T)
        peaks = rows.max(0)
        return cls(order, active.tolist(), ends.tolist(), column, column >= np.append(active[1:], 0)[step], own, peaks, columns(rows / peaks, own))


def log10_likelihoods(model: Hmm, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each sequence by the scaled forward recursion."""
    steps = Steps.of(model, symbols, lengths)
    total = np.bincount(steps.column, np.log10(steps.peaks)[steps.own], len(lengths))
    ahead, state = np.ascontiguousarray(model.moves.T), None
    for t, (n, end) in enumerate(zip(steps.active, steps.ends, strict=True)):
        own = steps.shares[:, end - n : end]
        state = own * (model.start[:, None] if t == 0 else ahead @ state[:, :n])
        after = steps.active[t + 1] if t + 1 < len(steps.active) else 0
        first = 0 if t % SCALED == 0 else after
        if first < n:  # those that end here, or all
            scale = state[:, first:].sum(0)
            state[:, first:] /= scale
            total[first:n] += np.log10(scale)
    out = np.empty(len(lengths))
    out[steps.order] = total
    return out


def expected(model: Hmm, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of starts, moves and emissions over sequences."""
    steps = Steps.of(model, symbols, lengths)
    shares = steps.shares
    ahead, forward, before = np.ascontiguousarray(model.moves.T), np.empty_like(shares), 0
    for t, (n, end) in enumerate(zip(steps.active, steps.ends, strict=True)):
        now = forward[:, end - n : end]
        if t == 0:
            np.multiply(model.start[:, None], shares[:, :n], out=now)
        else:
            np.matmul(ahead, forward[:, before : before + n], out=now)
            now *= shares[:, end - n : end]
        if t % SCALED == 0:
            now /= now.sum(0)
        before = end - n
    # ``shares`` become what a step's emissions and all after them weigh.
    back = np.ones_like(shares)
    for t in range(len(steps.active) - 1, -1, -1):
        n, end = steps.active[t], steps.ends[t]
        if t + 1 < len(steps.active):
            more = steps.active[t + 1]
            np.matmul(model.moves, shares[:, end : end + more], out=back[:, end - n : end - n + more])
        now = shares[:, end - n : end]
        now *= back[:, end - n : end]
        if t % SCALED == 0:
            now /= now.sum(0)
    scale = 1 / np.einsum("kn,kn->n", forward, back)
    forward *= scale
    back *= forward
    first = steps.active[0]
    moves = columns(forward, np.flatnonzero(~steps.last)) @ shares[:, first:].T  # a token's next one is the first that isn't paired yet
    emissions = np.stack([np.bincount(steps.own, row, len(model.emits)) for row in back], 1)
    return back[:, :first].sum(1), moves * model.moves, emissions


def sequences(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with their concatenated symbols and lengths."""
    for batch in batches:
        first, size = 0, 0
        values = batch.column(column).to_pylist()
        for i, v in enumerate(values):
            size += len(v) // 2
            if size > SLICE_TOKENS or i == len(values) - 1:
                own = values[first : i + 1]
                yield batch.slice(first, i + 1 - first), np.frombuffer(b"".join(own), np.uint16), np.array([len(v) // 2 for v in own])
                first, size = i + 1, 0


def by_length_class(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Concatenated symbols and lengths of all sequences, those of a length class together."""
    waiting: list[list[bytes]] = [[] for _ in range(len(LENGTHS) + 1)]
    sizes = [0] * len(waiting)

    def taken(k: int) -> tuple[np.ndarray, np.ndarray]:
        own, waiting[k], sizes[k] = waiting[k], [], 0
        return np.frombuffer(b"".join(own), np.uint16), np.array([len(v) // 2 for v in own])

    for batch in batches:
        for v in batch.column(column).to_pylist():
            k = bisect_left(LENGTHS, len(v) // 2)
            waiting[k].append(v)
            sizes[k] += len(v) // 2
            if sizes[k] > SLICE_TOKENS:
                yield taken(k)
    yield from (taken(k) for k in range(len(waiting)) if waiting[k])


def baum_welch(texts: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Hmm:
    """Rounds of expectation over all ``texts`` (encoded, not held out) and re-estimation."""
    spark = texts.sparkSession
    model = first_model(words)
    floor = PRIOR * words.symbol_counts() / words.symbol_counts().sum()
    for _ in range(rounds):
        own = spark.sparkContext.broadcast(model)  # symbols x STATES numbers, bounded by HEAD and CLASSES

        def run(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            model = own.value
            starts, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros_like(model.emits)
            for symbols, lengths in by_length_class(batches, 0):
                a, b, c = expected(model, symbols, lengths)
                starts, moves, emits = starts + a, moves + b, emits + c
            rows = np.vstack([starts, moves, emits])
            at = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(rows[at, k].copy()) for k in range(STATES))], names=["at", *(f"s{k}" for k in range(STATES))])

        schema = "at long, " + ", ".join(f"s{k} double" for k in range(STATES))
        counts = texts.select("symbols").mapInArrow(run, schema)
        sums = counts.groupBy("at").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(STATES))).collect()  # symbols + STATES + 1 rows at most
        own.unpersist()
        if not sums:
            continue
        rows = np.zeros((1 + STATES + words.symbols, STATES))
        for r in sums:
            rows[r["at"]] = r[1:]
        starts, moves, emits = rows[0] + 1.0, rows[1 : 1 + STATES] + 0.1, rows[1 + STATES :] + floor[:, None] + 1e-9
        model = Hmm(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return model


def scored(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"),
        (common.remainder(id_column, FOLD) == HELD_OUT).alias("held_out"), F.col(text_column).alias("text"),
    )
    counts = common.written(word_counts(narrow), "counts")
    words = vocabulary(counts)
    texts = encoded(narrow, words)
    own = spark.sparkContext.broadcast(baum_welch(texts.filter("not held_out"), words, rounds))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, symbols, lengths in sequences(batches, 7):
            found = log10_likelihoods(own.value, symbols, lengths)
            yield pa.RecordBatch.from_arrays([*part.columns[:7], pa.array(found)], names=[*part.schema.names[:7], "forward"])

    likely = texts.select("row", "doc_id", "held_out", "n_tokens", "n_head", "base_head", "class_room", "symbols").mapInArrow(
        forward, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base_head double, class_room double, forward double"
    )
    rare = texts.select("row", F.explode("rare").alias("rare")).select("row", F.col("rare.word").alias("word"), F.col("rare.n").alias("n"))
    sums = rare.join(counts, "word").groupBy("row").agg(  # rare words without a count add nothing
        F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("count") + 1)).alias("rare_counts")
    )
    found = likely.join(sums, "row", "left")
    zero = lambda n: F.coalesce(n, F.lit(0))
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + zero("rare_known")).cast("long").alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base_head") + zero("rare_counts")).alias("base_score"), (F.col("forward") - F.col("class_room") + zero("rare_counts")).alias("score"),
    )

