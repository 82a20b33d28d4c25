"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text's features are which of its word n-grams (one and two words; marks between
words count as words, and a word said again right away counts as a repetition)
hash to which bucket. The FTRL-Proximal state of a bucket is its sum of shifted
gradients ``z`` and of squared gradients ``n``; the weight follows from both, and
is exactly 0 while |z| is small, so the model is sparse and a score is a sparse
dot product.

Training rows are dealt to a fixed number of shards. In each pass every shard
runs through its own rows in a fixed order, updating after every row, from the
state that the last pass left; the next state is the mean of the shards'. Rows
stream through the tasks, only the states (``BUCKETS`` numbers) come back to the
driver. Scoring is one pass over all texts, whole.

Fitting reads labelled rows of a bounded expected number (``SAMPLE``), chosen by
hashes of the id and the text, so it doesn't depend on how rows are dealt.

Defined results: null and empty texts have no features and get the score of the
bias alone; without labelled training rows every score is 0.5; with training
rows of one kind only the model learns that kind; a document labelled twice
counts by its larger label; null labels and labels of null ids are ignored; equal
texts of an id count once, and no id has more texts than its even share of
``SAMPLE``; repeated documents each get a row; a null id is scored like any other
and its remainder is that of the empty text; an empty table gives no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltway.llm import common
from voltway.llm.words import WordHashes, rolling

#: Expected number of labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
#: Buckets of hashed n-grams, as a power of two.
BITS = 17
BUCKETS = 1 << BITS
NGRAMS = (1, 2)
SHARDS, PASSES = 4, 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.25, 0.1

#: Words, and runs of marks between them; bytes of letters beyond ASCII count as letters.
WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
AGAIN = np.uint64(0x5BD1E995)


class Hasher:
    """text -> sorted buckets of its n-grams, with a bounded memory of words."""

    def __init__(self):
        self.hashes = WordHashes()

    def buckets(self, text: bytes | None) -> np.ndarray:
        """All buckets that the text's n-grams fall in, with repetitions."""
        words = self.hashes.of(WORDS.findall(text)) if text else np.zeros(0, np.uint64)
        if len(words) > 1:
            words[1:][words[1:] == words[:-1]] = AGAIN
        grams = np.concatenate([rolling(words, k) for k in NGRAMS]).view(np.uint64)
        return (grams >> np.uint64(64 - BITS)).astype(np.int32)

    def features(self, text: bytes | None) -> np.ndarray:
        return np.unique(self.buckets(text))


@dataclass
class Leader:
    """State of FTRL-Proximal; the last place is the bias."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls) -> Leader:
        return cls(np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def learn(self, features: np.ndarray, label: int) -> None:
        """One row: predict, then move every bucket of it."""
        at = np.append(features, BUCKETS)
        w, n = self.weights(at), self.n[at]
        g = probability(w.sum()) - label
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] += g * g


def probability(z: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -500.0, 500.0))))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scorer(self):
        """text -> probability of label 1."""
        hasher, used = Hasher(), self.weights != 0

        def score(text: bytes | None) -> float:
            found = hasher.buckets(text)
            return probability(self.weights[np.unique(found[used[found]])].sum() + self.bias)

        return score


def labelled_sample(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> DataFrame:
    """doc_id, label, text of the training rows, their expected number at most ``sample``; ``training`` is a condition on doc_id."""
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    known = known.filter(training).groupBy("doc_id").agg(F.max("label").alias("label"))
    n = max(1, known.count())
    part = lambda share, *columns: F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < F.lit(float(1 << 30)) * share
    chosen = F.broadcast(known.filter(part(F.lit(sample / n), "doc_id")))  # bounded by ``sample``
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).join(chosen, "doc_id")
    rows = F.broadcast(texts.groupBy("doc_id").agg(F.count("*").alias("rows")))  # one for each of the chosen
    return texts.join(rows, "doc_id").filter(part(F.lit(max(1, sample // n)) / F.col("rows"), "doc_id", "text")).select("doc_id", "label", "text").distinct()


def feature_rows(sample: DataFrame) -> DataFrame:
    """shard, place (in the shard's order), label, features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [hasher.features(t) for t in part.column(3).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(found, pa.list_(pa.int32()))], names=["shard", "place", "label", "features"])

    place = F.xxhash64("text", "doc_id")
    dealt = sample.select(F.pmod(place, F.lit(SHARDS)).cast("int").alias("shard"), place.alias("place"), "label", "text")
    return dealt.mapInArrow(run, "shard int, place long, label int, features array<int>")


def passed(rows: DataFrame, state: Leader) -> Leader:
    """The mean of the states in which the shards leave ``state``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = None, None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([own.z.tobytes()]), pa.array([own.n.tobytes()])], names=["z", "n"])

        for batch in batches:
            for at, label, features in zip(*(c.to_pylist() if k < 2 else c for k, c in enumerate((batch.column(0), batch.column(2), batch.column(3)))), strict=True):
                if at != shard:
                    if own:
                        yield made()
                    own, shard = Leader(state.z.copy(), state.n.copy()), at
                own.learn(features.values.to_numpy(), label)
        if own:
            yield made()

    ordered = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place", "label")
    found = ordered.mapInArrow(run, "z binary, n binary").collect()  # one row a shard
    mean = lambda name: np.mean([np.frombuffer(r[name]) for r in sorted(found)], axis=0)
    return Leader(mean("z"), mean("n")) if found else state


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE, passes: int = PASSES, **columns) -> Model:
    """Learn from the labelled rows for which ``training`` holds."""
    rows = common.written(feature_rows(labelled_sample(docs, labels, training, sample, **columns)), "quality-features")
    state = Leader.new()
    for _ in range(passes):
        state = passed(rows, state)
    weights = state.weights()
    return Model(weights[:-1], float(weights[-1]))


def quality(model: Model, text: Column) -> Column:
    """The score of each text."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        score = model.scorer()
        return pa.array([score(t) for t in common.texts_of(texts)], pa.float64())

    return run.asNondeterministic()(text)


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
           fold: int = 3, held: int = 1, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; rows of remainder ``held`` teach nothing."""
    model = fit(docs, labels, common.remainder("doc_id", fold) != held, id_column=id_column, text_column=text_column, label_column=label_column, **options)
    found = docs.select(F.col(id_column).alias("doc_id"), (common.remainder(id_column, fold) == held).alias("held_out"), quality(model, F.col(text_column)).alias("score"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
