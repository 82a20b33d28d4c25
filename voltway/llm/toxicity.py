"""Toxicity classifier with counterfactual regularisation.

A logistic model over the presence of words and word beginnings. Which features
count is chosen from their document counts among labelled training rows, all
that are far enough from no effect. Every sampled text that mentions an identity
term is written anew with the term swapped for each other of its kind, and the
weights are fitted with a penalty on how far that moves the text's score, so a
neutral mention of a group weighs nothing of its own. The model is linear, so a
swap is known by the features that the text gains and loses; equal ones are
counted in Spark.

Fitting reads a sample of labelled rows of bounded expected size (``SAMPLE``,
chosen by hashes of the id and the text); scoring is one pass over all texts, whole.

Defined results: null and empty texts get the score of no features; without
labelled rows of both kinds every score is 0; a document labelled twice counts
as toxic if any label says so; null labels are ignored; repeated documents each
get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltway.llm import common

#: Expected number of labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
#: A feature counts if it is in at least so many sampled texts, and so many standard errors from no effect.
LEAST_TEXTS, LEAST_Z = 4, 4.0
BEGINNINGS = (4, 5, 6)
#: Words whose features a worker remembers.
MOST_WORDS = 150_000
L2, SWAP_PENALTY, STEPS, RATE = 1e-4, 10.0, 500, 0.1

# Identity terms that may be swapped for each other, by kind.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("femmes", "hommes", "filles"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer", "mädchen"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres", "niñas"),
    ("musulmanes", "cristianos", "judíos"),
)
TERMS = {t.encode(): tuple(o.encode() for o in kind if o != t) for kind in IDENTITY for t in kind}
#: ASCII that isn't a letter or digit becomes a space.
SPACED = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> set[bytes]:
    return set(text.lower().encode().translate(SPACED).split()) if text else set()


def features_of(word: bytes) -> list[bytes]:
    """The word and its beginnings."""
    return [b"=" + word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)]


@dataclass
class Model:
    """Weights by feature; ``bias`` None: nothing was learned."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float | None = None

    def scorer(self):
        """text -> score, with a bounded memory of words."""
        known: dict[bytes, tuple] = {}

        def score(text: str | None) -> float:
            if self.bias is None:
                return 0.0
            found = set()
            if len(known) > MOST_WORDS:
                known.clear()
            for word in words_of(text):
                hits = known.get(word)
                if hits is None:
                    hits = known[word] = tuple(f for f in features_of(word) if f in self.weights)
                if hits:
                    found.update(hits)
            z = self.bias + sum(self.weights[f] for f in sorted(found))
            return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))

        return score


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, id_column: str, text_column: str, label_column: str, fold: int) -> DataFrame:
    """label, text: training rows, their expected number bounded by ``sample``.

    Equal texts of an id count once, and no id has more texts than its even share of ``sample``.
    """
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    known = known.filter(common.remainder("doc_id", fold) != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    n = max(1, known.count())
    share, most = min(1.0, sample / n), max(1, sample // n)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id").distinct()  # bounded by ``sample``
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    return joined.withColumn("rank", rank).filter(F.col("rank") <= most).select("label", "text")


def features_of_all(words: set[bytes]) -> set[bytes]:
    return {f for w in words for f in features_of(w)}


def swapped(words: set[bytes]) -> list[dict]:
    """What a text of these words gains and loses by each swap of a term; a term's swaps weigh 1 together."""
    before, found = features_of_all(words), []
    for term in sorted(words & TERMS.keys()):
        for other in TERMS[term]:
            after = features_of_all(words - {term} | {other})
            if after != before:
                found.append({"gained": sorted(after - before), "lost": sorted(before - after), "weight": 1.0 / len(TERMS[term])})
    return found


SWAPS = pa.list_(pa.struct([("gained", pa.list_(pa.binary())), ("lost", pa.list_(pa.binary())), ("weight", pa.float64())]))


def feature_rows(sample: DataFrame) -> DataFrame:
    """row, label, features (words and beginnings), swaps of the text's identity terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words = [words_of(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([sorted(features_of_all(ws)) for ws in words], pa.list_(pa.binary())), pa.array([swapped(ws) for ws in words], SWAPS)],
                    names=["row", "label", "features", "swaps"],
                )

    numbered = sample.select(F.monotonically_increasing_id().alias("row"), "label", "text")
    return numbered.mapInArrow(run, "row long, label int, features array<binary>, swaps array<struct<gained: array<binary>, lost: array<binary>, weight: double>>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", fold: int = 5, swap_penalty: float = SWAP_PENALTY) -> Model:
    """Learn from labelled rows outside the held-out fold."""
    rows = common.written(feature_rows(labelled_sample(docs, labels, sample, id_column, text_column, label_column, fold)), "features")
    n1, n = rows.agg(F.sum("label"), F.count("*")).first()
    if not n or not n1 or n1 == n:
        return Model()
    counts = rows.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("label").alias("a"), F.count("*").alias("m"))
    a, m, rate = F.col("a"), F.col("m"), n1 / n
    part = lambda k, share: F.when(k > 0, k * F.log(k / (m * share))).otherwise(0.0)
    z = F.sqrt(F.greatest(2 * (part(a, rate) + part(m - a, 1 - rate)), F.lit(0.0)))  # root of the likelihood ratio statistic
    kept = counts.filter(m >= LEAST_TEXTS).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
    names = sorted(bytes(r["feature"]) for r in kept.select("feature").collect())  # bounded by the sample
    index = {f: i for i, f in enumerate(names)}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[index[f] for f in fs if f in index] for fs in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32()))], names=["label", "at"])

    found = rows.select("label", "features").mapInArrow(chosen, "label int, at array<int>").collect()  # bounded by the sample
    moves = rows.select(F.explode("swaps").alias("swap")).groupBy("swap.gained", "swap.lost").agg(F.sum("swap.weight").alias("texts")).collect()  # bounded by the sample
    known = lambda fs: np.array([index[bytes(f)] for f in fs if bytes(f) in index], int)
    pairs = [(known(r["gained"]), known(r["lost"]), r["texts"]) for r in moves]
    return trained(found, names, [(g, l, t) for g, l, t in pairs if len(g) or len(l)], swap_penalty)


def trained(rows: list, names: list[bytes], pairs: list[tuple[np.ndarray, np.ndarray, float]], swap_penalty: float) -> Model:
    """Full-batch Adam on weighted log loss, L2 and the swap penalty over ``pairs`` (features gained, features lost, texts)."""
    y = np.array([r["label"] for r in rows], float)
    lengths = np.array([len(r["at"]) for r in rows])
    columns = np.array([i for r in rows for i in r["at"]], int)
    owner = np.repeat(np.arange(len(rows)), lengths)
    w = np.zeros(len(names) + 1)
    weight = np.where(y == 1, np.sqrt((1 - y.mean()) / y.mean()), 1.0)  # toxic rows are few
    weight /= weight.mean()
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, w[columns], len(rows)) + w[-1]
        error = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(rows)
        g = np.append(np.bincount(columns, error[owner], len(names)), error.sum())
        g[:-1] += L2 * w[:-1]
        for gained, lost, texts in pairs:
            move = 2 * swap_penalty * texts / len(rows) * (w[gained].sum() - w[lost].sum())
            g[gained] += move
            g[lost] -= move
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model({f: float(x) for f, x in zip(names, w, strict=False) if x}, float(w[-1]))


def toxicity(model: Model, text: Column) -> Column:
    """The score of each text."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        score = model.scorer()
        return pa.array([score(t) for (part,) in common.in_parts(texts) for t in part.to_pylist()], pa.float64())

    return run.asNondeterministic()(text)


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", fold: int = 5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels, id_column=id_column, text_column=text_column, fold=fold, **options)
    found = docs.select(
        F.col(id_column).alias("doc_id"), (common.remainder(id_column, fold) == 0).alias("held_out"), toxicity(model, F.col(text_column)).alias("score")
    )
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents predicted not toxic, with all their columns."""
    model = fit(docs, labels, id_column=id_column, text_column=text_column, **options)
    return docs.withColumn("_voltway_toxicity", toxicity(model, F.col(text_column))).filter("_voltway_toxicity < 0.5").select(*docs.columns)
