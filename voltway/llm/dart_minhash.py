"""Near-duplicate classes by DartMinHash.

A text is a weighted set: its five-word shingles (of A-Z lower-cased words)
with their counts. Over each element's strip (weight along one side, time along
the other) hashed darts fall as a Poisson process; a set sees the darts below
its weights, and the earliest dart of each coordinate is its signature. Two
sets agree in a coordinate with the probability of their weighted Jaccard
similarity. Time runs only as far as a few darts per coordinate need, so a set
costs its size plus a constant; where a coordinate is still empty it runs on.

Texts with equal words are one representative from the start. Representatives
whose bands agree share a bucket. Each is first compared, exactly, with one
leader of each of its buckets: the member that shares most buckets with others,
which in a group of copies is the one that the others were made from. After
components are formed, only buckets that still hold several components are
looked at again: members outside a bucket's largest component are compared with
all others, in small buckets as pairs and in large ones in cells of bounded
size, which give back links only. So big groups of copies cost about one
comparison a member, no link between components is left out, and no bucket is
capped.

Defined results: null and empty texts have no words and are copies of each
other; texts of one to four words are one shingle; a class is known by its
smallest doc_id (null ids come last); repeated rows are copies; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltway.llm import common
from voltway.llm.components import components
from voltway.llm.words import WordHashes, mixed, rolling, uniform

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Darts per set that are looked for at first.
DARTS = COORDINATES * (np.log(COORDINATES) + 2.5)
MOST_ELEMENTS = 120_000
#: Buckets of at most so many members are compared as pairs, larger ones in cells of about so many members.
SMALL, MINORS_A_CELL, OTHERS_A_CELL = 8, 256, 1024
SIGNED = "doc_id long, key binary, weight long, buckets array<long>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def key_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def shingles(words: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their counts."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(rolling(known.of(words), min(SHINGLE, len(words))), return_counts=True)


def strips(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """index, hash, low, width of the weight cells [0,1), [1,2), [2,4), [4,8)... that each element reaches into."""
    at = np.arange(len(elements))
    found = [(at, mixed(elements, 0), np.zeros(len(at)), np.ones(len(at)))]
    low, cell = 1, 1
    while True:
        at = np.flatnonzero(weights > low)
        if not len(at):
            return tuple(map(np.concatenate, zip(*found, strict=True)))
        found.append((at, mixed(elements[at], cell), np.full(len(at), float(low)), np.full(len(at), float(low))))
        low, cell = 2 * low, cell + 1


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(sets, COORDINATES) ids of the earliest darts, for sets with elements."""
    sizes = np.array([len(e) for e, _ in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    elements, weights = np.concatenate([e for e, _ in sets]), np.concatenate([w for _, w in sets])
    totals = np.bincount(owner, weights, len(sets))
    out, until, todo = np.zeros((len(sets), COORDINATES), np.uint64), DARTS / totals, np.ones(len(sets), bool)
    while todo.any():
        chosen = todo[owner]
        own, mass = owner[chosen], weights[chosen]
        index, seed, low, width = strips(elements[chosen], mass)
        own, mass, time = own[index], mass[index], np.zeros(len(index))
        slots, times, darts = [], [], []
        arrival = 0
        while len(own):
            arrival += 1
            hashes = mixed(seed, 100 + arrival)
            time = time - np.log(uniform(hashes)) / width
            near = time <= until[own]
            own, mass, seed, low, width, time, hashes = (x[near] for x in (own, mass, seed, low, width, time, hashes))
            dart = mixed(hashes, 1)
            under = (low + width <= mass) | (low + width * uniform(mixed(hashes, 2)) < mass)
            slots.append((own * COORDINATES + (dart % np.uint64(COORDINATES)).astype(np.int64))[under])
            times.append(time[under])
            darts.append(mixed(hashes, 3)[under])
        slot, time, dart = np.concatenate(slots), np.concatenate(times), np.concatenate(darts)
        first = np.full(len(sets) * COORDINATES, np.inf)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        out.reshape(-1)[slot[won]] = dart[won]
        empty = np.isinf(first).reshape(len(sets), COORDINATES).any(1)
        todo &= empty
        until = until * 2
    return out


def buckets(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS) a hash of each band."""
    bands = signature.reshape(len(signature), BANDS, ROWS)
    found = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
    for r in range(ROWS):
        found = mixed(found ^ bands[:, :, r], 50 + r)
    return found.view(np.int64)


def signed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, key of the words, weight, bucket of each band (none without words); one pass, nothing shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()

        def made(ids: list, keys: list, sets: list) -> pa.RecordBatch:
            full = [i for i, s in enumerate(sets) if len(s[0])]
            rows: list = [[]] * len(sets)
            if full:
                for i, row in zip(full, buckets(signatures([sets[i] for i in full])), strict=True):
                    rows[i] = row
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array([int(w.sum()) for _, w in sets], pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                names=["doc_id", "key", "weight", "buckets"],
            )

        for batch in batches:
            ids, keys, sets, n = [], [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), common.texts_of(batch.column(1)), strict=True):
                words = words_of(text)
                ids.append(doc)
                keys.append(key_of(words))
                sets.append(shingles(words, known))
                n += len(words)
                if n > MOST_ELEMENTS:
                    yield made(ids, keys, sets)
                    ids, keys, sets, n = [], [], [], 0
            if ids:
                yield made(ids, keys, sets)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, SIGNED)


def text_key(text: Column) -> Column:
    """The key of a text's words, as ``signed`` gives it."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([key_of(words_of(b)) for b in common.texts_of(texts)], pa.binary())

    return run.asNondeterministic()(text)


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two texts' shingles."""

    @F.arrow_udf("double")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        known, memory = WordHashes(), {}

        def of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
            if text not in memory:
                if len(memory) > 200:
                    memory.clear()
                memory[text] = shingles(words_of(text), known)
            return memory[text]

        found = []
        for x, y in zip(common.texts_of(left), common.texts_of(right), strict=True):
            (a, v), (b, w) = of(x), of(y)
            _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            shared = int(np.minimum(v[i], w[j]).sum())
            found.append(shared / max(1, int(v.sum() + w.sum()) - shared))
        return pa.array(found, pa.float64())

    return run.asNondeterministic()(a, b)


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts (node, text) are at least so similar."""
    left, right = texts.select(F.col("node").alias("u"), F.col("text").alias("a")), texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", similarity(F.col("a"), F.col("b")).alias("s")).filter(F.col("s") >= least).select("u", "v")


def with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def by_leader(members: DataFrame) -> DataFrame:
    """Pairs (u, v) of each member and its buckets' leaders."""
    popular = members.withColumn("popularity", F.sum("n").over(Window.partitionBy("node")))  # a node has BANDS rows
    leaders = popular.groupBy("bucket").agg(F.max(F.struct("popularity", "node")).alias("head")).select("bucket", F.col("head.node").alias("u"))
    return members.join(leaders, "bucket").filter("u <> node").select("u", F.col("node").alias("v")).distinct()


def mixed_members(current: DataFrame) -> DataFrame:
    """Members of buckets of several components; ``minor``: outside the bucket's largest one."""
    sizes = current.filter("n > 2").groupBy("bucket", "component").agg(F.count("*").alias("own"))  # two have met as leader and member
    large = sizes.groupBy("bucket").agg(F.count("*").alias("components"), F.max(F.struct("own", "component")).alias("largest")).filter("components > 1")
    joined = current.join(large.select("bucket", F.col("largest.component").alias("largest")), "bucket")
    return joined.withColumn("minor", F.col("component") != F.col("largest")).drop("largest")


def small_pairs(mixed: DataFrame, least: float) -> DataFrame:
    """Pairs of different components in buckets of at most SMALL members."""
    own = mixed.filter(F.col("n") <= SMALL)
    other = own.filter("minor").select("bucket", F.col("node").alias("v"), F.col("component").alias("c"), F.col("weight").alias("w"))
    apart = (F.col("component") != F.col("c")) & ((F.col("node") < F.col("v")) | ~F.col("minor"))
    near = F.least("weight", "w") >= least * F.greatest("weight", "w")
    return own.join(other, "bucket").filter(apart & near).select(F.col("node").alias("u"), "v").distinct()


def linked_in_cell(minors: pd.DataFrame, others: pd.DataFrame, least: float) -> pd.DataFrame:
    """A link from each minor member to each other component that it is near to."""
    known = WordHashes()
    sets = [shingles(words_of(bytes(t)), known) for t in others["other_text"]]
    lengths = np.array([len(e) for e, _ in sets])
    names, where = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True)
    counts = np.concatenate([w for _, w in sets])
    ends = np.cumsum(lengths) - lengths
    totals = np.add.reduceat(counts, ends)
    component, node = others["other_component"].to_numpy(), others["other_node"].to_numpy()
    found: list[tuple[int, int]] = []
    for u, own, text in zip(minors["node"], minors["component"], minors["text"], strict=True):
        elements, weights = shingles(words_of(bytes(text)), known)
        dense = np.zeros(len(names), np.int64)
        at = np.minimum(np.searchsorted(names, elements), len(names) - 1)
        hit = names[at] == elements
        dense[at[hit]] = weights[hit]
        shared = np.add.reduceat(np.minimum(dense[where], counts), ends)
        near = (shared >= least * (weights.sum() + totals - shared) - 1e-9) & (component != own)
        _, first = np.unique(component[near], return_index=True)
        found += [(u, v) for v in node[near][first]]
    return pd.DataFrame(found, columns=["u", "v"], dtype="int64")


def large_links(mixed: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links across components in buckets of more than SMALL members, found in cells."""
    own = mixed.filter(F.col("n") > SMALL)
    blocks = own.groupBy("bucket").agg(F.ceil(F.count("*") / OTHERS_A_CELL).alias("blocks"), F.ceil(F.count(F.when(F.col("minor"), 1)) / MINORS_A_CELL).alias("groups"))
    dealt = own.join(blocks, "bucket").join(texts.select("node", F.col("text").cast("binary").alias("text")), "node")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    minors = dealt.filter("minor").select("bucket", every("blocks").alias("block"), block("groups").alias("group"), "node", "component", "text")
    keys = ["bucket", "block", "group"]
    others = dealt.select("bucket", block("blocks").alias("block"), every("groups").alias("group"), "node", "component", "text")
    others = others.select(*(F.col(c).alias(f"other_{c}") for c in others.columns))  # the sides come from one frame
    nothing = pd.DataFrame({"u": [], "v": []}, dtype="int64")
    cells = lambda a, b: linked_in_cell(a, b, least) if len(a) and len(b) else nothing
    return minors.groupBy(keys).cogroup(others.groupBy([f"other_{k}" for k in keys])).applyInPandas(cells, "u long, v long").distinct()


def near_classes(
    docs: DataFrame, least: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, key), (keys: key, doc_id, chosen, class_id).

    ``keys`` has a row for each different text: its smallest id, its class's
    smallest id, and whether it is the text that has that id.
    """
    documents = common.written(signed(docs, id_column, text_column), "signed")
    alone = documents.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("weight").alias("weight"), F.first("buckets").alias("buckets"))
    nodes = common.written(alone.select(F.monotonically_increasing_id().alias("node"), "key", "doc_id", "weight", "buckets"), "nodes")

    spread = nodes.select("node", "weight", F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = common.written(spread.join(shared, "bucket"), "members")

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "key", "doc_id")
    keyed = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), text_key(F.col(text_column)).alias("key"))
    texts = keyed.join(wanted, (keyed.key == wanted.key) & keyed.doc_id.eqNullSafe(wanted.doc_id)).select("node", "text")
    texts = common.written(texts.dropDuplicates(["node"]), "texts")

    links = common.checkpointed(verified(by_leader(members), texts, least))
    found = components(links)
    mixed = common.checkpointed(mixed_members(with_component(members, found)))
    if not mixed.isEmpty():
        more = verified(small_pairs(mixed, least), texts, least).unionByName(large_links(mixed, texts, least))
        more = common.checkpointed(more)
        if not more.isEmpty():
            found = components(links.unionByName(more))
    labelled = with_component(nodes.select("node", "key", "doc_id"), found)
    first = labelled.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("head"))
    keys = labelled.join(first, "component").select("key", "doc_id", (F.col("node") == F.col("head.node")).alias("chosen"), F.col("head.doc_id").alias("class_id"))
    return documents.select("doc_id", "key"), common.written(keys, "keys")


def classified(docs: DataFrame, least: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, class_id of every document."""
    documents, keys = near_classes(docs, least, id_column, text_column)
    return documents.join(keys.select("key", "class_id"), "key").select("doc_id", "class_id")


def deduplicated(docs: DataFrame, least: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each class, with all columns of ``docs``: the one with the smallest id."""
    _, keys = near_classes(docs, least, id_column, text_column)
    order = Window.partitionBy("_voltway_key").orderBy(F.col(id_column).asc_nulls_last())
    one = docs.withColumn("_voltway_key", text_key(F.col(text_column))).withColumn("_voltway_rank", F.row_number().over(order)).filter("_voltway_rank = 1")
    chosen = keys.filter("chosen").select(F.col("key").alias("_voltway_key"))
    return one.join(chosen, "_voltway_key", "left_semi").select(*docs.columns)
