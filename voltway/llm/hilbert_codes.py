"""Vector code compression: integer product codes from Hilbert-sorted flat blocks.

Vectors of integers are cut into ``PARTS`` parts, and each part position has a
codebook that a few rounds of nearest-entry averaging improve. Vectors are packed
once into slices, a row each: for every part position the slice's parts lie
sorted along a Hilbert curve, in flat blocks with the block's box (least and
largest component) and its sum. In a round, the least and largest distance from a
box to every entry, and how much farther than the best entry another is at least,
leave a shortlist of entries that can be nearest to anything inside. A block with one entry on its list is counted by its sum alone; the rest
go through exact integer kernels over equally long lists. Which parts share a
slice or block changes no result.

A round sends only sums by part, entry and component through a shuffle (a few
thousand rows a task, combined there), and no key of the data deals rows out, so
equal vectors in any number are spread like others. Labels are summed by an
aggregate that combines in the tasks first.

Defined results: dropped are vectors that are null, empty or hold null or
non-finite components, and those that can't be coded with the rest: lengths that
are no multiple of ``PARTS`` or not that of the first kept vector, and components
beyond ``REACH`` either way, which exact kernels in 64 bits don't hold. The first
codebook takes rows in order of vec_id (null last), then of the vector; with fewer
rows than ``ENTRIES`` it has as many entries as there are rows. Repeated rows each
get a row and each count; a null vec_id is coded like any other; empty tables give
no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltway.llm import common

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components are at most this in size before scaling, so that no sum of squares overflows.
REACH = float(1 << 18)
#: Vectors a slice and parts a block.
SLICE, BLOCK = 8_192, 32
#: Distances that a kernel holds at a time.
MOST = 2_000_000


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Places of points (n, w) along a Hilbert curve through their bounding cube, of 60 bits at most."""
    n, w = points.shape
    w = min(w, 60)  # the order is only there to make boxes small
    bits = max(1, min(16, 60 // w))
    low, high = int(points.min()), int(points.max())
    x = [((points[:, i].astype(np.int64) - low) * ((1 << bits) - 1) // max(1, high - low)) for i in range(w)]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(w):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, w):
        x[i] = x[i] ^ x[i - 1]
    flips = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    keys = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for own in x:
            keys = keys << 1 | ((own ^ flips) >> level) & 1
    return keys


def kernel_type(w: int, reach: int) -> type:
    """The smallest integers that hold squared distances of points within ``reach``."""
    return np.int32 if w * (2 * reach + 1) ** 2 < 1 << 31 else np.int64


class Blocks:
    """One part position of a slice: sorted parts in blocks with boxes and sums."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.points, self.low, self.high, self.sums = points, low, high, sums

    @classmethod
    def packed(cls, points: np.ndarray) -> tuple[Blocks, np.ndarray]:
        """The blocks and the order in which they hold the points."""
        order = np.argsort(hilbert_keys(points), kind="stable").astype(np.int32)
        points = np.ascontiguousarray(points[order])
        starts = np.arange(0, len(points), BLOCK)
        return cls(points, np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts), np.add.reduceat(points.astype(np.int64), starts)), order

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """(blocks, entries): whether the entry can be nearest to a point of the block."""
        e, low, high = entries[None], self.low[:, None].astype(np.int64), self.high[:, None].astype(np.int64)
        least = (np.maximum(np.maximum(low - e, e - high), 0) ** 2).sum(2)
        most = (np.maximum(np.abs(e - low), np.abs(e - high)) ** 2).sum(2)
        best = most.argmin(1)
        ahead = e - entries[best][:, None]  # by how much an entry is at least farther than the best one, anywhere in the box
        farther = (entries * entries).sum(1)[None] - (entries[best] ** 2).sum(1)[:, None] - 2 * np.maximum(low * ahead, high * ahead).sum(2)
        return (least <= most.min(1, keepdims=True)) & (farther <= 0)

    def assigned(self, entries: np.ndarray, with_distances: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per point the nearest entry (ties: the lower) and its distance; per entry how many points and their sum.

        Without ``with_distances`` only the last two are filled in.
        """
        n, w = self.points.shape
        near, far = np.zeros(n, np.int16), np.zeros(n, np.int64)
        counts, totals = np.zeros(len(entries), np.int64), np.zeros((len(entries), w), np.int64)
        listed = self.shortlists(entries)
        lengths = listed.sum(1)
        sizes = np.minimum(BLOCK, n - BLOCK * np.arange(len(listed)))
        whole = np.flatnonzero(lengths == 1) if not with_distances else np.zeros(0, int)
        if len(whole):
            only = listed[whole].argmax(1)
            np.add.at(counts, only, sizes[whole])
            np.add.at(totals, only, self.sums[whole])
        kind = kernel_type(w, int(max(np.abs(self.low).max(), np.abs(self.high).max(), np.abs(entries).max())))
        points, small = self.points.astype(kind), entries.astype(kind)
        for length in np.unique(lengths):
            if length == 1 and not with_distances:
                continue
            blocks = np.flatnonzero(lengths == length)
            step = max(1, MOST // (BLOCK * int(length)))
            for at in range(0, len(blocks), step):
                own = blocks[at : at + step]
                lists = np.nonzero(listed[own])[1].reshape(len(own), length)
                places = own[:, None] * BLOCK + np.arange(BLOCK)
                real = places < n
                x = points[np.minimum(places, n - 1)]
                distance = np.zeros((len(own), BLOCK, length), kind)
                for i in range(w):
                    difference = x[:, :, None, i] - small[lists][:, None, :, i]
                    distance += difference * difference
                least = distance.argmin(2)
                entry = np.take_along_axis(lists, least, 1)[real]
                near[places[real]] = entry
                far[places[real]] = np.take_along_axis(distance, least[:, :, None], 2)[:, :, 0][real]
                counts += np.bincount(entry, minlength=len(entries))
                if not with_distances:
                    np.add.at(totals, entry, self.points[places[real]])
        return near, far, counts, totals


SLICES = "vec_id array<long>, label array<string>, points binary, orders binary, lows binary, highs binary, sums binary"
SLICE_NAMES = [x.split()[0] for x in SLICES.split(", ")]


def packed_slices(vectors: DataFrame, width: int) -> DataFrame:
    """One row per slice of ``vectors`` (vec_id, label, ints of ``PARTS`` times ``width``)."""

    def made(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        ints = np.concatenate([c.flatten().to_numpy() for c in table.column("ints").chunks]).reshape(-1, PARTS, width)
        found = [Blocks.packed(np.ascontiguousarray(ints[:, p])) for p in range(PARTS)]
        flat = lambda arrays: b"".join(a.tobytes() for a in arrays)
        blobs = [flat(b.points for b, _ in found), flat(o for _, o in found), flat(b.low for b, _ in found), flat(b.high for b, _ in found), flat(b.sums for b, _ in found)]
        ids, labels = (pa.array([table.column(c).to_pylist()], pa.list_(k)) for c, k in (("vec_id", pa.int64()), ("label", pa.string())))
        return pa.RecordBatch.from_arrays([ids, labels, *(pa.array([b], pa.binary()) for b in blobs)], names=SLICE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, SLICE - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == SLICE:
                    yield made(held)
                    held, n = [], 0
        if n:
            yield made(held)

    return vectors.select("vec_id", "label", "ints").mapInArrow(run, SLICES)


def slices_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.ListScalar, pa.ListScalar, list[tuple[Blocks, np.ndarray]]]]:
    """vec_id, label and the blocks and order by part position of each slice of a batch."""
    for row in range(batch.num_rows):
        ids, labels, points, orders, lows, highs, sums = (c[row] for c in batch.columns)
        view = lambda blob, kind, *shape: np.frombuffer(blob.as_buffer(), kind).reshape(PARTS, -1, *shape)
        shaped = zip(view(points, np.int32, width), view(lows, np.int32, width), view(highs, np.int32, width), view(sums, np.int64, width), strict=True)
        yield ids, labels, list(zip((Blocks(*x) for x in shaped), view(orders, np.int32), strict=True))


def improved(slices: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, width) after one round."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
        for batch in batches:
            for _, _, blocks in slices_of(batch, width):
                for p, (own, _) in enumerate(blocks):
                    _, _, n, total = own.assigned(codebooks[p], with_distances=False)
                    counts[p] += n
                    totals[p] += total
        used = np.flatnonzero(np.repeat(counts, width))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.repeat(counts, width)[used]), pa.array(totals.ravel()[used])], names=["place", "n", "total"])

    sums = slices.mapInArrow(run, "place long, n long, total long").groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = codebooks.ravel().copy()
    for r in sums.collect():  # one row a component of the codebooks
        found[r["place"]] = r["total"] // r["n"]
    return found.reshape(codebooks.shape)


def coded(slices: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, code, error."""
    width = codebooks.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, blocks in slices_of(batch, width):
                codes, error = np.zeros((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
                for p, (own, order) in enumerate(blocks):
                    near, far, _, _ = own.assigned(codebooks[p])
                    codes[order, p] = near
                    error[order] += far
                text = codes.tobytes().hex()
                texts = [text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(texts, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return slices.mapInArrow(run, "vec_id long, label string, code string, error long")


def integers(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label (as text), ints of the vectors that can be coded."""
    named = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("string").alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    fits = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= REACH))
    kept = named.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % PARTS == 0) & fits)
    return kept.select("vec_id", "label", F.transform("vector", lambda x: F.floor(x * SCALE).cast("int")).alias("ints"))


def compressed(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector."""
    kept = integers(vectors, id_column, vector_column, label_column)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(ENTRIES).collect()
    width = len(first[0]["ints"]) // PARTS if first else 1
    kept = kept.filter(F.size("ints") == width * PARTS)
    seeds = [r["ints"] for r in first if len(r["ints"]) == width * PARTS]
    if seeds and len(seeds) < len(first):
        seeds = [r["ints"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(ENTRIES).collect()]
    codebooks = np.array(seeds, np.int64).reshape(len(seeds), PARTS, width).transpose(1, 0, 2).copy()
    slices = packed_slices(kept, width)
    path = common.new_folder(vectors.sparkSession, "slices")
    slices.write.option("maxRecordsPerFile", 16).parquet(path)  # a reader holds a file's slices at once
    slices = vectors.sparkSession.read.schema(slices.schema).parquet(path)
    for _ in range(rounds if seeds else 0):
        codebooks = improved(slices, codebooks)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    codes = common.written(coded(slices, codebooks), "codes")
    labels = codes.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(labels, F.col("label").eqNullSafe(F.col("same_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def compressed_sql(table: str = "embeddings", rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``compressed`` on a table whose vec_ids are unique and whose vectors have one length."""
    nearest = """SELECT vec_id, p, m // 64 AS error, m % 64 AS e FROM (
        SELECT vec_id, s.p, min(64 * list_sum(list_transform(list_zip(s.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + c.e)::BIGINT AS m
        FROM parts s JOIN {book} c ON s.p = c.p GROUP BY vec_id, s.p)"""
    steps = []
    for r in range(rounds):
        steps.append(f"near{r} AS ({nearest.format(book=f'book{r}')})")
        steps.append(f"""sums{r} AS (SELECT p, e, list(mean ORDER BY i) AS v FROM (
            SELECT p, e, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS mean
            FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM parts JOIN near{r} USING (vec_id, p)) GROUP BY p, e, i) GROUP BY p, e)""")
        steps.append(f"book{r + 1} AS (SELECT p, e, coalesce(s.v, b.v) AS v FROM book{r} b LEFT JOIN sums{r} s USING (p, e))")
    return f"""WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM {table}
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (SELECT vec_id, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS v FROM kept, range(16) AS t(p)),
    book0 AS (SELECT p, n - 1 AS e, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM kept) USING (vec_id) WHERE n <= 64),
    {", ".join(steps)},
    last AS ({nearest.format(book=f"book{rounds}")}),
    coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(error)::BIGINT AS error FROM last GROUP BY vec_id),
    digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
        FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM book{rounds}))
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest"""
