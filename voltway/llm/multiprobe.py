"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors are scaled by the largest norm and lengthened by one component to unit
norm, so that the largest inner product is the nearest point. Each table hashes
a point by ``floor((a.x + b) / width)`` for a few Gaussian directions a; a query
visits the buckets around its own in order of estimated success (the summed
squared distances from its projections to a bucket's slots), in every table, and
what the tables find is merged and ranked by exact inner products in double
precision. A query whose buckets held fewer than k others, or which by the sizes
of all buckets and its k-th distance is expected to have found less than ``SURE``
of what lies nearer (one long vector squeezes the others into few buckets), is
scored against all points of its dimension.

Equal vectors are searched once: a class of them keeps its smallest ids, found
with a limit before the shuffle, so a vector that a third of all rows share is
one point. A bucket is scored in cells of at most about ``ROWS_A_CELL`` points
by ``QUERIES_A_CELL`` queries, each giving its best few, so hot buckets spread
and pairs are never rows. All buckets are searched whole: there is no cap.

Defined results: null and zero vectors, empty ones and those with null or
non-finite components take no part; vectors of another dimension are not
candidates for each other; a repeated (id, vector) row counts once; a query
gives fewer than k rows only where its dimension has no more others; an empty
table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltway.llm import common

TABLES, DIRECTIONS, WIDTH, PROBES, REACH = 2, 3, 2.0, 16, 3
ROWS_A_CELL, QUERIES_A_CELL = 4096, 1024
SEED = 20
SURE = 0.9


def directions(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The table's Gaussian directions (over dim + 1 components) and offsets."""
    rng = np.random.default_rng([SEED, table, dim])
    return rng.normal(size=(dim + 1, DIRECTIONS)), rng.uniform(0, WIDTH, DIRECTIONS)


def projected(points: np.ndarray, table: int) -> np.ndarray:
    a, b = directions(points.shape[1] - 1, table)
    return (points @ a + b) / WIDTH


def lengthened(x: np.ndarray, largest: float) -> np.ndarray:
    """Points of unit norm for stored vectors of norm at most ``largest``."""
    x = x / largest
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))])


def code(slots: np.ndarray) -> list[str]:
    return [",".join(map(str, s)) for s in slots.tolist()]


def probe_order(at: np.ndarray, probes: int) -> np.ndarray:
    """(queries, probes, directions): slots to visit, likeliest first."""
    own = np.floor(at)
    steps = np.array(list(itertools.product(range(-REACH, REACH + 1), repeat=at.shape[1])))
    below = (at - own)[:, None, :] - steps - 1.0
    away = np.where(steps < 0, below, np.where(steps > 0, -below - 1.0, 0.0))
    order = np.argsort((away**2).sum(2), axis=1, kind="stable")[:, :probes]
    return (own[:, None, :] + steps[order]).astype(np.int64)


def unpacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def dimension_groups(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    return (own for _, own in pdf.groupby("dim"))


def bucketed(points: DataFrame, largest: float) -> DataFrame:
    """table, dim, bucket, point, vector: each point's bucket in each table."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in (g for f in frames for g in dimension_groups(f)):
            at = lengthened(unpacked(own["vector"]), largest)
            for table in range(TABLES):
                yield own.assign(table=table, bucket=code(np.floor(projected(at, table)).astype(np.int64)))[["table", "dim", "bucket", "point", "vector"]]

    return points.mapInPandas(run, "table int, dim int, bucket string, point long, vector binary")


def probed(queries: DataFrame, probes: int) -> DataFrame:
    """table, dim, bucket, query, target: the buckets that each query visits."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in (g for f in frames for g in dimension_groups(f)):
            x = unpacked(own["vector"])
            at = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])
            for table in range(TABLES):
                visits = probe_order(projected(at, table), probes)
                n = visits.shape[1]
                yield pd.DataFrame(
                    {"table": table, "dim": np.repeat(own["dim"].to_numpy(), n), "bucket": code(visits.reshape(-1, DIRECTIONS)),
                     "query": np.repeat(own["point"].to_numpy(), n), "target": np.repeat(own["vector"].to_numpy(), n)}
                )

    return queries.mapInPandas(run, "table int, dim int, bucket string, query long, target binary")


def bucket_sizes(counts: DataFrame) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """(table, dim) -> slots and point counts of its buckets.

    Points have unit norm, so a table has at most a few hundred buckets per
    dimension, whatever the number of points.
    """
    pdf = counts.toPandas()
    return {
        (int(t), int(d)): (np.array([b.split(",") for b in own["bucket"]], np.int64), own["n"].to_numpy(np.float64))
        for (t, d), own in pdf.groupby(["table", "dim"])
    }


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """Abramowitz and Stegun 7.1.26, within 1e-7."""
    a = np.abs(z) / np.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * a)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-a * a) / 2
    return np.where(z > 0, 1.0 - tail, tail)


def expected_share(x: np.ndarray, kth: np.ndarray, largest: float, probes: int, sizes: dict) -> np.ndarray:
    """The share of the points nearer than the k-th one found that each query's visits are expected to hold.

    A point at distance r projects around the query with deviation r; a bucket
    weighs its points times the chance of its slots, visited or not.
    """
    norm = np.linalg.norm(x, axis=1)
    r = np.sqrt(np.maximum(1e-12, 2.0 - 2.0 * kth / (norm * largest)))[:, None, None] / WIDTH
    points = np.hstack([x / norm[:, None], np.zeros((len(x), 1))])
    missed = np.ones(len(x))
    for table in range(TABLES):
        slots, counts = sizes[table, x.shape[1]]
        at = projected(points, table)
        from_own = slots[None] - at[:, None, :]
        weight = counts * np.maximum(normal_cdf((from_own + 1.0) / r) - normal_cdf(from_own / r), 1e-300 ** (1 / DIRECTIONS)).prod(2)
        visits = probe_order(at, probes)
        visited = np.array([np.isin(code(slots), code(v)) for v in visits])
        missed *= 1.0 - (weight * visited).sum(1) / weight.sum(1)
    return 1.0 - missed


def unsure(queries: DataFrame, largest: float, probes: int, sizes: dict) -> DataFrame:
    """table, dim, bucket, query, target: one visit to all points, for each query (kth null: fewer than k found) that needs it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in (g for f in frames for g in dimension_groups(f)):
            for first in range(0, len(own), 512):
                part = own.iloc[first : first + 512]
                kth = part["kth"].to_numpy(np.float64)
                share = expected_share(unpacked(part["vector"]), np.nan_to_num(kth), largest, probes, sizes)
                part = part[np.isnan(kth) | (share < SURE)]
                yield pd.DataFrame({"table": -1, "dim": part["dim"], "bucket": "", "query": part["point"], "target": part["vector"]})

    return queries.mapInPandas(run, "table int, dim int, bucket string, query long, target binary")


def cells(rows: DataFrame, counts: DataFrame, visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt out to cells: rows to blocks and queries to groups, each copied to the other's."""
    keys = ["table", "dim", "bucket"]
    sizes = counts.select(*keys, F.ceil(F.col("n") / ROWS_A_CELL).alias("blocks")).join(
        visits.groupBy(keys).agg(F.ceil(F.count("*") / QUERIES_A_CELL).alias("groups")), keys
    )
    sizes = common.checkpointed(sizes)
    block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = rows.join(sizes, keys).select(*keys, block("point", "blocks").alias("block"), every("groups").alias("group"), "point", "vector")
    right = visits.join(sizes, keys).select(*keys, every("blocks").alias("block"), block("query", "groups").alias("group"), "query", "target")
    return left, right


def best(rows: pd.DataFrame, queries: pd.DataFrame, most: int) -> pd.DataFrame:
    """Each query's ``most`` points of a cell with the largest exact inner products, ties to smaller points."""
    if rows.empty or queries.empty:
        return pd.DataFrame({"query": [], "point": [], "score": []})
    x, points = unpacked(rows["vector"]), rows["point"].to_numpy()
    found = []
    for first in range(0, len(queries), 256):
        part = queries.iloc[first : first + 256]
        q, ids = unpacked(part["target"]), part["query"].to_numpy()
        near = q @ x.T
        k = min(most, len(x))
        least = np.partition(near, len(x) - k, axis=1)[:, len(x) - k]
        i, j = np.nonzero(near >= (least - 1e-9 * (1.0 + np.abs(least)))[:, None])
        score = (q[i] * x[j]).sum(1)
        order = np.lexsort((points[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        take = rank < most
        found.append(pd.DataFrame({"query": ids[i[take]], "point": points[j[take]], "score": score[take]}))
    return pd.concat(found)


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, probes: int = PROBES, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``, against all other rows."""
    valid = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).filter(
        "vec_id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)"
    ).distinct()
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    classes = valid.withColumn("rank", rank).filter(F.col("rank") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    pack = F.arrow_udf(lambda v: _packed(v), "binary")
    classes = common.checkpointed(
        classes.select(F.col("ids")[0].alias("point"), "ids", "v", F.size("v").alias("dim"), pack("v").alias("vector"))
    )
    own = valid.filter(F.col("vec_id") % every == 0)
    asked = common.checkpointed(common.joined_in_slices(own, classes.select("v", "point", "dim", "vector"), "v", "vec_id").select(F.col("vec_id").alias("query_id"), "point", "dim", "vector"))
    largest = classes.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x, F.sqrt))).first()[0]
    if largest is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    largest *= 1 + 1e-12

    points = classes.select("point", "dim", "vector")
    targets = common.checkpointed(asked.dropDuplicates(["point"]).select("point", "dim", "vector"))
    keys = ["table", "dim", "bucket"]
    most = k + 2  # its own class may come and then give nothing
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")

    def scored(rows: DataFrame, counts: DataFrame, visits: DataFrame) -> DataFrame:
        left, right = (side.groupBy(*keys, "block", "group") for side in cells(rows, counts, visits))
        return left.cogroup(right).applyInPandas(lambda a, b: best(a, b, most), "query long, point long, score double")

    def merged(found: DataFrame) -> DataFrame:
        once = found.groupBy("query", "point").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).drop("rank")

    def listed(found: DataFrame) -> DataFrame:
        spread = found.join(classes.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
        by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return (
            spread.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k + 1)
            .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
        )

    rows = bucketed(points, largest)
    counts = common.checkpointed(rows.groupBy(keys).agg(F.count("*").alias("n")))
    near = common.checkpointed(merged(scored(rows, counts, probed(targets, probes))))
    kth = listed(near).select(F.col("query").alias("point"), F.try_element_at("found", F.lit(k + 1))["score"].alias("kth"))
    again = common.checkpointed(unsure(targets.join(kth, "point", "left"), largest, probes, bucket_sizes(counts)))
    if not again.isEmpty():
        whole = points.select(F.lit(-1).alias("table"), "dim", F.lit("").alias("bucket"), "point", "vector")
        near = merged(near.unionByName(scored(whole, whole.groupBy(keys).agg(F.count("*").alias("n")), again)))
    lists = listed(near)
    own = common.joined_in_slices(asked.select("query_id", F.col("point").alias("query")), lists, "query", "query_id")
    others = own.select("query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)))
    return others.select("query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", "col.score")


def _packed(v):
    import pyarrow as pa

    return pa.array([np.array(x, np.float64).tobytes() for x in v.to_pylist()], pa.binary())
