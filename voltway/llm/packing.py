"""Best-fit packing of token sequences, planned over the histogram of lengths.

A task encodes its documents, cuts those longer than ``capacity`` and numbers
the pieces of each length that it has met, so that a piece's rank within its
length is a prefix sum over tasks plus that number: no window gathers a length,
even if a third of all pieces share it. The plan needs only how many pieces of
each length there are (at most ``capacity`` numbers, whatever the input) and
gives runs of slots; pieces take theirs by joining on length and rank.

Defined results: null and empty texts are one end token; a repeated row is
packed again; a document of exactly ``capacity`` tokens is one piece; of a
longer one the first piece takes the rest that doesn't fill a sequence; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltway.llm import common
from voltway.llm.encoding import encoder, public_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLAN = "length long, first_rank long, last_rank long, first_sequence long, offset long"


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts, longest first.

    Rows (length, first rank, last rank, first sequence, offset): the piece of
    that length and rank r goes to sequence first_sequence + r - first_rank.
    Sequences with equal room are handled as runs of consecutive numbers.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, how many)
    rooms: list[int] = []
    rows, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room <= 0:
            return
        if room not in runs:
            runs[room] = []
            insort(rooms, room)
        runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length  # new sequences take several each
                n = -(-left // fit)
                full = left // fit
                for k in range(fit):
                    there = n if k < left - fit * full or full == n else full
                    if there:
                        rows.append((length, rank, rank + there - 1, sequences, k * length))
                        rank += there
                put(capacity - fit * length, sequences, full)
                if full < n:
                    put(capacity - (left - fit * full) * length, sequences + full, 1)
                sequences += n
                break
            room = rooms[at]
            first, n = runs[room].pop()
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            taken = min(n, left)
            rows.append((length, rank, rank + taken - 1, first, capacity - room))
            put(room - length, first, taken)
            if taken < n:
                put(room, first + taken, n - taken)
            rank += taken
            left -= taken
    return rows


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_column: str = "doc_id", text_column: str = "text",
    drops_white: bool = False,
) -> DataFrame:
    """Pieces with their length, checksum, task and number within task and length, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, own = TaskContext.get().partitionId(), encoder(tokenizer, drops_white)
        met = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some_docs, texts in common.in_parts(batch.column(0), batch.column(1)):
                rows = []
                for doc, ids in zip(some_docs.to_pylist(), own.encode(texts.to_pylist()), strict=True):
                    ids = np.append(ids.astype("<u4"), np.array([end_id], "<u4"))
                    start, length = 0, len(ids) % capacity or capacity
                    for k in range(-(-len(ids) // capacity)):
                        rows.append((doc, k, start, length, zlib.crc32(ids[start : start + length]), part, met[length]))
                        met[length] += 1
                        start, length = start + length, capacity
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)

    found = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return common.written(found.mapInArrow(run, PIECES), "pieces")


NAMES = [c.split()[0] for c in PIECES.split(", ")]
KINDS = [{"long": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in PIECES.split(", ")]


def packed(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer or public_path("byte_bpe_50k.json"), capacity, end_id, id_column, text_column)
    by_part = common.checkpointed(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    bases = by_part.select("length", "part", before.alias("base"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    slots = spark.createDataFrame(plan(histogram, capacity), PLAN)
    ranked = cut.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    at = ranked.join(
        F.broadcast(slots),  # its rows depend on the number of different lengths only
        (ranked.length == slots.length) & ranked.rank.between(slots.first_rank, slots.last_rank),
    )
    return at.select(
        "doc_id", "piece", "start", ranked.length, "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset",
    )
