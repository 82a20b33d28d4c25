"""Shared helpers: the cluster's shared folder, tables that cut lineage, ids."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltway.sources.files import shared_dir


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine find this package, wherever the driver was started.

    On a cluster it comes with ``--py-files`` or an installed environment; a
    folder that isn't there does no harm.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{shared_dir(spark).rstrip('/')}/voltway/{uuid.uuid4().hex}-{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: work isn't repeated and lineage ends."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def joined_in_slices(left: DataFrame, right: DataFrame, on: str, by: str, slices: int = 256) -> DataFrame:
    """Inner join with a ``right`` of one row a key, where very many rows of ``left`` may share one.

    Rows of ``left`` are dealt to slices by ``by``, and ``right`` is copied to the
    slices that its key has there, so that no key is one task.
    """
    dealt = left.withColumn("_slice", F.pmod(F.xxhash64(by), F.lit(slices)))
    copies = right.join(dealt.select(on, "_slice").distinct(), on)
    return dealt.join(copies, [on, "_slice"]).drop("_slice")


def give_back() -> None:
    """Hand freed memory back to the system: a worker runs tasks of many kinds, and keeps what one needed most for ever otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def in_parts(*arrays: pa.Array, rows: int = 500) -> Iterator[tuple[pa.Array, ...]]:
    """Equally long arrays some rows at a time, so that a task holds few texts as Python objects at once."""
    for at in range(0, len(arrays[0]), rows):
        yield tuple(a.slice(at, rows) for a in arrays)
    give_back()


def texts_of(texts: pa.Array) -> Iterator[bytes | None]:
    """The texts as UTF-8, some at a time."""
    for (part,) in in_parts(texts):
        yield from part.cast(pa.large_binary()).to_pylist()


def remainder(id_column: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor
