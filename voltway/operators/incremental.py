"""Incremental tables: changed sources, replacement by source, slowly changing history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE = ["source", "file_name", "sha256"]


def changed_sources(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Sources with a file that only one of the two knows in that version."""
    ours, theirs = manifest.select(FILE).distinct(), loaded.select(FILE).distinct()
    return ours.join(theirs, FILE, "left_anti").unionByName(theirs.join(ours, FILE, "left_anti")).select("source").distinct()


def replaced(fact: DataFrame, fresh: DataFrame) -> DataFrame:
    """``fresh`` in place of all rows of its sources; a source without fresh rows keeps its old ones."""
    return fact.join(fresh.select("source").distinct(), "source", "left_anti").unionByName(fresh)


def write_replacing(fresh: DataFrame, path: str) -> None:
    """The same on disk: overwrite only the partitions of ``fresh``'s sources."""
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def scd2_step(history: DataFrame, current: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """One run of a check-strategy history.

    ``current`` has ``as_of``; open versions (``valid_to`` null) whose tracked
    columns differ, null-safely, are closed at it and followed by a new version;
    new keys open one; keys that are missing stay open.
    """
    names = [key, *tracked]
    now = current.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in tracked), F.col("as_of").alias("_as_of"))
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    open_rows, closed = history.filter("valid_to is null"), history.filter("valid_to is not null")
    both = open_rows.join(now, F.col(key) == F.col("_key"), "full_outer").withColumn("_same", same)
    stays = F.col("_key").isNull() | (F.col(key).isNotNull() & F.col("_same"))
    olds = both.filter(F.col(key).isNotNull()).select(*names, "valid_from", F.when(~stays, F.col("_as_of")).alias("valid_to"))
    news = both.filter(~stays).select(F.col("_key").alias(key), *(F.col(f"_{c}").alias(c) for c in tracked), F.col("_as_of").alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"))
    return closed.select(*names, "valid_from", "valid_to").unionByName(olds).unionByName(news)
