"""Stored history of slowly changing rows, over many runs.

Open versions stand in one folder, closed ones in a folder for each run that
closed some; a run reads and rewrites the open ones only, and commits by a state
of a log, so a run that dies leaves the history as it was. Attributes are
compared null-safely; keys that a run doesn't bring stay open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltway.sources import files as fs
from voltway.sources.files import Log


def scd_id(key: Column, since: Column) -> Column:
    """One id for a key's version: md5 of both as text."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(text(key), F.lit("|"), text(since)))


class History:
    """The history under a folder: key, tracked columns, valid_from, valid_to (null: open), scd_id."""

    def __init__(self, spark: SparkSession, root: str, key: str, tracked: list[str]):
        self.spark, self.root, self.key, self.tracked = spark, str(root).rstrip("/"), key, tracked
        self.log = Log(spark, f"{self.root}/runs")

    def read(self, folders: list[str], state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def table(self) -> DataFrame:
        """All versions."""
        _, state = self.log.latest()
        return self.read([state["open"], *state["closed"]], state)

    def as_of(self, at) -> DataFrame:
        """The version of each key that held at a time: from ``valid_from`` on, before ``valid_to``."""
        return self.table().filter((F.col("valid_from") <= F.lit(at)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(at))))

    def step(self, current: DataFrame, open_rows: DataFrame | None) -> DataFrame:
        """Versions that stay open, are closed, and are new; ``current`` has the key once, the tracked columns and ``as_of``."""
        kind = current.schema["as_of"].dataType
        new = current.select(
            self.key, *self.tracked, F.col("as_of").alias("valid_from"), F.lit(None).cast(kind).alias("valid_to"), scd_id(F.col(self.key), F.col("as_of")).alias("scd_id")
        )
        if open_rows is None:
            return new
        names = new.columns
        both = open_rows.select(F.col(self.key).alias("_key"), F.struct(*names).alias("old")).join(new.select(F.col(self.key).alias("_key"), F.struct(*names).alias("new")), "_key", "full_outer")
        same = F.lit(True)
        for c in self.tracked:
            same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
        stays = F.col("new").isNull() | (F.col("old").isNotNull() & same)
        closed = F.col("old").withField("valid_to", F.col("new.valid_from"))
        versions = F.when(stays, F.array("old")).when(F.col("old").isNull(), F.array("new")).otherwise(F.array(closed, F.col("new")))
        return both.select(F.explode(versions).alias("v")).select("v.*")

    def run(self, current: DataFrame) -> int:
        """One run; the number of the state that it committed. Raises if another run committed meanwhile."""
        number, state = self.log.latest()
        made = self.step(current, self.read([state["open"]], state) if number else None)
        batch = f"{self.root}/{uuid.uuid4().hex}"
        made.withColumn("_open", F.col("valid_to").isNull()).write.partitionBy("_open").parquet(batch)
        parts = {p.removeprefix("_open="): f"{batch}/{p}" for p in fs.folders(self.spark, batch)}
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in made.schema]).jsonValue()
        if "true" not in parts:  # nothing is open
            made.limit(0).write.parquet(f"{batch}/none")
        after = {"open": parts.get("true", f"{batch}/none"), "closed": [*state.get("closed", []), *([parts["false"]] if "false" in parts else [])], "schema": schema}
        if not self.log.commit(number + 1, after):
            raise RuntimeError(f"another run committed to {self.root} meanwhile")
        return number + 1
