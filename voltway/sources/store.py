"""Versions of the stored tables, and releases that rebuild only what changed.

A version is a state of a log: for every table and source the folder that holds
its rows, the tables' schemas and the landed files that they came from. A release
builds the sources of which a file is new, changed or gone, in a folder of its
own, and commits a version that takes everything else from the version before, so
the files of unchanged sources stay where they are. Until the commit nobody sees
the new folders; a build that dies leaves the tables as they were. Readers hold a
version; ``vacuum`` deletes only what no kept or held version refers to.

Every table can be built source by source: stations belong to one source.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltway.operators import gold
from voltway.operators import intervals as I
from voltway.sources import deliveries, landing
from voltway.sources import files as fs
from voltway.sources.files import Log
from voltway.sources.warehouse import COMPRESSION, Warehouse

PART = "_part"
#: Tables of a version: name -> attribute of the warehouse that builds it.
TABLES = {
    "silver/sessions": "rows", "gold/fct_charging_session": "fact", "gold/int_day_levels": "levels", "gold/int_station_gaps": "gaps",
    "gold/dim_station": "dim", "gold/fct_station_day": "days", "gold/mart_monthly": "monthly",
}


def source_of(df: DataFrame) -> Column:
    return F.col("source") if "source" in df.columns else F.split("station_key", "/")[0]


def read_folders(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*sorted(folders)) if folders else spark.createDataFrame([], schema)


class Delivered(Warehouse):
    """The layers over landed files of some sources, each table in a folder a source."""

    def __init__(self, spark: SparkSession, manifest: dict[str, dict], sources: set[str], folder: str):
        self.spark, self.manifest, self.sources, self.folder = spark, manifest, sorted(sources), folder
        self.schemas: dict[str, T.StructType] = {}

    def folders(self, name: str) -> dict[str, str]:
        """source -> folder of a table that is written."""
        found = fs.folders(self.spark, f"{self.folder}/{name}")
        return {f.removeprefix(f"{PART}="): f"{self.folder}/{name}/{f}" for f in found if f.startswith(f"{PART}=")}

    def stored(self, name: str, made: DataFrame) -> DataFrame:
        made.withColumn(PART, source_of(made)).write.option("compression", COMPRESSION).partitionBy(PART).parquet(f"{self.folder}/{name}")
        self.schemas[name] = T.StructType([T.StructField(f.name, f.dataType) for f in made.schema])
        return read_folders(self.spark, list(self.folders(name).values()), self.schemas[name])

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return {s: landing.bronze(self.spark, self.manifest, s) for s in self.sources}

    @cached_property
    def typed(self) -> DataFrame:
        parts = [deliveries.typed(df, s) for s, df in self.bronze.items()]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return self.stored("silver/typed", whole)

    @cached_property
    def dim(self) -> DataFrame:
        """Stations with the latest retrieval time of their source's files."""
        known = [(e["source"], e["retrieved_at"]) for e in good(self.manifest).values()]
        times = self.spark.createDataFrame(known, "source string, retrieved_at string").groupBy("source").agg(F.max("retrieved_at").alias("data_as_of_utc"))
        made = gold.dim_station(self.line, I.days_at_level(self.levels, most=I.MOST_LEVELS), self.gaps)
        return self.stored("gold/dim_station", made.join(F.broadcast(times), "source", "left").select(*made.columns, "data_as_of_utc"))  # a row a source

    @cached_property
    def files(self) -> DataFrame:
        known = [(e["source"], e["file_name"], e["sha256"]) for e in good(self.manifest).values()]
        return self.spark.createDataFrame(known, "source string, file_name string, sha256 string")


def good(manifest: dict[str, dict]) -> dict[str, dict]:
    return {k: e for k, e in manifest.items() if landing.QUARANTINED not in e["landed_path"]}


def inputs(manifest: dict[str, dict]) -> dict[str, dict[str, dict]]:
    """source -> file -> sha256 and rows of what bronze reads."""
    found: dict[str, dict[str, dict]] = {}
    for e in good(manifest).values():
        found.setdefault(e["source"], {})[e["file_name"]] = {"sha256": e["sha256"], "rows": e["row_count"]}
    return found


class Store:
    """The versions under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")
        self.log = Log(spark, f"{self.root}/versions")

    def table(self, state: dict, name: str) -> DataFrame:
        """A table as a version has it."""
        return read_folders(self.spark, list(state["tables"][name].values()), T.StructType.fromJson(state["schemas"][name]))

    def hold(self) -> Held:
        """The newest version, held until it is let go: ``vacuum`` leaves it alone."""
        number, state = self.log.latest()
        if not number:
            raise LookupError(f"no version under {self.root}")
        return Held(self, number, state)

    def stale(self, state: dict, manifest: dict[str, dict]) -> set[str]:
        """Sources of which a file is new, changed or gone since a version; a source whose files are all gone keeps its rows."""
        now, then = inputs(manifest), state.get("inputs", {})
        sha = lambda files: {n: f["sha256"] for n, f in files.items()}
        return {s for s in now if sha(now[s]) != sha(then.get(s, {}))}

    def release(self, manifest: dict[str, dict], full: bool = False) -> tuple[int, set[str]]:
        """Build stale sources (``full``: all) and commit them; the newest version's number and the sources that were built."""
        number, state = self.log.latest()
        sources = set(inputs(manifest)) if full else self.stale(state, manifest)
        if not sources:
            return number, sources
        own = Delivered(self.spark, {k: e for k, e in manifest.items() if e["source"] in sources}, sources, f"{self.root}/tables/{uuid.uuid4().hex}")
        for attribute in TABLES.values():
            getattr(own, attribute)
        fresh, schemas, known = {n: own.folders(n) for n in TABLES}, {n: own.schemas[n].jsonValue() for n in TABLES}, inputs(manifest)

        def change(state: dict) -> dict:
            """What others committed meanwhile stays, but for the sources built here."""
            old, files = state.get("tables", {}), state.get("inputs", {})
            if any(state["schemas"][n] != schemas[n] for n in old):
                raise ValueError("the tables' columns have changed: make a full release")
            return {
                "tables": {n: {s: f for s, f in old.get(n, {}).items() if s not in sources} | fresh[n] for n in TABLES},
                "schemas": schemas, "inputs": {s: f for s, f in files.items() if s not in sources} | {s: known[s] for s in sources},
            }

        number, _ = self.log.update(lambda s: change({} if full else s))
        for name in ("silver/typed", "steps"):  # only steps of the build read them
            fs.delete(self.spark, f"{own.folder}/{name}")
        return number, sources

    def leases(self) -> set[int]:
        return {int(f.name.split("-")[0]) for f in fs.listed(self.spark, f"{self.root}/held")}

    def vacuum(self, keep: int = 1, orphans_after_s: float = 24 * 3600.0) -> list[str]:
        """Delete versions but the newest ``keep`` and held ones, and folders that no remaining version refers to.

        A folder that no version ever referred to may be a build under way: it
        stays until it is ``orphans_after_s`` old.
        """
        numbers, held = self.log.numbers(), self.leases()
        stay = {n for k, n in enumerate(reversed(numbers)) if k < keep or n in held}
        states = {n: self.log.state(n) for n in numbers}
        refers = lambda chosen: {f for n in chosen for t in states[n]["tables"].values() for f in t.values()}
        used = refers(stay)
        gone = sorted(refers(set(numbers) - stay) - used)
        for folder in gone:
            fs.delete(self.spark, folder)
        for n in set(numbers) - stay:
            fs.delete(self.spark, self.log.path(n))
        builds = {f.removeprefix(f"{self.root}/tables/").split("/")[0] for f in refers(numbers)}
        for build in set(fs.folders(self.spark, f"{self.root}/tables")) - builds:
            path = f"{self.root}/tables/{build}"
            if fs.one(self.spark, path).modified / 1000 < time.time() - orphans_after_s:
                fs.delete(self.spark, path)
                gone.append(path)
        return gone


class Held:
    """A version that a reader holds; use with ``with``, or let it go."""

    def __init__(self, store: Store, number: int, state: dict):
        self.store, self.number, self.state = store, number, state
        self.lease = f"{store.root}/held/{number:010d}-{uuid.uuid4().hex}"
        fs.put(store.spark, self.lease, json.dumps({"since": time.time()}))

    def __enter__(self) -> Held:
        return self

    def __exit__(self, *_) -> None:
        self.let_go()

    def let_go(self) -> None:
        fs.delete(self.store.spark, self.lease)

    def table(self, name: str) -> DataFrame:
        return self.store.table(self.state, name)
