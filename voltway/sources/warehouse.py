"""A folder of Parquet tables in three layers, each written once from those before it.

``bronze``: publishers' rows as strings; ``silver``: all rows typed and judged;
``gold``: the session fact, gaps, stations, station-days and months. A table is
built when it is first asked for (``build`` makes all of gold) and read back from
disk by everything after, so nothing is held in executors' memory. The fact is
made of the judged rows on their way: they are written only for what reads them.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltway.operators import gold
from voltway.operators import intervals as I
from voltway.operators import sessions as S
from voltway.sources.files import hadoop_path, shared_dir


#: Of the stored tables: hashes in hexadecimal are half as long under it.
COMPRESSION = "zstd"


def version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files under a path."""
    own, system = hadoop_path(spark, path)
    files = system.listStatus(own) if system.exists(own) else []
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores, but only where the files make fewer partitions than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


class Warehouse:
    """The layers over one ``events`` table."""

    def __init__(self, spark: SparkSession, events: DataFrame, folder: str | None = None):
        self.spark, self.events = spark, spread(events)
        self.folder = folder or f"{shared_dir(spark).rstrip('/')}/voltway/{uuid.uuid4().hex}-warehouse"

    def stored(self, name: str, made: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        made.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(made.schema).parquet(path)

    def step(self, name: str, made: DataFrame) -> DataFrame:
        """A table that only the build itself reads."""
        path = f"{self.folder}/steps/{name}"
        made.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(made.schema).parquet(path)

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        published: dict[str, Callable] = {"alpha": S.published_alpha, "beta": S.published_beta, "gamma": S.published_gamma}
        return {n: self.stored(f"bronze/{n}", f(self.events)) for n, f in published.items()}

    @cached_property
    def typed(self) -> DataFrame:
        """Every published row parsed: written, as what follows reads each value several times."""
        raw = self.bronze
        return self.stored("silver/typed", S.typed_alpha(raw["alpha"]).unionByName(S.typed_beta(raw["beta"])).unionByName(S.typed_gamma(raw["gamma"])))

    @cached_property
    def told(self) -> DataFrame:
        """Every published row, typed and judged: a plan over the typed rows, for whoever reads them once."""
        return S.judged(self.typed, self.step)

    @cached_property
    def rows(self) -> DataFrame:
        """Every published row, typed and judged."""
        return self.stored("silver/sessions", self.told)

    @cached_property
    def sessions(self) -> DataFrame:
        return S.unioned(self.rows)

    @cached_property
    def files(self) -> DataFrame:
        """source, file_name, sha256: what stands for the version of each publisher's file."""
        content = F.sum(F.xxhash64("row_hash").cast("decimal(38,0)")).cast("string")
        return self.typed.groupBy("source", F.col("source_file").alias("file_name")).agg(F.sha2(content, 256).alias("sha256"))

    @cached_property
    def fact(self) -> DataFrame:
        # Silver is read if it is there: the fact alone doesn't need it written.
        judged = self.rows if "rows" in self.__dict__ else self.told
        return self.stored("gold/fct_charging_session", gold.session_fact(S.unioned(judged), self.files))

    @cached_property
    def line(self) -> DataFrame:
        return I.timeline(self.fact)

    @cached_property
    def levels(self) -> DataFrame:
        return self.stored("gold/int_day_levels", I.day_levels(I.sweep(self.line)))

    @cached_property
    def all_levels(self) -> DataFrame:
        """The daily levels with trivial sessions."""
        return I.day_levels(I.sweep(I.timeline(self.fact, all_sessions=True)))

    @cached_property
    def gaps(self) -> DataFrame:
        return self.stored("gold/int_station_gaps", I.gaps(self.line, gold.GAP_DAYS))

    @cached_property
    def dim(self) -> DataFrame:
        return self.stored("gold/dim_station", gold.dim_station(self.line, I.days_at_level(self.levels, most=I.MOST_LEVELS), self.gaps))

    @cached_property
    def days(self) -> DataFrame:
        return self.stored("gold/fct_station_day", gold.station_day(self.dim, self.gaps, self.fact))

    @cached_property
    def monthly(self) -> DataFrame:
        return self.stored("gold/mart_monthly", gold.mart_monthly(self.days))

    def build(self) -> DataFrame:
        """relation, n of every gold table, all tables written."""
        relations = {"fct_charging_session": self.fact, "int_station_gaps": self.gaps, "dim_station": self.dim, "fct_station_day": self.days, "mart_monthly": self.monthly}
        counts = [t.agg(F.lit(n).alias("relation"), F.count("*").alias("n")) for n, t in relations.items()]
        whole = counts[0]
        for c in counts[1:]:
            whole = whole.unionByName(c)
        return whole

    def drop(self) -> None:
        path, system = hadoop_path(self.spark, self.folder)
        system.delete(path, True)


_OPEN: dict[tuple, Warehouse] = {}


def opened(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The session's warehouse over ``sf_dir``'s events, a new one for each version of the files.

    A table is written by the first call that needs it. Frames that were returned
    earlier stay readable until the session ends, whatever is opened since.
    """
    path = f"{sf_dir}/events.parquet"
    key = (spark.sparkContext.applicationId, sf_dir, version(spark, path))
    if key not in _OPEN:
        if not _OPEN:
            atexit.register(lambda: close(spark))
        _OPEN[key] = Warehouse(spark, spark.read.parquet(path))
    return _OPEN[key]


def close(spark: SparkSession) -> None:
    """Delete this session's tables: nothing reads them any more."""
    own = [k for k in _OPEN if k[0] == spark.sparkContext.applicationId] if spark.sparkContext._jsc is not None else []
    for key in own:
        _OPEN.pop(key).drop()
