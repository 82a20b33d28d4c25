"""Publishers' deliveries: their files, and how declared columns become the silver models' inputs.

``published_files`` writes what the publishers would deliver of the ``events``
table: string files under the publishers' own names and columns. ``bound`` reads
landed files of a source, whatever their number and headers, as what the typed
models take.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltway.functions.columns import normal_name
from voltway.operators import sessions as S
from voltway.sources import files as fs
from voltway.sources.contracts import CONTRACTS, GAMMA

# publisher's column -> input of the typed model.
BINDINGS = {
    "alpha": {
        "Station_Name": "station_name", "Address": "address", "Start_Date___Time": "start_text", "End_Date___Time": "end_text", "Charging_Time__hh_mm_ss_": "charging_text",
        "Total_Duration__hh_mm_ss_": "total_text", "Energy__kWh_": "energy_text", "ObjectID": "delivery_row", "ObjectId2": "file_row",
    },
    "beta": {"station_name": "station_name", "address_1": "address", "start_date": "start_text", "charging_time_hh_mm_ss": "charging_text", "energy_kwh": "energy_text"},
    "gamma": {
        "ChargingEvent": "source_session_id", "CPID": "cpid", "Name": "name", "Connector": "connector", "StartDate": "start_date", "StartTime": "start_time", "EndDate": "end_date", "EndTime": "end_time",
        "PluginDuration": "plugged_text", "Energy": "energy_text",
    },
}
#: Inputs that are whole numbers; anything else in them is null.
NUMBERS = ("delivery_row", "file_row")
TYPED = {"alpha": S.typed_alpha, "beta": S.typed_beta, "gamma": S.typed_gamma}
PUBLISHED = {"alpha": S.published_alpha, "beta": S.published_beta, "gamma": S.published_gamma}


def family_of(file_name: Column) -> Column:
    """Gamma's family by the part of the file name that its contract knows it by; null for others."""
    found = F.lit(None).cast("string")
    for family in reversed(GAMMA.families):
        found = F.when(file_name.contains(family.pattern), F.lit(family.name)).otherwise(found)
    return found


def bound(bronze: DataFrame, source: str) -> DataFrame:
    """Landed rows of a source (normal names and metadata) under the typed model's names.

    A column that no file has is null, and one that gamma's family doesn't publish
    holds its token for nothing; a row's id only tells equal rows of a file apart.
    """
    def value(published: str, name: str) -> Column:
        own = normal_name(published)
        text = F.col(own) if own in bronze.columns else F.lit(None).cast("string")
        for f in GAMMA.families if source == "gamma" else ():
            if published not in {c.name for c in f.columns}:
                text = F.coalesce(text, F.when(family_of(F.col("_file_name")) == f.name, F.lit(f.null_tokens[0])))
        return (text.try_cast("long") if name in NUMBERS else text).alias(name)

    given = [F.monotonically_increasing_id().alias("object_id"), F.col("_file_name").alias("source_file"), F.col("_row_hash").alias("row_hash")]
    family = [family_of(F.col("_file_name")).alias("family")] if source == "gamma" else []
    found = bronze.select(*given, *family, *(value(p, n) for p, n in BINDINGS[source].items()))
    return found.withColumn("source_session_id", F.nullif("source_session_id", F.lit("NA"))) if source == "gamma" else found


def typed(bronze: DataFrame, source: str) -> DataFrame:
    """Landed rows of a source, parsed."""
    return TYPED[source](bound(bronze, source))


def published_files(spark: SparkSession, events: DataFrame, inbox: str, sources: tuple[str, ...] = ("alpha", "beta", "gamma")) -> None:
    """Write ``inbox/<source>/<family's name>-<part>.csv`` for every family; a source's earlier files go."""
    for source in sources:
        fs.delete(spark, f"{inbox}/{source}")
        rows = PUBLISHED[source](events)
        for family in CONTRACTS[source].families:
            own = rows.filter(F.col("family") == family.name) if source == "gamma" else rows
            written_files(own, source, family, f"{inbox}/{source}")


def written_files(rows: DataFrame, source: str, family, folder: str) -> None:
    """One family's rows under its declared columns as csv files, a file a partition."""
    spark, named = rows.sparkSession, BINDINGS[source]
    own = lambda c: F.col(named[c]).cast("string") if named.get(c) in rows.columns else F.lit(None).cast("string")
    aside = f"{folder}/.{uuid.uuid4().hex}"
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    rows.select(*(own(c.name).alias(c.name) for c in family.columns)).write.options(header=True, **kept).csv(aside)
    for k, part in enumerate(fs.listed(spark, aside, ".csv")):
        fs.renamed(spark, part.path, f"{folder}/{family.pattern}-{k:05d}.csv")
    fs.delete(spark, aside)
