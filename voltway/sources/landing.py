"""Landing: raw files to string Parquet with a manifest; exports with digests.

All files of a source land together: digests are taken in tasks, files that are
unchanged stop there, and the rest are checked by one aggregation and written by
one job for each header that they have. Landed files are never overwritten: a
newer delivery goes to a folder of its own, and the manifest, a log of numbered
states, says which one holds. Paths are Hadoop's throughout.
"""

from __future__ import annotations

import csv
import json
import uuid
from datetime import datetime
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltway.functions.columns import normal_name, row_hash
from voltway.sources import files as fs
from voltway.sources.contracts import KEEP_LAST_GOOD, Contract, Drift, Finding, check_files
from voltway.sources.files import Listed, Log, hadoop_path

METADATA = ("_source", "_file_name", "_retrieved_at", "_row_hash")
QUARANTINED = "_quarantined"
#: Column of a raw frame that names a row's file, and of a landed batch that numbers it.
FILE, PART = "_voltway_file", "_part"
ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "file_name", "url", "sha256", "retrieved_at", "landed_path")] + [T.StructField(n, T.LongType()) for n in ("bytes", "row_count")])
MANIFEST = T.StructType([T.StructField("files", T.MapType(T.StringType(), ENTRY))])
CSV = {"header": True, "nullValue": "", "quote": '"', "escape": '"', "encoding": "UTF-8"}
#: Exports of up to so many rows are one file; larger ones are files of ordered ranges.
ROWS_A_FILE = 1_000_000


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """A raw file's column names: of nothing in an empty file; a nameless first column is ``publisher_row_index``."""
    if path.endswith(".parquet"):
        return tuple(spark.read.parquet(fs.glob_safe(path)).columns)
    if not path.endswith(".csv"):
        raise ValueError(f"neither csv nor parquet: {path}")
    line = fs.first_line(spark, path)
    names = next(csv.reader([line]), []) if line else []
    named = [n or ("publisher_row_index" if not k else f"_c{k}") for k, n in enumerate(names)]
    return tuple(n if named.count(n) == 1 else f"{n}{k}" for k, n in enumerate(named))


def read_files(spark: SparkSession, paths: list[str], names: tuple[str, ...]) -> DataFrame:
    """Raw files of one header as strings, with FILE; only empty fields are null."""
    own = [fs.glob_safe(p) for p in paths]
    if paths[0].endswith(".parquet"):
        df = spark.read.parquet(*own)
    else:
        df = spark.read.options(**CSV).schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(own)
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))  # Spark gives it as part of a url
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns), name.alias(FILE))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One raw file: every column a nullable string."""
    names = header(spark, str(path))
    return read_files(spark, [str(path)], names).drop(FILE)


def landed(df: DataFrame, source: str, file_name: str | Column, retrieved_at: str) -> DataFrame:
    """The raw columns and where they come from; the hash covers raw columns only."""
    raw = [c for c in df.columns if c != FILE]
    hashed = row_hash(*(F.col(f"`{c}`") for c in raw)) if raw else F.lit(None).cast("string")
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    return df.select(*(F.col(f"`{c}`") for c in raw), F.lit(source).alias("_source"), name.alias("_file_name"), F.lit(retrieved_at).alias("_retrieved_at"), hashed.alias("_row_hash"))


def bronze(spark: SparkSession, files: dict[str, dict], source: str) -> DataFrame | None:
    """All landed files of a source by column name, renamed to normal names; None without any. Files set aside aren't read."""
    paths = sorted(e["landed_path"] for e in files.values() if e["source"] == source and QUARANTINED not in e["landed_path"])
    if not paths:
        return None
    # Files with the same columns are read together, those of other headers united by name: no file's schema is guessed from another's.
    parts: dict[tuple, list[str]] = {}
    for entry in files.values():
        if entry["landed_path"] in paths:
            parts.setdefault(tuple(entry["columns"]), []).append(entry["landed_path"])
    frames = []
    for names, own in sorted(parts.items()):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, *METADATA)])
        df = spark.read.schema(schema).parquet(*sorted(own))
        frames.append(df.select(*(F.col(f"`{c}`").alias(c if c in METADATA else normal_name(c)) for c in df.columns)))
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole


def existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``; an empty one of ``schema`` where there is none."""
    own, system = hadoop_path(spark, path)
    found = system.globStatus(own)
    return spark.read.schema(schema).parquet(path) if found is not None and len(found) else spark.createDataFrame([], schema)


def manifest_log(spark: SparkSession, root: str | Path) -> Log:
    return Log(spark, f"{root}/manifest")


def manifest_table(spark: SparkSession, path: str) -> DataFrame:
    """manifest_key and the entry's fields, without files set aside."""
    files = spark.read.schema(MANIFEST).option("multiLine", True).json(path).select(F.explode("files").alias("manifest_key", "entry"))
    return files.select("manifest_key", "entry.*").filter(~F.col("landed_path").contains(QUARANTINED))


def land_files(spark: SparkSession, raws: list[Listed], contract: Contract, root: str | Path, files: dict[str, dict], retrieved_at: str | None = None, urls: dict[str, str] | None = None) -> list[Drift]:
    """Land files of one folder unless they are unchanged; a file that breaks its contract is set aside.

    An empty or unreadable file doesn't replace one that landed well. ``files``,
    the manifest's entries, is changed in place.
    """
    key = lambda name: f"{contract.source}/{name}"
    shas, drifts, groups = fs.digests(spark, raws), {}, {}
    for raw in raws:
        before = files.get(key(raw.name))
        if before and before["sha256"] == shas[raw.name] and (not before["row_count"] or fs.exists(spark, before["landed_path"])):
            drifts[raw.name] = Drift(raw.name, [Finding("unchanged", "ok")])
            continue
        try:
            names = header(spark, raw.path)
        except (ValueError, PySparkException, csv.Error) as e:  # an unreadable delivery is a finding
            drifts[raw.name] = Drift(raw.name, [Finding("unreadable_file", "quarantine", type(e).__name__)])
            continue
        groups.setdefault((names, contract.family(raw.name), raw.name.endswith(".csv")), []).append(raw)
    at = retrieved_at or datetime.now().isoformat(timespec="seconds")
    for (names, _, _), group in groups.items():
        for some in landable(spark, group, names):
            if isinstance(some, Drift):
                drifts[some.file_name] = some
            else:
                drifts |= land_group(spark, some, names, contract, root, files, shas, at, urls or {})
    return [drifts[r.name] for r in raws]


def landable(spark: SparkSession, group: list[Listed], names: tuple[str, ...]):
    """The group whole if all of it can be read, else its files one by one, those that can't as findings."""
    def readable(raws: list[Listed]) -> bool:
        try:
            read_files(spark, [r.path for r in raws], names).agg(F.count("*")).collect()
        except PySparkException:
            return False
        return True

    if not names or group[0].name.endswith(".csv") or readable(group):  # text can always be read
        yield group
        return
    for raw in group:
        yield [raw] if readable([raw]) else Drift(raw.name, [Finding("unreadable_file", "quarantine", "PySparkException")])


def land_group(spark: SparkSession, raws: list[Listed], names: tuple[str, ...], contract: Contract, root: str | Path, files: dict[str, dict], shas: dict[str, str], at: str, urls: dict[str, str]) -> dict[str, Drift]:
    """Check and write files of one header."""
    own = [r.name for r in raws]
    df = read_files(spark, [r.path for r in raws], names) if names else spark.createDataFrame([], T.StructType([T.StructField(FILE, T.StringType())]))
    df, drifts, rows = check_files(df, contract, own, FILE)
    batch, goes = uuid.uuid4().hex[:12], {False: [], True: []}
    for k, raw in enumerate(raws):
        drift, before = drifts[raw.name], files.get(f"{contract.source}/{raw.name}")
        broken = drift.outcome == "quarantine"
        if broken and before and QUARANTINED not in before["landed_path"] and set(drift.codes) <= KEEP_LAST_GOOD:
            continue
        folder = "/".join([str(root), contract.source, *([QUARANTINED] if broken else []), batch])
        goes[broken].append((raw.name, k))
        files[f"{contract.source}/{raw.name}"] = {
            "source": contract.source, "file_name": raw.name, "url": urls.get(raw.name), "sha256": shas[raw.name], "bytes": raw.bytes, "retrieved_at": at,
            "landed_path": f"{folder}/{PART}={k}", "row_count": rows.get(raw.name, 0), "columns": [c for c in df.columns if c != FILE],
        }
    for broken, chosen in goes.items():
        if chosen:
            folder = "/".join([str(root), contract.source, *([QUARANTINED] if broken else []), batch])
            places = F.broadcast(spark.createDataFrame(chosen, f"{FILE} string, {PART} int"))  # a row a file
            out = landed(df, contract.source, F.col(FILE), at).join(places.withColumnRenamed(FILE, "_file_name"), "_file_name")
            ordered = [c for c in df.columns if c != FILE]
            out.select(*(F.col(f"`{c}`") for c in ordered), *METADATA, PART).write.option("compression", "zstd").partitionBy(PART).parquet(folder)
    return drifts


def land_file(spark: SparkSession, raw: str | Path, contract: Contract, root: str | Path, files: dict[str, dict], retrieved_at: str | None = None, url: str | None = None) -> Drift:
    """Land one raw file."""
    found = fs.one(spark, str(raw))
    return land_files(spark, [found], contract, root, files, retrieved_at, {found.name: url})[0]


def land_source(spark: SparkSession, folder: str | Path, contract: Contract, root: str | Path, files: dict[str, dict], retrieved_at: str | None = None) -> list[Drift]:
    """Land every csv file of a source's folder, in the order of their names; ``files`` is the manifest, changed in place."""
    return land_files(spark, fs.listed(spark, str(folder), ".csv"), contract, root, files, retrieved_at)


def land(spark: SparkSession, inbox: str | Path, contract: Contract, root: str | Path, retrieved_at: str | None = None) -> list[Drift]:
    """Land ``inbox/<source>`` and commit the source's entries to the manifest of ``root``.

    Several sources may land at once: an entry is only ever changed by its own
    source, and whoever commits second puts its entries into the first's state.
    """
    log = manifest_log(spark, root)
    before = log.latest()[1].get("files", {})
    files = dict(before)
    drifts = land_source(spark, f"{inbox}/{contract.source}", contract, root, files, retrieved_at)
    own = {k: e for k, e in files.items() if e["source"] == contract.source}
    if files != before:
        log.update(lambda state: {"files": {k: e for k, e in state.get("files", {}).items() if e["source"] != contract.source} | own})
    return drifts


def forget(spark: SparkSession, root: str | Path, keys: set[str]) -> None:
    """Take files (``source/name``) out of the manifest: they are delivered no more."""
    manifest_log(spark, root).update(lambda state: {"files": {k: e for k, e in state.get("files", {}).items() if k not in keys}})


def export(df: DataFrame, path: str, grain: list[str], as_json: bool = False) -> dict:
    """A relation in the order of its grain as zstd Parquet, and its entry for the exports' manifest.

    The entry has the digest, bytes and name of every file, in order, and a
    checksum over the rows that doesn't depend on files. With ``as_json`` the
    relation, which then must be small, is written as JSON records too.
    """
    spark = df.sparkSession
    n = df.count()
    ordered = df.repartition(1).sortWithinPartitions(*grain) if n <= ROWS_A_FILE else df.orderBy(*grain)
    ordered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    if as_json:
        if n > ROWS_A_FILE:
            raise ValueError(f"{n} rows are too many for JSON records")
        df.repartition(1).sortWithinPartitions(*grain).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}.json")
    back = spark.read.parquet(path)
    digest = back.agg(F.sum(F.xxhash64(*back.columns).cast("decimal(38,0)")).cast("string").alias("d")).first()["d"]
    entry = {"path": path, "rows": n, "grain": grain, "columns": back.columns, "types": [t for _, t in back.dtypes], "checksum": digest, "files": file_entries(spark, path, ".parquet")}
    return entry | ({"json": file_entries(spark, f"{path}.json", ".json")} if as_json else {})


def file_entries(spark: SparkSession, folder: str, suffix: str) -> list[dict]:
    found = fs.listed(spark, folder, suffix)
    shas = fs.digests(spark, found)
    return [{"name": f.name, "bytes": f.bytes, "sha256": shas[f.name]} for f in found]


def schema_document(entries: dict[str, dict]) -> str:
    """The exports described: each relation's grain, rows, files and columns."""
    lines = ["# Exports", "", "Rows are in the order of the grain; `manifest.json` has each file's rows, bytes and SHA-256.", ""]
    for name, e in sorted(entries.items()):
        lines += [f"## {name}", "", f"Grain: {', '.join(f'`{g}`' for g in e['grain'])}. Rows: {e['rows']}. Files: {len(e['files'])}{', and JSON records' if 'json' in e else ''}.", "", "| Column | Type |", "|---|---|"]
        lines += [*(f"| `{c}` | {t} |" for c, t in zip(e["columns"], e["types"], strict=True)), ""]
    return "\n".join(lines)


def export_all(relations: dict[str, tuple[DataFrame, list[str], bool]], folder: str) -> dict:
    """Export name -> (relation, grain, whether as JSON too) with a manifest and a schema document; returns the manifest."""
    spark = next(iter(relations.values()))[0].sparkSession
    entries = {name: export(df, f"{folder}/{name}.parquet", grain, as_json) for name, (df, grain, as_json) in relations.items()}
    fs.put(spark, f"{folder}/SCHEMA.md", schema_document(entries))
    fs.put(spark, f"{folder}/manifest.json", json.dumps({"artifact": "exports", "relations": entries}, indent=1, sort_keys=True))
    return entries
