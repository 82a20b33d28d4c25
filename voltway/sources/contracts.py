"""Declared source contracts and schema drift.

Contracts are small frozen values on the driver; what they need to know of a
file is one aggregation over it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltway.operators.profiling import infer_types, inferred, values

# Declared type -> inferred types that satisfy it; text takes anything.
COMPATIBLE = {
    "integer": {"integer"},
    "decimal": {"integer", "decimal"},
    "datetime": {"datetime"},
    "date": {"date"},
    "duration_hms": {"duration_hms"},
}
#: A delivery without rows or that can't be read doesn't replace one that landed well.
KEEP_LAST_GOOD = frozenset({"empty_file", "unreadable_file"})
SEVERITIES = ("ok", "info", "warn", "quarantine")


@dataclass(frozen=True)
class Column:
    name: str
    type: str = "text"
    required: bool = False


@dataclass(frozen=True)
class Family:
    """One shape of a source's files, chosen by a part of the file name."""

    name: str
    pattern: str
    columns: tuple[Column, ...]
    aliases: tuple[tuple[str, str], ...] = ()
    null_tokens: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    source: str
    families: tuple[Family, ...]

    def family(self, file_name: str) -> Family | None:
        return next((f for f in self.families if f.pattern in file_name), None)


@dataclass(frozen=True)
class Finding:
    code: str
    severity: str
    column: str | None = None


@dataclass
class Drift:
    file_name: str
    findings: list[Finding] = field(default_factory=list)

    @property
    def outcome(self) -> str:
        return max((f.severity for f in self.findings), key=SEVERITIES.index, default="ok")

    @property
    def codes(self) -> list[str]:
        return sorted({f.code for f in self.findings if f.severity == "quarantine"})


def apply_aliases(df: DataFrame, family: Family) -> tuple[DataFrame, list[Finding]]:
    """Rename known other names; where both names are there, keep both and warn."""
    findings = []
    for old, new in family.aliases:
        if old in df.columns and new in df.columns:
            findings.append(Finding("alias_target_present", "warn", old))
        elif old in df.columns:
            df = df.withColumnRenamed(old, new)
            findings.append(Finding("aliased", "info", old))
    return df, findings


def column_finding(spec: Column, present: bool, inferred: str | None) -> Finding | None:
    """The one thing wrong with a declared column; ``inferred`` None: there is nothing to judge a type on."""
    needed = "required" if spec.required else "optional"
    judged = inferred not in (None, "empty") and spec.type in COMPATIBLE
    cases = (  # code, whether it holds, severity if required, severity if optional
        (f"missing_{needed}", not present, "quarantine", "info"),
        ("all_null", present and inferred == "empty", "info", "info"),
        (f"retyped_{needed}", present and judged and inferred not in COMPATIBLE.get(spec.type, ()), "quarantine", "warn"),
    )
    return next((Finding(code, strict if spec.required else mild, spec.name) for code, holds, strict, mild in cases if holds), None)


def without_tokens(df: DataFrame, family: Family, *keys: str) -> DataFrame:
    """The family's columns that are there, its tokens for nothing as null."""
    known = [c.name for c in family.columns if c.name in df.columns]
    plain = lambda n: F.when(~F.col(f"`{n}`").isin(list(family.null_tokens)), F.col(f"`{n}`")) if family.null_tokens else F.col(f"`{n}`")
    return df.select(*keys, *(plain(n).alias(n) for n in known))


def departures(family: Family, names: list[str], types: dict[str, str], empty: bool) -> list[Finding]:
    """How a file of these column names and inferred types departs from its family."""
    findings = [Finding("empty_file", "quarantine")] if empty else []
    found = (column_finding(spec, spec.name in names, None if empty else types.get(spec.name)) for spec in family.columns)
    findings += [f for f in found if f]
    return findings + [Finding("unknown_column", "warn", c) for c in names if c not in {spec.name for spec in family.columns}]


def check_file(df: DataFrame, contract: Contract, file_name: str) -> tuple[DataFrame, Drift]:
    """The frame under its contract's names, and how it departs from the contract; types come from one aggregation."""
    family = contract.family(file_name)
    if family is None:
        return df, Drift(file_name, [Finding("unknown_family", "quarantine")])
    df, findings = apply_aliases(df, family)
    plain, empty = without_tokens(df, family), df.limit(1).isEmpty()
    types = {r["name"]: r["type"] for r in infer_types(plain).collect()} if plain.columns and not empty else {}  # a row a column
    return df, Drift(file_name, findings + departures(family, df.columns, types, empty))


def check_files(df: DataFrame, contract: Contract, file_names: list[str], key: str) -> tuple[DataFrame, dict[str, Drift], dict[str, int]]:
    """``check_file`` for many files of one family and header at once: one aggregation over all of them.

    ``key`` is the column that names a row's file. Also returns each file's rows.
    """
    family = contract.family(file_names[0])
    if family is None:
        rows = {r[key]: r["n"] for r in df.groupBy(key).agg(F.count("*").alias("n")).collect()}  # a row a file
        return df, {n: Drift(n, [Finding("unknown_family", "quarantine")]) for n in file_names}, rows
    df, findings = apply_aliases(df, family)
    names = [c for c in df.columns if c != key]
    plain = without_tokens(df, family, key)
    rows, types = {}, {}
    if len(plain.columns) > 1:
        for r in inferred(values(plain, key), key).collect():  # a row a file and column
            rows[r[key]] = r["n_rows"]
            types.setdefault(r[key], {})[r["name"]] = r["type"]
    else:
        rows = {r[key]: r["n"] for r in df.groupBy(key).agg(F.count("*").alias("n")).collect()}
    return df, {n: Drift(n, [*findings, *departures(family, names, types.get(n, {}), not rows.get(n))]) for n in file_names}, rows


def drift_record(drifts: list[tuple[str, Drift]], run_id: str) -> dict:
    """What a landing run has to say: (source, drift) of every file, counted by outcome."""
    return {
        "run_id": run_id,
        "summary": {
            "files": len(drifts), "by_outcome": {s: sum(d.outcome == s for _, d in drifts) for s in SEVERITIES},
            "quarantined_files": [f"{source}/{d.file_name}" for source, d in drifts if d.outcome == "quarantine"],
        },
        "files": [
            {"source": source, "file_name": d.file_name, "outcome": d.outcome, "reason_codes": d.codes, "findings": [{"column": f.column or "*", "severity": f.severity, "code": f.code} for f in d.findings]}
            for source, d in drifts
        ],
    }


def columns(*specs: str) -> tuple[Column, ...]:
    """``name:type``, required; ``name:type?``, optional."""
    return tuple(Column(name, kind.rstrip("?"), not kind.endswith("?")) for name, kind in (s.rsplit(":", 1) for s in specs))


# The publishers' files as they are published: columns, types, other names, tokens for nothing, file names.
ALPHA = Contract(
    "alpha",
    (
        Family(
            "transactions", "Electric_Vehicle_Charging_Station_Data",
            columns(
                "Station_Name:text", "Address:text?", "City:text?", "State_Province:text?", "Zip_Postal_Code:text?", "Start_Date___Time:text", "Start_Time_Zone:text?", "End_Date___Time:text",
                "End_Time_Zone:text?", "Total_Duration__hh_mm_ss_:duration_hms", "Charging_Time__hh_mm_ss_:duration_hms", "Energy__kWh_:decimal", "GHG_Savings__kg_:decimal?",
                "Gasoline_Savings__gallons_:decimal?", "Port_Type:text?", "ObjectID:integer", "ObjectId2:integer",
            ),
        ),
    ),
)
BETA = Contract(
    "beta",
    (
        Family(
            "sessions", "electric-vehicle-charging-stations",
            columns(
                "start_date:datetime", "station_name:text", "charging_time_hh_mm_ss:duration_hms", "energy_kwh:decimal", "address_1:text?", "address_2:text?", "city:text?", "state_province:text?",
                "zip_postal_code:text?",
            ),
        ),
    ),
)
GAMMA_COLUMNS = (
    "ChargingEvent:text?", "CPID:text", "Connector:text?", "StartDate:date", "StartTime:duration_hms", "EndDate:date", "EndTime:duration_hms", "Energy:decimal", "Name:text",
)
RENAMED, NOTHING = (("EnergySupplied", "Energy"),), ("NA",)
GAMMA = Contract(
    "gamma",
    (
        Family("rapids", "local_authority_rapids_raw", columns(*GAMMA_COLUMNS, "Price:text?", "PluginDuration:integer"), RENAMED, NOTHING),
        Family("rapids_anomalies", "local_authority_rapids_incomplete_anomalies", columns(*GAMMA_COLUMNS, "Price:text?", "Area code:text?"), RENAMED, NOTHING),
        Family("fasts", "public_sector_fasts_raw", columns("publisher_row_index:integer?", *GAMMA_COLUMNS, "PluginDuration:decimal"), (), NOTHING),
        Family("fasts_anomalies", "public_sector_fasts_incomplete_anomalies", columns("publisher_row_index:integer?", *GAMMA_COLUMNS, "PluginDuration:decimal"), (), NOTHING),
    ),
)
CONTRACTS = {c.source: c for c in (ALPHA, BETA, GAMMA)}
