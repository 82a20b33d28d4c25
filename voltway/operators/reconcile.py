"""Reconciliation of rows and energy between layers, and comparing runs (small dictionaries on the driver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-6


def classify(residual: float, reference: float, kind: str) -> str:
    """``ok``, ``non_blocking`` or ``blocking``: counts must agree exactly, measures to a relative tolerance."""
    if kind == "count":
        return "ok" if residual == 0 else "blocking"
    scale = max(abs(reference), 1.0)
    if abs(residual) <= TOLERANCE * scale:
        return "ok" if residual == 0 else "non_blocking"
    return "blocking"


def differences(old: dict, new: dict, path: str = "") -> list[str]:
    """Paths whose values differ: counts (integers) at all, measures beyond the tolerance."""
    if isinstance(old, dict) and isinstance(new, dict):
        return [d for k in sorted(old.keys() | new.keys()) for d in differences(old.get(k), new.get(k), f"{path}.{k}" if path else str(k))]
    numbers = all(isinstance(x, float | int) and not isinstance(x, bool) for x in (old, new))
    if numbers and any(isinstance(x, float) for x in (old, new)):
        return [] if abs(old - new) <= TOLERANCE * max(abs(old), abs(new), 1.0) else [path]
    return [] if old == new else [path]


def run_status(blocking: bool, inputs_changed: bool, outputs_changed: bool, source_problem: bool) -> str:
    """What a rerun shows: a blocking reconciliation counts as a regression, whatever came in."""
    if blocking:
        return "regression"
    if inputs_changed:
        return "upstream_changed"
    if outputs_changed:
        return "regression"
    return "source_problem" if source_problem else "ok"


def month_of(start: str = "start_local") -> Column:
    return F.coalesce(F.date_format(start, "yyyy-MM"), F.lit("unparsed"))


def identity_i(rows: DataFrame) -> DataFrame:
    """Per source and start month, and per source as ``__total__``: raw, fact and quarantined rows, and the fact's parts."""
    ok, real, unknown = F.col("primary_reason").isNull(), F.col("is_non_trivial"), F.col("station_key").contains("/unknown/")
    n = lambda p, name: F.count(F.when(p, 1)).alias(name)
    months = rows.groupBy("source", month_of().alias("year_month")).agg(
        F.count("*").alias("raw_rows"), n(ok, "fact_rows"), n(~ok, "quarantined_rows"), n(ok & real & ~unknown, "counted"), n(ok & ~real, "trivial"), n(ok & real & unknown, "unknown"),
        F.sum("energy_kwh").alias("raw_kwh"), F.sum(F.when(ok, F.col("energy_kwh"))).alias("fact_kwh"),
    )
    sums = [F.sum(c).alias(c) for c in months.columns if c not in ("source", "year_month")]
    return months.unionByName(months.groupBy("source").agg(F.lit("__total__").alias("year_month"), *sums))


def spill(line: DataFrame, days: DataFrame) -> DataFrame:
    """source, month, counted_kwh by start month, station_day_kwh by piece month, and their difference."""
    a = line.groupBy("source", F.date_format("start_local", "yyyy-MM").alias("month")).agg(F.sum("energy_kwh").alias("a"))
    b = days.groupBy("source", F.date_format("day", "yyyy-MM").alias("month")).agg(F.sum("energy_kwh").alias("b"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return a.join(b, ["source", "month"], "full_outer").select("source", "month", zero("a").alias("counted_kwh"), zero("b").alias("station_day_kwh"), (zero("a") - zero("b")).alias("spill_kwh"))


def duplicates_by_twin(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """source, bucket, n: natural-key duplicates by the family of the accepted row of their key."""
    raws = ("rapids", "fasts")
    lost = rows.filter("primary_reason = 'natural_key_duplicate'").groupBy("source", "family", "key_hash").agg(F.count("*").alias("n"))
    kept = fact.select("source", "key_hash", F.col("family").alias("twin"))
    moved = (F.col("source") == "gamma") & F.col("twin").isin(*raws) & ~F.col("family").isin(*raws)
    bucket = F.when(moved, "same_event_in_raw_file").when(F.col("twin") == F.col("family"), "within_family").otherwise("other")
    return lost.join(kept, ["source", "key_hash"], "left").groupBy("source", bucket.alias("bucket")).agg(F.sum("n").alias("n"))


def twins(rows: DataFrame, family: str) -> DataFrame:
    """source, primary_reason, twin_family, twin_status, n of a family's natural-key duplicates; the twin may be rejected itself for its values."""
    lost = rows.filter((F.col("family") == family) & (F.col("primary_reason") == "natural_key_duplicate")).groupBy("source", "primary_reason", "key_hash").agg(F.count("*").alias("n"))
    first = rows.filter(~F.col("is_exact_repeat") & ~F.col("is_key_repeat")).select(
        "source", "key_hash", F.col("family").alias("twin_family"), F.when(F.col("primary_reason").isNull(), "accepted").otherwise("quarantined").alias("twin_status")
    )
    none = lambda c: F.coalesce(c, F.lit("<none>")).alias(c)
    return lost.join(first, ["source", "key_hash"], "left").groupBy("source", "primary_reason", none("twin_family"), none("twin_status")).agg(F.sum("n").alias("n"))


def populations(rows: DataFrame) -> DataFrame:
    """Per family: rows accepted, by the publisher's own rule, and rejected."""
    ok, own = F.col("primary_reason").isNull(), F.col("publisher_excluded")
    n = lambda p, name: F.count(F.when(p, 1)).alias(name)
    return rows.groupBy("family").agg(F.count("*").alias("total"), n(ok, "accepted"), n(ok & own, "accepted_meets_rule"), n(ok & ~own, "accepted_not_meeting_rule"), n(~ok, "quarantined"))
