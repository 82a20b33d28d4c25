"""Ordered quarantine rules and quality flags over typed sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most power in kW that a charger family can give.
CEILINGS = {"alpha": 20.0, "beta": 20.0, "rapids": 55.0, "rapids_anomalies": 55.0, "fasts": 30.0, "fasts_anomalies": 30.0}


def ceiling(family: Column) -> Column:
    """The family's ceiling; null for an unknown family."""
    found = F.lit(None).cast("double")
    for name, kw in CEILINGS.items():
        found = F.when(family == name, kw).otherwise(found)
    return found


def quarantine_rules() -> list[tuple[str, Column]]:
    """Code and predicate, most important first; a null predicate doesn't fail. The codes are fixed values."""
    c = F.col
    return [
        ("blank_row", c("is_blank")),
        ("unparseable_timestamp", c("start_local").isNull() | (c("has_end") & c("end_local").isNull() & ~c("is_end_sentinel"))),
        ("nonexistent_local_time", c("is_nonexistent")),
        ("exact_duplicate", c("is_exact_repeat")),
        ("natural_key_duplicate", c("is_key_repeat")),
        ("end_sentinel_1970", c("is_end_sentinel")),
        ("end_before_start", c("connected_minutes") < 0),
        ("negative_energy", c("energy_kwh") < 0),
        ("energy_sentinel", c("energy_kwh") < -1000),
        ("charging_exceeds_connected", c("charging_minutes") > c("connected_minutes") + c("precision_seconds") / 60.0),
        ("implied_kw_over_ceiling", c("implied_kw") > ceiling(c("family"))),
    ]


def quality_flags() -> list[tuple[str, Column]]:
    """Code and predicate of what is kept but marked. The codes are fixed values."""
    c = F.col
    longest = F.coalesce(c("connected_minutes"), c("charging_minutes"))
    return [
        ("zero_energy", c("energy_kwh") == 0),
        (
            "charging_exceeds_connected_within_precision",
            (c("charging_minutes") > c("connected_minutes")) & (c("charging_minutes") <= c("connected_minutes") + c("precision_seconds") / 60.0),
        ),
        ("over_24h", longest > 1440),
        ("duration_disagrees", F.abs(c("connected_minutes") - c("reported_minutes")) > 2),
        ("dst_ambiguous", c("is_ambiguous")),
        ("publisher_excluded_rule", c("publisher_excluded")),
        ("unknown_station", c("station_key").contains("/unknown/")),
    ]


def failing(rules: list[tuple[str, Column]]) -> Column:
    """Codes of all rules that hold, in their order."""
    return F.array_compact(F.array(*(F.when(p, F.lit(code)) for code, p in rules)))


def primary(rules: list[tuple[str, Column]]) -> Column:
    """Code of the first rule that holds, else null."""
    return F.coalesce(*(F.when(p, F.lit(code)) for code, p in rules))


def non_trivial() -> Column:
    """Some energy over more than three minutes; false where unknown."""
    return F.coalesce((F.col("energy_kwh") > 0) & (F.coalesce("connected_minutes", "charging_minutes") > 3), F.lit(False))


def judged(sessions: DataFrame) -> DataFrame:
    """Adds reasons, primary_reason, flags, is_non_trivial."""
    return sessions.select(
        "*", failing(quarantine_rules()).alias("reasons"), primary(quarantine_rules()).alias("primary_reason"),
        failing(quality_flags()).alias("flags"), non_trivial().alias("is_non_trivial"),
    )
