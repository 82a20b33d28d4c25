"""Data-quality checks; each returns the rows that fail, so an empty result passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def not_unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def null_in(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def orphans(df: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is set but has no parent."""
    return df.filter(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)), column, "left_anti")


def uneven(df: DataFrame, others: dict[str, DataFrame], *keys: str) -> DataFrame:
    """Keys whose row count differs from the sum of the others' counts."""
    whole = df.groupBy(*keys).agg(F.count("*").alias("expected"))
    for name, other in others.items():
        whole = whole.join(other.groupBy(*keys).agg(F.count("*").alias(name)), list(keys), "left").na.fill(0, [name])
    return whole.filter(F.col("expected") != sum((F.col(n) for n in others), F.lit(0)))


def outside_reasons(rows: DataFrame) -> DataFrame:
    """Rejected rows whose primary reason isn't among their reasons."""
    return rows.filter(F.col("primary_reason").isNotNull() & ((F.size("reasons") == 0) | ~F.array_contains("reasons", F.col("primary_reason"))))


def not_conserved(whole: DataFrame, parts: DataFrame, keys: list[str], measure: str, tolerance: float = 1e-6) -> DataFrame:
    """Keys whose sums differ by more than a relative tolerance, or of which only one is null."""
    a = whole.groupBy(*keys).agg(F.sum(measure).alias("a"))
    b = parts.groupBy(*keys).agg(F.sum(measure).alias("b"))
    apart = F.abs(F.col("a") - F.col("b")) > tolerance * F.greatest(F.abs("a"), F.abs("b"), F.lit(1.0))
    return a.join(b, keys, "full_outer").filter((F.col("a").isNull() != F.col("b").isNull()) | apart)


def measures_lost(whole: DataFrame, parts: DataFrame, keys: list[str], counts: list[str], measures: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Keys of both whose counts differ, or whose measures differ by more than a relative tolerance or are null on one side only."""
    sums = lambda df, end: df.groupBy(*keys).agg(*(F.sum(c).alias(f"{c}{end}") for c in (*counts, *measures)))
    zero = lambda c: F.coalesce(c, F.lit(0))
    off = F.lit(False)
    for c in counts:
        off = off | (F.col(f"{c}_a") != F.col(f"{c}_b"))
    for m in measures:
        a, b = f"{m}_a", f"{m}_b"
        off = off | (F.abs(zero(a) - zero(b)) > tolerance * F.greatest(F.abs(zero(a)), F.lit(1.0))) | (F.col(a).isNull() != F.col(b).isNull())
    return sums(whole, "_a").join(sums(parts, "_b"), keys).filter(off)


def spine_holes(dim: DataFrame, days: DataFrame) -> DataFrame:
    """Stations without exactly one row for each date of their active window, or whose dates that count lack available minutes."""
    per = days.groupBy("station_key", "day").agg(F.count("*").alias("k"), F.count(F.when(~F.col("is_excluded"), 1)).alias("open"), F.count(F.when(~F.col("is_excluded") & (F.col("available_minutes") <= 0), 1)).alias("dry"))
    n = per.groupBy("station_key").agg(F.sum("k").alias("n"), F.count("*").alias("n_days"), F.sum("open").alias("open"), F.sum("dry").alias("dry"))
    window, counted = F.col("window_days"), F.col("window_days") - F.col("excluded_days")
    wrong = F.col("n").isNull() | (F.col("n") != window) | (F.col("n_days") != window) | (F.col("open") != counted) | (F.col("dry") > 0)
    return dim.select("station_key", "window_days", "excluded_days").join(n, "station_key", "left").filter(wrong)


def grain_mixed(days: DataFrame, dim: DataFrame) -> DataFrame:
    """offender, problem: stations whose days have another capacity grain, and sources with several grains."""
    own = dim.select("station_key", F.col("capacity_grain").alias("own"))
    rows = days.select("station_key", "capacity_grain").distinct().join(own, "station_key").filter("capacity_grain <> own")
    sources = days.select("source", "capacity_grain").distinct().groupBy("source").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.select(F.col("station_key").alias("offender"), F.lit("row grain differs from station grain").alias("problem")).distinct().unionByName(
        sources.select(F.col("source").alias("offender"), F.lit("source mixes capacity grains").alias("problem"))
    )


def unknown_in_capacity(relations: dict[str, DataFrame]) -> DataFrame:
    """station_key, relation of stations without an id in any of the relations."""
    found = [df.select("station_key").filter(F.col("station_key").contains("/unknown/")).distinct().withColumn("relation", F.lit(name)) for name, df in relations.items()]
    whole = found[0]
    for df in found[1:]:
        whole = whole.unionByName(df)
    return whole


def ratio_equals_mean(days: DataFrame) -> DataFrame:
    """Sources, of at least two station-days, whose ratio of sums is no other than the mean of daily ratios."""
    counted = days.filter("not is_excluded and available_minutes > 0 and connected_minutes is not null")
    per = counted.groupBy("source").agg(
        F.count("*").alias("n"), (F.sum("connected_minutes") / F.sum("available_minutes")).alias("ratio"), F.avg(F.col("connected_minutes") / F.col("available_minutes")).alias("mean")
    )
    return per.filter((F.col("n") >= 2) & (F.abs(F.col("ratio") - F.col("mean")) < 1e-9))


def newest_period_off(df: DataFrame, period: list[str], tolerance: float = 0.35) -> DataFrame:
    """The newest period, if its number of rows is further than a share from the period's before."""
    n = df.groupBy(*period).agg(F.count("*").alias("n"))
    order = Window.orderBy(*(F.col(p).asc_nulls_first() for p in period))  # one row a period
    newest = Window.orderBy(*(F.col(p).desc_nulls_last() for p in period))
    both = n.withColumn("prior", F.lag("n").over(order)).withColumn("k", F.row_number().over(newest))
    return both.filter((F.col("k") == 1) & (F.abs(F.col("n") - F.col("prior")) / F.col("prior") > tolerance)).drop("k")


def wrong_schema(df: DataFrame, expected: StructType) -> list[str]:
    """Differences from an enforced contract: names, types and order."""
    have, want = [(f.name, f.dataType.simpleString()) for f in df.schema], [(f.name, f.dataType.simpleString()) for f in expected]
    return [f"{i}: {a} is not {b}" for i, (a, b) in enumerate(zip(have, want, strict=False)) if a != b] + ([f"{len(have)} columns, not {len(want)}"] if len(have) != len(want) else [])


def row_counts(one: DataFrame, other: DataFrame) -> DataFrame:
    """n_one, n_other, difference: whether two relations have equally many rows, one row."""
    both = one.select(F.lit(1).alias("side")).unionByName(other.select(F.lit(2).alias("side")))
    sums = both.agg(*(F.count(F.when(F.col("side") == k, 1)).alias(n) for k, n in ((1, "n_one"), (2, "n_other"))))
    return sums.withColumn("difference", F.col("n_one") - F.col("n_other"))
