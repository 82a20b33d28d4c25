"""Exact interpolated quantiles without a group's values in one buffer.

Values are dealt to ranges between approximate quantiles (sketches are merged,
their size is bounded); the counts of ranges tell in which one each wanted rank
lies, and only the rows of those ranges are put in order, each range by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 64


def exact(df: DataFrame, keys: list[str], value: str, wanted: list[float], ranges: int = RANGES) -> DataFrame:
    """keys, q, value: the quantiles of each group's non-null values, linear between neighbours.

    Equal values are counted first, so a value that many rows share is one row.
    """
    own = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v")).groupBy(*keys, "v").agg(F.count("*").alias("n"))
    # Computed once and kept (one row a group): sketches merge in any order, and counts by one set of cuts don't fit rows dealt by another.
    cuts = own.groupBy(*keys).agg(F.percentile_approx("v", [i / ranges for i in range(1, ranges)], 1000).alias("cuts"), F.sum("n").alias("total")).localCheckpoint()
    dealt = own.join(cuts, keys).withColumn("range", F.size(F.filter("cuts", lambda c: c < F.col("v"))))
    sizes = dealt.groupBy(*keys, "total", "range").agg(F.sum("n").alias("own"))
    bases = sizes.withColumn("before", F.sum("own").over(Window.partitionBy(*keys).orderBy("range")) - F.col("own"))  # at most RANGES rows a group
    at = F.explode(F.array(*(F.struct(F.lit(q).alias("q"), (F.lit(q) * (F.col("total") - 1)).alias("at")) for q in wanted)))
    asked = bases.select(*keys, "range", "before", "own", at.alias("x")).select(*keys, "range", "before", "own", "x.*")
    hit = asked.filter((F.col("before") + F.col("own") > F.floor("at")) & (F.col("before") <= F.ceil("at")))
    within = F.sum("n").over(Window.partitionBy(*keys, "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.join(hit.select(*keys, "range", "before").distinct(), [*keys, "range"]).withColumn("last", within + F.col("before") - 1)
    found = placed.select(*keys, "range", "v", "last", (F.col("last") - F.col("n") + 1).alias("first")).join(hit.select(*keys, "range", "q", "at"), [*keys, "range"])
    holds = lambda r: (F.col("first") <= r(F.col("at"))) & (F.col("last") >= r(F.col("at")))
    ends = found.groupBy(*keys, "q", "at").agg(F.max(F.when(holds(F.floor), F.col("v"))).alias("low"), F.max(F.when(holds(F.ceil), F.col("v"))).alias("high"))
    return ends.select(*keys, "q", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))).alias("value"))
