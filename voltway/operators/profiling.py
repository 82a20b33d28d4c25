"""Column profiles of string tables.

Columns are turned into one (name, value, n) table first: equal values are
combined before the shuffle and every profile figure is an aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltway.functions import columns as C
from voltway.operators.intervals import sweep

# Inferred type, pattern name and the shape of a whole trimmed value, in order of preference.
SHAPES = (
    ("integer", None, r"^-?\d+\z"),
    ("decimal", None, r"^-?\d+(\.\d+)?\z"),
    ("duration_hms", None, r"^\d{1,4}:\d{2}:\d{2}\z"),
    ("datetime", "ISO", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?\z"),
    ("datetime", "%Y-%m-%d %H:%M", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}\z"),
    ("date", "%Y-%m-%d", r"^\d{4}-\d{2}-\d{2}\z"),
    ("datetime", "MDY_OR_DMY", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?\z"),
    ("date", "MDY_OR_DMY_DATE", r"^\d{1,2}/\d{1,2}/\d{4}\z"),
    ("datetime", "MDY2_OR_DMY2", r"^\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}\z"),
)
SHARE = 0.99
SAMPLES = 5


def values(df: DataFrame, *keys: str) -> DataFrame:
    """keys, name, value (trimmed text; null for nulls and blanks), n, raw_null: how often each value of each other column occurs."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("v")) for c in df.columns if c not in keys)))
    long = df.select(*keys, each.alias("x")).select(*keys, "x.name", F.nullif(F.trim("x.v"), F.lit("")).alias("value"), F.col("x.v").isNull().alias("raw_null"))
    return long.groupBy(*keys, "name", "value", "raw_null").agg(F.count("*").alias("n"))


def inferred(counted: DataFrame, *keys: str) -> DataFrame:
    """keys, name, type, pattern, n_rows from ``values``: the first shape that at least SHARE of a column's non-blank texts have; ``empty`` without any."""
    there, n = F.col("value").isNotNull(), F.col("n")
    shares = [F.sum(F.when(F.col("value").rlike(p), n).otherwise(0)).alias(f"p{i}") for i, (_, _, p) in enumerate(SHAPES)]
    totals = counted.groupBy(*keys, "name").agg(F.sum("n").alias("n_rows"), F.sum(F.when(there, n).otherwise(0)).alias("filled"), *shares)

    def pick(give, otherwise: str | None) -> Column:
        found = F.lit(otherwise)
        for i, shape in reversed(list(enumerate(SHAPES))):
            found = F.when(F.col(f"p{i}") >= SHARE * F.col("filled"), F.lit(give(shape)).cast("string")).otherwise(found)
        return found

    empty = F.col("filled") == 0
    return totals.select(*keys, "name", F.when(empty, "empty").otherwise(pick(lambda s: s[0], "text")).alias("type"), F.when(~empty, pick(lambda s: s[1], None)).alias("pattern"), "n_rows")


def infer_types(df: DataFrame) -> DataFrame:
    """name, type, pattern of every column; a row a column also of an empty table."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "name string")
    return names.join(inferred(values(df)).drop("n_rows"), "name", "left").withColumn("type", F.coalesce("type", F.lit("empty")))


def field(value: Column, i: int) -> Column:
    """The first or second number of a slashed date."""
    return F.regexp_extract(value, r"^(\d{1,2})/(\d{1,2})/", i).try_cast("int")


def verdict(first: Column, second: Column) -> Column:
    """What counts of first and of second fields beyond 12 say; published values."""
    return F.when((first > 0) & (second == 0), "day_first").when((second > 0) & (first == 0), "month_first").otherwise("ambiguous")


def parsed(value: Column, pattern: Column, day_first: Column) -> Column:
    """A timestamp (UTC where an offset is given) of a text by its column's pattern; null where it doesn't parse.

    Years of two digits from 69 on are of the last century.
    """
    short = lambda i: F.regexp_extract(value, r"^(\d{1,2}/\d{1,2}/)(\d{2})( .*)$", i)
    century = F.when(short(2).try_cast("int") >= 69, "19").otherwise("20")
    whole = F.concat(short(1), century, short(2), short(3))

    def slashed(text: Column, tail: str) -> Column:
        by_day, by_month = (F.try_to_timestamp(text, F.lit(f"{order}/{tail}")) for order in ("d/M", "M/d"))
        return F.when(day_first, F.coalesce(by_day, by_month)).otherwise(F.coalesce(by_month, by_day))

    return (
        F.when(pattern.isin("ISO", "%Y-%m-%d", "%Y-%m-%d %H:%M"), value.try_cast("timestamp")).when(pattern == "MDY_OR_DMY", F.coalesce(slashed(value, "yyyy H:mm"), slashed(value, "yyyy H:mm:ss")))
        .when(pattern == "MDY_OR_DMY_DATE", slashed(value, "yyyy")).when(pattern == "MDY2_OR_DMY2", slashed(whole, "yyyy H:mm"))
    )


def arrival() -> Column:
    """Where a row of a file source was met: file, place of its block, row within the block; it survives shuffles."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def first_met(df: DataFrame, order: str, most: int = SAMPLES) -> DataFrame:
    """name, k, value: the first ``most`` different non-blank texts of each column in ``order``.

    The least place of each value is an aggregate, combined before its shuffle.
    """
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias("value")) for c in df.columns if c != order)))
    first = df.select(order, each.alias("x")).filter("x.value is not null").groupBy("x.name", "x.value").agg(F.min(order).alias("_at"))
    place = Window.partitionBy("name").orderBy("_at", "value")
    return first.withColumn("k", F.row_number().over(place)).filter(F.col("k") <= most).select("name", "k", "value")  # limited before the shuffle


def profile(df: DataFrame) -> DataFrame:
    """A row for each column: type, rows, nulls and blanks, distinct values, samples and, by type, extremes, mean and counts.

    Extremes are numbers for integers and decimals, minutes for durations, seconds
    since 1970 for dates; null otherwise. Samples are the first texts in order.
    """
    counted = values(df)
    kinds = inferred(counted).drop("n_rows")
    v, n = F.col("value"), F.col("n")
    first, second = F.sum(F.when(field(v, 1) > 12, n).otherwise(0)), F.sum(F.when(field(v, 2) > 12, n).otherwise(0))
    slashes = counted.groupBy("name").agg(first.alias("first_over_12"), second.alias("second_over_12"), F.count(field(v, 1)).alias("slashed"))
    typed = counted.join(kinds, "name").join(slashes, "name")
    says = verdict(F.col("first_over_12"), F.col("second_over_12"))
    number = (
        F.when(F.col("type").isin("integer", "decimal"), v.try_cast("double")).when(F.col("type") == "duration_hms", C.hms_to_minutes(v))
        .when(F.col("type").isin("date", "datetime"), F.unix_micros(parsed(v, F.col("pattern"), says == "day_first")) / 1e6)
    )
    measured = typed.withColumn("number", number)
    x, filled = F.col("number"), v.isNotNull()
    many = lambda p: F.sum(F.when(p, n).otherwise(0))
    numeric, timed = F.col("type").isin("integer", "decimal", "duration_hms"), F.col("type").isin("date", "datetime")
    top = Window.partitionBy("name").orderBy(v.asc_nulls_last())
    samples = counted.select("name", "value").filter(filled).distinct().withColumn("k", F.row_number().over(top)).filter(F.col("k") <= SAMPLES)  # limited before the shuffle
    chosen = samples.groupBy("name").agg(F.array_sort(F.collect_list("value")).alias("samples"))
    return measured.groupBy("name", "type", "pattern").agg(
        F.sum("n").alias("n_rows"), many(F.col("raw_null")).alias("nulls"), many(~filled & ~F.col("raw_null")).alias("blanks"), F.count("value").alias("n_distinct"),
        F.min("number").alias("least"), F.max("number").alias("most"), F.when(F.first("type").isin("integer", "decimal"), F.sum(x * n) / many(x.isNotNull())).alias("mean"),
        F.when(F.first(numeric), many(x == 0)).alias("zeros"), F.when(F.first(numeric), many(x < 0)).alias("negatives"), F.when(F.first("type") == "duration_hms", many(x > 1440)).alias("over_24h"),
        F.when(F.first(timed), many(filled & x.isNull())).alias("parse_failures"),
        F.first(F.when(timed & (F.col("slashed") > 0), says)).alias("day_first"),
    ).join(chosen, "name", "left")


def day_first_evidence(df: DataFrame, column: str) -> DataFrame:
    """How often the first and the second field of a slashed date exceed 12, and what that says."""
    value = F.trim(F.col(column))
    n = df.agg(F.count(F.when(field(value, 1) > 12, 1)).alias("first_over_12"), F.count(F.when(field(value, 2) > 12, 1)).alias("second_over_12"))
    return n.withColumn("verdict", verdict(F.col("first_over_12"), F.col("second_over_12")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, and rows that repeat an earlier one."""
    per = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"))


def max_concurrency(df: DataFrame, key: str, start: str, end: str, unique: str, day: str = "start_day") -> DataFrame:
    """The most intervals that run at once for each key; those without an end, or that end before they start, don't count."""
    whole = df.filter(F.col(key).isNotNull() & (F.col(end) >= F.col(start)))
    return sweep(whole, key, start, end, unique, day).groupBy(key).agg(F.max("level").alias("most"))


def transition_gaps(sessions: DataFrame, transitions: tuple[tuple[str, str], ...], most: int = 4) -> DataFrame:
    """source, day, spanning, gap_minutes, n: sessions over the hour in which a source's clocks change on a date.

    ``gap_minutes`` is wall-clock time less reported duration, ``spanning`` the
    sessions of all gaps; the ``most`` commonest gaps stay, ties by the gap.
    """
    days = F.broadcast(sessions.sparkSession.createDataFrame(list(transitions), "source string, day string"))  # a few rows
    from_one, to_two = (F.col("day").cast("timestamp") + F.expr(f"interval {h} hour") for h in (1, 2))
    over = sessions.filter("reported_minutes is not null").join(days, "source").filter((F.col("start_local") < to_two) & (F.col("end_local") > from_one))
    gap = F.round(C.minutes_between("start_local", "end_local") - F.col("reported_minutes")).cast("long")
    each = over.groupBy("source", "day", gap.alias("gap_minutes")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("source", "day")
    ranked = each.withColumn("spanning", F.sum("n").over(own)).withColumn("k", F.row_number().over(own.orderBy(F.desc("n"), "gap_minutes")))
    return ranked.filter(F.col("k") <= most).drop("k")
