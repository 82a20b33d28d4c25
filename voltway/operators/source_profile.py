"""What a source's rows say of themselves: coverage, repeats, stations, ports, implausible sessions.

Everything is over judged rows of all sources at once; figures that need distinct
values come from tables of counts, so no source, station or key is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltway.operators import quantiles
from voltway.operators.rules import ceiling

#: Parts in which a source's sites are ranked before the best of all parts are.
PARTS = 64
#: Files that one word of a key's file set holds.
BITS = 62


def file_numbers(rows: DataFrame) -> tuple[DataFrame, int]:
    """source, names (its files in order, one row a source), and the words that a set of them needs."""
    names = rows.groupBy("source").agg(F.sort_array(F.collect_set("source_file")).alias("names"))
    most = names.agg(F.max(F.size("names")).alias("n")).first()["n"] or 0
    return names, max(1, -(-most // BITS))


def keys_by_files(rows: DataFrame, key: str = "key_hash") -> DataFrame:
    """source, files, n_keys: how many natural keys each set of files holds, for sets of several; files joined by `` & ``.

    A key's set is a row of bits, combined by ``bit_or`` before the shuffle; keys
    are then counted by their sets. Any number of files fits.
    """
    names, words = file_numbers(rows)
    at = (F.array_position("names", F.col("source_file")) - 1).cast("int")
    one = F.expr("shiftleft(1L, _at % {0})".format(BITS))
    numbered = rows.join(F.broadcast(names), "source").withColumn("_at", at)  # a row a source
    bits = [F.bit_or(F.when(F.floor(F.col("_at") / BITS) == w, one).otherwise(F.lit(0).cast("long"))).alias(f"_w{w}") for w in range(words)]
    sets = numbered.groupBy("source", key).agg(*bits).groupBy("source", *(f"_w{w}" for w in range(words))).agg(F.count("*").alias("n_keys"))
    several = sets.filter(sum((F.bit_count(f"_w{w}") for w in range(words)), F.lit(0)) > 1)
    own = F.array(*(F.col(f"_w{w}") for w in range(words)))
    inside = lambda _, i: F.getbit(F.element_at(own, F.floor(i / BITS).cast("int") + 1), i % BITS) == 1
    return several.join(F.broadcast(names), "source").select("source", F.array_join(F.filter("names", inside), " & ").alias("files"), "n_keys")


def session_ids(rows: DataFrame, column: str = "source_session_id") -> DataFrame:
    """source, n_rows, null_ids, distinct_ids, repeated_in_file, in_several_files of the publisher's own session ids."""
    per = rows.groupBy("source", "source_file", column).agg(F.count("*").alias("n"))
    there = F.col(column).isNotNull()
    ids = per.groupBy("source", column).agg(F.sum("n").alias("n"), F.sum(F.when(there, F.col("n") - 1)).alias("again"), F.count("*").alias("files"))
    return ids.groupBy("source").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("null_ids"), F.count(column).alias("distinct_ids"),
        F.coalesce(F.sum("again"), F.lit(0)).alias("repeated_in_file"), F.coalesce(F.sum(F.when(there, F.col("files") - 1)), F.lit(0)).alias("in_several_files"),
    )


def histograms(rows: DataFrame) -> DataFrame:
    """source, what, value, n: at how many sites so many station names occur, and how many stations show so many ports."""
    def spread(what: str, by: str, counted: str) -> DataFrame:
        pairs = rows.filter(F.col(by).isNotNull()).select("source", by, counted).distinct()
        return pairs.groupBy("source", by).agg(F.count(counted).alias("value")).groupBy("source", "value").agg(F.count("*").alias("n")).select("source", F.lit(what).alias("what"), "value", "n")

    ports = spread("ports_per_station", "station_name_raw", "port_id").filter("value > 0")
    return spread("names_per_site", "site_key", "station_name_raw").unionByName(ports)


def span_minutes() -> Column:
    """Wall-clock minutes from start to end."""
    return (F.unix_micros("end_local") - F.unix_micros("start_local")) / 6e7


def figures(rows: DataFrame) -> DataFrame:
    """One row per source: rows, repeats, names and ids, sessions a station, implausible values, spans against recorded durations.

    Blank rows are counted and then left out.
    """
    c, n = F.col, lambda p, name: F.count(F.when(p, 1)).alias(name)
    real = ~c("is_blank")
    energy, charged, plugged = c("energy_kwh"), c("charging_minutes"), c("reported_minutes")
    gap = span_minutes() - F.coalesce(plugged, charged)
    day = 24 * 60
    counts: list[Column] = [
        F.count("*").alias("rows_all"), n(~real, "blank_rows"), n(real & c("is_exact_repeat"), "exact_repeats"), n(real & c("is_key_repeat"), "key_repeats"),
        n(real & c("station_name_raw").isNull(), "null_names"), n(real & c("station_name_raw").rlike(r"^\d+\z"), "numeric_names"),
        n(real & energy.isNull(), "energy_null"), n(real & (energy == 0), "energy_zero"), n(real & (energy < 0), "energy_negative"), F.min(F.when(real, energy)).alias("energy_least"),
        n(real & charged.isNull(), "charging_null"), n(real & (charged == 0), "charging_zero"), n(real & (charged > day), "charging_over_24h"),
        n(real & (plugged == 0), "connected_zero"), n(real & (plugged > day), "connected_over_24h"), n(real & (charged > plugged + 1 / 60), "charging_exceeds_connected"),
        n(real & (energy == 0) & (charged > 0), "no_energy_in_some_time"), n(real & (energy > 0) & (charged == 0), "energy_in_no_time"),
        n(real & gap.isNotNull(), "spans"), n(real & (F.abs(gap) <= 2), "span_within_2_min"), n(real & (gap > 5), "span_longer"), n(real & (gap < -5), "span_shorter"),
        n(real & F.abs(gap).between(55, 65), "span_off_by_an_hour"),
    ]
    own = rows.groupBy("source").agg(*counts)
    stations = rows.filter(real).groupBy("source", "station_name_raw").agg(F.count("start_local").alias("_n"))
    named = stations.filter("station_name_raw is not null").groupBy("source").agg(
        F.count("*").alias("distinct_names"), F.min("_n").alias("least_sessions"), F.max("_n").alias("most_sessions"), n(c("_n") < 30, "stations_under_30_sessions")
    )
    return own.join(named, "source", "left")


def anomaly_buckets(rows: DataFrame) -> DataFrame:
    """source_family, bucket, n: what became of the anomaly files' rows that the publisher's own rule doesn't explain.

    A row counts once for each rejected and each accepted row of its key and file
    family, as a join of them would give; the counts are multiplied instead.
    """
    gamma = rows.filter("source = 'gamma'").select("key_hash", "family", "primary_reason", "publisher_excluded")
    per = gamma.groupBy("key_hash", "family", "primary_reason").agg(F.count("*").alias("n"), F.count(F.when(~F.col("publisher_excluded"), 1)).alias("unexplained"))
    lost = per.filter("primary_reason is not null").select("key_hash", "family", "primary_reason", F.col("n").alias("b"))
    sums = per.groupBy("key_hash", "family").agg(F.sum("unexplained").alias("a"), F.coalesce(F.sum(F.when(F.col("primary_reason").isNull(), F.col("n"))), F.lit(0)).alias("c"))
    asked = sums.filter("family in ('rapids_anomalies', 'fasts_anomalies') and a > 0")
    raw = per.filter("family in ('rapids', 'fasts')").groupBy("key_hash").agg(F.min("family").alias("raw"))
    joined = asked.join(raw, "key_hash", "left").join(lost, ["key_hash", "family"], "left")
    reason = F.col("primary_reason")
    bucket = (
        F.when(reason.isNotNull() & (reason != "natural_key_duplicate"), F.concat(F.lit("quarantined_"), reason)).when((F.col("raw") == "fasts") & (F.col("family") == "rapids_anomalies"), "same_event_in_fasts_raw")
        .when(F.col("raw").isNotNull(), F.concat(F.lit("same_event_in_"), "raw")).when(F.col("c") > 0, "accepted_unexplained").otherwise("other")
    )
    times = F.col("a") * F.coalesce("b", F.lit(1)) * F.greatest("c", F.lit(1))
    return joined.groupBy(F.col("family").alias("source_family"), bucket.alias("bucket")).agg(F.sum(times).alias("n"))


def name_groups(rows: DataFrame) -> DataFrame:
    """site_key, raw_names: the ways in which each of gamma's site names was published, in order."""
    return rows.filter("source = 'gamma' and site_key is not null").groupBy("site_key").agg(F.sort_array(F.collect_set("site_key_raw")).alias("raw_names"))


def key_conflicts(rows: DataFrame) -> DataFrame:
    """source, n_groups, with_idle_row, energy_differs: what sets the rows of one natural key apart.

    ``with_idle_row``: keys of which a row has neither charging time nor energy (a
    plug pulled again beside the real session). Keys that lack a part aren't keys.
    Keys are told by two extremes each, combined before the shuffle.
    """
    c = F.col
    whole = c("station_name_raw").isNotNull() & c("start_local").isNotNull()
    whole &= ~c("has_end") | (c("end_local").isNotNull() & c("energy_kwh").isNotNull())
    whole &= (c("source") != "gamma") | c("port_id").isNotNull()
    idle = F.coalesce((c("charging_minutes") == 0) & (c("energy_kwh") == 0), F.lit(False))
    keys = rows.filter(~c("is_blank") & whole).groupBy("source", "key_hash").agg(
        F.count("*").alias("n"), F.bool_or(idle).alias("idle"), (F.max("energy_kwh") > F.min("energy_kwh")).alias("differs")
    )
    count = lambda p, name: F.count(F.when(c(p), 1)).alias(name)
    return keys.filter("n > 1").groupBy("source").agg(F.count("*").alias("n_groups"), count("idle", "with_idle_row"), count("differs", "energy_differs"))


def powers(rows: DataFrame, wanted: tuple[float, ...] = (0.5, 0.9, 0.99, 0.999)) -> DataFrame:
    """source, port (null: all ports), q, kw: exact quantiles of energy over recorded time, and the median of each port.

    The time is the charging time, for a source without any the connected one;
    rows without time don't count, rejected and repeated rows do.
    """
    c = F.col
    minutes = F.when(c("source") == "gamma", c("reported_minutes")).otherwise(c("charging_minutes"))
    kw = rows.filter(~c("is_blank") & (minutes > 0)).select("source", "family", "port_id", (c("energy_kwh") / (minutes / 60)).alias("kw"))
    whole = quantiles.exact(kw, ["source"], "kw", list(wanted)).select("source", F.lit(None).cast("string").alias("port"), "q", c("value").alias("kw"))
    ports = quantiles.exact(kw.filter("port_id is not null"), ["source", "port_id"], "kw", [0.5]).select("source", c("port_id").alias("port"), "q", c("value").alias("kw"))
    return whole.unionByName(ports)


def over_ceiling(rows: DataFrame) -> DataFrame:
    """source, family, n_rows with a power, n_over their family's ceiling, most: the largest power."""
    c = F.col
    kw = rows.filter(~c("is_blank") & c("implied_kw").isNotNull())
    return kw.groupBy("source", "family").agg(F.count("*").alias("n_rows"), F.count(F.when(c("implied_kw") > ceiling(c("family")), 1)).alias("n_over"), F.max("implied_kw").alias("most"))


def span_figures(rows: DataFrame) -> DataFrame:
    """One row per source with ends: what is odd in them, and the idle share of all connected minutes.

    A row that lacks an instant counts among those over midnight and over a year's end.
    """
    c, n = F.col, lambda p, name: F.count(F.when(p, 1)).alias(name)
    span, epoch = span_minutes(), F.coalesce(F.year("end_local") == 1970, F.lit(False))
    other = lambda f: F.coalesce(f("start_local") != f("end_local"), F.lit(True))
    return rows.filter(~c("is_blank") & c("has_end")).groupBy("source").agg(
        n(c("end_local").isNull(), "end_null"), n(epoch, "end_in_1970"), n((span < 0) & ~epoch, "end_before_start"), n(span == 0, "end_at_start"),
        n(span > 24 * 60, "over_24h"), n(span > 7 * 24 * 60, "over_7d"), n(other(F.to_date), "over_midnight"), n(other(F.year) & ~epoch, "over_new_year"),
        (1 - F.sum("charging_minutes") / F.nullif(F.sum("reported_minutes"), F.lit(0.0))).alias("idle_share"),
    )


def hour_gaps(rows: DataFrame) -> DataFrame:
    """source, year_month, n: sessions whose span is an hour off their recorded duration."""
    gap = F.abs(span_minutes() - F.coalesce("reported_minutes", "charging_minutes"))
    off = rows.filter(~F.col("is_blank") & gap.between(55, 65))
    return off.groupBy("source", F.date_format("start_local", "yyyy-MM").alias("year_month")).agg(F.count("*").alias("n"))


def names_and_sites(rows: DataFrame) -> DataFrame:
    """source, n_sites, sites_with_several_names, n_names, names_at_several_sites, most_names: how names and sites belong together."""
    pairs = rows.filter("station_name_raw is not null and site_key is not null").select("source", "site_key", "station_name_raw").distinct()
    several = F.count(F.when(F.col("n") > 1, 1))
    per = lambda by: pairs.groupBy("source", by).agg(F.count("*").alias("n")).groupBy("source")
    sites = per("site_key").agg(F.count("*").alias("n_sites"), several.alias("sites_with_several_names"), F.max("n").alias("most_names"))
    return sites.join(per("station_name_raw").agg(F.count("*").alias("n_names"), several.alias("names_at_several_sites")), "source")


def largest_sites(rows: DataFrame, most: int = 8) -> DataFrame:
    """source, place, site_key, n_names: the sites with most names, ties by site. Ranked within parts first."""
    pairs = rows.filter("station_name_raw is not null and site_key is not null").select("source", "site_key", "station_name_raw").distinct()
    sites = pairs.groupBy("source", "site_key").agg(F.count("*").alias("n_names")).withColumn("_part", F.pmod(F.xxhash64("site_key"), F.lit(PARTS)))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n_names"), "site_key"))
    best = sites.withColumn("place", rank("source", "_part")).filter(F.col("place") <= most)
    return best.withColumn("place", rank("source")).filter(F.col("place") <= most).select("source", F.col("place").cast("long").alias("place"), "site_key", "n_names")


def port_values(rows: DataFrame) -> DataFrame:
    """source, port, n: rows of each port, ``<null>`` without one."""
    return rows.filter("not is_blank").groupBy("source", F.coalesce("port_id", F.lit("<null>")).alias("port")).agg(F.count("*").alias("n"))


def median_sessions(rows: DataFrame) -> DataFrame:
    """source, median: sessions a station."""
    per = rows.filter("not is_blank and station_name_raw is not null").groupBy("source", "station_name_raw").agg(F.count("start_local").alias("n"))
    return quantiles.exact(per, ["source"], "n", [0.5]).select("source", F.col("value").alias("median"))


def redelivered(rows: DataFrame, first: str, second: str, keys: list[str], columns: list[str]) -> DataFrame:
    """column, compared, changed: cells that differ between two files' rows of equal keys (nulls are equal).

    Each pair of rows with a key counts, as a join of the files would give them, but
    none is formed: of a key's pairs, those that agree are the sums over values of
    the product of both files' counts.
    """
    c = F.col
    there = rows.filter(c("source_file").isin(first, second)).dropna(subset=keys)
    cells = F.explode(F.array(*(F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("value")) for n in columns)))
    long = there.select(*(c(k).alias(f"_k{i}") for i, k in enumerate(keys)), (c("source_file") == first).cast("long").alias("_a"), cells.alias("_c"))
    own = [f"_k{i}" for i in range(len(keys))]
    values = long.groupBy(*own, "_c").agg(F.sum("_a").alias("a"), F.sum(1 - c("_a")).alias("b"))
    pairs = values.groupBy(*own, c("_c.column").alias("column")).agg((F.sum("a") * F.sum("b")).alias("compared"), F.sum(c("a") * c("b")).alias("same"))
    return pairs.groupBy("column").agg(F.sum("compared").alias("compared"), F.sum(c("compared") - c("same")).alias("changed"))
