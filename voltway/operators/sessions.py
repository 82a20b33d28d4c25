"""Session logs of three publishers, as strings, conformed to one typed contract.

``published_*`` turn the ``events`` table into what three publishers would
deliver, each with its own columns, formats and faults; ``typed_*`` parse a
publisher's rows; ``conformed`` measures, keys, marks repeats of and judges all
of them; ``unioned`` and ``quarantined`` split the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltway.functions import columns as C
from voltway.operators import rules

ZONES = {"alpha": "America/Denver", "beta": "America/New_York", "gamma": "Europe/London"}
HMS = "concat(cast({0} div 3600 as string), ':', lpad(cast(({0} % 3600) div 60 as string), 2, '0'), ':', lpad(cast({0} % 60 as string), 2, '0'))"
#: Rows of a file that are numbered in one task.
RANGE = 65_536
#: Keys whose rows are told from their first by broadcast: the commonest, a row each.
HOT_KEYS = 1000
#: Rows of a kept step up to which it is broadcast: numbers of keys, or ids of rows.
FEW = 1_000_000
#: Ids in a map of marks, and how many of those rows a map (4 kB, two bits an id) counts for.
SPAN = 16_384
ROWS_A_MAP = 64
#: What comes first among equal rows or equal natural keys; nulls last.
ORDER = ("order_1", "order_2", "source_file", "row_hash", "object_id")
#: The same among landed rows: a family has any number of files, and their row hash covers what else the files hold, so neither says more than the texts.
LANDED_ORDER = ("order_1", "order_2", "family", "text_hash", "source_file", "row_hash", "object_id")


def _timed(events: DataFrame) -> DataFrame:
    """Events with instants, durations and faults; some come twice (``copy`` 1), under an id of their own."""
    return events.selectExpr(
        "event_id", "user_id", "event_type", "value", "cast(get_json_object(props, '$.k') as bigint) as k",
        """case when event_id % 79 = 5 then timestampadd(SECOND, event_id * 7 % 3600, case when event_id % 3 = 2 then timestamp '2024-10-27 01:00:00' else timestamp '2024-11-03 01:00:00' end)
           when event_id % 73 = 11 then timestampadd(DAY, cast(61 + 40 * (event_id % 5) as int), date_trunc('second', cast(ts as timestamp)))
           else timestampadd(DAY, 61, date_trunc('second', cast(ts as timestamp))) end as started""",
        "cast(round(value * 60) as bigint) + case when event_id % 83 = 13 then 90000 else 0 end as charge_s",
        "cast(round(value * 75) as bigint) + case when event_id % 83 = 13 then 90000 else 0 end as plug_s",
        """case when event_id % 103 = 0 then -2000.0 when event_id % 101 = 0 then -1.5 when event_id % 11 = 0 then 0.0
           when event_id % 89 = 17 then round(value * 2.4, 3) else round(value * 0.12, 3) end as energy""",
        "event_id % 211 = 7 as blank", "explode(case when event_id % 97 = event_id % 3 then array(0, 1) else array(0) end) as copy",
    ).withColumn("object_id", F.col("event_id") + 1_000_000_000 * F.col("copy"))


def _blanked(df: DataFrame, *kept: str) -> DataFrame:
    """Blank rows lose all but ``kept``."""
    return df.select(*(F.col(c) if c in kept else F.when(~F.col("blank"), F.col(c)).alias(c) for c in df.columns if c != "blank"))


def published_alpha(events: DataFrame) -> DataFrame:
    """Wall-clock starts and ends in two formats, both durations; a file of deliveries that each number their rows from 0."""
    rows = _timed(events).filter("event_id % 3 = 0").selectExpr(
        "*", "timestampadd(SECOND, case when event_id % 53 = 0 then -600 else plug_s end, started) as ended",
        "case when event_id % 47 = 0 then plug_s + 120 else charge_s end as charged_s",
    )
    fmt = "case when event_id % 2 = 0 then date_format({0}, 'yyyy-MM-dd HH:mm:ss') else date_format({0}, 'M/d/yyyy H:mm') end"
    text = rows.selectExpr(
        "object_id", "blank", "object_id as file_row", "case when copy = 1 then event_id div 291 else event_id div 3 % 1000 end as delivery_row",
        "concat('Plaza ', cast(user_id % 25 as string)) as station_name", "event_type as address",
        f"case when event_id % 59 = 0 then 'n/a' else {fmt.format('started')} end as start_text", f"{fmt.format('ended')} as end_text",
        f"{HMS.format('charged_s')} as charging_text", f"{HMS.format('plug_s')} as total_text", "cast(energy as string) as energy_text",
    )
    return _blanked(text, "object_id")


def published_beta(events: DataFrame) -> DataFrame:
    """UTC starts as ISO text and charging durations only; rows that come twice charge for longer or shorter."""
    rows = _timed(events).filter("event_id % 3 = 1").selectExpr(
        "*", "case when copy = 0 then charge_s when event_id % 2 = 0 then charge_s + 60 else greatest(charge_s - 60, 0) end as charged_s"
    )
    text = rows.selectExpr(
        "object_id", "blank", "concat('Garage ', cast(user_id % 25 as string)) as station_name", "event_type as address",
        "concat(date_format(started, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00') as start_text",
        f"case when event_id % 244 = 0 then '7 min' else {HMS.format('charged_s')} end as charging_text", "cast(energy as string) as energy_text",
    )
    return _blanked(text, "object_id")


def published_gamma(events: DataFrame) -> DataFrame:
    """Dates and times apart in ISO or day-first form, plug-in durations in minutes or hours, ``NA`` for nothing; some rows are in two files."""
    rows = _timed(events).filter("event_id % 3 = 2").selectExpr(
        "*", "timestampadd(SECOND, plug_s, started) as ended",
        "element_at(array('rapids', 'rapids_anomalies', 'fasts', 'fasts_anomalies'), cast(1 + case when copy = 0 then event_id % 4 else (event_id % 4 div 2) * 2 + (event_id + 1) % 2 end as int)) as family",
    )
    day = "case when family = 'rapids_anomalies' then date_format({0}, 'dd/MM/yyyy') else date_format({0}, 'yyyy-MM-dd') end"
    sentinel = day.format("date'1970-01-01'")
    text = rows.selectExpr(
        "object_id", "blank", "family", "case when event_id % 17 = 0 then 'NA' else concat('CP', cast(user_id % 25 as string)) end as cpid",
        "concat('Site  ', event_type, ' ') as name", "concat(cast(k % 3 as string), ' - Type 2') as connector",
        f"{day.format('started')} as start_date", "date_format(started, 'HH:mm:ss') as start_time",
        f"case when event_id % 29 = 0 then 'NA' when event_id % 31 = 0 then {sentinel} else {day.format('ended')} end as end_date",
        "case when event_id % 29 = 0 then 'NA' else date_format(ended, 'HH:mm:ss') end as end_time",
        "case family when 'rapids' then cast(plug_s div 60 as string) when 'rapids_anomalies' then 'NA' else cast(round(plug_s / 3600.0, 3) as string) end as plugged_text",
        "cast(energy as string) as energy_text",
    )
    return _blanked(text, "object_id", "family")


def delivery_blocks(rows: DataFrame, position: str = "file_row", row_id: str = "delivery_row") -> DataFrame:
    """Adds ``delivery_block``: how often row ids restarted at 0 before and at each row, less one.

    A running count over the whole file in two phases: within ranges of the
    position, then over the ranges' totals (one row a range). Rows without a
    position come last; of those only restarts are counted one after another, the
    rest have seen them all, so blank rows aren't one task.
    """
    restarts = F.when(F.col(row_id) == 0, 1).otherwise(0)
    ordered = F.col(position).isNotNull() | F.coalesce(F.col(row_id) <= 0, F.lit(False))
    dealt = rows.filter(ordered).withColumn("_range", F.coalesce(F.floor(F.col(position) / RANGE), F.lit((1 << 62))))
    within = F.sum(restarts).over(Window.partitionBy("_range").orderBy(F.col(position).asc_nulls_last(), F.col(row_id).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    totals = dealt.groupBy("_range").agg(F.sum(restarts).alias("n"))
    bases = totals.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_base"))
    counted = dealt.withColumn("_within", within).join(bases, "_range").withColumn("delivery_block", F.col("_within") + F.col("_base") - 1).drop("_range", "_within", "_base")
    whole = F.broadcast(totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_n")))  # one row
    last = rows.filter(~ordered).join(whole, F.lit(True)).withColumn("delivery_block", F.col("_n") - 1).drop("_n")
    return counted.unionByName(last)


def given(raw: DataFrame, name: str, otherwise: Column) -> Column:
    """A column that landed rows bring along, else what stands for it."""
    return (F.col(name) if name in raw.columns else otherwise).alias(name)


def hashes(raw: DataFrame, *texts: Column) -> list[Column]:
    """``row_hash`` over a row's texts; landed rows bring one along, over all that their file holds, and get ``text_hash`` beside it."""
    own = C.row_hash(*texts)
    return [F.col("row_hash"), own.alias("text_hash")] if "row_hash" in raw.columns else [own.alias("row_hash")]


def typed_alpha(raw: DataFrame) -> DataFrame:
    c = F.col
    iso = lambda n: c(n).rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z")
    return delivery_blocks(raw).select(
        "object_id", F.lit("alpha").alias("source"), F.lit("alpha").alias("family"), given(raw, "source_file", F.lit("alpha")), F.lit(ZONES["alpha"]).alias("zone"),
        c("delivery_block").cast("long").alias("delivery_block"), (-c("delivery_block")).cast("double").alias("order_1"), (-c("file_row")).cast("double").alias("order_2"),
        F.concat(F.lit("alpha/"), "station_name").alias("station_key"), c("station_name").alias("station_name_raw"), c("address").alias("site_key"), c("address").alias("site_key_raw"), F.lit(None).cast("string").alias("port_id"),
        F.lit(None).cast("string").alias("source_session_id"),
        C.parse_us_mixed("start_text").alias("start_local"), C.parse_us_mixed("end_text").alias("end_local"), F.lit(None).cast("timestamp").alias("start_utc_given"),
        F.lit(True).alias("has_end"), F.lit(False).alias("is_end_sentinel"),
        (c("station_name").isNull() & c("start_text").isNull() & c("end_text").isNull() & c("energy_text").isNull() & c("file_row").isNull()).alias("is_blank"),
        F.when(iso("start_text") & iso("end_text"), 1).otherwise(60).alias("precision_seconds"),
        C.hms_to_minutes("charging_text").alias("charging_minutes"), C.hms_to_minutes("total_text").alias("reported_minutes"), C.to_number("energy_text").alias("energy_kwh"),
        *hashes(raw, F.lit("alpha"), c("station_name"), c("address"), c("start_text"), c("end_text"), c("charging_text"), c("total_text"), c("energy_text")),
        C.natural_key_hash(c("station_name"), F.date_trunc("minute", C.parse_us_mixed("start_text")), F.date_trunc("minute", C.parse_us_mixed("end_text")), C.to_number("energy_text")).alias("key_hash"),
    )


def typed_beta(raw: DataFrame) -> DataFrame:
    c = F.col
    instant = F.try_to_timestamp(F.regexp_replace("start_text", r"\+00:00$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    charging = C.hms_to_minutes("charging_text")
    return raw.select(
        "object_id", F.lit("beta").alias("source"), F.lit("beta").alias("family"), given(raw, "source_file", F.lit("beta")), F.lit(ZONES["beta"]).alias("zone"),
        F.lit(None).cast("long").alias("delivery_block"), (-charging).alias("order_1"), F.lit(None).cast("double").alias("order_2"),
        F.concat(F.lit("beta/"), "station_name").alias("station_key"), c("station_name").alias("station_name_raw"), c("address").alias("site_key"), c("address").alias("site_key_raw"), F.lit(None).cast("string").alias("port_id"),
        F.lit(None).cast("string").alias("source_session_id"),
        C.utc_to_local(instant, ZONES["beta"]).alias("start_local"), F.lit(None).cast("timestamp").alias("end_local"), instant.alias("start_utc_given"),
        F.lit(False).alias("has_end"), F.lit(False).alias("is_end_sentinel"),
        (c("station_name").isNull() & c("start_text").isNull() & c("charging_text").isNull() & c("energy_text").isNull()).alias("is_blank"),
        F.lit(1).alias("precision_seconds"), charging.alias("charging_minutes"), F.lit(None).cast("double").alias("reported_minutes"), C.to_number("energy_text").alias("energy_kwh"),
        *hashes(raw, F.lit("beta"), c("station_name"), c("address"), c("start_text"), c("charging_text"), c("energy_text")),
        C.natural_key_hash(c("station_name"), instant).alias("key_hash"),
    )


def typed_gamma(raw: DataFrame) -> DataFrame:
    c = F.col
    na = lambda n: F.nullif(c(n), F.lit("NA"))
    raws = ("rapids", "fasts")
    unit = F.when(c("family").isin("fasts", "fasts_anomalies"), 60.0).when(c("family") == "rapids", 1.0)
    start, end = C.parse_date_time(na("start_date"), na("start_time")), C.parse_date_time(na("end_date"), na("end_time"))
    name = F.nullif(C.tidy_name(na("name")), F.lit(""))
    energy, connector = C.to_number(na("energy_text")), C.leading_integer(na("connector"))
    return raw.select(
        "object_id", F.lit("gamma").alias("source"), "family", given(raw, "source_file", c("family")), F.lit(ZONES["gamma"]).alias("zone"),
        F.lit(None).cast("long").alias("delivery_block"), F.when(c("family").isin(*raws), 0.0).otherwise(1.0).alias("order_1"), F.lit(None).cast("double").alias("order_2"),
        F.concat(F.lit("gamma/"), F.coalesce(na("cpid"), F.concat(F.lit("unknown/"), F.coalesce(name, F.lit("<null>"))))).alias("station_key"), na("cpid").alias("station_name_raw"),
        name.alias("site_key"), na("name").alias("site_key_raw"), connector.alias("port_id"), given(raw, "source_session_id", F.lit(None).cast("string")), start.alias("start_local"), end.alias("end_local"), F.lit(None).cast("timestamp").alias("start_utc_given"),
        F.lit(True).alias("has_end"), (na("end_date").like("1970-%") | na("end_date").like("%/1970")).alias("is_end_sentinel"),
        (na("cpid").isNull() & na("start_date").isNull() & na("end_date").isNull() & na("energy_text").isNull() & na("name").isNull()).alias("is_blank"),
        F.lit(1).alias("precision_seconds"), F.lit(None).cast("double").alias("charging_minutes"), (C.to_number(na("plugged_text")) * unit).alias("reported_minutes"), energy.alias("energy_kwh"),
        *hashes(raw, F.lit("gamma"), *(c(n) for n in ("cpid", "name", "connector", "start_date", "start_time", "end_date", "end_time", "plugged_text", "energy_text"))),
        C.natural_key_hash(na("cpid"), connector, F.date_trunc("minute", start), F.date_trunc("minute", end), energy).alias("key_hash"),
    )


def measured(df: DataFrame) -> DataFrame:
    """Adds UTC instants, durations, power and what the publisher itself leaves out."""
    c = F.col
    wall = c("start_utc_given").isNull()
    connected = C.minutes_between("start_utc", "end_utc")
    excluded = (c("energy_kwh") == 0) | (F.coalesce("reported_minutes", "connected_minutes") <= 3)
    # Of each wall-clock time its first instant and what the clock shows an hour after it, once: the rest follows from both.
    names = ("start", "end")
    first = df.withColumns({f"_{n}_first": C.first_utc(c(f"{n}_local"), c("zone")) for n in names})
    later = first.withColumns({f"_{n}_twice": C.utc_to_local(C.hour_later(c(f"_{n}_first")), c("zone")) == c(f"{n}_local") for n in names})
    utc = {n: F.when(c(f"_{n}_twice"), C.hour_later(c(f"_{n}_first"))).otherwise(c(f"_{n}_first")) for n in names}
    skipped = lambda n: F.coalesce(~c(f"_{n}_twice") & (C.utc_to_local(c(f"_{n}_first"), c("zone")) != c(f"{n}_local")), F.lit(False))
    return (
        later.withColumn("start_utc", F.coalesce("start_utc_given", utc["start"])).withColumn("end_utc", utc["end"])
        .withColumn("is_nonexistent", wall & (skipped("start") | skipped("end")))
        .withColumn("is_ambiguous", wall & F.coalesce("_start_twice", F.lit(False)))
        .withColumn("connected_minutes", connected).withColumn("duration_disagreement_minutes", connected - F.col("reported_minutes"))
        .withColumn("port_id_present", (c("source") == "gamma") & c("port_id").isNotNull())
        .withColumn("duration_availability", F.when(c("source") == "alpha", "both").when(c("source") == "beta", "charging_only").otherwise("plug_in_only"))
        .withColumn("implied_kw", C.implied_kw(c("energy_kwh"), F.when(c("source") == "gamma", c("connected_minutes")).otherwise(c("charging_minutes"))))
        .withColumn("idle_minutes", F.when(c("source") == "alpha", F.greatest(c("connected_minutes") - c("charging_minutes"), F.lit(0.0))))
        .withColumn("publisher_excluded", (c("source") == "gamma") & F.coalesce(excluded, F.lit(False)))
        .drop("start_utc_given", *(f"_{n}_{x}" for n in names for x in ("first", "twice")))
    )


def order(df: DataFrame) -> tuple[str, ...]:
    return LANDED_ORDER if "text_hash" in df.columns else ORDER


def ordering(names: tuple[str, ...], key: str) -> Column:
    """``names`` as one comparable value, nulls last; without the key itself, which is the same in all rows that are compared."""
    return F.struct(*(x for n in names if n != key for x in (F.col(n).isNull(), F.col(n))))


def repeats(narrow: DataFrame, key: str) -> DataFrame:
    """source, object_id of the rows that aren't the first of their ``key`` within their source.

    The first of each key is an aggregate, combined before its shuffle, and only
    keys with several rows are joined back: the ``HOT_KEYS`` commonest (blank
    rows, say) by broadcast, so that none of them is one task, the rest by key.
    """
    # Both uses of the firsts need all their columns and no null keys, so that one shuffle serves them.
    known = narrow.filter(F.col("source").isNotNull() & F.col(key).isNotNull())
    shared = known.groupBy("source", key).agg(F.min(ordering(order(narrow), key)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = shared.select("source", key, F.col("first.object_id").alias("_first"), "n")
    hot = F.broadcast(firsts.orderBy(F.desc("n"), "source", key).limit(HOT_KEYS).select("source", key, F.col("_first").alias("_hot")))
    rows = narrow.select("source", key, "object_id").join(hot, ["source", key], "left")
    # Rows of hot keys find nothing below; they are dealt by their own ids.
    own = F.encode(F.concat(F.lit("hot "), F.col("object_id").cast("string")), "UTF-8")
    spread = F.when(F.col("_hot").isNull(), F.col(key).cast("binary")).otherwise(own)
    found = rows.withColumn("_at", spread).join(firsts.select("source", F.col(key).cast("binary").alias("_at"), "_first"), ["source", "_at"], "left")
    return found.filter(F.coalesce("_hot", "_first") != F.col("object_id")).select("source", "object_id")


def key_number(key: str) -> Column:
    """A number that equal keys of a source share, and others by chance only."""
    return F.xxhash64(F.lit(key), "source", key)


def shared_numbers(narrow: DataFrame, keys: list[str]) -> DataFrame:
    """number: those of all keys that several rows have (by chance a single one's, too)."""
    numbers = narrow.select(F.explode(F.array(*map(key_number, keys))).alias("number"))
    return numbers.groupBy("number").agg(F.count("*").alias("n")).filter("n > 1").select("number")


def few(df: DataFrame, rows: int = 1) -> bool:
    """Whether a table is at most ``FEW`` rows that count for ``rows`` each."""
    most = FEW // rows
    return df.limit(most + 1).count() <= most


def marked(df: DataFrame, keep: Callable[[str, DataFrame], DataFrame] | None = None, also: Callable[[DataFrame], DataFrame] = lambda wide: wide) -> DataFrame:
    """Adds ``is_exact_repeat`` and ``is_key_repeat``: found on narrow rows, joined to the wide ones once, by their ids.

    ``keep`` writes a table and reads it back, so that its rows can be counted
    before what follows is planned: where few keys are shared, only their rows are
    compared, and the wide rows aren't shuffled where few of them are repeats or the
    repeats' ids lie close enough together for ``mark_maps``. ``also`` is done to the
    wide rows: before the marks' join where that doesn't shuffle them, so that a
    filter on the result doesn't repeat it; else after it.
    """
    narrow = df.select("source", "row_hash", "key_hash", *(n for n in order(df) if n != "row_hash"))
    flags = {"is_exact_repeat": "row_hash", "is_key_repeat": "key_hash"}
    compared = dict.fromkeys(flags.values(), narrow)
    if keep and few(numbers := keep("shared_numbers", shared_numbers(narrow, list(compared)))):
        for key in compared:
            compared[key] = narrow.join(F.broadcast(numbers), key_number(key) == F.col("number"), "left_semi")
    found = None
    for k, key in enumerate(flags.values()):
        own = repeats(compared[key], key).withColumn("_mark", F.lit(1 << k))
        found = own if found is None else found.unionByName(own)
    if keep:
        found = keep("repeats", found)
    marks = found.groupBy("source", "object_id").agg(F.bit_or("_mark").alias("_mark"))
    if keep and few(found):
        wide = also(df).join(F.broadcast(marks), ["source", "object_id"], "left")
    elif keep and few(maps := keep("repeat_maps", mark_maps(found)), ROWS_A_MAP):
        wide = also(df).withColumn("_span", span()).join(F.broadcast(maps), ["source", "_span"], "left").withColumn("_mark", mapped_mark()).drop("_span", "_map")
    else:
        wide = also(df.join(marks, ["source", "object_id"], "left"))
    has = lambda k: F.coalesce(F.col("_mark"), F.lit(0)).bitwiseAND(F.lit(1 << k)) > 0
    return wide.withColumns({flag: has(k) for k, flag in enumerate(flags)}).drop("_mark")


def span() -> Column:
    return F.shiftright("object_id", SPAN.bit_length() - 1)


def mark_maps(found: DataFrame) -> DataFrame:
    """source, _span, _map: the marks (1, 2) of each span of ids as two bits an id.

    Ids are brought together first: a map made before the shuffle has its full size however few bits it holds.
    """
    bit = F.pmod("object_id", F.lit(SPAN)) * 2 + F.col("_mark") - 1
    dealt = found.filter("object_id is not null").select("source", span().alias("_span"), bit.alias("_bit")).repartition("source", "_span")
    return dealt.groupBy("source", "_span").agg(F.bitmap_construct_agg("_bit").alias("_map"))


def mapped_mark() -> Column:
    """The two bits of ``object_id`` in its ``_map``."""
    at = f"pmod(object_id, {SPAN})"
    return F.expr(f"cast(shiftright(cast(conv(hex(substring(_map, cast({at} div 4 + 1 as int), 1)), 16, 10) as int), cast({at} % 4 * 2 as int)) & 3 as int)")


def places(narrow: DataFrame, key: str, name: str) -> DataFrame:
    """source, object_id, ``name``: the place of each row among those of its ``key``, in ``order``; of rows whose key others have.

    Rows are dealt by ranges of (key, order), numbered within a range and then
    over the ranges' counts, so a key that many rows share isn't one task.
    """
    ordered = [F.col(n).asc_nulls_last() for n in order(narrow)]
    keys = [F.col(n).asc() for n in ("source", key)]
    several = narrow.groupBy("source", key).agg(F.count("*").alias("_n")).filter("_n > 1").select("source", key)
    shared = narrow.join(several, ["source", key], "left_semi")
    dealt = shared.repartitionByRange(*keys, *ordered).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.row_number().over(Window.partitionBy("_part", "source", key).orderBy(*ordered)))
    counts = dealt.groupBy("source", key, "_part").agg(F.max("_at").alias("_n"))
    earlier = Window.partitionBy("source", key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("source", key, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    found = dealt.join(bases, ["source", key, "_part"])
    return found.select("source", "object_id", (F.col("_at") + F.col("_base")).cast("int").alias(name))


def ranked(df: DataFrame) -> DataFrame:
    """object_id, exact_rank, key_rank: places among equal rows and among equal natural keys; 1 where there are no others."""
    narrow = df.select("source", "key_hash", *order(df))
    found = narrow.select("source", "object_id")
    for key, name in (("row_hash", "exact_rank"), ("key_hash", "key_rank")):
        found = found.join(places(narrow, key, name), ["source", "object_id"], "left")
    return found.select("object_id", *(F.coalesce(n, F.lit(1)).alias(n) for n in ("exact_rank", "key_rank")))


def typed(events: DataFrame) -> DataFrame:
    """Every published row under the shared columns."""
    return typed_alpha(published_alpha(events)).unionByName(typed_beta(published_beta(events))).unionByName(typed_gamma(published_gamma(events)))


def judged(rows: DataFrame, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """Typed rows, with repeats marked (``keep`` as there), measured, reasons, flags and the surrogate key.

    Hashes are shuffled as the bytes that their hexadecimal digits stand for, half
    as long and in the same order; measures are taken after the marks' join if that is a shuffle.
    """
    digests = [n for n in ("row_hash", "key_hash", "text_hash") if n in rows.columns]
    told = marked(rows.withColumns({n: F.unhex(n) for n in digests}), keep, measured).drop("text_hash").withColumns({n: F.lower(F.hex(n)) for n in digests if n != "text_hash"})
    return rules.judged(told).withColumn("session_sk", F.md5(F.concat_ws("|", "source", "key_hash")))


def conformed(events: DataFrame) -> DataFrame:
    """Every published row, typed and judged."""
    return judged(typed(events))


def unioned(rows: DataFrame) -> DataFrame:
    """Accepted sessions."""
    return rows.filter(F.col("primary_reason").isNull())


def quarantined(rows: DataFrame) -> DataFrame:
    """Rejected rows; their primary reason and all reasons."""
    return rows.filter(F.col("primary_reason").isNotNull())
