"""Column functions: parsing, time zones, keys, arrays and profiling."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voltway.functions import columns as C
from voltway.operators import profiling as P
from voltway.operators import sessions as S

QUERIES, ORACLE = {}, {}
HMS_SQL = "CAST(s // 3600 AS VARCHAR) || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0')"


def query(sql: str, *tables: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str):
            return f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, sql
        return f

    return add


@query("SELECT event_id, round(CASE WHEN event_id % 7 = 0 THEN NULL ELSE s / 60.0 END, 6) AS minutes FROM (SELECT event_id, CAST(round(value * 600) AS BIGINT) AS s FROM events)", "events")
def hms_to_minutes(events):
    text = events.selectExpr("event_id", "cast(round(value * 600) as bigint) as s").selectExpr("event_id", f"case when event_id % 7 = 0 then concat(cast(s as string), ' s') else {S.HMS.format('s')} end as t")
    return text.select("event_id", F.round(C.hms_to_minutes("t"), 6).alias("minutes"))


@query("SELECT event_id, CAST(CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 2 = 0 THEN epoch(date_trunc('second', ts)) ELSE epoch(date_trunc('minute', ts)) END AS BIGINT) AS s FROM events", "events")
def parse_mixed_timestamp(events):
    text = events.selectExpr("event_id", "case when event_id % 13 = 0 then '13/32/2024 9:99' when event_id % 2 = 0 then date_format(ts, 'yyyy-MM-dd HH:mm:ss') else date_format(ts, 'M/d/yyyy H:mm') end as t")
    return text.select("event_id", F.unix_seconds(C.parse_us_mixed("t")).alias("s"))


@query("SELECT event_id, CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE epoch(date_trunc('second', ts)) END AS BIGINT) AS s FROM events", "events")
def parse_dayfirst_timestamp(events):
    text = events.selectExpr("event_id", "case when event_id % 13 = 0 then 'NA' when event_id % 2 = 0 then date_format(ts, 'yyyy-MM-dd') else date_format(ts, 'd/M/yyyy') end as d", "date_format(ts, 'H:mm:ss') as t")
    return text.select("event_id", F.unix_seconds(C.parse_date_time("d", "t")).alias("s"))


GRID = "(SELECT event_id, z.zone, TIMESTAMP '2012-01-01' + to_minutes(CAST(event_id * 1087 % 227952 * 30 AS BIGINT)) AS l FROM events, (VALUES ('America/Denver'), ('America/New_York'), ('Europe/London')) z(zone))"


def grid(events):
    """Half hours of thirteen years, spread by the id, in three zones."""
    half = F.expr("timestampadd(MINUTE, cast(event_id * 1087 % 227952 * 30 as int), timestamp'2012-01-01 00:00:00')")
    return events.select("event_id", half.alias("l"), F.explode(F.array(*map(F.lit, S.ZONES.values()))).alias("zone"))


@query(f"SELECT event_id, zone, CAST(epoch(timezone(zone, l)) AS BIGINT) AS utc_s FROM {GRID}", "events")
def local_to_utc_grid(events):
    return grid(events).select("event_id", "zone", F.unix_seconds(C.local_to_utc("l", F.col("zone"))).alias("utc_s"))


@query(f"SELECT event_id, zone, timezone(zone, timezone(zone, l)) <> l AS nonexistent, timezone(zone, timezone(zone, l) - INTERVAL 1 HOUR) = l AS ambiguous FROM {GRID}", "events")
def dst_flags(events):
    z = F.col("zone")
    return grid(events).select("event_id", "zone", C.is_nonexistent_local("l", z).alias("nonexistent"), C.is_ambiguous_local("l", z).alias("ambiguous"))


@query(f"SELECT DISTINCT zone, strftime(d, '%Y-%m-%d') AS day, (epoch(timezone(zone, CAST(d + 1 AS TIMESTAMP))) - epoch(timezone(zone, CAST(d AS TIMESTAMP)))) / 60.0 AS minutes FROM (SELECT zone, CAST(l AS DATE) AS d FROM {GRID})", "events")
def local_day_minutes(events):
    days = grid(events).select("zone", F.to_date("l").alias("d")).distinct()
    return days.select("zone", F.date_format("d", "yyyy-MM-dd").alias("day"), C.local_day_minutes("d", F.col("zone")).alias("minutes"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE greatest(least(o_custkey + 500.0, o_orderkey / 10.0 + 300) - greatest(o_custkey * 1.0, o_orderkey / 10.0), 0) END AS shared FROM orders", "orders")
def overlap_minutes(orders):
    end = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey") / 10.0 + 300)
    return orders.select("o_orderkey", C.overlap(F.col("o_custkey") * 1.0, F.col("o_custkey") + 500.0, F.col("o_orderkey") / 10.0, end).alias("shared"))


@query("SELECT l_orderkey, l_linenumber, md5(CAST(l_orderkey AS VARCHAR) || chr(31) || coalesce(CAST(nullif(l_partkey % 5, 0) AS VARCHAR), '<null>') || chr(31) || l_returnflag) AS key FROM lineitem", "lineitem")
def natural_key_hash(lineitem):
    return lineitem.select("l_orderkey", "l_linenumber", C.natural_key_hash(F.col("l_orderkey"), F.nullif(F.col("l_partkey") % 5, F.lit(0)), F.col("l_returnflag")).alias("key"))


@query("SELECT c_custkey, sha256(c_name || chr(31) || coalesce(nullif(c_mktsegment, 'BUILDING'), '?')) AS hash FROM customer", "customer")
def row_hash(customer):
    segment = F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("?"))
    return customer.select("c_custkey", C.row_hash(F.col("c_name"), segment).alias("hash"))


@query("SELECT event_id, CAST(k AS VARCHAR) AS lead_int, CASE WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) / 8 END AS number, 'Site ' || event_type AS tidy FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events)", "events")
def text_cleaning(events):
    t = events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    messy = F.when(F.col("k") % 3 == 0, (F.col("k") / 8.0).cast("string")).when(F.col("k") % 3 == 1, F.concat(F.col("k").cast("string"), F.lit("d"))).otherwise("NaN")
    return t.select("event_id", C.leading_integer(F.concat(F.lit(" "), F.col("k").cast("string"), F.lit(" - Type 2"))).alias("lead_int"), C.to_number(messy).alias("number"), C.tidy_name(F.concat(F.lit("  Site \t "), "event_type", F.lit(" "))).alias("tidy"))


@query("SELECT count(CASE WHEN p_type LIKE '%BRASS%' THEN 1 END) AS brass, count(CASE WHEN contains(p_name, 'a') THEN 1 END) AS with_a, count(CASE WHEN regexp_matches(p_brand, '^Brand#1') THEN 1 END) AS brand_one FROM part", "part")
def text_predicates(part):
    n = lambda p, name: F.count(F.when(p, 1)).alias(name)
    return part.agg(n(F.col("p_type").like("%BRASS%"), "brass"), n(F.col("p_name").contains("a"), "with_a"), n(F.col("p_brand").rlike("^Brand#1"), "brand_one"))


@query("SELECT o_orderkey, list_aggregate(list_filter([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'F' THEN 'done' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS marks, CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority LIKE '1%' THEN 'urgent' END AS mark FROM orders", "orders")
def reasons_and_primary(orders):
    from voltway.operators import rules

    listed = [("large", F.col("o_totalprice") > 200000), ("done", F.col("o_orderstatus") == "F"), ("urgent", F.col("o_orderpriority").like("1%"))]
    return orders.select("o_orderkey", C.joined_or_null(rules.failing(listed)).alias("marks"), rules.primary(listed).alias("mark"))


@query("SELECT event_id, CAST(epoch(ts) AS BIGINT) AS whole_s, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS minute_s, isodow(ts) AS dow, strftime(ts, '%Y-%m') AS month, CAST(epoch(ts + to_seconds(CAST(round(value * 60) AS BIGINT))) AS BIGINT) AS later_s FROM (SELECT event_id, value, date_trunc('second', ts) AS ts FROM events)", "events")
def date_arithmetic(events):
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    later = F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("long"), ts)
    return events.select(
        "event_id", F.unix_seconds(ts).alias("whole_s"), F.unix_seconds(F.date_trunc("minute", ts)).alias("minute_s"), (F.weekday(ts) + 1).cast("long").alias("dow"),
        F.date_format(ts, "yyyy-MM").alias("month"), F.unix_seconds(later).alias("later_s"),
    )


@query("SELECT key, value FROM (SELECT 'orders' AS key, count(*) AS value FROM orders UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O')", "orders")
def map_entries(orders):
    both = orders.agg(F.create_map(F.lit("orders"), F.count("*"), F.lit("open"), F.count(F.when(F.col("o_orderstatus") == "O", 1))).alias("m"))
    return both.select(F.explode("m"))


COLS = {"o_orderkey": "integer", "o_totalprice": "decimal", "o_orderstatus": "text", "o_orderdate": "text"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct FROM orders" for c in COLS), "orders")
def profile_columns(orders):
    return P.profile(orders.select(*COLS)).select("name", "n_rows", "nulls", "n_distinct")


TEXTS = {
    "whole": ("CAST(o_orderkey AS VARCHAR)", "cast(o_orderkey as string)"),
    "price": ("CAST(o_totalprice AS VARCHAR)", "cast(o_totalprice as string)"),
    "status": ("o_orderstatus", "o_orderstatus"),
    "nearly": ("CASE WHEN o_orderkey % 211 = 0 THEN 'x' ELSE '12' END", "case when o_orderkey % 211 = 0 then 'x' else '12' end"),
    "mixed": ("CASE WHEN o_orderkey % 29 = 0 THEN 'x' ELSE '12' END", "case when o_orderkey % 29 = 0 then 'x' else '12' end"),
    "hms": ("CAST(o_orderkey % 90 AS VARCHAR) || ':05:09'", "concat(cast(o_orderkey % 90 as string), ':05:09')"),
    "iso": ("strftime(o_orderdate, ' %Y-%m-%d ')", "date_format(o_orderdate, \"' 'yyyy-MM-dd' '\")"),
    "stamp": ("strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.250+01:00')", "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'.250+01:00'\")"),
    "slash": ("strftime(o_orderdate, '%d/%m/%Y')", "date_format(o_orderdate, 'dd/MM/yyyy')"),
    "short": ("strftime(o_orderdate, '%m/%d/%y %H:%M')", "date_format(o_orderdate, 'MM/dd/yy HH:mm')"),
    "none": ("CASE WHEN o_orderkey % 2 = 0 THEN '  ' END", "case when o_orderkey % 2 = 0 then '  ' end"),
}
UNPIVOTED = " UNION ALL ".join(f"SELECT '{n}' AS name, nullif(trim({sql}), '') AS v, {sql} AS raw FROM orders" for n, (sql, _) in TEXTS.items())


def shape_case(empty: str, given: list[str], other: str) -> str:
    """The SQL of the first shape that holds, with what it gives."""
    holds = [f"count(CASE WHEN regexp_matches(v, '{p.removesuffix(chr(92) + 'z')}$') THEN 1 END) >= 0.99 * count(v)" for _, _, p in P.SHAPES]
    return f"CASE WHEN count(v) = 0 THEN {empty} " + " ".join(f"WHEN {h} THEN {g}" for h, g in zip(holds, given, strict=True)) + f" ELSE {other} END"


TYPE_CASE = shape_case("'empty'", [f"'{t}'" for t, _, _ in P.SHAPES], "'text'")
PATTERN_CASE = shape_case("NULL", [f"'{n}'" if n else "NULL" for _, n, _ in P.SHAPES], "NULL")


def texts(orders):
    return orders.selectExpr(*(f"{expr} as {n}" for n, (_, expr) in TEXTS.items()))


@query(f"SELECT name, {TYPE_CASE} AS type, {PATTERN_CASE} AS pattern FROM ({UNPIVOTED}) GROUP BY 1", "orders")
def infer_types(orders):
    return P.infer_types(texts(orders))


@query(
    "SELECT name, count(*) AS n_rows, count(*) - count(raw) AS nulls, count(raw) - count(v) AS blanks, count(DISTINCT v) AS n_distinct, round(CASE WHEN name = 'hms' THEN min(TRY_CAST(split_part(v, ':', 1) AS DOUBLE)) * 60 + 5.15 "
    "WHEN name IN ('whole', 'price', 'nearly') THEN min(TRY_CAST(v AS DOUBLE)) WHEN name IN ('iso', 'slash') THEN (SELECT epoch(min(date_trunc('day', o_orderdate))) FROM orders) "
    "WHEN name = 'stamp' THEN (SELECT epoch(min(date_trunc('second', o_orderdate))) - 3599.75 FROM orders) WHEN name = 'short' THEN (SELECT epoch(min(date_trunc('minute', o_orderdate))) FROM orders) END, 3) AS least, "
    "round(CASE WHEN name IN ('whole', 'price', 'nearly') THEN avg(TRY_CAST(v AS DOUBLE)) END, 4) AS mean, CASE WHEN name IN ('iso', 'slash', 'stamp', 'short') THEN 0 END AS parse_failures, "
    f"CASE WHEN name = 'slash' THEN 'day_first' WHEN name = 'short' THEN 'month_first' END AS day_first FROM ({UNPIVOTED}) GROUP BY 1",
    "orders",
)
def profile_texts(orders):
    found = P.profile(texts(orders))
    return found.select("name", "n_rows", "nulls", "blanks", "n_distinct", F.round("least", 3).alias("least"), F.round("mean", 4).alias("mean"), "parse_failures", "day_first")


EVIDENCE = "count(CASE WHEN o_orderdate IS NOT NULL AND day(o_orderdate) > 12 THEN 1 END)"


@query(f"SELECT {EVIDENCE} AS first_over_12, 0 AS second_over_12, CASE WHEN {EVIDENCE} > 0 THEN 'day_first' ELSE 'ambiguous' END AS verdict FROM orders", "orders")
def day_first_evidence(orders):
    return P.day_first_evidence(orders.select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("t")), "t")


@query("SELECT count(CASE WHEN day(o_orderdate) > 12 AND o_orderkey % 2 = 0 THEN 1 END) AS first_over_12, count(CASE WHEN day(o_orderdate) > 12 AND o_orderkey % 2 = 1 THEN 1 END) AS second_over_12, 'ambiguous' AS verdict FROM orders", "orders")
def day_first_conflict(orders):
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return P.day_first_evidence(orders.select(mixed.alias("t")), "t")


@query("SELECT count(*) AS n_rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS repeated FROM lineitem", "lineitem")
def exact_duplicates(lineitem):
    return P.duplicate_rows(lineitem.select("l_orderkey", "l_linenumber"))


SPANS = "(SELECT o_custkey, o_orderkey, epoch(o_orderdate) AS s, CASE WHEN o_orderkey % 19 <> 0 THEN epoch(o_orderdate) + 86400.0 * (o_orderkey % 200 - 20) END AS e FROM orders)"


@query(f"SELECT o_custkey, CAST(max(level) AS BIGINT) AS most FROM (SELECT o_custkey, sum(d) OVER (PARTITION BY o_custkey ORDER BY t, d, o_orderkey ROWS UNBOUNDED PRECEDING) AS level FROM (SELECT o_custkey, o_orderkey, s AS t, 1 AS d FROM {SPANS} WHERE e >= s UNION ALL SELECT o_custkey, o_orderkey, e, -1 FROM {SPANS} WHERE e >= s)) GROUP BY 1", "orders")
def max_concurrency(orders):
    """Some orders end before they start, some have no end: they don't count."""
    t = F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6
    ends = F.when(F.col("o_orderkey") % 19 != 0, t + 86400.0 * (F.col("o_orderkey") % 200 - 20))
    spans = orders.select("o_custkey", "o_orderkey", t.alias("s"), ends.alias("e"), F.to_date("o_orderdate").alias("start_day"))
    return P.max_concurrency(spans, "o_custkey", "s", "e", "o_orderkey")


@query("SELECT name, CAST(k AS INTEGER) AS k, value FROM (SELECT name, value, row_number() OVER (PARTITION BY name ORDER BY min(met)) AS k FROM (SELECT event_id AS met, unnest(['event_type', 'user_id', 'props']) AS name, unnest([event_type, CAST(user_id AS VARCHAR), props]) AS value FROM events) WHERE trim(value) <> '' GROUP BY 1, 2) WHERE k <= 5", "events")
def first_met_samples(events):
    """The first five different values of each column, in the order of the events."""
    return P.first_met(events.select(F.col("event_id").alias("at"), "event_type", "user_id", "props"), "at")
