"""Plain relational operators over the star schema."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from voltway.operators import quantiles
from voltway.operators.sessions import delivery_blocks

QUERIES, ORACLE = {}, {}


def query(sql: str, *tables: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str):
            return f(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[f.__name__], ORACLE[f.__name__] = run, sql
        return f

    return add


def r2(c, name):
    return F.round(c, 2).alias(name)


@query("SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1", "customer", "nation")
def inner_join_nations(customer, nation):
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.groupBy("n_name").agg(F.count("*").alias("customers"), r2(F.sum("c_acctbal"), "balance"))


@query("SELECT c_custkey, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS spent FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1", "customer", "orders")
def left_join_orders(customer, orders):
    per = orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("orders"), F.sum("o_totalprice").alias("spent"))
    joined = customer.join(per, customer.c_custkey == per.o_custkey, "left")
    return joined.select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), r2(F.coalesce("spent", F.lit(0.0)), "spent"))


@query("SELECT r_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1", "supplier", "nation", "region")
def using_join_regions(supplier, nation, region):
    named = nation.withColumnRenamed("n_nationkey", "s_nationkey").withColumnRenamed("n_regionkey", "r_regionkey")
    return supplier.join(named, ["s_nationkey"]).join(region, ["r_regionkey"]).groupBy("r_name").agg(F.count("*").alias("suppliers"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')", "customer", "orders")
def anti_join_orders(customer, orders):
    return customer.join(orders.filter("o_orderstatus = 'F'"), customer.c_custkey == orders.o_custkey, "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)", "customer", "orders")
def semi_join_customers(customer, orders):
    return customer.join(orders.filter("o_totalprice > 300000"), customer.c_custkey == orders.o_custkey, "left_semi").select("c_custkey")


@query("SELECT p.p_partkey, count(*) AS near FROM part p JOIN part q ON p.p_brand = q.p_brand AND q.p_size > p.p_size AND q.p_size < p.p_size + 3 GROUP BY 1", "part")
def range_join(part):
    """An equal key with a range left over; the range is dealt out to its few sizes, so the join is on equality."""
    wide = part.select(F.col("p_partkey").alias("k"), "p_brand", F.explode(F.sequence(F.col("p_size") + 1, F.col("p_size") + 2)).alias("p_size"))
    sizes = part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    return wide.join(sizes, ["p_brand", "p_size"]).groupBy(F.col("k").alias("p_partkey")).agg(F.sum("n").alias("near"))


@query("SELECT a.l_orderkey, a.l_linenumber, count(*) AS twins FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_partkey IS NOT DISTINCT FROM b.l_partkey GROUP BY 1, 2", "lineitem")
def null_safe_join(lineitem):
    a, b = lineitem.alias("a"), lineitem.alias("b")
    on = (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_linenumber") == F.col("b.l_linenumber")) & F.col("a.l_partkey").eqNullSafe(F.col("b.l_partkey"))
    return a.join(b, on).groupBy("a.l_orderkey", "a.l_linenumber").agg(F.count("*").alias("twins"))


@query("SELECT count(CASE WHEN a.l_quantity IS DISTINCT FROM b.l_quantity THEN 1 END) AS quantity_changed, count(CASE WHEN a.l_tax IS DISTINCT FROM b.l_tax THEN 1 END) AS tax_changed, count(*) AS compared FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND b.l_linenumber = a.l_linenumber + 1", "lineitem")
def keyed_cell_diff(lineitem):
    b = lineitem.select("l_orderkey", "l_partkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_quantity").alias("q"), F.col("l_tax").alias("t"))
    both = lineitem.join(b, ["l_orderkey", "l_partkey", "l_linenumber"])
    other = lambda x, y: F.count(F.when(~F.col(x).eqNullSafe(F.col(y)), 1))
    return both.agg(other("l_quantity", "q").alias("quantity_changed"), other("l_tax", "t").alias("tax_changed"), F.count("*").alias("compared"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(l_tax) AS taxed, round(sum(l_quantity), 2) AS quantity, round(avg(l_discount), 6) AS discount, min(l_linenumber) AS low, max(l_linenumber) AS high FROM lineitem GROUP BY 1, 2", "lineitem")
def group_aggregates(lineitem):
    return lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count("l_tax").alias("taxed"), r2(F.sum("l_quantity"), "quantity"), F.round(F.avg("l_discount"), 6).alias("discount"),
        F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"),
    )


@query("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT year(o_orderdate)) AS years FROM orders GROUP BY 1", "orders")
def distinct_counts(orders):
    return orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"), F.count_distinct(F.year("o_orderdate")).alias("years"))


@query("SELECT l_shipdate_year AS year, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, round(sum(l_extendedprice) FILTER (WHERE l_discount > 0.05), 2) AS discounted FROM (SELECT *, year(l_shipdate) AS l_shipdate_year FROM lineitem) GROUP BY 1", "lineitem")
def filtered_aggregates(lineitem):
    return lineitem.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"), r2(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice"))), "discounted")
    )


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > (SELECT count(*) / count(DISTINCT l_suppkey) FROM lineitem)", "lineitem")
def having_filter(lineitem):
    per = lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return per.join(F.broadcast(per.agg(F.avg("n").alias("mean"))), F.col("n") > F.col("mean")).select("l_suppkey", "n")  # one row


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders", "orders")
def select_distinct(orders):
    return orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT c_nationkey, string_agg(s, ',' ORDER BY s) AS segments FROM (SELECT DISTINCT c_nationkey, c_mktsegment AS s FROM customer) GROUP BY 1", "customer")
def ordered_list_aggregate(customer):
    return customer.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"))


@query("SELECT c_mktsegment, round(sum(o_totalprice) / nullif(sum(c_acctbal), 0), 6) AS ratio FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1", "customer", "orders")
def ratio_of_sums(customer, orders):
    joined = customer.join(orders, customer.c_custkey == orders.o_custkey)
    return joined.groupBy("c_mktsegment").agg(F.round(F.sum("o_totalprice") / F.nullif(F.sum("c_acctbal"), F.lit(0.0)), 6).alias("ratio"))


@query("SELECT p_brand, p_size AS p_size FROM (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_size) AS k FROM part GROUP BY 1, 2) WHERE k = 1", "part")
def mode_smallest_tie(part):
    return part.groupBy("p_brand").agg(F.mode("p_size", True).alias("p_size"))


@query("SELECT l_shipmode_key AS flag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM (SELECT *, l_returnflag AS l_shipmode_key FROM lineitem) GROUP BY 1", "lineitem")
def interpolated_quantiles(lineitem):
    found = quantiles.exact(lineitem.select(F.col("l_returnflag").alias("flag"), "l_extendedprice"), ["flag"], "l_extendedprice", [0.5, 0.9])
    at = lambda q, n: F.round(F.max(F.when(F.col("q") == q, F.col("value"))), 4).alias(n)
    return found.groupBy("flag").agg(at(0.5, "median"), at(0.9, "p90"))


@query("SELECT p_size, count(*) AS n FROM part GROUP BY 1", "part")
def value_histogram(part):
    return part.groupBy("p_size").agg(F.count("*").alias("n"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS F, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS O, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS P FROM orders GROUP BY 1", "orders")
def crosstab_pivot(orders):
    wide = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).pivot("o_orderstatus", ["F", "O", "P"]).count()
    return wide.na.fill(0, ["F", "O", "P"])


@query("SELECT event_type, round(atan2(avg(sin(radians(15 * hour(ts)))), avg(cos(radians(15 * hour(ts))))), 5) AS mean_angle FROM events GROUP BY 1", "events")
def circular_mean(events):
    angle = F.radians(15.0 * F.hour("ts"))
    return events.groupBy("event_type").agg(F.round(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle))), 5).alias("mean_angle"))


@query("SELECT hour(ts) AS hour, round(sum(value), 2) AS total FROM events GROUP BY 1", "events")
def hour_buckets(events):
    return events.groupBy(F.hour("ts").alias("hour")).agg(r2(F.sum("value"), "total"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC NULLS LAST, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) WHERE k = 1", "lineitem")
def dedup_row_number(lineitem):
    order = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(F.col("l_extendedprice").desc_nulls_last(), "l_partkey", "l_suppkey", "l_quantity")
    found = lineitem.withColumn("k", F.row_number().over(order)).filter("k = 1")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_order, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS last_order FROM orders", "orders")
def running_lead_lag(orders):
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").asc_nulls_last(), "o_orderkey")
    running = F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return orders.select("o_custkey", "o_orderkey", r2(running, "running"), F.lead("o_orderkey").over(w).alias("next_order"), F.lag("o_orderkey").over(w).alias("last_order"))


@query("SELECT o_custkey, o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW) AS high FROM orders", "orders")
def rolling_90_day_max(orders):
    w = Window.partitionBy("o_custkey").orderBy(F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date"))).rangeBetween(-89, 0)
    return orders.select("o_custkey", "o_orderkey", F.max("o_totalprice").over(w).alias("high"))


@query("SELECT CAST(event_id AS BIGINT) AS event_id, CAST(sum(CASE WHEN event_id % 1000 = 7 THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS block FROM events", "events")
def delivery_block(events):
    """Restarts of a row id that counts from 0 again every thousand rows, before and at each row."""
    rows = events.select("event_id", F.pmod(F.col("event_id") - 7, F.lit(1000)).alias("row_id"))
    return delivery_blocks(rows, "event_id", "row_id").select("event_id", F.col("delivery_block").alias("block"))


@query("SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= 4", "part")
def topk_per_group(part):
    order = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return part.withColumn("k", F.row_number().over(order)).filter("k <= 4").select("p_brand", "p_partkey", "p_retailprice")


@query("SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 8", "part")
def topk_ties(part):
    return part.groupBy("p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_type").limit(8)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey", "customer")
def total_order_sort(customer):
    return customer.select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey")


@query("SELECT c_nationkey AS nationkey, 'customer' AS kind, c_name AS name FROM customer UNION ALL SELECT s_nationkey, 'supplier', s_name FROM supplier", "customer", "supplier")
def union_all(customer, supplier):
    a = customer.select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    return a.unionByName(supplier.select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("kind"), F.col("s_name").alias("name")))


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier", "customer", "supplier")
def union_distinct(customer, supplier):
    return customer.select(F.col("c_nationkey").alias("nationkey")).union(supplier.select("s_nationkey")).distinct()


@query("SELECT c_custkey AS k, c_mktsegment AS segment, NULL AS type FROM customer UNION ALL BY NAME SELECT p_partkey AS k, p_type AS type FROM part", "customer", "part")
def union_by_name(customer, part):
    a = customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(part.select(F.col("p_partkey").alias("k"), F.col("p_type").alias("type")), allowMissingColumns=True)


@query("SELECT count(*) AS shared, (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS missing FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0)", "orders", "customer")
def set_algebra(orders, customer):
    a, b = orders.select(F.col("o_custkey").alias("k")), customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    shared = a.intersect(b).agg(F.count("*").alias("shared"))
    return shared.join(a.subtract(b).agg(F.count("*").alias("missing")), F.lit(True))  # one row each


@query("SELECT l_orderkey, strftime(day, '%Y-%m-%d') AS day FROM (SELECT l_orderkey, l_linenumber, unnest(generate_series(CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE) + l_linenumber - 1, INTERVAL 1 DAY)) AS day FROM lineitem)", "lineitem")
def per_row_date_spine(lineitem):
    first = F.to_date("l_shipdate")
    days = lineitem.select("l_orderkey", F.explode(F.sequence(first, F.date_add(first, (F.col("l_linenumber") - 1).cast("int")))).alias("day"))
    return days.select("l_orderkey", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("SELECT strftime(m, '%Y-%m') AS period, n, prior, abs(n - prior) > 0.1 * prior AS failing FROM (SELECT m, n, lag(n) OVER (ORDER BY m) AS prior FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)) WHERE prior IS NOT NULL", "orders")
def period_over_period(orders):
    n = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(F.count("*").alias("n"))
    prior = n.withColumn("prior", F.lag("n").over(Window.orderBy("period"))).filter("prior is not null")  # one row per month
    return prior.withColumn("failing", F.abs(F.col("n") - F.col("prior")) > 0.1 * F.col("prior"))


GAP = "SELECT o_custkey, o_orderkey, CAST(epoch(next_at) - epoch(o_orderdate) AS BIGINT) // 86400 AS gap_days FROM (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_at FROM orders) WHERE epoch(next_at) - epoch(o_orderdate) > 90 * 86400"


@query(GAP, "orders")
def order_gaps_90_days(orders):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    gap = F.unix_micros(F.lead("o_orderdate").over(w).cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    found = orders.withColumn("gap", gap).filter(F.col("gap") > 90 * 86400 * 1_000_000)
    return found.select("o_custkey", "o_orderkey", F.floor(F.col("gap") / 86_400_000_000).alias("gap_days"))
