"""Aggregates: histories, coverage, histograms, lists and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonnage.functions.aggregates import count_distinct_of_few
from tonnage.plans.catalogue import Tables, query


@query("""SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
  CAST(count(*) AS BIGINT) AS orders, CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) AS years, CAST(count(*) FILTER (o_orderstatus IN ('F', 'P')) AS BIGINT) AS closed,
  CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS priorities, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS span_days,
  count(*) FILTER (o_orderstatus IN ('F', 'P')) / count(*) AS closed_share
FROM orders GROUP BY o_custkey""")
def group_history_per_customer(t: Tables):
    order = F.struct(F.col("o_orderdate").isNull(), "o_orderdate", "o_orderkey")
    closed = F.count_if(F.col("o_orderstatus").isin("F", "P"))
    return t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first_date"),
        F.to_date(F.max("o_orderdate")).alias("last_date"),
        F.min_by("o_orderkey", order).alias("first_order"),
        F.max_by("o_orderkey", order).alias("last_order"),
        F.count("*").alias("orders"),
        count_distinct_of_few(F.year("o_orderdate")).alias("years"),
        closed.alias("closed"),
        count_distinct_of_few("o_orderpriority").alias("priorities"),
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("long").alias("span_days"),
        (closed / F.count("*")).alias("closed_share"),
    )


@query("""SELECT user_id, arg_min(event_id, k) AS first_event, arg_max(event_id, k) AS last_event FROM (
  SELECT user_id, event_id, (event_id % 7 = 0, CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '1970-01-01' ELSE ts END, event_id) AS k FROM events) GROUP BY user_id""")
def first_last_by_total_order_nulls_last(t: Tables):
    at = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    order = F.struct(at.isNull(), at, "event_id")
    return t.events.groupBy("user_id").agg(F.min_by("event_id", order).alias("first_event"), F.max_by("event_id", order).alias("last_event"))


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (value > 50) AS BIGINT) AS high, CAST(count(*) FILTER (value IS NULL) AS BIGINT) AS absent, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY event_type""")
def count_filter_multi(t: Tables):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"), F.count_if(F.col("value").isNull()).alias("absent"), F.countDistinct("user_id").alias("users"))


@query("SELECT o_custkey, CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS statuses FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
def having_distinct_gt1(t: Tables):
    return t.orders.groupBy("o_custkey").agg(count_distinct_of_few("o_orderstatus").alias("statuses")).where("statuses > 1")


@query("""WITH g AS (SELECT p_brand AS member, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 9 > 0 THEN p_brand END AS p_brand FROM part) GROUP BY 1)
SELECT member, CAST(n AS BIGINT) AS n, CAST((SELECT count(*) FROM g WHERE member IS NOT NULL) AS BIGINT) AS members, CAST((SELECT sum(n) FROM g WHERE member IS NULL) AS BIGINT) AS absent
FROM g WHERE member IS NOT NULL ORDER BY g.n DESC, member LIMIT 10""")
def category_coverage_topk(t: Tables):
    counts = t.part.groupBy(F.when(F.col("p_partkey") % 9 > 0, F.col("p_brand")).alias("member")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.count("member").alias("members"), F.sum(F.when(F.col("member").isNull(), F.col("n"))).alias("absent")).withColumn("k", F.lit(1))
    top = counts.where("member is not null").orderBy(F.desc("n"), "member").limit(10).withColumn("k", F.lit(1))
    return top.join(F.broadcast(totals), "k").drop("k")  # one row of totals


@query("SELECT lines, CAST(count(*) AS BIGINT) AS orders FROM (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS lines FROM lineitem GROUP BY l_orderkey) GROUP BY lines")
def histogram_counts(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines")).groupBy("lines").agg(F.count("*").alias("orders"))


@query("""WITH b(label, lo, hi) AS (VALUES ('none', 0, 0), ('1', 1, 1), ('2-9', 2, 9), ('10-99', 10, 99), ('100+', 100, 1000000000)),
g AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT label, CAST(count(user_id) AS BIGINT) AS users FROM b LEFT JOIN g ON n BETWEEN lo AND hi GROUP BY label""")
def bucket_distribution_zero_filled(t: Tables):
    n = F.col("n")
    label = F.when(n == 0, "none").when(n == 1, "1").when(n <= 9, "2-9").when(n <= 99, "10-99").otherwise("100+")
    held = t.events.groupBy("user_id").agg(F.count("*").alias("n")).groupBy(label.alias("label")).agg(F.count("*").alias("users"))
    labels = t.spark.createDataFrame([(x,) for x in ("none", "1", "2-9", "10-99", "100+")], "label string")
    return labels.join(held, "label", "left").fillna(0, ["users"])


@query("""SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS orders, CAST(count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.09)) AS BIGINT) AS discounted FROM orders GROUP BY o_orderpriority""")
def coverage_two_counts(t: Tables):
    marked = t.lineitem.where("l_discount > 0.09").select("l_orderkey").distinct().withColumn("hit", F.lit(True))
    joined = t.orders.select("o_orderkey", "o_orderpriority").join(marked, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.count("hit").alias("discounted"))


@query("SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses FROM orders GROUP BY o_custkey")
def list_distinct_sorted(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@query("""SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, count(DISTINCT year(o_orderdate)) AS n FROM orders GROUP BY ALL) JOIN (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS years FROM orders GROUP BY 1) USING (o_custkey) WHERE n = years AND years > 1""")
def set_intersection_by_count(t: Tables):
    year = F.year("o_orderdate")
    each = t.orders.groupBy("o_custkey", "o_orderpriority").agg(count_distinct_of_few(year).alias("n"))
    every = t.orders.groupBy("o_custkey").agg(count_distinct_of_few(year).alias("years")).where("years > 1")
    return each.join(every, "o_custkey").where("n = years").select("o_custkey", "o_orderpriority")


@query("SELECT p_brand, p_size, arg_min(p_name, (p_name, p_partkey)) AS name, arg_min(p_partkey, (p_name, p_partkey)) AS p_partkey FROM part GROUP BY p_brand, p_size")
def min_variant_per_key(t: Tables):
    least = F.min(F.struct("p_name", "p_partkey"))
    return t.part.groupBy("p_brand", "p_size").agg(least.alias("v")).select("p_brand", "p_size", F.col("v.p_name").alias("name"), "v.p_partkey")


@query("""SELECT n_name, CAST(count(*) AS BIGINT) AS customers, CAST(count(*) FILTER (c_acctbal < 0) AS BIGINT) AS failed, CASE WHEN count(*) > 0 THEN count(*) FILTER (c_acctbal < 0) / count(*) ELSE 0.0 END AS rate,
  round(max(abs(c_acctbal)), 2) AS largest FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def sign_as_result_rate(t: Tables):
    failed = F.count_if(F.col("c_acctbal") < 0)
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("customers"), failed.alias("failed"), F.coalesce(F.try_divide(failed, F.count("*")), F.lit(0.0)).alias("rate"), F.round(F.max(F.abs("c_acctbal")), 2).alias("largest"))


@query("""SELECT CAST(count(*) AS BIGINT) AS orders, CAST(count(*) FILTER (abs(o_totalprice - parts) <= 1000) AS BIGINT) AS agreeing, CAST(count(*) FILTER (NOT abs(o_totalprice - parts) <= 1000) AS BIGINT) AS differing
FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice) AS parts FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def total_vs_parts_tolerance(t: Tables):
    parts = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("parts"))
    near = F.abs(F.col("o_totalprice") - F.col("parts")) <= 1000
    return t.orders.join(parts, F.col("l_orderkey") == F.col("o_orderkey")).agg(F.count("*").alias("orders"), F.count_if(near).alias("agreeing"), F.count_if(~near).alias("differing"))
