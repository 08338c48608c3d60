"""Joins, set operations, windows and order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tonnage.plans.catalogue import Tables, query
from tonnage.plans.corpus import window_first


@query("""SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS lines, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def inner_join_three_way(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("r"))  # before the shuffle to orders
    joined = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("n").alias("lines"), F.round(F.sum("r"), 2).alias("revenue"))


@query("""SELECT c_custkey, CAST(coalesce(n, 0) AS BIGINT) AS urgent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000 GROUP BY 1) ON o_custkey = c_custkey""")
def left_join_fill_zero(t: Tables):
    n = t.orders.where("o_orderpriority = '1-URGENT' and o_totalprice > 200000").groupBy("o_custkey").agg(F.count("*").alias("urgent"))
    return t.customer.select("c_custkey").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "urgent").fillna(0, ["urgent"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49)")
def semi_join_exists(t: Tables):
    return t.orders.join(t.lineitem.where("l_quantity > 49"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_join_not_exists(t: Tables):
    return t.customer.join(t.orders.where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate < o.o_orderdate)")
def anti_join_theta(t: Tables):
    return t.orders.join(t.lineitem, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") < F.col("o_orderdate")), "left_anti").select("o_orderkey")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) <> CAST(o_orderdate AS DATE)")
def join_using_residual(t: Tables):
    joined = t.lineitem.select("l_orderkey", "l_shipdate").join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.where(F.to_date("l_shipdate") != F.to_date("o_orderdate")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, l_partkey AS first_part FROM orders JOIN (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) ON l_orderkey = o_orderkey AND n = 1""")
def first_row_index_lookup(t: Tables):
    index = window_first(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")])
    return t.orders.join(index, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", F.col("l_partkey").alias("first_part"))


@query("""SELECT year, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT year(o_orderdate) AS year FROM orders UNION ALL SELECT year(o_orderdate) - 1 FROM orders WHERE o_orderstatus = 'O') GROUP BY year""")
def union_all_explode_years(t: Tables):
    year = F.year("o_orderdate").cast("long")
    years = F.when(F.col("o_orderstatus") == "O", F.array(year, year - 1)).otherwise(F.array(year))
    return t.orders.select(F.explode(years).alias("year")).groupBy("year").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(t: Tables):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def dedup_first(t: Tables):
    return window_first(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], [F.col("o_orderkey")])


@query("""SELECT kind, id, instant, CAST(row_number() OVER (PARTITION BY owner ORDER BY instant, kind, id) AS BIGINT) AS place, owner FROM (
  SELECT 'event' AS kind, event_id AS id, user_id AS owner, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant FROM events UNION ALL
  SELECT 'order', o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') FROM orders)""")
def timeline_union_ordered(t: Tables):
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    events = t.events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("user_id").alias("owner"), F.date_format("ts", iso).alias("instant"))
    orders = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"), F.date_format("o_orderdate", iso).alias("instant"))
    place = F.row_number().over(Window.partitionBy("owner").orderBy("instant", "kind", "id"))
    return events.unionByName(orders).withColumn("place", place.cast("long"))


@query("""SELECT user_id, CAST(count(*) FILTER (state IS NOT NULL AND before IS NOT NULL AND state <> before) AS BIGINT) AS transitions FROM (
  SELECT user_id, state, lag(state IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM (
    SELECT user_id, ts, event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS state FROM events)) GROUP BY user_id""")
def lag_ignore_nulls_transitions(t: Tables):
    state = t.events.select("user_id", "ts", "event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("state"))
    earlier = Window.partitionBy("user_id").orderBy(F.col("ts").asc_nulls_last(), "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return state.withColumn("before", F.last("state", ignorenulls=True).over(earlier)).groupBy("user_id").agg(F.count_if(F.col("state") != F.col("before")).alias("transitions"))


@query("""SELECT o_orderkey, o_custkey FROM (
  SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 60 DAY AS until, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS following FROM orders) WHERE until > following""")
def interval_overlap_lead(t: Tables):
    following = F.lead("o_orderdate").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    spans = t.orders.select("o_orderkey", "o_custkey", F.expr("o_orderdate + interval 60 day").alias("until"), following.alias("following"))
    return spans.where("until > following").select("o_orderkey", "o_custkey")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n FROM documents) WHERE n > 1")
def duplicate_seen_before(t: Tables):
    keyed = t.documents.select("doc_id", "source", F.md5("text").alias("digest"))  # digests are shuffled, not texts
    first = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(first, "digest").where("doc_id > first").select("doc_id", "source")


@query("SELECT l_orderkey, l_partkey, CAST(count(*) OVER (PARTITION BY l_partkey) AS BIGINT) AS claims FROM lineitem WHERE l_quantity > 45")
def claim_count_window(t: Tables):
    return t.lineitem.where("l_quantity > 45").select("l_orderkey", "l_partkey", F.count("*").over(Window.partitionBy("l_partkey")).alias("claims"))


@query("""SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END NULLS LAST, o_orderkey) AS INTEGER) AS place FROM orders""")
def canonical_total_order_rank(t: Tables):
    date = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate"))
    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(date.asc_nulls_last(), "o_orderkey")).alias("place"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topn_examples(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
