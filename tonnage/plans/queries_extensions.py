"""Extensions: operators that the domain pipeline does not need but a query engine offers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tonnage.plans.catalogue import Tables, query


@query("SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_totals(t: Tables):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_totals(t: Tables):
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, o_orderkey, CAST(rank() OVER w AS INTEGER) AS r, CAST(dense_rank() OVER w AS INTEGER) AS d, CAST(ntile(4) OVER w AS INTEGER) AS q FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)""")
def rank_functions(t: Tables):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.ntile(4).over(w).alias("q"))


@query("SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS recent FROM events")
def rows_frame(t: Tables):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    return t.events.select("event_id", "user_id", F.round(F.sum("value").over(w), 4).alias("recent"))


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def intersect_except(t: Tables):
    def keys(condition: str):
        return t.orders.where(condition).select("o_custkey")

    return keys("o_orderstatus = 'F'").intersect(keys("o_orderstatus = 'P'")).subtract(keys("o_totalprice > 400000"))


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def tumbling_windows(t: Tables):
    hours = t.events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return hours.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query("""SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
    SELECT user_id, ts, CAST(coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR, true) AS INTEGER) AS opens FROM events)) GROUP BY user_id, s""")
def session_windows(t: Tables):
    found = t.events.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return found.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query()
def approx_distinct(t: Tables):
    return t.orders.agg(F.approx_count_distinct("o_custkey", 0.01).alias("customers"))


@query("""SELECT v.vec_id, CAST(floor(1000 * list_dot_product(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) / sqrt(list_dot_product(CAST(v.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) * list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))) + 0.5) AS BIGINT) AS cosine
FROM embeddings v JOIN (SELECT * FROM embeddings ORDER BY vec_id LIMIT 1) q ON true""")
def array_cosine(t: Tables):
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    query_vector = t.embeddings.orderBy("vec_id").first()["embedding"]
    q, v = F.array(*(F.lit(float(x)) for x in query_vector)), F.transform("embedding", lambda x: x.cast("double"))
    return t.embeddings.select("vec_id", F.floor(1000 * dot(v, q) / F.sqrt(dot(v, v) * dot(q, q)) + 0.5).alias("cosine"))
