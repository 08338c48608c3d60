"""Scans, projections, text, numbers, dates and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonnage.functions import ids, text
from tonnage.plans.catalogue import Tables, query


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 20 AND p_brand IS NOT NULL")
def scan_project_filter(t: Tables):
    return t.part.where("p_size between 10 and 20 and p_brand is not null").select("p_partkey", "p_name", "p_retailprice")


@query("SELECT doc_id, CASE WHEN trim(source) <> '' AND length(text) <= 1500 THEN source END AS source, CASE WHEN length(text) <= 500 THEN text END AS text FROM documents")
def width_guard_null(t: Tables):
    short = text.fit(F.col("text"), 1500).isNotNull()
    return t.documents.select("doc_id", F.when(short, text.blank_to_null(F.col("source"))).alias("source"), text.fit(F.col("text"), 500).alias("text"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN ' ' || o_orderstatus END AS status FROM orders")
def blank_to_null(t: Tables):
    cell = F.when(F.col("o_orderkey") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "o_orderstatus"))
    return t.orders.select("o_orderkey", text.blank_to_null(cell).alias("status"))


@query("SELECT c_custkey, 'ath_' || substr(sha256('psd-ids-v1' || chr(31) || 'ath' || chr(31) || 's6:driver' || chr(31) || 's' || length(c_name) || ':' || c_name), 1, 32) AS id FROM customer")
def deterministic_id_sha256(t: Tables):
    return t.customer.select("c_custkey", ids.make_id("athlete", ids.text_part("driver"), ids.text_part(F.col("c_name"))).alias("id"))


@query(r"SELECT page_id, lower(trim(regexp_replace(coalesce(url, ''), '[\s/]+', ' ', 'g'))) AS key FROM pages")
def normalize_text_key(t: Tables):
    return t.pages.select("page_id", text.normalized_key(F.regexp_replace("url", "/", " ")).alias("key"))


@query(r"SELECT bucket, count(*) AS n FROM (SELECT ascii(regexp_extract(sha256(p_name), '([0-9a-f])', 1)) % 16 AS bucket FROM part) GROUP BY bucket")
def regex_extract_bucket(t: Tables):
    digit = F.regexp_extract(F.sha2("p_name", 256), "([0-9a-f])", 1)
    return t.part.select((F.ascii(digit) % 16).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


@query(r"SELECT CAST(count(*) FILTER (regexp_matches(html, '<h1>')) AS BIGINT) AS titled, CAST(count(*) FILTER (contains(url, '+')) AS BIGINT) AS plus, CAST(count(*) FILTER (regexp_matches(html, '<p>.*<p>')) AS BIGINT) AS paragraphs FROM pages")
def regex_flag_count(t: Tables):
    return t.pages.agg(F.count_if(F.col("html").rlike("<h1>")).alias("titled"), F.count_if(F.contains("url", F.lit("+"))).alias("plus"), F.count_if(F.col("html").rlike("<p>.*<p>")).alias("paragraphs"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_totalprice WHEN 2 THEN -o_totalprice ELSE NULL END AS price FROM orders""")
def lenient_number_parse(t: Tables):
    price = F.col("o_totalprice").cast("string")
    cell = F.when(F.col("o_orderkey") % 4 == 0, F.lit("n/a")).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit(" "), price, F.lit("\t"))).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("-"), price)).otherwise(F.concat(price, F.lit("d")))
    return t.orders.select("o_orderkey", text.number(cell).alias("price"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def strict_date_parse(t: Tables):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cell = F.when(F.col("o_orderkey") % 3 == 0, day).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit(" "), day)).otherwise("2025-02-30")
    return t.orders.select("o_orderkey", F.date_format(text.day(cell), "yyyy-MM-dd").alias("day"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status FROM orders")
def vocab_map_default_null(t: Tables):
    return t.orders.select("o_orderkey", text.mapped(F.col("o_orderstatus"), {"F": "finished", "O": "open"}).alias("status"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def year_extract(t: Tables):
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS span_days FROM orders GROUP BY o_custkey")
def date_span_days(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("long").alias("span_days"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant FROM events")
def iso_format(t: Tables):
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("instant"))


@query("""SELECT l_orderkey, l_linenumber, measure, value FROM (
  SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS value FROM lineitem UNION ALL
  SELECT l_orderkey, l_linenumber, 'discount', nullif(l_discount, 0) FROM lineitem UNION ALL
  SELECT l_orderkey, l_linenumber, 'tax', nullif(l_tax, 0) FROM lineitem) WHERE value IS NOT NULL""")
def unpivot_measures(t: Tables):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return wide.unpivot(["l_orderkey", "l_linenumber"], ["quantity", "discount", "tax"], "measure", "value").where("value is not null")


@query("""SELECT family, round(sum(value), 2) AS total, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'amount' AS family, l_quantity AS value FROM lineitem UNION ALL SELECT 'rate', l_discount FROM lineitem UNION ALL SELECT 'rate', l_tax FROM lineitem)
GROUP BY family""")
def unpivot_to_spec_join(t: Tables):
    spec = t.spark.createDataFrame([("l_quantity", "amount"), ("l_discount", "rate"), ("l_tax", "rate")], "measure string, family string")
    long = t.lineitem.select("l_quantity", "l_discount", "l_tax").unpivot([], ["l_quantity", "l_discount", "l_tax"], "measure", "value")
    return long.join(F.broadcast(spec), "measure").groupBy("family").agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n"))


@query("""SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o,
  max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS p FROM orders GROUP BY o_custkey""")
def pivot_case_max(t: Tables):
    wide = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("o_totalprice"))
    return wide.select("o_custkey", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query("SELECT p_partkey, round(CAST(p_size AS DOUBLE) * CAST(0.45359237 AS DOUBLE), 6) AS kg, round(CAST(p_size AS DOUBLE) * CAST(2.54 AS DOUBLE), 6) AS cm FROM part")
def unit_conversion(t: Tables):
    from tonnage.functions.units import centimetres, kilograms

    size = F.col("p_size").cast("double")
    return t.part.select("p_partkey", F.round(kilograms(size, F.lit("lb")), 6).alias("kg"), F.round(centimetres(size, F.lit("in")), 6).alias("cm"))
