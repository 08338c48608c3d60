"""Predicates, column rules, cross-record rules, invariants and digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.operators import rules
from tonnage.plans.catalogue import Tables, query


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F'")
def is_distinct_from(t: Tables):
    return t.orders.where(~F.nullif("o_orderstatus", F.lit("P")).eqNullSafe(F.lit("F"))).select("o_orderkey")


@query("""SELECT CAST(count(*) FILTER (s IN ('F', 'O')) AS BIGINT) AS known, CAST(count(*) FILTER (s NOT IN ('F', 'O')) AS BIGINT) AS other, CAST(count(*) FILTER (s IS NULL OR s NOT IN ('F', 'O')) AS BIGINT) AS outside
FROM (SELECT nullif(o_orderstatus, 'O') AS s FROM orders)""")
def three_valued_in(t: Tables):
    s = F.nullif("o_orderstatus", F.lit("O"))
    return t.orders.agg(F.count_if(s.isin("F", "O")).alias("known"), F.count_if(~s.isin("F", "O")).alias("other"), F.count_if(s.isNull() | ~s.isin("F", "O")).alias("outside"))


@query("""SELECT o_orderkey, o_orderpriority IN (CASE WHEN o_orderstatus = 'F' THEN '1-URGENT' ELSE '' END, CASE WHEN o_totalprice > 100000 THEN '2-HIGH' ELSE '' END) AS member FROM orders""")
def list_membership_null_safe(t: Tables):
    members = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "F", "1-URGENT"), F.when(F.col("o_totalprice") > 100000, "2-HIGH")))
    return t.orders.select("o_orderkey", F.array_contains(members, F.col("o_orderpriority")).alias("member"))


@query("SELECT 'range_l_quantity' AS code, l_orderkey AS id, CAST(l_quantity AS VARCHAR) AS seen FROM lineitem WHERE NOT l_quantity BETWEEN 2 AND 49 UNION ALL SELECT 'range_l_discount', l_orderkey, CAST(l_discount AS VARCHAR) FROM lineitem WHERE NOT l_discount BETWEEN 0 AND 0.09")
def range_violations(t: Tables):
    found = rules.range_issues(t.lineitem, "l_orderkey", {"l_quantity": (2, 49), "l_discount": (0, 0.09)})
    return found.select("code", "id", "seen")


@query("SELECT 'range_c_acctbal' AS code, c_custkey AS id, CAST(c_acctbal AS VARCHAR) AS seen FROM customer WHERE c_acctbal <= 0")
def positivity_violations(t: Tables):
    return rules.positive_issues(t.customer, "c_custkey", ("c_acctbal",)).select("code", "id", "seen")


@query("SELECT 'vocabulary_event_type' AS code, event_id AS id, event_type AS seen FROM events WHERE event_type NOT IN ('click', 'view')")
def vocabulary_violations(t: Tables):
    return rules.vocabulary_issues(t.events, "event_id", {"event_type": ("click", "view")}).select("code", "id", "seen")


@query("""SELECT event_id AS id, f AS seen, 'vocabulary_flags' AS code FROM (SELECT event_id, unnest(CASE WHEN event_id % 4 = 0 THEN [] ELSE [event_type, 'x' || (event_id % 3)] END) AS f FROM events) WHERE f NOT IN ('click', 'view', 'x0', 'x1')""")
def array_vocab_violations(t: Tables):
    flags = F.when(F.col("event_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("event_type", F.concat(F.lit("x"), (F.col("event_id") % 3).cast("string"))))
    return rules.vocabulary_issues(t.events.select("event_id", flags.alias("flags")), "event_id", {"flags": ("click", "view", "x0", "x1")}).select("code", "id", "seen")


@query("""SELECT 'dangling_order' AS code, l_orderkey AS id, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")
def fk_violation_report(t: Tables):
    dangling = rules.dangling(t.lineitem.select("l_orderkey"), "l_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey", "dangling_order")
    return dangling.groupBy("code", "id").agg(F.count("*").alias("n"))


@query("SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def pk_duplicate_excess(t: Tables):
    return rules.duplicate_excess(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def composite_key_unique(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("""SELECT 'price_not_positive' AS code, 'error' AS severity, o_orderkey AS id FROM orders WHERE o_totalprice <= 1000 UNION ALL
SELECT 'line_before_order', 'warning', l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate) UNION ALL
SELECT 'repeated_line', 'error', l_orderkey FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 2)""")
def cross_record_rules_report(t: Tables):
    def issue(df: DataFrame, code: str, severity: str, key: str) -> DataFrame:
        return df.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.col(key).alias("id"))

    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate < o_orderdate").select("l_orderkey").distinct()
    repeated = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 2")
    parts = [issue(t.orders.where("o_totalprice <= 1000"), "price_not_positive", "error", "o_orderkey"), issue(joined, "line_before_order", "warning", "l_orderkey"), issue(repeated, "repeated_line", "error", "l_orderkey")]
    return reduce(DataFrame.unionByName, parts)


@query("""SELECT 'quantity_positive' AS name, CAST(0 AS BIGINT) AS expected, CAST(count(*) FILTER (l_quantity <= 0) AS BIGINT) AS observed FROM lineitem UNION ALL
SELECT 'ship_after_1994', 0, CAST(count(*) FILTER (l_shipdate < TIMESTAMP '1995-06-01') AS BIGINT) FROM lineitem UNION ALL
SELECT 'lines_reference_orders', 0, CAST(count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS BIGINT) FROM lineitem""")
def invariant_table(t: Tables):
    def tally(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    fused = t.lineitem.agg(tally(F.col("l_quantity") <= 0, "quantity_positive"), tally(F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz"), "ship_after_1994"))
    broken = t.lineitem.select("l_orderkey").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.count("*").alias("observed")).select(F.lit("lines_reference_orders").alias("name"), "observed")
    return fused.unpivot([], fused.columns, "name", "observed").unionByName(broken).withColumn("expected", F.lit(0).cast("long"))


_DIGESTED = """concat('I', o_orderkey, ';I', o_custkey, ';', CASE WHEN o_orderstatus IS NULL THEN 'N;' ELSE concat('S', strlen(o_orderstatus), ':', o_orderstatus, ';') END, strftime(o_orderdate, 'T%Y-%m-%dT%H:%M:%S.%fZ;'), CASE WHEN o_totalprice > 200000 THEN 'B1;' ELSE 'B0;' END)"""


@query(f"""SELECT 'orders' AS name, sha256(concat('psd-canonical-content/2', chr(10), 'table:orders', chr(10), 'columns:o_orderkey,o_custkey,status,at,large', chr(10), 'excluded:', chr(10), 'rows:', count(*), chr(10), string_agg(row_, '' ORDER BY o_orderkey))) AS digest
FROM (SELECT *, {_DIGESTED} AS row_ FROM (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders))""")
def content_digest_rows(t: Tables):
    from tonnage.operators.integrity import content_digest

    rows = t.orders.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_orderdate").cast("timestamp").alias("at"), (F.col("o_totalprice") > 200000).alias("large"))
    return t.spark.createDataFrame([("orders", content_digest(rows, "orders", ["o_orderkey"]))], "name string, digest string")


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(bit_xor(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus), 1, 15)) AS BIGINT)) AS BIGINT) AS digest FROM orders")
def parallel_digest(t: Tables):
    row = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")), 1, 15), 16, 10).cast("long")
    return t.orders.agg(F.count("*").alias("n"), F.bit_xor(row).alias("digest"))


#: Labels with what the vocabulary makes of them by the rules of the ladder, worked out by hand.
LADDER = (
    ("squat", "exact_canonical", "canonical_identity", "squat", "squat", None),
    ("  LOW bar   Squat!", "exact_canonical", "canonical_identity", "low_bar_squat", "squat", None),
    ("Bench Variation", "partial_family", "curated_ambiguous", None, "bench", "unspecified_variation"),
    ("chest press", "ambiguous", "curated_ambiguous", None, "unknown", "unspecified_implement"),
    ("Comp Squat", "resolved_alias", "registered_alias", "squat", "squat", None),
    ("Conv DL", "resolved_alias", "registered_alias", "conventional_deadlift", "deadlift", None),
    ("legpress", "exact_canonical", "canonical_identity", "leg_press", "accessory", None),
    ("Flat Bench Press", "resolved_alias", "cross_source_alias", "bench", "bench", None),
    ("Sumo Deadlift?", "ambiguous", "question_form", None, "deadlift", "question_form_label"),
    ("Squat variations heavy", "partial_family", "generic_qualifier", None, "squat", "unspecified_variation"),
    ("Squat with friends", "partial_family", "family_keyword", None, "squat", "unknown_source_taxonomy"),
    ("swimming", "unmapped", "no_match", None, None, None),
    ("", "unmapped", "no_match", None, None, None),
    ("Wide grip bench 3x5", "resolved_alias", "structured_interpretation", "wide_grip_bench", "bench", None),
)


def _literal(x: str | None) -> str:
    return "NULL" if x is None else f"'{x}'"


@query("WITH l(k, raw_label, resolution_status, resolution_method, exercise_key, parent_lift, ambiguity_reason) AS (VALUES " + ", ".join(f"({k}, {', '.join(map(_literal, row))})" for k, row in enumerate(LADDER))
    + f") SELECT p_partkey, l.* EXCLUDE (k) FROM part JOIN l ON k = p_partkey % {len(LADDER)}")
def label_normalize_ladder(t: Tables):
    from tonnage.operators.exercises import vocabulary
    from tonnage.operators.labels import resolve

    labels = F.array(*(F.lit(row[0]) for row in LADDER))
    asked = t.part.select("p_partkey", F.get(labels, (F.col("p_partkey") % len(LADDER)).cast("int")).alias("raw_label"), F.lit("generic_csv").alias("source_system"))
    found = resolve(asked.select("raw_label", "source_system").distinct(), vocabulary())
    return asked.join(found, ["raw_label", "source_system"]).select("p_partkey", "raw_label", "resolution_status", "resolution_method", "exercise_key", "parent_lift", "ambiguity_reason")


#: Labels, and what normalization makes of them, worked out by hand.
NORMALIZED = (
    ("DB Bench-Press", "dumbbell benchpress"), ("Pause  Squats", "pause squat"), ("ＯＨＰ", "overheadpress"), ("Élévation latérale", "elevation laterale"), ("2ct bench", "2 count bench"),
    ("Good mornings", "goodmorning"), ("T-Bar rows", "t bar row"), ("lat pull down", "latpulldown"), ("???", ""), ("Lat Pulldowns", "latpulldown"), ("Straße", "strasse"),
)


@query("WITH l(k, raw_label, normalized_label) AS (VALUES " + ", ".join(f"({k}, '{raw}', '{text}')" for k, (raw, text) in enumerate(NORMALIZED)) + f") SELECT p_partkey, raw_label, normalized_label FROM part JOIN l ON k = p_partkey % {len(NORMALIZED)}")
def label_normal_form(t: Tables):
    from tonnage.operators.labels import parsed

    labels = F.array(*(F.lit(raw) for raw, _ in NORMALIZED))
    asked = t.part.select("p_partkey", F.get(labels, (F.col("p_partkey") % len(NORMALIZED)).cast("int")).alias("raw_label"))
    return asked.withColumn("p", parsed("raw_label")).select("p_partkey", "raw_label", F.col("p.text").alias("normalized_label"))


@query(f"""SELECT resolution_status, CAST(count(*) AS BIGINT) AS n FROM (VALUES {", ".join(f"({k}, '{row[1]}')" for k, row in enumerate(LADDER))}) l(k, resolution_status) JOIN part ON k = p_partkey % {len(LADDER)} GROUP BY resolution_status""")
def label_coverage(t: Tables):
    from tonnage.operators.labels import coverage

    return coverage(label_normalize_ladder(t))
