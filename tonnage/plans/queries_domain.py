"""The competition corpus over the driver's tables: each query calls the library's own function.

Orders make an export (:mod:`tonnage.plans.domain_rows`), the library builds its tables, histories and audit
from it; the oracle computes the same in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.plans import audit, corpus, history
from tonnage.plans.catalogue import Tables, query
from tonnage.plans.domain_rows import CORPUS, SOURCE_ID, export

BUILD = corpus.Build(SOURCE_ID, datetime(2025, 12, 1, tzinfo=timezone.utc))
SNAPSHOT = datetime(2015, 6, 1, tzinfo=timezone.utc)


def rows(t: Tables) -> DataFrame:
    return t.spark.sql(export("{orders}"), orders=t.orders)


def built(t: Tables) -> dict[str, DataFrame]:
    return corpus.build_tables(corpus.staged(rows(t), BUILD), BUILD)


def shown(t: Tables, report: dict) -> DataFrame:
    """The leaves of a report as (path, value), both text."""

    def leaves(path: str, x: object):
        if isinstance(x, dict):
            for k, v in x.items():
                yield from leaves(f"{path}/{k}" if path else str(k), v)
        elif not isinstance(x, list):
            yield path, "" if x is None else f"{x:.6f}" if isinstance(x, float) else str(x)

    return t.spark.createDataFrame(list(leaves("", report)), "path string, value string")


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _list(*paths: tuple[str, str], more: str = "") -> str:
    """Oracle of a report: path and the SQL of a scalar."""
    each = " UNION ALL ".join(f"SELECT '{path}' AS path, coalesce(CAST(({sql}) AS VARCHAR), '') AS value" for path, sql in paths)
    return f"{CORPUS} SELECT * FROM ({each}) q {more}"


def _buckets(path: str, relation: str, column: str, buckets: tuple) -> list[tuple[str, str]]:
    return [(f"{path}/{name}", f"SELECT count(*) FROM {relation} WHERE {column} >= {lo}" + (f" AND {column} <= {hi}" if hi is not None else "")) for name, lo, hi in buckets]


# Projections


@query(f"""{CORPUS} SELECT competition_id, athlete_id, competition_meet_id, concat('opl:row=', row_ordinal + 1) AS source_record_key, strftime(competition_date, '%Y-%m-%d') AS competition_date, competition_event, federation,
sanctioning_body, name, equipment_class_raw, equipment_class, weight_class_raw, bodyweight_kg, CASE WHEN bodyweight_kg IS NOT NULL THEN 'kg' END AS bodyweight_unit, participation_status, participation_status_kind, participation_place,
is_drug_tested_category, age_reported, age_precision, division_raw FROM c""")
def domain_competitions(t: Tables):
    found = built(t)["competition"]
    return found.select("competition_id", "athlete_id", "competition_meet_id", "source_record_key", _day("competition_date"), "competition_event", "federation", "sanctioning_body", "name", "equipment_class_raw", "equipment_class", "weight_class_raw", "bodyweight_kg", "bodyweight_unit", "participation_status", "participation_status_kind", "participation_place", "is_drug_tested_category", "age_reported", "age_precision", "division_raw")


@query(f"""{CORPUS} SELECT competition_attempt_id, competition_id, athlete_id, lift, CAST(attempt_number AS BIGINT) AS attempt_number, attempt_role, source_attempt_raw, load_kg AS load_raw, 'kg' AS load_unit, load_kg, result, attempt_number = 1 AS is_opener FROM a""")
def domain_attempts(t: Tables):
    return built(t)["competition_attempt"].select("competition_attempt_id", "competition_id", "athlete_id", "lift", "attempt_number", "attempt_role", "source_attempt_raw", "load_raw", "load_unit", "load_kg", "result", "is_opener")


@query(f"{CORPUS} SELECT competition_reported_result_id, competition_id, athlete_id, result_kind, value, unit, source_value_raw, reported_best_semantics, false AS is_derived FROM v")
def domain_reported_results(t: Tables):
    return built(t)["competition_reported_result"].select("competition_reported_result_id", "competition_id", "athlete_id", "result_kind", "value", "unit", "source_value_raw", "reported_best_semantics", "is_derived")


@query(f"""{CORPUS} SELECT athlete_id, sex_category_raw, CASE sex_category_raw WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' WHEN 'Mx' THEN 'other_self_described' END AS sex_category,
CASE WHEN torn THEN 'opl-name-conflict:' || name END AS ambiguity_group_id, CASE WHEN torn THEN 'ambiguous_identity' ELSE '' END AS flags FROM p""")
def domain_athletes(t: Tables):
    return built(t)["athlete"].select("athlete_id", "sex_category_raw", "sex_category", "ambiguity_group_id", F.concat_ws(",", "quality_flags").alias("flags"))


@query(f"{CORPUS} SELECT athlete_id, name AS source_athlete_key, name AS source_record_key, 'exact_attribute_match' AS link_method FROM p")
def domain_athlete_links(t: Tables):
    return built(t)["athlete_source_link"].select("athlete_id", "source_athlete_key", "source_record_key", "link_method")


@query(f"{CORPUS} SELECT competition_meet_id, meet_name, strftime(meet_date, '%Y-%m-%d') AS meet_date, meet_federation, meet_parent_federation, meet_town, is_sanctioned FROM m")
def domain_meets(t: Tables):
    return built(t)["competition_meet"].select("competition_meet_id", "meet_name", _day("meet_date"), "meet_federation", "meet_parent_federation", "meet_town", "is_sanctioned")


_BAD = "regexp_full_match({0}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')"
_ATTEMPT_CELLS = [f"{lift}{n}Kg" for lift in ("Squat", "Bench", "Deadlift") for n in (1, 2, 3, 4)]
_RESULT_CELLS = ["Best3SquatKg", "Best3BenchKg", "Best3DeadliftKg", "TotalKg", "Dots", "Wilks", "Glossbrenner", "Goodlift"]


def _counted(columns: list[str], name: str) -> str:
    unread = " + ".join(f"count(*) FILTER ({c} <> '' AND NOT {_BAD.format(c)})" for c in columns)
    zero = " + ".join(f"count(*) FILTER ({c} = '0')" for c in columns)
    return f"CAST({unread} AS BIGINT) AS {name}_unparseable, CAST({zero} AS BIGINT) AS {name}_zero"


@query(f"""WITH x AS ({export("orders")}) SELECT count(*) AS source_rows, {_counted(_ATTEMPT_CELLS, "attempt_values")}, {_counted(_RESULT_CELLS, "reported_values")}, count(*) FILTER (Age = 'abc') AS ages_unparseable,
count(*) FILTER (BodyweightKg <> '' AND NOT {_BAD.format("BodyweightKg")}) AS bodyweights_unparseable, count(*) FILTER (TRY_CAST(Date AS DATE) IS NULL) AS dates_unparseable, count(*) FILTER (Federation = '') AS rows_without_federation, count(*) FILTER (length(Division) > 256) AS values_too_long FROM x""")
def domain_build_counters(t: Tables):
    return corpus.counters(rows(t))


@query(f"""WITH x AS ({export("orders")}) SELECT 'Event' AS "column", Event AS value, count(*) AS n FROM x WHERE Event = 'X' GROUP BY ALL UNION ALL SELECT 'Equipment', Equipment, count(*) FROM x WHERE Equipment = 'Novel' GROUP BY ALL
UNION ALL SELECT 'Sanctioned', Sanctioned, count(*) FROM x WHERE Sanctioned = 'Maybe' GROUP BY ALL UNION ALL SELECT 'Sex', Sex, count(*) FROM x WHERE Sex = 'Q' GROUP BY ALL""")
def domain_unrecognised(t: Tables):
    return corpus.unrecognised(rows(t))


# Histories

_DISTINCT = {"event": "competition_event", "equipment_class": "equipment_class", "federation": "federation", "sanctioning_body": "sanctioning_body"}
_PLACE = "{'u': competition_date IS NULL, 'd': competition_date, 'm': competition_meet_id, 'c': competition_id}"


@query(f"""{CORPUS}, h AS (
  SELECT athlete_id, strftime(min(competition_date), '%Y-%m-%d') AS first_competition_date, strftime(max(competition_date), '%Y-%m-%d') AS last_competition_date, arg_min(competition_id, {_PLACE}) AS first_competition_id, arg_max(competition_id, {_PLACE}) AS last_competition_id,
    count(DISTINCT competition_meet_id) AS meet_count, count(*) AS competition_count, {", ".join(f"count(*) FILTER (competition_event IN {events}) AS {lift}_competition_count" for lift, events in history.CONTESTED.items())},
    {", ".join(f"count(DISTINCT {c}) AS distinct_{k}_count" for k, c in _DISTINCT.items())}, count(bodyweight_kg) AS bodyweight_count, count(age_reported) AS age_count, count(*) FILTER (is_drug_tested_category) AS tested_count,
    CAST(date_diff('day', min(competition_date), max(competition_date)) AS BIGINT) AS span_days, count(DISTINCT competition_meet_id) FILTER (competition_id IN (SELECT competition_id FROM a)) AS attempt_detail_meet_count
  FROM c GROUP BY athlete_id)
SELECT h.*, (SELECT count(*) FROM v WHERE v.athlete_id = h.athlete_id AND result_kind = 'total') AS reported_total_count, torn AS is_ambiguous_identity, attempt_detail_meet_count / meet_count AS attempt_detail_fraction FROM h JOIN p USING (athlete_id)""")
def domain_histories(t: Tables):
    found = history.athlete_histories(built(t)).drop("sex_category", "identity_status")
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_competition_date", "last_competition_date")})


# Audit


@query(_list(*((f"rows/{name}", f"SELECT count(*) FROM {r}") for name, r in {"athlete": "p", "athlete_source_link": "p", "competition_meet": "m", "competition": "c", "competition_attempt": "a", "competition_reported_result": "v"}.items()), *((f"duplicate_key_excess/{n}", "0") for n in ("athlete", "athlete_source_link", "competition_meet", "competition", "competition_attempt", "competition_reported_result")),
    ("with_attempts", "SELECT count(DISTINCT competition_id) FROM a"), ("with_total", "SELECT count(DISTINCT competition_id) FROM v WHERE result_kind = 'total'"), ("without_result", "SELECT count(*) FROM c WHERE competition_id NOT IN (SELECT competition_id FROM v)")))
def audit_entities(t: Tables):
    return shown(t, audit.entities(built(t)))


def _covered(path: str, relation: str, column: str, top: int = 40) -> str:
    counts = f"(SELECT CAST({column} AS VARCHAR) AS k, count(*) AS n FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n DESC, {column} LIMIT {top})"
    return f"""SELECT '{path}/top/' || k AS path, CAST(n AS VARCHAR) AS value FROM {counts} UNION ALL SELECT '{path}/distinct', CAST(count(DISTINCT {column}) AS VARCHAR) FROM {relation}
UNION ALL SELECT '{path}/absent', CAST(count(*) - count({column}) AS VARCHAR) FROM {relation} UNION ALL SELECT '{path}/remainder', CAST((SELECT count({column}) FROM {relation}) - (SELECT coalesce(sum(n), 0) FROM {counts}) AS VARCHAR)"""


_WITH_YEAR = "(SELECT *, year(competition_date) AS year FROM c)"
_SEXED = "(SELECT *, CASE sex_category_raw WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' WHEN 'Mx' THEN 'other_self_described' END AS sex_category FROM p)"


@query(CORPUS + " UNION ALL ".join([*(_covered(k, _WITH_YEAR, k) for k in ("year", "federation", "sanctioning_body", "competition_event", "equipment_class", "equipment_class_raw")), _covered("sex_category", _SEXED, "sex_category"), "SELECT 'undated', CAST(count(*) AS VARCHAR) FROM c WHERE competition_date IS NULL"]))
def audit_coverage(t: Tables):
    return shown(t, audit.coverages(built(t)))


_CAREERS = "(SELECT athlete_id, count(DISTINCT competition_meet_id) AS meets, date_diff('day', min(competition_date), max(competition_date)) AS span FROM c GROUP BY athlete_id)"


@query(_list(("athletes", f"SELECT count(*) FROM {_CAREERS}"), ("one", f"SELECT count(*) FROM {_CAREERS} WHERE meets = 1"), ("two_to_four", f"SELECT count(*) FROM {_CAREERS} WHERE meets BETWEEN 2 AND 4"), ("five_to_nine", f"SELECT count(*) FROM {_CAREERS} WHERE meets BETWEEN 5 AND 9"),
    ("ten_or_more", f"SELECT count(*) FROM {_CAREERS} WHERE meets >= 10"), ("most_meets", f"SELECT max(meets) FROM {_CAREERS}"), ("longest_span", f"SELECT max(span) FROM {_CAREERS}"), ("no_dated_meets", f"SELECT count(*) FROM {_CAREERS} WHERE span IS NULL"),
    ("multi_meet", f"SELECT count(*) FROM {_CAREERS} WHERE meets > 1"), *_buckets("meets", _CAREERS, "meets", audit.MEET_BUCKETS), *_buckets("spans", _CAREERS, "span", audit.SPAN_BUCKETS)))
def audit_longitudinal(t: Tables):
    return shown(t, audit.longitudinal(built(t)))


_PER = "(SELECT competition_id, count(*) AS n FROM a GROUP BY competition_id)"
_CONTESTS = "(VALUES " + ", ".join(f"('{event}', '{lift}')" for lift, events in history.CONTESTED.items() for event in events) + ") k(competition_event, lift)"


def _tried(path: str, column: str) -> str:
    groups = f"(SELECT {column} AS k, count(*) AS n, count(q.n) AS w FROM {_WITH_YEAR} y LEFT JOIN {_PER} q USING (competition_id) GROUP BY {column} ORDER BY n DESC, {column} NULLS FIRST LIMIT 40)"
    return " UNION ALL ".join(f"SELECT '{path}/' || coalesce(CAST(k AS VARCHAR), 'None') || '/{name}', {sql} FROM {groups}" for name, sql in (("competitions", "CAST(n AS VARCHAR)"), ("with_attempts", "CAST(w AS VARCHAR)"), ("fraction", "format('{:.6f}', w / n)")))


@query(_list(("attempts", "SELECT count(*) FROM a"), ("failed", "SELECT count(*) FROM a WHERE result = 'bad_lift'"), ("fourth", "SELECT count(*) FROM a WHERE attempt_number = 4"), ("competitions", "SELECT count(*) FROM c"), ("with_attempts", "SELECT count(DISTINCT competition_id) FROM a"),
    ("fraction", "SELECT format('{:.6f}', (SELECT count(DISTINCT competition_id) FROM a) / (SELECT count(*) FROM c))"), ("failed_rate", "SELECT format('{:.6f}', count(*) FILTER (result = 'bad_lift') / count(*)) FROM a"), ("fourth_rate", "SELECT format('{:.6f}', count(*) FILTER (attempt_number = 4) / count(*)) FROM a"),
    *((f"fourth_by_lift/{x}", f"SELECT count(*) FROM a WHERE attempt_number = 4 AND lift = '{x}'") for x in history.CONTESTED),
    ("no_contested_lift", f"SELECT count(*) FROM c WHERE competition_event IS NOT NULL AND competition_id IN (SELECT competition_id FROM a) AND competition_id NOT IN (SELECT competition_id FROM a JOIN c USING (competition_id) JOIN {_CONTESTS} USING (competition_event, lift))"),
    more=f"UNION ALL SELECT 'per_competition/' || n, CAST(count(*) AS VARCHAR) FROM {_PER} GROUP BY n UNION ALL {_tried('by_federation', 'federation')} UNION ALL {_tried('by_year', 'year')}"))
def audit_attempts(t: Tables):
    return shown(t, audit.attempts(built(t)))


_WIDE = "(SELECT competition_id, " + ", ".join(f"max(value) FILTER (result_kind = '{k}') AS {k}" for k in ("squat_best", "bench_best", "deadlift_best", "total")) + " FROM v GROUP BY competition_id)"
_OFF = f"(SELECT *, abs(total - squat_best - bench_best - deadlift_best) AS off, competition_id IN (SELECT competition_id FROM a WHERE attempt_number = 4) AS fourth FROM {_WIDE})"


@query(_list(("totals", f"SELECT count(total) FROM {_OFF}"), ("complete", f"SELECT count(off) FROM {_OFF}"), ("agreeing", f"SELECT count(*) FROM {_OFF} WHERE off <= 0.0005"), ("differing", f"SELECT count(*) FROM {_OFF} WHERE off > 0.0005"), ("fourth_and_total", f"SELECT count(*) FROM {_OFF} WHERE fourth AND total IS NOT NULL"),
    ("fourth_and_agreeing", f"SELECT count(*) FROM {_OFF} WHERE fourth AND off <= 0.0005"), ("bests_without_total", f"SELECT count(*) FROM {_OFF} WHERE total IS NULL AND coalesce(squat_best, bench_best, deadlift_best) IS NOT NULL"), ("negative_bests", "SELECT count(*) FROM v WHERE source_value_raw < 0"),
    *((f"negative_by_kind/{k}", f"SELECT count(*) FROM v WHERE source_value_raw < 0 AND result_kind = '{k}'") for k in ("squat_best", "bench_best", "deadlift_best")), ("derived", "0")))
def audit_performance(t: Tables):
    return shown(t, audit.performance(built(t)))


@query(_list(("competitions", "SELECT count(*) FROM c"), ("bodyweights", "SELECT count(bodyweight_kg) FROM c"), ("bodyweight_fraction", "SELECT format('{:.6f}', count(bodyweight_kg) / count(*)) FROM c"), ("ages_exact", "SELECT count(*) FROM c WHERE age_precision = 'exact'"),
    ("ages_approximate", "SELECT count(*) FROM c WHERE age_precision = 'approximate'"), ("ages_missing", "SELECT count(*) FROM c WHERE age_reported IS NULL"), ("weight_classes", "SELECT count(weight_class_raw) FROM c"), ("distinct_weight_classes", "SELECT count(DISTINCT weight_class_raw) FROM c"),
    ("open_ended_classes", "SELECT count(*) FROM c WHERE weight_class_raw = '90+'"), ("tested", "SELECT count(*) FROM c WHERE is_drug_tested_category"), ("untested", "0"), ("tested_unknown", "SELECT count(*) FROM c WHERE is_drug_tested_category IS NULL"),
    ("sanctioned", "SELECT count(*) FROM m WHERE is_sanctioned"), ("unsanctioned", "SELECT count(*) FROM m WHERE NOT is_sanctioned"), ("sanction_unknown", "SELECT count(*) FROM m WHERE is_sanctioned IS NULL")))
def audit_athlete_context(t: Tables):
    return shown(t, audit.athlete_context(built(t)))


_SHARED = "(SELECT lower(trim(meet_name)) || '|' || lower(meet_town) AS k FROM m GROUP BY k HAVING count(*) > 1)"


@query(_list(("undated", "SELECT count(*) FROM c WHERE competition_date IS NULL"), ("earliest", "SELECT strftime(min(competition_date), '%Y-%m-%dT%H:%M:%SZ') FROM c"), ("latest", "SELECT strftime(max(competition_date), '%Y-%m-%dT%H:%M:%SZ') FROM c"),
    ("unknown_places", "SELECT count(*) FROM c WHERE participation_status_kind = 'unknown'"), ("places_not_positive", "0"), ("unknown_events", "0"), ("unknown_equipment", "SELECT count(*) FROM c WHERE equipment_class = 'unknown'"), ("suffixed_names", "SELECT count(*) FROM p WHERE contains(name, '#')"),
    ("sex_conflicts", "SELECT count(*) FROM p WHERE torn"), ("sex_absent", "SELECT count(*) FROM p WHERE coalesce(sex_category_raw, 'Q') = 'Q'"), ("place_collisions", f"SELECT count(*) FROM {_SHARED}"), ("date_disagrees_with_meet", "0"),
    ("unknown_place_values/distinct", "SELECT count(DISTINCT participation_status) FROM c WHERE participation_status_kind = 'unknown'"), ("unexpected_event_values/distinct", "1"), ("unexpected_event_values/values/None", "SELECT count(*) FROM c WHERE competition_event IS NULL"),
    ("unexpected_equipment_values/distinct", "1"), ("unexpected_equipment_values/values/Novel", "SELECT count(*) FROM c WHERE equipment_class_raw = 'Novel'"), ("unexpected_sex_values/distinct", "SELECT CAST(max(sex_category_raw = 'Q') AS INT) FROM p"),
    more="UNION ALL SELECT 'unknown_place_values/values/' || participation_status, CAST(count(*) AS VARCHAR) FROM c WHERE participation_status_kind = 'unknown' AND participation_status IS NOT NULL GROUP BY participation_status UNION ALL SELECT 'unexpected_sex_values/values/Q', CAST(count(*) AS VARCHAR) FROM p WHERE sex_category_raw = 'Q' HAVING count(*) > 0"))
def audit_anomalies(t: Tables):
    return shown(t, audit.anomalies(built(t)))


@query(f"""{CORPUS} SELECT lower(trim(meet_name)) || '|' || lower(meet_town) || '||usa' AS place_key, count(*) AS meets, strftime(min(meet_date), '%Y-%m-%d') AS first_date, strftime(max(meet_date), '%Y-%m-%d') AS last_date FROM m GROUP BY place_key HAVING count(*) > 1""")
def audit_place_collisions(t: Tables):
    found = audit.shared_places(built(t)["competition_meet"])
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_date", "last_date")})


_BASES = "(SELECT split_part(name, '#', 1) AS base, count(DISTINCT athlete_id) AS members, count(*) FILTER (NOT contains(name, '#')) AS unsuffixed FROM p GROUP BY base HAVING count(DISTINCT athlete_id) > 1)"


@query(_list(("base_groups", f"SELECT count(*) FROM {_BASES}"), ("largest_group", f"SELECT max(members) FROM {_BASES}"), ("with_unsuffixed_member", f"SELECT count(*) FROM {_BASES} WHERE unsuffixed > 0"), ("identities", "SELECT count(*) FROM p"), ("names_with_several_ids", "0"), ("ids_with_several_names", "0"),
    ("disambiguated", "SELECT count(*) FROM p WHERE contains(name, '#')"), *_buckets("sizes", _BASES, "members", audit.NAME_BUCKETS)))
def audit_identity(t: Tables):
    return shown(t, audit.identity(built(t)))


@query(f"""{CORPUS}, s AS (SELECT athlete_id, competition_id AS observation, age_precision, year(competition_date) - CAST(floor(age_reported) AS BIGINT) AS y FROM c WHERE age_reported IS NOT NULL AND competition_date IS NOT NULL)
SELECT athlete_id, observation, y AS year FROM s WHERE age_precision = 'exact' UNION ALL SELECT athlete_id, observation, y - 1 FROM s""")
def audit_birth_years(t: Tables):
    return audit.birth_years(built(t)["competition"])


_YEARS = "(SELECT athlete_id, competition_id AS o, unnest(CASE WHEN age_precision = 'exact' THEN [year(competition_date) - CAST(floor(age_reported) AS BIGINT), year(competition_date) - CAST(floor(age_reported) AS BIGINT) - 1] ELSE [year(competition_date) - CAST(floor(age_reported) AS BIGINT) - 1] END) AS y FROM c WHERE age_reported IS NOT NULL AND competition_date IS NOT NULL)"
_SEEN = f"(SELECT athlete_id, count(DISTINCT o) AS n FROM {_YEARS} GROUP BY athlete_id)"


@query(_list(("age_observations", f"SELECT CAST(sum(n) AS BIGINT) FROM {_SEEN}"), ("with_age", f"SELECT count(*) FROM {_SEEN}"), ("with_several_ages", f"SELECT count(*) FROM {_SEEN} WHERE n > 1"),
    ("inconsistent_ages", f"SELECT count(*) FROM {_SEEN} s WHERE athlete_id NOT IN (SELECT athlete_id FROM (SELECT athlete_id, y, count(DISTINCT o) AS q FROM {_YEARS} GROUP BY athlete_id, y) JOIN {_SEEN} USING (athlete_id) WHERE q = n)"),
    ("meets_with_several_dates", "0"), ("future_competitions", "SELECT count(*) FROM c WHERE competition_date > TIMESTAMP '2015-06-01'"), ("future_meets", "SELECT count(*) FROM m WHERE meet_date > TIMESTAMP '2015-06-01'")))
def audit_chronology(t: Tables):
    return shown(t, audit.chronology(built(t), SNAPSHOT))


def _changed(name: str) -> list[tuple[str, str]]:
    states = f"(SELECT athlete_id, competition_meet_id, min(competition_date) AS d, count(DISTINCT {name}) AS n, CASE WHEN count(DISTINCT {name}) = 1 THEN min({name}) END AS state FROM c GROUP BY athlete_id, competition_meet_id)"
    moved = f"(SELECT *, last_value(state IGNORE NULLS) OVER (PARTITION BY athlete_id ORDER BY d NULLS LAST, competition_meet_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {states})"
    per = f"(SELECT athlete_id, count(*) FILTER (state <> before) AS changes FROM {moved} GROUP BY athlete_id)"
    return [(f"{name}/meets", f"SELECT count(*) FROM {states}"), (f"{name}/known", f"SELECT count(state) FROM {states}"), (f"{name}/conflicts", f"SELECT count(*) FROM {states} WHERE n > 1"), (f"{name}/changes", f"SELECT CAST(sum(changes) AS BIGINT) FROM {per}"), (f"{name}/athletes_with_change", f"SELECT count(*) FROM {per} WHERE changes > 0"), *_buckets(f"{name}/distribution", per, "changes", audit.TRANSITION_BUCKETS)]


@query(_list(*(x for name in audit.TRANSITION_FIELDS for x in _changed(name))))
def audit_transitions(t: Tables):
    return shown(t, audit.transitions(built(t)))


# Invariants and units, over a corpus with planted faults

_FAULTS = {"a": "CASE WHEN attempt_number = 2 THEN 'good_lift' ELSE result END", "load": "CASE WHEN lift = 'bench' AND attempt_number = 3 THEN NULL WHEN lift = 'squat' AND attempt_number = 1 THEN 0.0 ELSE load_kg END"}


def tampered(t: Tables) -> dict[str, DataFrame]:
    """The corpus with signs, loads, units, values and references that are wrong."""
    d = built(t)
    a, r, c = d["competition_attempt"], d["competition_reported_result"], d["competition"]
    number = F.substring("source_record_key", 9, 20).cast("long") - 1
    d["competition_attempt"] = a.withColumns({"result": F.expr(_FAULTS["a"]), "load_kg": F.expr(_FAULTS["load"]), "load_unit": F.when(number % 5 > 0, F.col("load_unit")), "attempt_role": F.when(number % 7 == 0, "ordered").otherwise(F.col("attempt_role"))})
    d["competition_reported_result"] = r.withColumns({"value": F.when(number % 11 > 0, F.when(number % 13 == 0, -F.col("value")).otherwise(F.col("value"))), "unit": F.when(number % 3 == 0, F.lit("lb")).when(F.col("result_kind") == "dots", "kg").otherwise(F.col("unit")), "reported_best_semantics": F.when(F.col("result_kind") == "bench_best", "failed_attempt_only").otherwise(F.col("reported_best_semantics"))})
    d["competition"] = c.where(number % 29 > 0).withColumns({"bodyweight_kg": F.when(number % 6 == 0, F.col("bodyweight_kg") + 1).when(F.col("bodyweight_kg").isNull(), 0.0).otherwise(F.col("bodyweight_kg")), "bodyweight_unit": F.when(number % 2 == 0, F.col("bodyweight_unit"))})
    d["competition_meet"] = d["competition_meet"].where("meet_town <> 'T3'")
    return d


_TAMPERED = f"""{CORPUS},
o AS (SELECT competition_id, row_ordinal AS k FROM c),
ta AS (SELECT a.* REPLACE ({_FAULTS["a"]} AS result, {_FAULTS["load"]} AS load_kg, CASE WHEN k % 7 = 0 THEN 'ordered' ELSE attempt_role END AS attempt_role), load_kg AS load_raw, CASE WHEN k % 5 > 0 THEN 'kg' END AS load_unit FROM a JOIN o USING (competition_id)),
tv AS (SELECT v.* REPLACE (CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN -value ELSE value END AS value, CASE WHEN k % 3 = 0 THEN 'lb' WHEN result_kind = 'dots' THEN 'kg' ELSE unit END AS unit, CASE WHEN result_kind = 'bench_best' THEN 'failed_attempt_only' ELSE reported_best_semantics END AS reported_best_semantics) FROM v JOIN o USING (competition_id)),
tc AS (SELECT c.* REPLACE (CASE WHEN row_ordinal % 6 = 0 THEN bodyweight_kg + 1 WHEN bodyweight_kg IS NULL THEN 0.0 ELSE bodyweight_kg END AS bodyweight_kg), bodyweight_kg AS bodyweight_raw, CASE WHEN row_ordinal % 2 = 0 AND bodyweight_kg IS NOT NULL THEN 'kg' END AS bodyweight_unit FROM c WHERE row_ordinal % 29 > 0),
tm AS (SELECT * FROM m WHERE meet_town <> 'T3')"""
_ZEROS = ("results_not_derived", "places_positive", "approximate_ages_fractional", "attempt_numbers_unique")


def _tallies(*named: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, CAST(({sql}) AS BIGINT) AS observed" for name, sql in named)


@query(f"""{_TAMPERED} SELECT name, CAST(0 AS BIGINT) AS expected, observed FROM ({_tallies(
    ("attempt_loads_positive", "SELECT count(*) FROM ta WHERE load_kg <= 0"), ("attempt_sign_agrees_with_result", "SELECT count(*) FROM ta WHERE (source_attempt_raw > 0) <> (result = 'good_lift')"), ("fourth_attempts_are_record_attempts", "SELECT count(*) FROM ta WHERE (attempt_number = 4) <> (attempt_role = 'record_fourth')"),
    ("best_sign_agrees_with_semantics", "SELECT count(*) FROM tv WHERE result_kind LIKE '%best' AND (source_value_raw < 0) <> (reported_best_semantics = 'failed_attempt_only')"), ("result_values_not_negative", "SELECT count(*) FROM tv WHERE value < 0"), ("bodyweights_positive", "SELECT count(*) FROM tc WHERE bodyweight_kg <= 0"),
    ("attempts_reference_a_competition", "SELECT count(*) FROM ta WHERE competition_id NOT IN (SELECT competition_id FROM tc)"), ("results_reference_a_competition", "SELECT count(*) FROM tv WHERE competition_id NOT IN (SELECT competition_id FROM tc)"), ("competitions_reference_a_meet", "SELECT count(*) FROM tc WHERE competition_meet_id NOT IN (SELECT competition_meet_id FROM tm)"),
    ("athletes_have_a_competition", "SELECT count(*) FROM p WHERE athlete_id NOT IN (SELECT athlete_id FROM tc)"), ("attempts_inside_declared_event", f"SELECT count(*) FROM ta JOIN tc USING (competition_id) WHERE competition_event IS NOT NULL AND (competition_event, lift) NOT IN (SELECT (competition_event, lift) FROM {_CONTESTS})"), *((x, "0") for x in _ZEROS))}) q""")
def audit_invariants(t: Tables):
    return audit.invariants(tampered(t))


_LOAD = "load_kg IS NULL OR abs(load_kg - abs(source_attempt_raw)) > 1e-9 OR abs(load_kg - load_raw) > 1e-9"


@query(f"""{_TAMPERED} {_tallies(
    ("bodyweight_rows_checked", "SELECT count(bodyweight_raw) FROM tc"), ("bodyweight_kg_mismatches", "SELECT count(*) FROM tc WHERE bodyweight_raw IS NOT NULL AND (bodyweight_kg IS NULL OR abs(bodyweight_kg - bodyweight_raw) > 1e-9)"), ("bodyweight_unit_mismatches", "SELECT count(*) FROM tc WHERE bodyweight_raw IS NOT NULL AND bodyweight_unit IS DISTINCT FROM 'kg'"),
    ("bodyweight_absent_became_zero", "SELECT count(*) FROM tc WHERE bodyweight_raw IS NULL AND bodyweight_kg = 0"), ("open_ended_weight_classes", "SELECT count(*) FROM tc WHERE weight_class_raw = '90+'"), ("open_ended_weight_classes_coerced", "0"), ("attempt_rows_checked", "SELECT count(*) FROM ta"),
    ("attempt_load_kg_mismatches", f"SELECT count(*) FROM ta WHERE {_LOAD}"), ("attempt_sign_result_mismatches", "SELECT count(*) FROM ta WHERE (source_attempt_raw > 0) <> (result = 'good_lift')"), ("attempt_unit_mismatches", "SELECT count(*) FROM ta WHERE load_unit IS NULL"), ("attempt_loads_not_positive", "SELECT count(*) FROM ta WHERE load_kg <= 0"),
    ("reported_rows_checked", "SELECT count(*) FROM tv"), ("reported_value_mismatches", "SELECT count(*) FROM tv WHERE value IS NULL OR abs(abs(source_value_raw) - value) > 1e-9"), ("reported_mass_rows_checked", "SELECT count(*) FROM tv WHERE result_kind LIKE '%best' OR result_kind = 'total'"),
    ("reported_mass_unit_mismatches", "SELECT count(*) FROM tv WHERE (result_kind LIKE '%best' OR result_kind = 'total') AND unit IS DISTINCT FROM 'kg'"), ("reported_best_rows_checked", "SELECT count(*) FROM tv WHERE result_kind LIKE '%best'"),
    ("reported_best_semantics_mismatches", "SELECT count(*) FROM tv WHERE result_kind LIKE '%best' AND (source_value_raw < 0) <> (reported_best_semantics = 'failed_attempt_only')"), ("reported_totals_checked", "SELECT count(*) FROM tv WHERE result_kind = 'total'"), ("reported_total_unit_mismatches", "SELECT count(*) FROM tv WHERE result_kind = 'total' AND unit IS DISTINCT FROM 'kg'"),
    ("scoring_rows_checked", "SELECT count(*) FROM tv WHERE NOT (result_kind LIKE '%best' OR result_kind = 'total')"), ("scoring_rows_claiming_a_mass_unit", "SELECT count(*) FROM tv WHERE NOT (result_kind LIKE '%best' OR result_kind = 'total') AND unit = 'kg'"))}""")
def audit_unit_fidelity(t: Tables):
    return audit.unit_counters(tampered(t))

