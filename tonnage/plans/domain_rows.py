"""A competition export made from the driver's orders, and the same corpus in plain SQL.

The export is one statement that Spark and the oracle's engine both run.  What follows it here is SQL
alone, written from the rules and not from the library: the oracles of :mod:`tonnage.plans.queries_domain`.
"""

from __future__ import annotations

SOURCE_ID = "openpowerlifting_0123456789abcdef"


def _choice(key: str, *values: str) -> str:
    """One of ``values`` by the remainder of ``key``."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


def _attempt(i: int, fourth: bool) -> str:
    made = f"concat(60 + (k * {i + 1}) % 180, '')"
    cell = f"CASE WHEN (k + {i}) % 6 = 0 THEN '' WHEN (k * {i + 2}) % 7 = 0 THEN concat('-', {made}) WHEN (k + {i}) % 97 = 0 THEN '0' WHEN (k + {i}) % 89 = 0 THEN '60.0d' ELSE {made} END"
    return f"CASE WHEN k % 10 <> 0 THEN '' ELSE {cell} END" if fourth else cell


def _best(low: int, width: int, gap: int) -> str:
    return f"CASE WHEN k % {gap} = 0 THEN '' WHEN k % 23 = 0 THEN concat('-', {low} + k % {width}) ELSE concat({low} + k % {width}, '') END"


_CELLS = {
    "Name": "concat('Athlete ', c % 700, CASE WHEN c % 5 = 0 THEN concat('#', 1 + c % 2) ELSE '' END)",
    "Sex": "CASE WHEN c % 41 = 0 AND k % 2 = 0 THEN 'Mx' WHEN c % 43 = 0 THEN '' WHEN c % 47 = 0 THEN 'Q' WHEN c % 2 = 0 THEN 'M' ELSE 'F' END",
    "Event": _choice("k", "SBD", "BD", "SD", "SB", "S", "B", "D", "SBD", "X"),
    "Equipment": _choice("k", "Raw", "Wraps", "Single-ply", "Multi-ply", "Unlimited", "Straps", "Novel"),
    "Age": "CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN 'abc' ELSE concat(18 + (c + k) % 50, CASE WHEN k % 3 = 0 THEN '.5' ELSE '' END) END",
    "AgeClass": "''", "BirthYearClass": "''",
    "Division": "CASE WHEN k % 500 = 7 THEN repeat('x', 300) ELSE 'Open' END",
    "BodyweightKg": "CASE WHEN k % 17 = 0 THEN '0' WHEN k % 19 = 0 THEN '' ELSE concat(50 + k % 90, '.5') END",
    "WeightClassKg": _choice("k", "90+", "-105", "82.5", ""),
} | {
    f"{lift}{n}Kg": _attempt(4 * j + n, n == 4) for j, lift in enumerate(("Squat", "Bench", "Deadlift")) for n in (1, 2, 3, 4)
} | {
    "Best3SquatKg": _best(100, 150, 8), "Best3BenchKg": _best(60, 100, 9), "Best3DeadliftKg": _best(120, 160, 10),
    "TotalKg": "CASE WHEN k % 5 = 0 THEN '' ELSE concat(280 + k % 150 + k % 100 + k % 160 + CASE WHEN k % 3 = 0 THEN 5 ELSE 0 END, '') END",
    "Place": "CASE WHEN k % 31 = 0 THEN 'DQ' WHEN k % 37 = 0 THEN 'G' WHEN k % 41 = 0 THEN '0.5' WHEN k % 43 = 0 THEN '?' WHEN k % 47 = 0 THEN '' ELSE concat(1 + k % 20, '') END",
    "Dots": "concat(200 + k % 300, '.25')", "Wilks": "''", "Glossbrenner": "CASE WHEN k % 6 = 0 THEN '0' ELSE '' END", "Goodlift": "CASE WHEN k % 2 = 0 THEN concat(50 + k % 60, '.5') ELSE '' END",
    "Tested": "CASE WHEN k % 3 = 0 THEN 'Yes' ELSE '' END", "Country": "'USA'", "State": "''",
    "Federation": "CASE WHEN m % 13 = 0 THEN '' ELSE concat('F', m % 7) END", "ParentFederation": "CASE WHEN m % 3 = 0 THEN 'IPF' ELSE '' END",
    "Date": "CASE WHEN m = 59 THEN '2011-13-40' ELSE concat(2000 + m % 20, '-', lpad(CAST(1 + m % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + m % 28 AS STRING), 2, '0')) END",
    "MeetCountry": "'USA'", "MeetState": "''", "MeetTown": "concat('T', m % 4)",
    "MeetName": "CASE WHEN k % 50 = 3 THEN concat(' MEET  ', m % 20, ' ') ELSE concat('Meet ', m % 20) END",
    "Sanctioned": "CASE WHEN m % 4 = 0 THEN 'No' WHEN m % 11 = 0 THEN 'Maybe' ELSE 'Yes' END",
}


def export(orders: str) -> str:
    """The export's rows: a row number and the 42 columns as text."""
    cells = ", ".join(f"{sql} AS {name}" for name, sql in _CELLS.items())
    return f"SELECT k AS row_ordinal, {cells} FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 60 AS m FROM {orders}) o"


# From here on SQL of the oracles.


def _id(tag: str, *parts: str) -> str:
    each = ", chr(31), ".join(f"'s', length({p}), ':', {p}" if not p.startswith("#") else f"'i', {p[1:]}" for p in parts)
    return f"'{tag}_' || substr(sha256(concat('psd-ids-v1', chr(31), '{tag}', chr(31), {each})), 1, 32)"


def _key(column: str) -> str:
    return f"lower(regexp_replace(trim(coalesce({column}, '')), '\\s+', ' ', 'g'))"


def _number(cell: str) -> str:
    return f"CASE WHEN regexp_full_match({cell}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN CAST({cell} AS DOUBLE) END"


_MEET = ("Date", "Federation", "MeetCountry", "MeetState", "MeetTown", "MeetName")
_TRIES = " UNION ALL ".join(f"SELECT row_ordinal, '{lift.lower()}' AS lift, {n} AS attempt_number, {_number(f'{lift}{n}Kg')} AS number FROM x" for lift in ("Squat", "Bench", "Deadlift") for n in (1, 2, 3, 4))
_SAID = " UNION ALL ".join(f"SELECT row_ordinal, '{c}' AS source_column, '{kind}' AS result_kind, {_number(c)} AS number FROM x" for c, kind in (("Best3SquatKg", "squat_best"), ("Best3BenchKg", "bench_best"), ("Best3DeadliftKg", "deadlift_best"), ("TotalKg", "total"), ("Dots", "dots"), ("Wilks", "wilks"), ("Glossbrenner", "other"), ("Goodlift", "gl_points")))

#: x: the export; r: ids; c, a, v, m, p: competitions, attempts, reported results, meets, athletes.
CORPUS = f"""
WITH x AS ({export("orders")}),
i AS (SELECT row_ordinal, Name, {_id("ath", f"'{SOURCE_ID}'", "Name")} AS athlete_id, {_id("cmeet", f"'{SOURCE_ID}'", *map(_key, _MEET))} AS competition_meet_id FROM x),
r AS (SELECT *, {_id("cmp", "athlete_id", "competition_meet_id", "CAST(row_ordinal AS VARCHAR)")} AS competition_id FROM i),
n AS (SELECT *, {_number("Age")} AS age_number, {_number("BodyweightKg")} AS weight, {_number("Place")} AS place_number, CASE WHEN regexp_full_match(Date, '\\d{{4}}-\\d\\d-\\d\\d') THEN TRY_CAST(Date AS TIMESTAMP) END AS competition_date FROM x),
c AS (
  SELECT competition_id, athlete_id, competition_meet_id, n.row_ordinal, competition_date,
    CASE WHEN Event <> 'X' THEN lower(Event) END AS competition_event, nullif(Federation, '') AS federation, nullif(ParentFederation, '') AS sanctioning_body, MeetName AS name,
    Equipment AS equipment_class_raw, nullif(WeightClassKg, '') AS weight_class_raw,
    CASE Equipment WHEN 'Raw' THEN 'raw' WHEN 'Wraps' THEN 'raw_equip' WHEN 'Single-ply' THEN 'classic_powerlifting' WHEN 'Multi-ply' THEN 'multi_ply' WHEN 'Unlimited' THEN 'unlimited' WHEN 'Straps' THEN 'straps_allowed' ELSE 'unknown' END AS equipment_class,
    CASE WHEN weight > 0 THEN weight END AS bodyweight_kg, nullif(Place, '') AS participation_status,
    CASE WHEN Place = 'DQ' THEN 'disqualified' WHEN Place = 'G' THEN 'guest' WHEN place_number > 0 AND place_number = floor(place_number) THEN 'placed' ELSE 'unknown' END AS participation_status_kind,
    CASE WHEN place_number > 0 AND place_number = floor(place_number) THEN CAST(place_number AS BIGINT) END AS participation_place,
    CASE WHEN Tested = 'Yes' THEN true END AS is_drug_tested_category, age_number AS age_reported,
    CASE WHEN age_number = floor(age_number) THEN 'exact' WHEN age_number IS NOT NULL THEN 'approximate' END AS age_precision, CASE WHEN length(Division) <= 256 THEN Division END AS division_raw
  FROM n JOIN r USING (row_ordinal)),
a AS (
  SELECT {_id("catt", "competition_id", "lift", "#attempt_number")} AS competition_attempt_id, competition_id, athlete_id, lift, attempt_number, CASE WHEN attempt_number = 4 THEN 'record_fourth' ELSE 'ordered' END AS attempt_role,
    number AS source_attempt_raw, abs(number) AS load_kg, CASE WHEN number > 0 THEN 'good_lift' ELSE 'bad_lift' END AS result
  FROM ({_TRIES}) t JOIN r USING (row_ordinal) WHERE number <> 0),
v AS (
  SELECT {_id("cres", "competition_id", "source_column")} AS competition_reported_result_id, competition_id, athlete_id, result_kind, abs(number) AS value, number AS source_value_raw,
    CASE WHEN result_kind LIKE '%best' OR result_kind = 'total' THEN 'kg' END AS unit,
    CASE WHEN result_kind LIKE '%best' THEN CASE WHEN number < 0 THEN 'failed_attempt_only' ELSE 'successful_best' END END AS reported_best_semantics
  FROM ({_SAID}) t JOIN r USING (row_ordinal) WHERE number <> 0),
m AS (
  SELECT competition_meet_id, min(MeetName) AS meet_name, min(competition_date) AS meet_date, min(nullif(Federation, '')) AS meet_federation, min(nullif(ParentFederation, '')) AS meet_parent_federation,
    min(MeetTown) AS meet_town, min(CASE Sanctioned WHEN 'Yes' THEN true WHEN 'No' THEN false END) AS is_sanctioned
  FROM n JOIN r USING (row_ordinal) GROUP BY competition_meet_id),
p AS (
  SELECT athlete_id, r.Name AS name, count(DISTINCT nullif(Sex, '')) > 1 AS torn, CASE WHEN count(DISTINCT nullif(Sex, '')) <= 1 THEN max(nullif(Sex, '')) END AS sex_category_raw
  FROM x JOIN r USING (row_ordinal) GROUP BY ALL)
"""
