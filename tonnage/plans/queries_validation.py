"""Every validation rule over a dataset with planted faults, made from the driver's orders by SQL that both engines run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tonnage.operators import validation
from tonnage.plans.catalogue import Tables, query
from tonnage.plans.corpus import canonical
from tonnage.plans.schema import FOREIGN_KEYS, TABLES

#: k: order, c: customer, d: date; every column left out is null.
_ORDERS = "(SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM {orders}) o"
_CUSTOMERS = "(SELECT DISTINCT o_custkey AS c FROM {orders}) o"
_S, _A, _FLAG = "concat('s', k % 3)", "concat('a', c + CASE WHEN k % 13 = 0 THEN 1000000 ELSE 0 END)", "CASE WHEN k % 9 = 0 THEN array('edited_after_the_fact') ELSE array() END"


def _own(prefix: str, every: int = 0) -> str:
    """An id; one in ``every`` refers to nothing."""
    return f"concat('{prefix}', k + CASE WHEN k % {every} = 0 THEN 1000000 ELSE 0 END)" if every else f"concat('{prefix}', k)"


_SPEC: dict[str, tuple[str, dict[str, str], str]] = {
    "source": ("(SELECT 0 AS i UNION ALL SELECT 1) o", {"source_id": "concat('s', i)", "nature": "CASE i WHEN 0 THEN 'real' ELSE 'synthetic' END"}, ""),
    "athlete": (_CUSTOMERS, {"athlete_id": "concat('a', c)", "is_synthetic": "c % 4 = 1", "source_id": "concat('s', c % 3)", "identity_status": "CASE WHEN c % 5 = 0 THEN 'nonsense' ELSE 'unknown' END", "birth_year": "CAST(1850 + c % 300 AS BIGINT)", "ambiguity_group_id": "CASE WHEN c % 6 = 0 THEN 'g' END", "synthetic_regime": "CASE WHEN c % 4 < 2 THEN 'x' END"}, ""),
    "exercise_definition": (_ORDERS, {"exercise_id": "concat('e', k)", "canonical_key": "concat('key', k % 90)"}, "k < 100"),
    "exercise_alias": (_ORDERS, {"exercise_alias_id": _own("ea"), "exercise_id": "concat('e', k % 103)", "source_system": "concat('y', k % 2)", "alias_normalized": "concat('l', k % 150)"}, "k < 400"),
    "exercise_normalization": (_ORDERS, {"normalization_id": _own("en"), "exercise_id": "concat('e', k % 101)", "source_alias_id": "concat('ea', k % 410)", "candidate_exercise_ids": "array(concat('e', k % 99), concat('e', k % 104))"}, "k < 500"),
    "program_version": (_ORDERS, {"program_version_id": _own("pv"), "program_id": "concat('p', k % 7)", "effective_from": "d", "effective_to": "CASE WHEN k % 4 > 0 THEN d + INTERVAL 3 DAY END"}, "k % 10 = 0"),
    "equipment_state": (_ORDERS, {"equipment_state_id": _own("es"), "athlete_id": _A, "equipment_item": "CASE WHEN k % 3 = 0 THEN 'belt' ELSE 'shoes' END", "effective_from": "d", "effective_to": "CASE WHEN k % 2 = 0 THEN d + INTERVAL 200 DAY END"}, "k % 3 = 1"),
    "body_measurement": (_ORDERS, {"body_measurement_id": _own("bm"), "athlete_id": _A, "measured_at": "d", "raw_value": "CASE WHEN k % 5 > 0 THEN 80.0 END", "raw_unit": "CASE WHEN k % 6 > 0 THEN 'kg' END", "missingness_reason": "CASE WHEN k % 10 = 0 THEN 'not_recorded_in_source' WHEN k % 77 = 0 THEN 'lost' END"}, "k % 4 = 0"),
    "planned_session": (_ORDERS, {"planned_session_id": _own("ps"), "athlete_id": _A, "program_version_id": "concat('pv', k % 40)", "scheduled_at": "d", "source_id": _S}, ""),
    "planned_exercise": (_ORDERS, {"planned_exercise_id": _own("pe"), "planned_session_id": _own("ps", 17), "exercise_id": "concat('e', k % 102)"}, ""),
    "planned_set": (_ORDERS, {"planned_set_id": _own("pt"), "planned_exercise_id": _own("pe", 19), "target_load_kg": "CASE WHEN k % 50 = 0 THEN 0.0 ELSE 100.0 END", "target_reps_min": "k % 5", "target_reps_max": "CAST(3 AS BIGINT)"}, ""),
    "performed_session": (_ORDERS, {"performed_session_id": _own("fs"), "athlete_id": "concat('a', c + CASE WHEN k % 12 = 0 THEN 1 ELSE 0 END)", "planned_session_id": _own("ps", 23), "started_at": "d", "ended_at": "CASE WHEN k % 3 > 0 THEN d - INTERVAL 1 DAY END", "quality_flags": _FLAG, "modified_at": "CASE WHEN k % 18 = 0 THEN d END", "missingness_reason": "CASE WHEN k % 4 = 0 THEN 'unknown' END"}, ""),
    "performed_exercise": (_ORDERS, {"performed_exercise_id": _own("fe"), "performed_session_id": _own("fs", 29), "exercise_id": "concat('e', k % 105)", "planned_exercise_id": _own("pe", 31)}, ""),
    "performed_set": (_ORDERS, {"performed_set_id": "concat('ft', k - k % 50)", "performed_exercise_id": _own("fe", 37), "planned_set_id": "concat('pt', k - k % 2)", "ordinal": "k % 1005", "rpe": "CASE WHEN k % 7 > 0 THEN CAST(k % 12 AS DOUBLE) END", "rir": "CAST(k % 5 AS DOUBLE)", "load_kg": "CASE WHEN k % 45 = 0 THEN 0.0 ELSE 60.5 END", "load_raw": "60.5", "load_unit": "CASE WHEN k % 8 > 0 THEN 'kg' END", "missingness_reason": "CASE WHEN k % 14 = 0 THEN 'unknown' END", "set_status": "CASE WHEN k % 61 = 0 THEN 'odd' ELSE 'completed' END"}, "k % 50 < 2 OR k % 7 = 0"),
    "performed_rep": (_ORDERS, {"performed_rep_id": _own("fr"), "performed_set_id": "concat('ft', k)"}, "k % 25 = 0"),
    "observation": (_ORDERS, {"observation_id": _own("ob"), "athlete_id": _A, "observed_at": "d", "observation_scope": "CASE WHEN k % 3 = 0 THEN 'set' ELSE 'athlete' END", "observation_type": "CASE WHEN k % 2 = 0 THEN 'rpe' ELSE 'rir' END", "parent_set_id": "concat('ft', k - k % 50)"}, ""),
    "performance_test": (_ORDERS, {"performance_test_id": _own("pf"), "athlete_id": _A, "observed_at": "d", "performed_set_id": "concat('ft', k)"}, "k % 5 = 0"),
    "velocity_observation": (_ORDERS, {"velocity_observation_id": _own("vo"), "athlete_id": _A, "observed_at": "d", "performed_set_id": "concat('ft', k)", "performed_rep_id": "concat('fr', k)", "mean_velocity_mps": "CASE WHEN k % 4 = 0 THEN 0.5 WHEN k % 4 = 2 THEN 21.0 END"}, "k % 10 = 0"),
    "competition_meet": (_ORDERS, {"competition_meet_id": _own("cm"), "meet_name": "concat('Meet ', k)", "meet_federation": "'F'", "meet_parent_federation": "CASE WHEN k % 2 = 0 THEN 'P' END", "meet_date": "d"}, "k < 60"),
    "competition": (_ORDERS, {"competition_id": _own("cc"), "athlete_id": _A, "competition_meet_id": "concat('cm', k % 61)", "name": "concat('Meet ', k % 61 + CASE WHEN k % 30 = 0 THEN 1 ELSE 0 END)", "federation": "CASE WHEN k % 40 > 0 THEN 'F' END", "sanctioning_body": "CASE WHEN k % 61 % 2 = 0 AND k % 70 > 0 THEN 'P' END", "competition_event": "CASE k % 4 WHEN 0 THEN 'sbd' WHEN 1 THEN 'b' WHEN 2 THEN 'bd' END", "competition_date": "d", "bodyweight_kg": "CASE WHEN k % 80 = 0 THEN 0.0 END"}, ""),
    "competition_attempt": (_ORDERS, {"competition_attempt_id": _own("ca"), "competition_id": "concat('cc', k - k % 2 + CASE WHEN k % 41 = 0 THEN 1000000 ELSE 0 END)", "athlete_id": _A, "lift": "CASE WHEN k % 3 = 0 THEN 'squat' ELSE 'bench' END", "attempt_number": "CAST(1 + k % 6 AS BIGINT)", "load_kg": "CASE WHEN k % 33 = 0 THEN 0.0 ELSE 90.0 END", "result": "CASE WHEN k % 10 = 0 THEN 'no_attempt' WHEN k % 10 < 9 THEN 'good_lift' END"}, ""),
    "competition_reported_result": (_ORDERS, {"competition_reported_result_id": _own("cr"), "competition_id": "concat('cc', k - k % 4 + CASE WHEN k % 43 = 0 THEN 1000000 ELSE 0 END)", "result_kind": "CASE k % 4 WHEN 0 THEN 'squat_best' WHEN 1 THEN 'bench_best' WHEN 2 THEN 'deadlift_best' ELSE 'total' END", "value": "CAST(CASE WHEN k % 4 < 3 THEN 100 WHEN k % 20 = 3 THEN 310 ELSE 300 END AS DOUBLE)", "source_value_raw": "CASE WHEN k % 15 = 0 THEN -100.0 ELSE 100.0 END", "reported_best_semantics": "CASE WHEN k % 10 = 0 THEN 'failed_attempt_only' ELSE 'successful_best' END", "is_derived": "k % 35 = 0"}, ""),
}


def _sql(table: str) -> str:
    source, columns, where = _SPEC[table]
    return f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in columns.items())} FROM {source}" + (f" WHERE {where}" if where else "")


def dataset(t: Tables) -> dict[str, DataFrame]:
    found = {n: canonical(t.spark.sql(_sql(n), orders=t.orders) if "{orders}" in _sql(n) else t.spark.sql(_sql(n)), n) for n in _SPEC}
    return validation.complete(found, t.spark)


_WITH = "WITH " + ", ".join(f"{n} AS ({_sql(n)})" for n in _SPEC).replace("{orders}", "orders").replace("array(", "list_value(") + " "
_KEY = {n: s.primary_key[0] for n, s in TABLES.items()}


def _issues(*parts: tuple[str, str, str], severity: str = "error", key: Callable[[str], str] = _KEY.__getitem__) -> str:
    """(code, table, relation with the table's key) to issues."""
    return " UNION ALL ".join(f"SELECT '{code}' AS code, '{severity}' AS severity, '{table}' AS \"table\", {key(table)} AS record_id FROM ({relation}) q" for code, table, relation in parts)


def _where(code: str, table: str, condition: str) -> tuple[str, str, str]:
    return code, table, f"SELECT * FROM {table} WHERE {condition}"


def _said(df: DataFrame) -> DataFrame:
    return df.select("code", "severity", "table", "record_id")


@query(_WITH + _issues(*((code, table, f"SELECT * FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {_KEY[target]} FROM {target})") for table, column, target, code in FOREIGN_KEYS)))
def validate_references(t: Tables):
    return _said(validation.references(dataset(t)))


@query(_WITH + _issues(*(_where("unregistered_source", n, "source_id = 's2'") for n in ("athlete", "planned_session"))))
def validate_source_provenance(t: Tables):
    return _said(validation.source_provenance(dataset(t)))


@query(_WITH + _issues(_where("synthetic_athlete_from_real_source", "athlete", "is_synthetic AND source_id = 's0'"), _where("real_athlete_from_synthetic_source", "planned_session", "source_id = 's1' AND athlete_id IN (SELECT athlete_id FROM athlete WHERE NOT is_synthetic)")))
def validate_synthetic_separation(t: Tables):
    return _said(validation.synthetic_separation(dataset(t)))


@query(_WITH + _issues(("duplicate_primary_key", "performed_set", "SELECT *, row_number() OVER (PARTITION BY performed_set_id) AS n FROM performed_set QUALIFY n > 1")))
def validate_duplicate_keys(t: Tables):
    return _said(validation.duplicate_keys(dataset(t)))


@query(_WITH + _issues(("duplicate_canonical_key", "exercise_definition", "SELECT *, row_number() OVER (PARTITION BY canonical_key ORDER BY exercise_id) AS n FROM exercise_definition QUALIFY n > 1"),
    ("alias_binding_conflict", "exercise_alias", "SELECT *, first_value(exercise_id) OVER (PARTITION BY source_system, alias_normalized ORDER BY exercise_alias_id) AS f FROM exercise_alias QUALIFY exercise_id <> f"),
    ("dangling_candidate_exercise", "exercise_normalization", "SELECT * FROM (SELECT *, unnest(candidate_exercise_ids) AS x FROM exercise_normalization) WHERE x NOT IN (SELECT exercise_id FROM exercise_definition)")))
def validate_exercise_identity(t: Tables):
    return _said(validation.exercise_identity(dataset(t)))


def _missing(table: str, column: str) -> tuple[str, str, str]:
    absent = "" if column not in _SPEC[table][1] else f"{column} IS NULL AND "
    return _where("missingness_undeclared", table, f"{absent}{'missingness_reason IS NULL' if 'missingness_reason' in _SPEC[table][1] else 'true'}")


@query(_WITH + _issues(*(_missing(*x.split(".")) for x in ("performed_set.load_raw", "performed_set.rpe", "performed_set.rir", "performed_set.reps_performed", "body_measurement.raw_value", "velocity_observation.mean_velocity_mps", "performed_session.duration_seconds", "performed_session.ended_at")),
    _where("rpe_rir_inconsistent", "performed_set", "abs(rpe + rir - 10) > 1"), severity="warning") + " UNION ALL " + _issues(
    *(_where("zero_as_missing", n, f"{c} = 0") for n, c in (("performed_set", "load_kg"), ("performed_set", "rpe"), ("performed_set", "rir"), ("competition_attempt", "load_kg"), ("competition", "bodyweight_kg"), ("planned_set", "target_load_kg"))),
    _where("edit_without_timestamp", "performed_session", "len(quality_flags) > 0 AND modified_at IS NULL"), _where("unknown_missingness_reason", "body_measurement", "missingness_reason = 'lost'"),
    _where("reported_best_semantics_mismatch", "competition_reported_result", "result_kind LIKE '%best' AND source_value_raw < 0 AND reported_best_semantics <> 'failed_attempt_only'")))
def validate_row_rules(t: Tables):
    return _said(validation.row_rules(dataset(t)))


def _overlap(table: str, group: str) -> tuple[str, str, str]:
    return "overlapping_interval", table, f"SELECT *, lead(effective_from) OVER (PARTITION BY {group} ORDER BY effective_from, {_KEY[table]}) AS f FROM {table} QUALIFY f IS NOT NULL AND (effective_to IS NULL OR effective_to > f)"


@query(_WITH + _issues(_overlap("equipment_state", "equipment_item, athlete_id"), _overlap("program_version", "program_id")))
def validate_overlaps(t: Tables):
    return _said(validation.overlaps(dataset(t)))


_BOTH = "SELECT c.*, meet_name, meet_federation, meet_parent_federation FROM competition c JOIN competition_meet USING (competition_meet_id)"
_BESTS = "SELECT competition_id, " + ", ".join(f"max_by(value, competition_reported_result_id) FILTER (result_kind = '{k}') AS {k}" for k in ("squat_best", "bench_best", "deadlift_best", "total")) + " FROM competition_reported_result WHERE NOT is_derived GROUP BY competition_id"


@query(_WITH + _issues(("duplicate_attempt_number", "competition_attempt", "SELECT *, row_number() OVER (PARTITION BY competition_id, lift, attempt_number ORDER BY competition_attempt_id) AS n FROM competition_attempt WHERE result IS NULL OR result <> 'no_attempt' QUALIFY n > 1"),
    ("attempt_outside_declared_event", "competition_attempt", "SELECT a.* FROM competition_attempt a JOIN competition c USING (competition_id) WHERE competition_event IS NOT NULL AND NOT contains(competition_event, left(lift, 1))"),
    *(("meet_field_disagreement", "competition", f"SELECT * FROM ({_BOTH}) WHERE {a} IS DISTINCT FROM {b}") for a, b in (("name", "meet_name"), ("federation", "meet_federation"), ("sanctioning_body", "meet_parent_federation"))))
    + " UNION ALL " + _issues(("reported_total_mismatch", "competition", f"SELECT * FROM ({_BESTS}) WHERE abs(total - squat_best - bench_best - deadlift_best) > 0.001"), severity="warning"))
def validate_competition_rules(t: Tables):
    return _said(validation.competition_rules(dataset(t)))


@query(_WITH + _issues(("cross_athlete_link", "performed_session", "SELECT f.* FROM performed_session f JOIN planned_session p USING (planned_session_id) WHERE f.athlete_id <> p.athlete_id"),
    ("cross_athlete_link", "performed_exercise", "SELECT e.* FROM performed_exercise e JOIN performed_session f USING (performed_session_id) JOIN planned_exercise x USING (planned_exercise_id) JOIN planned_session p ON p.planned_session_id = x.planned_session_id WHERE f.athlete_id <> p.athlete_id"))
    + " UNION ALL " + _issues(("plan_claimed_multiple_times", "performed_set", "SELECT *, count(*) OVER (PARTITION BY planned_set_id) AS n FROM performed_set QUALIFY n > 1"),
    ("duplicate_set_level_measurement", "observation", "SELECT o.* FROM observation o JOIN performed_set s ON parent_set_id = performed_set_id WHERE observation_scope = 'set' AND ((observation_type = 'rpe' AND rpe IS NOT NULL) OR (observation_type = 'rir' AND rir IS NOT NULL))"), severity="warning"))
def validate_plan_rules(t: Tables):
    return _said(validation.plan_rules(dataset(t)))


@query(_WITH + _issues(_where("contract_synthetic_regime", "athlete", "(synthetic_regime IS NOT NULL) <> is_synthetic"), _where("contract_ambiguity", "athlete", "false"), _where("contract_pair", "body_measurement", "(raw_value IS NULL) <> (raw_unit IS NULL)"),
    _where("contract_reps", "planned_set", "target_reps_min > target_reps_max"), _where("contract_interval", "performed_session", "ended_at < started_at"), _where("contract_mass_triplet", "performed_set", "load_unit IS NULL"), _where("contract_rpe", "performed_set", "rpe > 10"),
    _where("contract_value", "observation", "true"), _where("contract_load", "competition_attempt", "load_kg <= 0"), _where("contract_mass_triplet", "competition", "bodyweight_kg IS NOT NULL"),
    _where("contract_semantics", "competition_reported_result", "(source_value_raw < 0) <> (reported_best_semantics = 'failed_attempt_only')"), _where("contract_derivation", "competition_reported_result", "is_derived")))
def validate_contracts(t: Tables):
    return _said(validation.contract_issues(dataset(t)))


def _first(table: str, *conditions: tuple[str, str, str]) -> str:
    """The first 50 issues of a table by column, then key."""
    each = " UNION ALL ".join(f"SELECT '{code}' AS code, 'error' AS severity, '{table}' AS \"table\", {_KEY[table]} AS record_id, '{column}' AS c FROM {table} WHERE {condition}" for code, column, condition in conditions)
    return f"SELECT code, severity, \"table\", record_id FROM (SELECT * FROM ({each}) ORDER BY c, record_id LIMIT 50)"


@query(_WITH + " UNION ALL ".join(f"({x})" for x in (
    _first("athlete", ("range_birth_year", "birth_year", "birth_year NOT BETWEEN 1900 AND 2100"), ("vocabulary_identity_status", "identity_status", "identity_status = 'nonsense'")), _first("planned_set", ("range_target_load_kg", "target_load_kg", "target_load_kg <= 0")),
    _first("performed_set", ("range_load_kg", "load_kg", "load_kg <= 0"), ("range_ordinal", "ordinal", "ordinal > 1000"), ("range_rpe", "rpe", "rpe > 10"), ("vocabulary_set_status", "set_status", "set_status = 'odd'")), _first("body_measurement", ("vocabulary_missingness_reason", "missingness_reason", "missingness_reason = 'lost'")),
    _first("velocity_observation", ("range_mean_velocity_mps", "mean_velocity_mps", "mean_velocity_mps > 20")), _first("competition", ("range_bodyweight_kg", "bodyweight_kg", "bodyweight_kg <= 0")),
    _first("competition_attempt", ("range_attempt_number", "attempt_number", "attempt_number > 4"), ("range_load_kg", "load_kg", "load_kg <= 0")))))
def validate_columns(t: Tables):
    return _said(validation.column_issues(dataset(t)))


_EVENTS = {"body_measurement": "measured_at", "planned_session": "scheduled_at", "performed_session": "started_at", "observation": "observed_at", "performance_test": "observed_at", "velocity_observation": "observed_at", "competition": "competition_date"}


@query(_WITH + " UNION ALL ".join(f"SELECT strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ') AS \"at\", '{n}' AS \"table\", {_KEY[n]} AS record_id FROM {n} WHERE athlete_id = 'a7'" for n, c in _EVENTS.items()))
def athlete_timeline(t: Tables):
    return validation.timeline(dataset(t), "a7")
