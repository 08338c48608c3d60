"""Validation of a canonical dataset: column rules, keys, references and rules across records.

Every rule yields issues (code, severity, table, record_id, message); they are unioned and nothing is
collected before the caller asks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonnage.operators import rules
from tonnage.plans.history import CONTESTED
from tonnage.plans.schema import FOREIGN_KEYS, POSITIVE, RANGES, TABLES, VOCABULARIES

Dataset = dict[str, DataFrame]
ERROR, WARNING = "error", "warning"
#: Columns that need a reason when null, and columns where zero stands for missing.
NEEDS_REASON = ("performed_set.load_raw", "performed_set.rpe", "performed_set.rir", "performed_set.reps_performed", "body_measurement.raw_value", "velocity_observation.mean_velocity_mps", "performed_session.duration_seconds", "performed_session.ended_at")
NO_ZERO = ("performed_set.load_kg", "performed_set.rpe", "performed_set.rir", "competition_attempt.load_kg", "competition.bodyweight_kg", "planned_set.target_load_kg")


def record_id(table: str) -> Column:
    return F.concat_ws("|", *(F.col(c).cast("string") for c in TABLES[table].primary_key))


def _issue(df: DataFrame, table: str, code: str, message: Column | str, severity: str = ERROR) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return df.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(table).alias("table"), record_id(table).alias("record_id"), text.alias("message"))


def _empty(d: Dataset) -> DataFrame:
    return next(iter(d.values())).sparkSession.createDataFrame([], "code string, severity string, table string, record_id string, message string")


def column_issues(d: Dataset, most: int = 50) -> DataFrame:
    """Types, ranges, signs and vocabularies, the first ``most`` of each table by column and key; also missing and unexpected columns."""
    parts = []
    spark = next(iter(d.values())).sparkSession
    for name, df in d.items():
        spec = TABLES[name]
        missing, extra = [c for c in spec.columns if c not in df.columns], [c for c in df.columns if c not in spec.columns]
        said = [("missing_columns", c) for c in missing] + [("unexpected_columns", c) for c in extra]
        said += [(f"dtype_{f.name}", f"{df.schema[f.name].dataType.simpleString()} for {f.dataType.simpleString()}") for f in spec.schema if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
        if said:
            parts.append(spark.createDataFrame([(c, ERROR, name, None, m) for c, m in said], "code string, severity string, table string, record_id string, message string"))
        if any(c in missing for c in spec.primary_key):
            continue
        here = [c for c in df.columns if c in spec.columns]
        found = []
        if ranges := {c: RANGES[c] for c in here if c in RANGES and c not in POSITIVE}:
            found.append(rules.range_issues(df, record_id(name), ranges))
        if positive := [c for c in here if c in POSITIVE]:
            found.append(rules.positive_issues(df, record_id(name), positive))
        if vocabularies := {c: v for c, v in spec.vocabularies.items() if c in here}:
            found.append(rules.vocabulary_issues(df, record_id(name), vocabularies))
        if found:
            both = reduce(DataFrame.unionByName, found).orderBy("column", "id").limit(most)
            parts.append(both.select("code", "severity", F.lit(name).alias("table"), F.col("id").alias("record_id"), F.concat_ws(" ", "column", "seen").alias("message")))
    return reduce(DataFrame.unionByName, parts) if parts else _empty(d)


def references(d: Dataset) -> DataFrame:
    parts = []
    for table, column, target, code in FOREIGN_KEYS:
        if table in d and target in d:
            key = TABLES[target].primary_key[0]
            lost = d[table].where(F.col(column).isNotNull()).join(d[target].select(F.col(key).alias("__key")), F.col(column) == F.col("__key"), "left_anti")
            parts.append(_issue(lost, table, code, F.concat(F.lit(f"{column} "), F.col(column))))
    return reduce(DataFrame.unionByName, parts) if parts else _empty(d)


def source_provenance(d: Dataset) -> DataFrame:
    known = d["source"].select(F.col("source_id").alias("__source"))
    parts = [_issue(df.where("source_id is not null").join(F.broadcast(known), F.col("source_id") == F.col("__source"), "left_anti"), n, "unregistered_source", F.concat(F.lit("source_id "), F.col("source_id"))) for n, df in d.items() if n != "source" and "source_id" in df.columns]
    return reduce(DataFrame.unionByName, parts)


def synthetic_separation(d: Dataset) -> DataFrame:
    nature = F.broadcast(d["source"].select("source_id", "nature"))
    athletes = d["athlete"].join(nature, "source_id", "left")
    wrong = _issue(athletes.where("is_synthetic and nature = 'real'"), "athlete", "synthetic_athlete_from_real_source", "a synthetic athlete of a real source")
    marked = d["athlete"].select("athlete_id", "is_synthetic")
    parts = [wrong]
    for n, df in d.items():
        if "athlete_id" in df.columns and n not in ("athlete", "athlete_source_link"):
            mixed = df.join(nature, "source_id").join(marked, "athlete_id").where("nature = 'synthetic' and not is_synthetic")
            parts.append(_issue(mixed, n, "real_athlete_from_synthetic_source", "a real athlete in a synthetic source"))
    return reduce(DataFrame.unionByName, parts)


def _repeated(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return df.withColumn("__n", F.row_number().over(w)).where("__n > 1")


def duplicate_keys(d: Dataset) -> DataFrame:
    parts = [_issue(_repeated(df, list(TABLES[n].primary_key), list(TABLES[n].order)), n, "duplicate_primary_key", "the key is there before") for n, df in d.items()]
    return reduce(DataFrame.unionByName, parts)


def exercise_identity(d: Dataset) -> DataFrame:
    parts = [_issue(_repeated(d["exercise_definition"], ["canonical_key"], ["exercise_id"]), "exercise_definition", "duplicate_canonical_key", F.col("canonical_key"))]
    alias = d["exercise_alias"].withColumn("__first", F.first("exercise_id").over(Window.partitionBy("source_system", "alias_normalized").orderBy("exercise_alias_id")))
    parts.append(_issue(alias.where("exercise_id <> __first"), "exercise_alias", "alias_binding_conflict", F.col("alias_normalized")))
    each = d["exercise_normalization"].withColumn("__candidate", F.explode("candidate_exercise_ids"))
    lost = each.join(d["exercise_definition"].select(F.col("exercise_id").alias("__known")), F.col("__candidate") == F.col("__known"), "left_anti")
    parts.append(_issue(lost, "exercise_normalization", "dangling_candidate_exercise", F.col("__candidate")))
    return reduce(DataFrame.unionByName, parts)


def row_rules(d: Dataset) -> DataFrame:
    """Rules that look at one row: missingness, zeros, effort, edits, best semantics, reasons."""
    parts = []
    for place in NEEDS_REASON:
        table, column = place.split(".")
        parts.append(_issue(d[table].where(F.col(column).isNull() & F.col("missingness_reason").isNull()), table, "missingness_undeclared", f"{column} is null without a reason", WARNING))
    for place in NO_ZERO:
        table, column = place.split(".")
        parts.append(_issue(d[table].where(F.col(column) == 0), table, "zero_as_missing", f"{column} is zero"))
    for n, df in d.items():
        if "quality_flags" in df.columns:
            edited = F.array_contains(F.coalesce("quality_flags", F.array().cast("array<string>")), "edited_after_the_fact")
            unstamped = F.col("modified_at").isNull() if "modified_at" in df.columns else F.lit(True)
            parts.append(_issue(df.where(edited & unstamped), n, "edit_without_timestamp", "edited, but no time of the edit"))
        if "missingness_reason" in df.columns:
            parts.append(_issue(df.where(~F.col("missingness_reason").isin(*VOCABULARIES["MissingnessReason"])), n, "unknown_missingness_reason", F.col("missingness_reason")))
    effort = F.abs(F.col("rpe") + F.col("rir") - 10) > 1
    parts.append(_issue(d["performed_set"].where(effort), "performed_set", "rpe_rir_inconsistent", "rpe and rir do not add up to 10", WARNING))
    bests = d["competition_reported_result"].where(F.col("result_kind").endswith("_best") & (F.col("source_value_raw") < 0) & (F.col("reported_best_semantics") != "failed_attempt_only"))
    parts.append(_issue(bests, "competition_reported_result", "reported_best_semantics_mismatch", F.col("reported_best_semantics")))
    return reduce(DataFrame.unionByName, parts)


def overlaps(d: Dataset) -> DataFrame:
    parts = []
    for table, group in (("equipment_state", ["equipment_item", "athlete_id"]), ("program_version", ["program_id"])):
        w = Window.partitionBy(*group).orderBy("effective_from", *TABLES[table].primary_key)
        following = d[table].withColumn("__next", F.lead("effective_from").over(w))
        open_ = F.col("__next").isNotNull() & (F.col("effective_to").isNull() | (F.col("effective_to") > F.col("__next")))
        parts.append(_issue(following.where(open_), table, "overlapping_interval", "the next interval starts before this one ends"))
    return reduce(DataFrame.unionByName, parts)


def competition_rules(d: Dataset) -> DataFrame:
    c, a, m, r = d["competition"], d["competition_attempt"], d["competition_meet"], d["competition_reported_result"]
    counted = a.where("result is null or result <> 'no_attempt'")
    parts = [_issue(_repeated(counted, ["competition_id", "lift", "attempt_number"], ["competition_attempt_id"]), "competition_attempt", "duplicate_attempt_number", "the number is there before")]
    spark = c.sparkSession
    pairs = F.broadcast(spark.createDataFrame([(e, lift) for lift, events in CONTESTED.items() for e in events], "competition_event string, lift string"))
    events = c.select("competition_id", "competition_event").where(F.col("competition_event").isin(*sorted({e for x in CONTESTED.values() for e in x})))
    parts.append(_issue(a.join(events, "competition_id").join(pairs, ["competition_event", "lift"], "left_anti"), "competition_attempt", "attempt_outside_declared_event", "the event does not contest this lift"))
    meets = m.select(F.col("competition_meet_id").alias("__meet"), *(F.col(x) for x in ("meet_name", "meet_federation", "meet_parent_federation")))
    joined = c.join(meets, F.col("competition_meet_id") == F.col("__meet"))
    for own, theirs in (("name", "meet_name"), ("federation", "meet_federation"), ("sanctioning_body", "meet_parent_federation")):
        parts.append(_issue(joined.where(~F.col(own).eqNullSafe(F.col(theirs))), "competition", "meet_field_disagreement", f"{own} is not the meet's"))
    wide = r.where("not is_derived").groupBy("competition_id").pivot("result_kind", ["squat_best", "bench_best", "deadlift_best", "total"]).agg(F.max_by("value", "competition_reported_result_id"))
    off = wide.where(F.abs(F.col("total") - F.col("squat_best") - F.col("bench_best") - F.col("deadlift_best")) > 0.001)
    parts.append(_issue(off, "competition", "reported_total_mismatch", "the total is not the sum of the bests", WARNING))
    return reduce(DataFrame.unionByName, parts)


def plan_rules(d: Dataset) -> DataFrame:
    planned, performed = d["planned_session"], d["performed_session"]
    theirs = planned.select(F.col("planned_session_id").alias("__plan"), F.col("athlete_id").alias("__athlete"))
    parts = [_issue(performed.join(theirs, F.col("planned_session_id") == F.col("__plan")).where("athlete_id <> __athlete"), "performed_session", "cross_athlete_link", "the planned session is another athlete's")]
    owner = d["planned_exercise"].join(theirs, F.col("planned_session_id") == F.col("__plan")).select(F.col("planned_exercise_id").alias("__exercise"), "__athlete")
    done = d["performed_exercise"].join(performed.select(F.col("performed_session_id").alias("__session"), "athlete_id"), F.col("performed_session_id") == F.col("__session"))
    parts.append(_issue(done.join(owner, F.col("planned_exercise_id") == F.col("__exercise")).where("athlete_id <> __athlete"), "performed_exercise", "cross_athlete_link", "the planned exercise is another athlete's"))
    claims = d["performed_set"].where("planned_set_id is not null").withColumn("__claims", F.count("*").over(Window.partitionBy("planned_set_id")))
    parts.append(_issue(claims.where("__claims > 1"), "performed_set", "plan_claimed_multiple_times", F.col("planned_set_id"), WARNING))
    sets = d["performed_set"].select(F.col("performed_set_id").alias("__set"), F.col("rpe").alias("__rpe"), F.col("rir").alias("__rir"))
    seen = d["observation"].where("observation_scope = 'set' and observation_type in ('rpe', 'rir')").join(sets, F.col("parent_set_id") == F.col("__set"))
    both = seen.where("(observation_type = 'rpe' and __rpe is not null) or (observation_type = 'rir' and __rir is not null)")
    parts.append(_issue(both, "observation", "duplicate_set_level_measurement", "the set states it already", WARNING))
    return reduce(DataFrame.unionByName, parts)


def contracts() -> dict[str, tuple[tuple[str, str], ...]]:
    """Row contracts as SQL that must hold, by table: (code, condition); unknown counts as holding."""
    mass = "({v}_raw is null) = ({v}_unit is null) and ({v}_kg is null or {v}_raw is not null) and ({v}_unit is null or {v}_unit in ('kg', 'lb'))"
    sets = (("mass_triplet", mass.format(v="load")), ("rpe", "rpe between 0 and 10"), ("rir", "rir between 0 and 10"))
    interval = (("interval", "effective_to >= effective_from"),)
    return {
        "athlete": (("synthetic_regime", "(synthetic_regime is not null) = coalesce(is_synthetic, false)"), ("ambiguity", "ambiguity_group_id is null or array_contains(quality_flags, 'ambiguous_identity')")),
        "athlete_source_link": (("confidence", "link_confidence between 0 and 1"),),
        "body_measurement": (("pair", "(raw_value is null) = (raw_unit is null)"), ("normalized", "value_normalized is null or raw_value is not null")),
        "equipment_state": interval,
        "program_version": interval,
        "program_modification": (("change", "previous_value is null or new_value is null or previous_value <> new_value"),),
        "planned_session": (("reason", "not_performed_reason is null or session_status in ('skipped', 'cancelled', 'partially_completed')"),),
        "planned_set": (("mass_triplet", "(target_load_raw is null) = (target_load_unit is null)"), ("reps", "target_reps_min <= target_reps_max"), ("percent", "target_percent_one_rm between 0 and 100")),
        "performed_session": (("interval", "ended_at >= started_at"),),
        "performed_exercise": (("substitution", "substituted_from_exercise_id is null or is_substitution"),),
        "performed_set": (*sets, ("reps", "reps_failed <= reps_performed or is_failure")),
        "performed_rep": (("mass_triplet", mass.format(v="load")), ("rpe", "rpe between 0 and 10"), ("success", "not (is_success and rep_status = 'failed')")),
        "observation": (("value", "numeric_value is not null or text_value is not null"), ("parent", "observation_scope <> 'set' or parent_set_id is not null")),
        "performance_test": (("pair", "(result_raw is null) = (result_unit is null)"),),
        "velocity_observation": (("mass_triplet", mass.format(v="load")), ("order", "peak_velocity_mps >= mean_velocity_mps")),
        "competition_meet": (("date", "meet_date is not null"),),
        "competition": (("date", "competition_date is not null"), ("mass_triplet", mass.format(v="bodyweight")), ("place", "(participation_place is not null) = (participation_status_kind = 'placed')"), ("age", "(age_reported is null) = (age_precision is null)")),
        "competition_attempt": (("role", "(attempt_number = 4) = (attempt_role = 'record_fourth')"), ("sign", "source_attempt_raw is null or (source_attempt_raw > 0) = (result = 'good_lift')"), ("load", "load_kg > 0")),
        "competition_reported_result": (("semantics", "reported_best_semantics is null or (source_value_raw < 0) = (reported_best_semantics = 'failed_attempt_only')"), ("derivation", "not is_derived or derivation_note is not null")),
        "exercise_normalization": (("resolved", "(resolution_status in ('exact_canonical', 'resolved_alias')) = (exercise_id is not null)"), ("reason", "resolution_status <> 'ambiguous' or ambiguity_reason is not null")),
    }


#: The contract that a source's unreadable dates break: a corpus may have them, so it is looked at on demand.
DATED = "date"


def contract_issues(d: Dataset, *, dates: bool = True) -> DataFrame:
    """One pass a table: a row for each contract that a record breaks."""
    parts = []
    for table, all_ in contracts().items():
        held = [x for x in all_ if dates or x[0] != DATED]
        if table in d and held:
            broken = F.array_compact(F.array(*(F.when(~F.expr(sql), F.lit(code)) for code, sql in held)))
            each = d[table].withColumn("__broken", F.explode(broken))
            parts.append(_issue(each, table, "contract", F.col("__broken")).withColumn("code", F.concat(F.lit("contract_"), "message")))
    return reduce(DataFrame.unionByName, parts) if parts else _empty(d)


RULES: tuple[Callable[[Dataset], DataFrame], ...] = (references, source_provenance, synthetic_separation, duplicate_keys, exercise_identity, row_rules, overlaps, competition_rules, plan_rules)


def complete(d: Dataset, spark) -> Dataset:
    """All tables of the model; absent ones are empty."""
    return {n: d[n] if n in d else spark.createDataFrame([], s.schema) for n, s in TABLES.items()}


def validate(d: Dataset, *, strict: bool = False, with_contracts: bool = True, with_dates: bool = False) -> DataFrame:
    """All issues of a dataset, broken contracts of its records included (on dates only ``with_dates``); ``strict`` makes errors of warnings and says so."""
    whole = complete(d, next(iter(d.values())).sparkSession)
    parts = [column_issues(d), *(rule(whole) for rule in RULES)] + ([contract_issues(d, dates=with_dates)] if with_contracts else [])
    out = reduce(DataFrame.unionByName, parts)
    if not strict:
        return out
    raised = F.col("severity") == WARNING
    return out.withColumn("message", F.when(raised, F.concat("message", F.lit(" (warning, strict)"))).otherwise(F.col("message"))).withColumn("severity", F.lit(ERROR))


def report(d: Dataset, *, strict: bool = False, examples: int = 20) -> dict:
    """What was looked at and what was found: tables, rows of each, issues by severity and code, first issues, and whether there is no error."""
    found = validate(d, strict=strict).persist()
    try:
        counts = [r.asDict() for r in found.groupBy("severity", "code").agg(F.count("*").alias("n")).orderBy("severity", "code").collect()]
        first = [r.asDict() for r in found.orderBy("severity", "code", "table", "record_id").limit(examples).collect()]
    finally:
        found.unpersist()
    return {"tables_checked": sorted(d), "rows": {n: d[n].count() for n in sorted(d)}, "issues": counts, "examples": first, "sound": all(c["severity"] != ERROR for c in counts)}


def timeline(d: Dataset, athlete_id: str) -> DataFrame:
    """at, table, record_id of everything that happened to an athlete, in order."""
    events = {"body_measurement": "measured_at", "planned_session": "scheduled_at", "performed_session": "started_at", "observation": "observed_at", "performance_test": "observed_at", "velocity_observation": "observed_at", "program_modification": "known_at", "competition": "competition_date"}
    parts = [d[n].where(F.col("athlete_id") == athlete_id).select(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"), F.lit(n).alias("table"), record_id(n).alias("record_id")) for n, c in events.items() if n in d]
    return reduce(DataFrame.unionByName, parts).orderBy("at", "table", "record_id")
