"""The canonical tables: columns, keys, order, vocabularies, ranges and references.

Every persisted column may be null.  A column is a name and a type; a third entry names the vocabulary
that it holds members of.  Six provenance columns end all tables but two.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

#: Name, type and, if there is one, vocabulary of a column.
Field = tuple[str, str] | tuple[str, str, str]

#: The provenance columns.
PROVENANCE: tuple[Field, ...] = (
    ("source_id", "string"),
    ("source_record_key", "string"),
    ("source_record_hash", "string"),
    ("ingested_at", "timestamp"),
    ("quality_flags", "array<string>"),
    ("missingness_reason", "string", "MissingnessReason"),
)

#: Vocabularies of the columns below.
VOCABULARIES: dict[str, tuple[str, ...]] = {
    "AgePrecision": ("exact", "approximate"),
    "AmbiguityReason": (
        "unspecified_variation", "unspecified_machine", "unspecified_implement", "multiple_defensible_matches", "question_form_label",
        "conflicting_alias_bindings", "unknown_source_taxonomy",
    ),
    "AttemptOrderBasis": ("source_explicit", "derived_from_source_order", "derived_from_load_order", "unknown"),
    "AttemptResult": ("good_lift", "bad_lift", "no_attempt", "withdrawn", "unknown"),
    "AttemptRole": ("ordered", "record_fourth"),
    "BarType": ("not_applicable", "olympic_bar", "specialty_bar", "safety_bar", "trap_bar", "ez_bar", "curl_bar", "t_bar", "unknown"),
    "BodyMassContext": ("morning_fasted", "pre_session", "post_session", "weigh_in", "pre_competition", "unspecified", "unknown"),
    "BodyMeasurementMethod": ("bathroom_scale", "clinical_scale", "smart_scale", "bioimpedance", "tape_measure", "caliper", "self_reported", "source_reported", "unknown"),
    "BodyMeasurementType": ("body_mass", "height", "body_fat_percentage", "skeletal_muscle_mass", "waist_circumference", "chest_circumference", "other"),
    "CompetitionEvent": ("sbd", "bd", "sd", "sb", "s", "b", "d"),
    "CompetitionResultKind": ("squat_best", "bench_best", "deadlift_best", "total", "placing", "dots", "gl_points", "wilks", "other"),
    "ConsentBasis": ("public_record", "public_license", "user_consent", "donation_agreement", "ethics_approved", "none_declared", "unknown"),
    "DataRegime": ("psd_comp", "psd_real", "psd_pro", "psd_sim", "psd_reference"),
    "EquipmentClass": ("raw", "raw_equip", "classic_powerlifting", "single_ply", "multi_ply", "unlimited", "straps_allowed", "other", "unknown"),
    "EquipmentItem": (
        "bar", "plates", "shoes", "heel_raisers", "belt", "knee_sleeves", "wrist_wraps", "shirt", "suit", "stool", "rack", "implements", "machine", "other",
        "unknown",
    ),
    "EventTimePrecision": ("date_only", "minute", "second", "millisecond", "unknown"),
    "ExerciseEquipment": (
        "none", "flat_bench", "incline_bench", "decline_bench", "rack", "box", "platforms", "machine", "cable_station", "landmine", "dip_bars",
        "hyperextension_bench", "unknown",
    ),
    "Grip": ("not_specified", "competition", "front_rack", "close", "wide", "neutral", "mixed", "overhand", "underhand", "supinated", "pronated", "unknown"),
    "IdentityLinkMethod": ("source_explicit_id", "exact_attribute_match", "fuzzy_attribute_match", "manual_review", "unresolved", "unknown"),
    "IdentityStatus": ("single_source_unverified", "single_source_verified", "cross_source_linked", "ambiguous_unresolved", "ambiguous_conflict", "unknown"),
    "ImplementType": (
        "barbell", "plate_loaded_barbell", "dumbbell", "kettlebell", "machine", "cable", "bodyweight", "band", "smith_machine", "specialty_bar", "other",
        "unknown",
    ),
    "Laterality": ("bilateral", "unilateral", "unknown"),
    "LiftType": ("squat", "bench", "deadlift"),
    "MissingnessReason": (
        "not_recorded_in_source", "not_applicable", "not_yet_recorded", "withheld_by_source", "redacted_for_privacy", "ambiguous_source_value",
        "source_error", "unknown",
    ),
    "NotPerformedReason": ("injury", "illness", "time_constraint", "travel", "scheduled_rest", "replaced_by_other_session", "program_cancelled", "unknown"),
    "ObservationMethod": ("self_report", "coach_report", "third_party_report", "device_measured", "instrumented_test", "video_review", "source_reported", "unknown"),
    "ObservationScope": ("athlete", "session", "exercise", "set", "rep", "competition", "unknown"),
    "ObservationType": (
        "rpe", "rir", "readiness_score", "soreness_score", "fatigue_score", "sleep_duration", "sleep_quality_score", "stress_score", "motivation_score",
        "mood_score", "pain_score", "confidence_score", "other_reported", "unknown",
    ),
    "ParentLift": ("squat", "bench", "deadlift", "accessory", "other", "unknown"),
    "ParticipationStatus": ("placed", "guest", "disqualified", "drug_disqualified", "no_show", "unknown"),
    "PauseRule": ("not_specified", "none", "competition", "brief", "count_2", "count_3", "long", "unknown"),
    "PrescriptionBasis": ("absolute_load", "percent_one_rm", "rpe_anchored", "rir_anchored", "bodyweight", "autoregulated", "unknown"),
    "ProgramModificationKind": (
        "load_change", "rep_change", "set_count_change", "exercise_substitution", "session_rescheduled", "session_cancelled", "session_added",
        "autoregulation_rule", "program_version_change", "other",
    ),
    "PublicationBasis": ("published_competition_results", "simulator_generated", "authored_vocabulary", "private_export", "unknown"),
    "QualityFlag": (
        "verified", "self_reported", "third_party_reported", "estimated", "rounded_to_increment", "device_measured", "lab_measured",
        "imported_without_source_time", "ambiguous_identity", "disputed", "out_of_plausible_range", "edited_after_the_fact", "unverified",
    ),
    "RangeOfMotion": ("not_specified", "competition", "full", "partial", "reduced", "elevated_start", "unknown"),
    "RedistributionPolicy": ("allowed", "restricted", "not_allowed", "unknown"),
    "RepStatus": ("completed", "failed", "assisted", "abandoned", "unknown"),
    "ReportedBestSemantics": ("successful_best", "failed_attempt_only"),
    "ReporterRole": ("athlete", "coach", "spotter", "other_trainer", "unknown"),
    "ResolutionMethod": (
        "canonical_identity", "registered_alias", "cross_source_alias", "structured_interpretation", "question_form", "generic_qualifier", "family_keyword",
        "curated_ambiguous", "no_match",
    ),
    "ResolutionStatus": ("exact_canonical", "resolved_alias", "partial_family", "ambiguous", "unmapped"),
    "SessionStatus": ("planned", "completed", "partially_completed", "skipped", "cancelled", "unknown"),
    "SessionType": ("training", "testing", "competition", "meet_warmup", "other", "unknown"),
    "SetStatus": ("completed", "partial", "failed", "aborted", "unknown"),
    "SexCategory": ("female", "male", "intersex", "other_self_described", "not_recorded", "unknown"),
    "SourceNature": ("real", "synthetic", "reference"),
    "SpecificityLevel": ("competition_lift", "competition_variation", "sport_specific", "general_strength", "accessory", "unknown"),
    "Stance": ("not_specified", "high", "low", "wide", "moderate", "narrow", "split", "unknown"),
    "TempoPattern": ("not_specified", "controlled_eccentric", "tempo_count", "tempo_prescribed", "unknown"),
    "TestType": ("maximal_single", "estimated_one_rm_from_work_sets", "repetition_test", "isometric", "jump_test", "strength_endurance_test", "other", "unknown"),
    "ValueEncoding": ("text", "number", "json"),
    "VelocityMethod": ("linear_position_transducer", "accelerometer", "optical", "radar", "manual_video", "estimated_by_coach", "unknown"),
}


@dataclass(frozen=True)
class TableSpec:
    """A canonical table."""

    name: str
    category: str
    primary_key: tuple[str, ...]
    order: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f[0] for f in self.fields]

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f[0], _KINDS[f[1]], True) for f in self.fields])

    @property
    def vocabularies(self) -> dict[str, tuple[str, ...]]:
        """Column to its members."""
        found = {f[0]: VOCABULARIES[f[2]] for f in self.fields if len(f) == 3}
        return found | ({"quality_flags": VOCABULARIES["QualityFlag"]} if "quality_flags" in self.columns else {})


_KINDS = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}

#: The tables with key, order and columns.
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        TableSpec(
            "source", "provenance", ("source_id",), ("source_id",),
            (
                ("source_id", "string"), ("nature", "string", "SourceNature"), ("regime", "string", "DataRegime"), ("origin_system", "string"),
                ("display_name", "string"), ("dataset_version", "string"), ("snapshot_date", "timestamp"), ("snapshot_sha256", "string"), ("license_id", "string"),
                ("license_url", "string"), ("publication_basis", "string", "PublicationBasis"), ("consent_basis", "string", "ConsentBasis"),
                ("redistribution", "string", "RedistributionPolicy"), ("ingested_at", "timestamp"), ("notes", "string"),
            ),
        ),
        TableSpec(
            "provenance", "provenance", ("provenance_id",), ("dataset_id", "transform_name", "provenance_id"),
            (
                ("provenance_id", "string"), ("dataset_id", "string"), ("parent_dataset_id", "string"), ("transform_name", "string"), ("transform_version", "string"),
                ("code_commit", "string"), ("config_sha256", "string"), ("schema_version", "string"), ("random_seed", "bigint"), ("created_at", "timestamp"),
                ("description", "string"),
            ),
        ),
        TableSpec(
            "athlete", "context", ("athlete_id",), ("athlete_id",),
            (
                ("athlete_id", "string"), ("pseudonym", "string"), ("identity_status", "string", "IdentityStatus"), ("ambiguity_group_id", "string"),
                ("is_synthetic", "boolean"), ("synthetic_regime", "string"), ("sex_category_raw", "string"), ("sex_category", "string", "SexCategory"),
                ("birth_year", "bigint"), ("country_code", "string"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "athlete_source_link", "context", ("athlete_id", "source_id"), ("athlete_id", "source_id"),
            (
                ("athlete_id", "string"), ("source_athlete_key", "string"), ("link_method", "string", "IdentityLinkMethod"), ("link_confidence", "double"),
                ("is_primary", "boolean"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "body_measurement", "context", ("body_measurement_id",), ("athlete_id", "measured_at", "body_measurement_id"),
            (
                ("body_measurement_id", "string"), ("athlete_id", "string"), ("measured_at", "timestamp"), ("measurement_type", "string", "BodyMeasurementType"),
                ("event_time_precision", "string", "EventTimePrecision"), ("measurement_context", "string", "BodyMassContext"),
                ("method", "string", "BodyMeasurementMethod"), ("raw_value", "double"), ("raw_unit", "string"), ("value_normalized", "double"),
                ("unit_normalized", "string"), ("created_at", "timestamp"), ("observed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "equipment_state", "context", ("equipment_state_id",), ("athlete_id", "equipment_item", "effective_from", "equipment_state_id"),
            (
                ("equipment_state_id", "string"), ("athlete_id", "string"), ("equipment_item", "string", "EquipmentItem"), ("effective_from", "timestamp"),
                ("effective_to", "timestamp"), ("identifier", "string"), ("version_label", "string"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "competition_meet", "context", ("competition_meet_id",), ("meet_date", "meet_federation", "meet_name", "competition_meet_id"),
            (
                ("competition_meet_id", "string"), ("meet_name", "string"), ("meet_date", "timestamp"), ("event_time_precision", "string", "EventTimePrecision"),
                ("meet_federation", "string"), ("meet_parent_federation", "string"), ("meet_country", "string"), ("meet_state", "string"), ("meet_town", "string"),
                ("sanctioned_status_raw", "string"), ("is_sanctioned", "boolean"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "exercise_definition", "semantics", ("exercise_id",), ("canonical_key", "exercise_id"),
            (
                ("exercise_id", "string"), ("canonical_key", "string"), ("canonical_name", "string"), ("parent_lift", "string", "ParentLift"),
                ("specificity_level", "string", "SpecificityLevel"), ("implement", "string", "ImplementType"), ("bar_type", "string", "BarType"),
                ("equipment", "string", "ExerciseEquipment"), ("laterality", "string", "Laterality"), ("stance", "string", "Stance"), ("grip", "string", "Grip"),
                ("range_of_motion", "string", "RangeOfMotion"), ("pause", "boolean"), ("pause_rule", "string", "PauseRule"), ("tempo", "string", "TempoPattern"),
                ("configuration", "array<string>"), ("equipment_note", "string"), ("definition_note", "string"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "exercise_alias", "semantics", ("exercise_alias_id",), ("source_system", "alias_normalized", "exercise_id", "exercise_alias_id"),
            (
                ("exercise_alias_id", "string"), ("exercise_id", "string"), ("source_system", "string"), ("alias_raw", "string"), ("alias_normalized", "string"),
                ("mapping_status", "string", "ResolutionStatus"), ("mapping_version", "string"), ("ontology_version", "string"), ("note", "string"),
                ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "exercise_normalization", "semantics", ("normalization_id",), ("source_system", "normalized_label", "raw_label", "normalization_id"),
            (
                ("normalization_id", "string"), ("raw_label", "string"), ("normalized_label", "string"), ("normalization_rules", "array<string>"),
                ("source_system", "string"), ("source_alias_id", "string"), ("resolution_status", "string", "ResolutionStatus"),
                ("resolution_method", "string", "ResolutionMethod"), ("exercise_id", "string"), ("parent_lift", "string", "ParentLift"),
                ("candidate_exercise_ids", "array<string>"), ("ambiguity_reason", "string", "AmbiguityReason"), ("mapping_version", "string"),
                ("ontology_version", "string"), ("note", "string"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "program", "programming", ("program_id",), ("program_id",),
            (
                ("program_id", "string"), ("name", "string"), ("description", "string"), ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "program_version", "programming", ("program_version_id",), ("program_id", "effective_from", "program_version_id"),
            (
                ("program_version_id", "string"), ("program_id", "string"), ("version_label", "string"), ("effective_from", "timestamp"),
                ("effective_to", "timestamp"), ("authored_at", "timestamp"), ("change_summary", "string"), ("supersedes_program_version_id", "string"),
                ("created_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "program_modification", "programming", ("program_modification_id",), ("athlete_id", "known_at", "program_modification_id"),
            (
                ("program_modification_id", "string"), ("athlete_id", "string"), ("planned_session_id", "string"), ("program_version_id", "string"),
                ("known_at", "timestamp"), ("change_kind", "string", "ProgramModificationKind"), ("field_changed", "string"), ("previous_value", "string"),
                ("new_value", "string"), ("value_encoding", "string", "ValueEncoding"), ("rationale", "string"), ("created_at", "timestamp"),
                ("scheduled_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "planned_session", "programming", ("planned_session_id",), ("athlete_id", "scheduled_at", "session_order_index", "planned_session_id"),
            (
                ("planned_session_id", "string"), ("athlete_id", "string"), ("program_version_id", "string"), ("scheduled_at", "timestamp"),
                ("session_order_index", "bigint"), ("session_status", "string", "SessionStatus"), ("not_performed_reason", "string", "NotPerformedReason"),
                ("template_label", "string"), ("created_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "planned_exercise", "programming", ("planned_exercise_id",), ("planned_session_id", "ordinal", "planned_exercise_id"),
            (
                ("planned_exercise_id", "string"), ("planned_session_id", "string"), ("exercise_id", "string"), ("ordinal", "bigint"),
                ("supersedes_planned_exercise_id", "string"), ("created_at", "timestamp"), ("scheduled_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "planned_set", "programming", ("planned_set_id",), ("planned_exercise_id", "ordinal", "planned_set_id"),
            (
                ("planned_set_id", "string"), ("planned_exercise_id", "string"), ("ordinal", "bigint"), ("target_reps", "bigint"), ("target_reps_min", "bigint"),
                ("target_reps_max", "bigint"), ("target_load_raw", "double"), ("target_load_unit", "string"), ("target_load_kg", "double"), ("target_rpe", "double"),
                ("target_rir", "double"), ("target_percent_one_rm", "double"), ("target_duration_seconds", "double"), ("rest_target_seconds", "double"),
                ("prescription_basis", "string", "PrescriptionBasis"), ("created_at", "timestamp"), ("scheduled_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "performed_session", "execution", ("performed_session_id",), ("athlete_id", "started_at", "session_order_index", "performed_session_id"),
            (
                ("performed_session_id", "string"), ("athlete_id", "string"), ("planned_session_id", "string"), ("started_at", "timestamp"),
                ("session_order_index", "bigint"), ("session_type", "string", "SessionType"), ("ended_at", "timestamp"), ("duration_seconds", "double"),
                ("is_completed", "boolean"), ("created_at", "timestamp"), ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "performed_exercise", "execution", ("performed_exercise_id",), ("performed_session_id", "ordinal", "performed_exercise_id"),
            (
                ("performed_exercise_id", "string"), ("performed_session_id", "string"), ("exercise_id", "string"), ("ordinal", "bigint"),
                ("planned_exercise_id", "string"), ("is_substitution", "boolean"), ("substituted_from_exercise_id", "string"), ("created_at", "timestamp"),
                ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "performed_set", "execution", ("performed_set_id",), ("performed_exercise_id", "ordinal", "performed_set_id"),
            (
                ("performed_set_id", "string"), ("performed_exercise_id", "string"), ("ordinal", "bigint"), ("planned_set_id", "string"),
                ("set_status", "string", "SetStatus"), ("load_raw", "double"), ("load_unit", "string"), ("load_kg", "double"), ("reps_performed", "bigint"),
                ("reps_failed", "bigint"), ("is_failure", "boolean"), ("rpe", "double"), ("rir", "double"), ("tempo_actual", "string"),
                ("duration_seconds", "double"), ("rest_actual_seconds", "double"), ("is_warmup", "boolean"), ("rep_level_data_available", "boolean"),
                ("incomplete_reason", "string", "MissingnessReason"), ("created_at", "timestamp"), ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "performed_rep", "execution", ("performed_rep_id",), ("performed_set_id", "rep_ordinal", "performed_rep_id"),
            (
                ("performed_rep_id", "string"), ("performed_set_id", "string"), ("rep_ordinal", "bigint"), ("rep_status", "string", "RepStatus"),
                ("is_success", "boolean"), ("load_raw", "double"), ("load_unit", "string"), ("load_kg", "double"), ("rpe", "double"), ("velocity_mps", "double"),
                ("created_at", "timestamp"), ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "observation", "observation", ("observation_id",), ("athlete_id", "observed_at", "observation_id"),
            (
                ("observation_id", "string"), ("athlete_id", "string"), ("observed_at", "timestamp"), ("observation_type", "string", "ObservationType"),
                ("observation_method", "string", "ObservationMethod"), ("observation_scope", "string", "ObservationScope"),
                ("reporter_role", "string", "ReporterRole"), ("instrument", "string"), ("numeric_value", "double"), ("text_value", "string"), ("unit", "string"),
                ("parent_session_id", "string"), ("parent_exercise_id", "string"), ("parent_set_id", "string"), ("parent_rep_id", "string"),
                ("parent_competition_id", "string"), ("created_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "performance_test", "observation", ("performance_test_id",), ("athlete_id", "observed_at", "performance_test_id"),
            (
                ("performance_test_id", "string"), ("athlete_id", "string"), ("observed_at", "timestamp"), ("test_type", "string", "TestType"),
                ("exercise_id", "string"), ("performed_set_id", "string"), ("competition_id", "string"), ("protocol_label", "string"), ("result_metric", "string"),
                ("result_raw", "double"), ("result_unit", "string"), ("result_normalized", "double"), ("result_unit_normalized", "string"),
                ("created_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "velocity_observation", "observation", ("velocity_observation_id",), ("athlete_id", "observed_at", "velocity_observation_id"),
            (
                ("velocity_observation_id", "string"), ("athlete_id", "string"), ("observed_at", "timestamp"), ("performed_set_id", "string"),
                ("performed_rep_id", "string"), ("method", "string", "VelocityMethod"), ("mean_velocity_mps", "double"), ("peak_velocity_mps", "double"),
                ("velocity_loss_percent", "double"), ("load_raw", "double"), ("load_unit", "string"), ("load_kg", "double"), ("sampling_hz", "double"),
                ("created_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "competition", "competition", ("competition_id",), ("athlete_id", "competition_date", "competition_id"),
            (
                ("competition_id", "string"), ("athlete_id", "string"), ("competition_meet_id", "string"), ("competition_date", "timestamp"),
                ("event_time_precision", "string", "EventTimePrecision"), ("competition_event", "string", "CompetitionEvent"), ("name", "string"),
                ("federation", "string"), ("sanctioning_body", "string"), ("location", "string"), ("equipment_class_raw", "string"),
                ("equipment_class", "string", "EquipmentClass"), ("weight_class_raw", "string"), ("bodyweight_raw", "double"), ("bodyweight_unit", "string"),
                ("bodyweight_kg", "double"), ("participation_status", "string"), ("participation_place", "bigint"),
                ("participation_status_kind", "string", "ParticipationStatus"), ("is_drug_tested_category", "boolean"), ("age_reported", "double"),
                ("age_precision", "string", "AgePrecision"), ("age_class_raw", "string"), ("birth_year_class_raw", "string"), ("division_raw", "string"),
                ("athlete_country_raw", "string"), ("athlete_region_raw", "string"), ("is_championship", "boolean"), ("created_at", "timestamp"),
                ("observed_at", "timestamp"), ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "competition_attempt", "competition", ("competition_attempt_id",), ("athlete_id", "competition_id", "lift", "attempt_number", "competition_attempt_id"),
            (
                ("competition_attempt_id", "string"), ("competition_id", "string"), ("athlete_id", "string"), ("lift", "string", "LiftType"),
                ("attempt_number", "bigint"), ("attempt_role", "string", "AttemptRole"), ("attempt_order_basis", "string", "AttemptOrderBasis"),
                ("attempt_time", "timestamp"), ("source_attempt_raw", "double"), ("load_raw", "double"), ("load_unit", "string"), ("load_kg", "double"),
                ("result", "string", "AttemptResult"), ("is_opener", "boolean"), ("created_at", "timestamp"), ("observed_at", "timestamp"),
                ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
        TableSpec(
            "competition_reported_result", "competition", ("competition_reported_result_id",), ("athlete_id", "competition_id", "result_kind", "competition_reported_result_id"),
            (
                ("competition_reported_result_id", "string"), ("competition_id", "string"), ("athlete_id", "string"),
                ("result_kind", "string", "CompetitionResultKind"), ("value", "double"), ("unit", "string"), ("source_value_raw", "double"),
                ("result_source_field", "string"), ("reported_best_semantics", "string", "ReportedBestSemantics"), ("is_derived", "boolean"),
                ("derivation_note", "string"), ("created_at", "timestamp"), ("observed_at", "timestamp"), ("performed_at", "timestamp"), ("modified_at", "timestamp"),
                *PROVENANCE,
            ),
        ),
    )
}

#: Foreign keys as table, column, target, code; every target key is the table's own id.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("body_measurement", "athlete_id", "athlete", "dangling_athlete"),
    ("equipment_state", "athlete_id", "athlete", "dangling_athlete"),
    ("planned_session", "athlete_id", "athlete", "dangling_athlete"),
    ("performed_session", "athlete_id", "athlete", "dangling_athlete"),
    ("observation", "athlete_id", "athlete", "dangling_athlete"),
    ("performance_test", "athlete_id", "athlete", "dangling_athlete"),
    ("velocity_observation", "athlete_id", "athlete", "dangling_velocity_athlete"),
    ("competition", "athlete_id", "athlete", "dangling_competition"),
    ("competition", "competition_meet_id", "competition_meet", "dangling_meet"),
    ("competition_attempt", "athlete_id", "athlete", "dangling_athlete"),
    ("competition_attempt", "competition_id", "competition", "dangling_competition"),
    ("competition_reported_result", "competition_id", "competition", "dangling_competition_result"),
    ("performed_exercise", "performed_session_id", "performed_session", "dangling_performed_session"),
    ("performed_set", "performed_exercise_id", "performed_exercise", "dangling_performed_exercise"),
    ("performed_rep", "performed_set_id", "performed_set", "dangling_performed_set"),
    ("planned_exercise", "planned_session_id", "planned_session", "dangling_planned_session"),
    ("planned_set", "planned_exercise_id", "planned_exercise", "dangling_planned_exercise"),
    ("performed_session", "planned_session_id", "planned_session", "dangling_plan_link"),
    ("performed_exercise", "planned_exercise_id", "planned_exercise", "dangling_plan_link"),
    ("performed_set", "planned_set_id", "planned_set", "dangling_plan_link"),
    ("planned_session", "program_version_id", "program_version", "dangling_program_version"),
    ("performed_exercise", "exercise_id", "exercise_definition", "dangling_exercise"),
    ("planned_exercise", "exercise_id", "exercise_definition", "dangling_exercise"),
    ("exercise_alias", "exercise_id", "exercise_definition", "dangling_exercise"),
    ("exercise_normalization", "exercise_id", "exercise_definition", "dangling_exercise"),
    ("exercise_normalization", "source_alias_id", "exercise_alias", "dangling_exercise_alias"),
    ("velocity_observation", "performed_set_id", "performed_set", "dangling_velocity_set"),
    ("velocity_observation", "performed_rep_id", "performed_rep", "dangling_velocity_rep"),
    ("performance_test", "performed_set_id", "performed_set", "dangling_test_set"),
)

#: Inclusive ranges of columns, and columns that must be positive.
RANGES: dict[str, tuple[float, float]] = {
    "ordinal": (0.0, 1000.0),
    "rep_ordinal": (1.0, 1000.0),
    "target_reps": (0.0, 1000.0),
    "target_reps_min": (0.0, 1000.0),
    "target_reps_max": (0.0, 1000.0),
    "reps_performed": (0.0, 1000.0),
    "reps_failed": (0.0, 1000.0),
    "target_rpe": (0.0, 10.0),
    "target_rir": (0.0, 10.0),
    "rpe": (0.0, 10.0),
    "rir": (0.0, 10.0),
    "target_percent_one_rm": (0.0, 100.0),
    "velocity_loss_percent": (0.0, 100.0),
    "link_confidence": (0.0, 1.0),
    "attempt_number": (1.0, 4.0),
    "participation_place": (1.0, 10000.0),
    "age_reported": (0.0, 130.0),
    "birth_year": (1900.0, 2100.0),
    "mean_velocity_mps": (0.0, 20.0),
    "peak_velocity_mps": (0.0, 30.0),
    "sampling_hz": (0.0, 1000.0),
    "duration_seconds": (0.0, 172800.0),
    "rest_actual_seconds": (0.0, 172800.0),
    "rest_target_seconds": (0.0, 172800.0),
    "target_duration_seconds": (0.0, 172800.0),
    "session_order_index": (0.0, 64.0),
}
POSITIVE = ("load_raw", "load_kg", "target_load_raw", "target_load_kg", "bodyweight_raw", "bodyweight_kg", "value_normalized", "result_normalized")
