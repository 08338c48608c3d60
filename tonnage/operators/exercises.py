"""The exercise vocabulary: definitions, aliases of source systems, labels that are refused."""

from __future__ import annotations

from tonnage.operators.labels import Vocabulary

FIELDS = ("key", "name", "parent_lift", "specificity_level", "implement", "bar_type", "equipment", "laterality", "stance", "grip", "range_of_motion", "pause_rule", "tempo", "configuration")
#: Exercises; the last field lists configuration flags.
EXERCISES = (
    ("squat", "Squat", "squat", "competition_lift", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "not_specified", "competition", "competition", "unknown", ()),
    ("low_bar_squat", "Low Bar Squat", "squat", "sport_specific", "barbell", "specialty_bar", "none", "bilateral", "low", "unknown", "competition", "competition", "unknown", ()),
    ("high_bar_squat", "High Bar Squat", "squat", "sport_specific", "barbell", "specialty_bar", "none", "bilateral", "high", "unknown", "competition", "competition", "unknown", ()),
    ("front_squat", "Front Squat", "squat", "sport_specific", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "front_rack", "competition", "competition", "unknown", ()),
    ("pause_squat", "Paused Squat", "squat", "competition_variation", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "competition", "brief", "unknown", ()),
    ("tempo_squat", "Tempo Squat", "squat", "competition_variation", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "competition", "competition", "tempo_prescribed", ()),
    ("pin_squat", "Pin Squat", "squat", "sport_specific", "barbell", "safety_bar", "rack", "bilateral", "unknown", "unknown", "partial", "competition", "unknown", ("safety_bars",)),
    ("box_squat", "Box Squat", "squat", "sport_specific", "barbell", "specialty_bar", "box", "bilateral", "unknown", "unknown", "partial", "competition", "unknown", ("block_supported",)),
    ("safety_bar_squat", "Safety Bar Squat", "squat", "sport_specific", "barbell", "safety_bar", "rack", "bilateral", "unknown", "unknown", "competition", "competition", "unknown", ("safety_bars",)),
    ("bench", "Bench Press", "bench", "competition_lift", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "not_specified", "competition", "competition", "unknown", ()),
    ("pause_bench", "Paused Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "competition", "brief", "unknown", ()),
    ("two_count_bench", "2-Count Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "competition", "count_2", "unknown", ()),
    ("three_count_bench", "3-Count Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "competition", "count_3", "unknown", ()),
    ("long_pause_bench", "Long Pause Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "competition", "long", "unknown", ()),
    ("close_grip_bench", "Close-Grip Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "close", "competition", "competition", "unknown", ("hand_spacing_reduced",)),
    ("wide_grip_bench", "Wide-Grip Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "wide", "competition", "competition", "unknown", ("hand_spacing_wide",)),
    ("spoto_press", "Spoto Press", "bench", "sport_specific", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "reduced", "competition", "unknown", ("competition_touch_point", "seated", "short_range_of_motion")),
    ("feet_up_bench", "Feet-Up Bench Press", "bench", "sport_specific", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "competition", "competition", "unknown", ("feet_elevated", "seated")),
    ("board_press", "Board Press", "bench", "sport_specific", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ("block_supported", "short_range_of_motion")),
    ("tempo_bench", "Tempo Bench Press", "bench", "competition_variation", "barbell", "olympic_bar", "flat_bench", "bilateral", "unknown", "unknown", "competition", "competition", "tempo_prescribed", ()),
    ("incline_bench", "Incline Bench Press", "bench", "general_strength", "barbell", "olympic_bar", "incline_bench", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("decline_bench", "Decline Bench Press", "bench", "general_strength", "barbell", "olympic_bar", "decline_bench", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("floor_press", "Floor Press", "bench", "general_strength", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "reduced", "none", "unknown", ("short_range_of_motion",)),
    ("dumbbell_bench", "Dumbbell Bench Press", "bench", "general_strength", "dumbbell", "not_applicable", "flat_bench", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("smith_bench", "Smith Machine Bench Press", "bench", "general_strength", "smith_machine", "not_applicable", "machine", "bilateral", "unknown", "unknown", "competition", "none", "unknown", ()),
    ("deadlift", "Deadlift", "deadlift", "competition_lift", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "unknown", "competition", "competition", "unknown", ()),
    ("conventional_deadlift", "Conventional Deadlift", "deadlift", "competition_variation", "barbell", "olympic_bar", "none", "bilateral", "moderate", "unknown", "competition", "competition", "unknown", ()),
    ("sumo_deadlift", "Sumo Deadlift", "deadlift", "competition_variation", "barbell", "olympic_bar", "none", "bilateral", "wide", "unknown", "competition", "competition", "unknown", ()),
    ("pause_deadlift", "Paused Deadlift", "deadlift", "competition_variation", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "unknown", "competition", "brief", "unknown", ()),
    ("tempo_deadlift", "Tempo Deadlift", "deadlift", "competition_variation", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "unknown", "competition", "competition", "tempo_prescribed", ()),
    ("deficit_deadlift", "Deficit Deadlift", "deadlift", "sport_specific", "barbell", "olympic_bar", "platforms", "bilateral", "not_specified", "unknown", "elevated_start", "competition", "unknown", ()),
    ("block_pull", "Block Pull", "deadlift", "sport_specific", "barbell", "olympic_bar", "box", "bilateral", "not_specified", "unknown", "partial", "competition", "unknown", ("block_supported", "short_range_of_motion")),
    ("rack_pull", "Rack Pull", "deadlift", "sport_specific", "barbell", "olympic_bar", "rack", "bilateral", "not_specified", "unknown", "partial", "competition", "unknown", ("block_supported", "short_range_of_motion")),
    ("rdl", "Romanian Deadlift", "deadlift", "sport_specific", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "unknown", "partial", "none", "unknown", ()),
    ("stiff_leg_deadlift", "Stiff-Leg Deadlift", "deadlift", "sport_specific", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "unknown", "partial", "none", "unknown", ()),
    ("trap_bar_deadlift", "Trap-Bar Deadlift", "deadlift", "sport_specific", "barbell", "trap_bar", "none", "bilateral", "moderate", "unknown", "competition", "competition", "unknown", ()),
    ("good_morning", "Good Morning", "deadlift", "general_strength", "barbell", "olympic_bar", "none", "bilateral", "not_specified", "unknown", "partial", "none", "unknown", ()),
    ("hack_squat", "Hack Squat", "squat", "general_strength", "machine", "not_applicable", "machine", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("leg_press", "Leg Press", "accessory", "accessory", "machine", "not_applicable", "machine", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("leg_extension", "Leg Extension", "accessory", "accessory", "machine", "not_applicable", "machine", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("leg_curl", "Leg Curl", "accessory", "accessory", "machine", "not_applicable", "machine", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("goblet_squat", "Goblet Squat", "squat", "accessory", "kettlebell", "not_applicable", "none", "bilateral", "not_specified", "unknown", "partial", "none", "unknown", ()),
    ("walking_lunge", "Walking Lunge", "squat", "accessory", "dumbbell", "not_applicable", "none", "unilateral", "split", "unknown", "partial", "none", "unknown", ()),
    ("bulgarian_split_squat", "Bulgarian Split Squat", "squat", "accessory", "dumbbell", "not_applicable", "none", "unilateral", "split", "unknown", "partial", "none", "unknown", ("feet_elevated",)),
    ("lat_pulldown", "Lat Pulldown", "accessory", "accessory", "cable", "not_applicable", "cable_station", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("pull_up", "Pull-Up", "accessory", "accessory", "bodyweight", "not_applicable", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("chin_up", "Chin-Up", "accessory", "accessory", "bodyweight", "not_applicable", "none", "bilateral", "unknown", "underhand", "full", "none", "unknown", ()),
    ("barbell_row", "Barbell Row", "accessory", "general_strength", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("pendlay_row", "Pendlay Row", "accessory", "sport_specific", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ("touch_and_go",)),
    ("t_bar_row", "T-Bar Row", "accessory", "accessory", "barbell", "t_bar", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("seated_cable_row", "Seated Cable Row", "accessory", "accessory", "cable", "not_applicable", "cable_station", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ("seated",)),
    ("overhead_press", "Overhead Press", "accessory", "general_strength", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("push_up", "Push-Up", "accessory", "accessory", "bodyweight", "not_applicable", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("dips", "Dips", "accessory", "accessory", "bodyweight", "not_applicable", "dip_bars", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("cable_fly", "Cable Fly", "accessory", "accessory", "cable", "not_applicable", "cable_station", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("lateral_raise", "Lateral Raise", "accessory", "accessory", "dumbbell", "not_applicable", "none", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("rear_delt_fly", "Rear Delt Fly", "accessory", "accessory", "dumbbell", "not_applicable", "none", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("face_pull", "Face Pull", "accessory", "accessory", "cable", "not_applicable", "cable_station", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("barbell_curl", "Barbell Curl", "accessory", "accessory", "barbell", "olympic_bar", "none", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("dumbbell_curl", "Dumbbell Curl", "accessory", "accessory", "dumbbell", "not_applicable", "none", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("hammer_curl", "Hammer Curl", "accessory", "accessory", "dumbbell", "not_applicable", "none", "bilateral", "unknown", "neutral", "partial", "none", "unknown", ()),
    ("triceps_pushdown", "Triceps Pushdown", "accessory", "accessory", "cable", "not_applicable", "cable_station", "bilateral", "unknown", "unknown", "partial", "none", "unknown", ()),
    ("plank", "Plank", "accessory", "accessory", "bodyweight", "not_applicable", "none", "bilateral", "unknown", "unknown", "not_specified", "none", "unknown", ()),
    ("side_plank", "Side Plank", "accessory", "accessory", "bodyweight", "not_applicable", "none", "unilateral", "unknown", "unknown", "not_specified", "none", "unknown", ()),
    ("hanging_leg_raise", "Hanging Leg Raise", "accessory", "accessory", "bodyweight", "not_applicable", "none", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
    ("back_extension", "Back Extension", "accessory", "accessory", "bodyweight", "not_applicable", "hyperextension_bench", "bilateral", "unknown", "unknown", "full", "none", "unknown", ()),
)
#: Aliases as source system, label, key.
ALIASES = (
    ("generic_csv", "Comp Squat", "squat"),
    ("generic_csv", "Squat (Competition)", "squat"),
    ("hevy", "Competition Squat", "squat"),
    ("strong", "Squat", "squat"),
    ("generic_csv", "Low-Bar Squat", "low_bar_squat"),
    ("generic_csv", "Lowbar Squat", "low_bar_squat"),
    ("generic_csv", "High-Bar Squat", "high_bar_squat"),
    ("generic_csv", "Highbar Squat", "high_bar_squat"),
    ("generic_csv", "Front-Squat", "front_squat"),
    ("hevy", "Paused Squat", "pause_squat"),
    ("generic_csv", "Pause Squat", "pause_squat"),
    ("generic_csv", "Squat Pause", "pause_squat"),
    ("generic_csv", "Tempo Squat Press", "tempo_squat"),
    ("generic_csv", "Tempo Squat", "tempo_squat"),
    ("generic_csv", "Safety Bar Squat", "safety_bar_squat"),
    ("generic_csv", "SSB Squat", "safety_bar_squat"),
    ("generic_csv", "Pin Squat", "pin_squat"),
    ("generic_csv", "Box Squat", "box_squat"),
    ("generic_csv", "Comp Bench", "bench"),
    ("generic_csv", "Bench Press (Competition)", "bench"),
    ("hevy", "Competition Bench Press", "bench"),
    ("hevy", "Competition Bench", "bench"),
    ("generic_csv", "Benchpress", "bench"),
    ("strong", "Flat Bench Press", "bench"),
    ("generic_csv", "Pause Bench", "pause_bench"),
    ("hevy", "Paused Bench Press", "pause_bench"),
    ("hevy", "Paused Bench", "pause_bench"),
    ("strong", "Paused Bench", "pause_bench"),
    ("generic_csv", "Bench Pause", "pause_bench"),
    ("generic_csv", "2ct Bench", "two_count_bench"),
    ("hevy", "2ct Bench", "two_count_bench"),
    ("generic_csv", "2-count Bench", "two_count_bench"),
    ("generic_csv", "2 Count Bench Press", "two_count_bench"),
    ("generic_csv", "Two Count Bench", "two_count_bench"),
    ("generic_csv", "3ct Bench", "three_count_bench"),
    ("generic_csv", "3 Count Bench Press", "three_count_bench"),
    ("generic_csv", "Long Pause Bench", "long_pause_bench"),
    ("generic_csv", "2s Pause Bench", "long_pause_bench"),
    ("generic_csv", "Close Grip Bench", "close_grip_bench"),
    ("generic_csv", "Close-Grip Bench Press", "close_grip_bench"),
    ("generic_csv", "CGBP", "close_grip_bench"),
    ("hevy", "CGBP", "close_grip_bench"),
    ("strong", "CGBP", "close_grip_bench"),
    ("hevy", "Close Grip Bench Press", "close_grip_bench"),
    ("generic_csv", "Wide Grip Bench", "wide_grip_bench"),
    ("generic_csv", "Wide-Grip Bench Press", "wide_grip_bench"),
    ("generic_csv", "Spoto Press", "spoto_press"),
    ("generic_csv", "Spoto", "spoto_press"),
    ("generic_csv", "Feet Up Bench", "feet_up_bench"),
    ("generic_csv", "Feet-Up Bench Press", "feet_up_bench"),
    ("generic_csv", "Feet Elevated Bench", "feet_up_bench"),
    ("generic_csv", "Board Press", "board_press"),
    ("generic_csv", "Tempo Bench", "tempo_bench"),
    ("generic_csv", "Tempo Bench Press", "tempo_bench"),
    ("generic_csv", "Incline Bench", "incline_bench"),
    ("generic_csv", "Incline Bench Press", "incline_bench"),
    ("generic_csv", "Decline Bench", "decline_bench"),
    ("generic_csv", "Decline Bench Press", "decline_bench"),
    ("generic_csv", "Floor Press", "floor_press"),
    ("generic_csv", "Dumbbell Bench", "dumbbell_bench"),
    ("generic_csv", "DB Bench Press", "dumbbell_bench"),
    ("generic_csv", "Smith Machine Bench", "smith_bench"),
    ("generic_csv", "Smith Bench", "smith_bench"),
    ("generic_csv", "Comp Deadlift", "deadlift"),
    ("hevy", "Competition Deadlift", "deadlift"),
    ("generic_csv", "Deadlift (Conventional)", "conventional_deadlift"),
    ("generic_csv", "Conventional Pull", "conventional_deadlift"),
    ("generic_csv", "Conv DL", "conventional_deadlift"),
    ("generic_csv", "Conventional DL", "conventional_deadlift"),
    ("generic_csv", "Standard Deadlift", "conventional_deadlift"),
    ("generic_csv", "Sumo DL", "sumo_deadlift"),
    ("generic_csv", "Sumo Pull", "sumo_deadlift"),
    ("hevy", "Sumo Deadlift", "sumo_deadlift"),
    ("generic_csv", "Pause Deadlift", "pause_deadlift"),
    ("hevy", "Paused Deadlift", "pause_deadlift"),
    ("generic_csv", "Tempo Deadlift", "tempo_deadlift"),
    ("generic_csv", "Deficit Deadlift", "deficit_deadlift"),
    ("generic_csv", "Deficit Pull", "deficit_deadlift"),
    ("generic_csv", "Block Pull", "block_pull"),
    ("generic_csv", "Rack Pull", "rack_pull"),
    ("generic_csv", "Rack Pulls", "rack_pull"),
    ("generic_csv", "RDL", "rdl"),
    ("generic_csv", "Romanian Deadlift", "rdl"),
    ("generic_csv", "Stiff Leg Deadlift", "stiff_leg_deadlift"),
    ("generic_csv", "Stiff-Leg DL", "stiff_leg_deadlift"),
    ("generic_csv", "Trap Bar Deadlift", "trap_bar_deadlift"),
    ("generic_csv", "Trap-Bar DL", "trap_bar_deadlift"),
    ("generic_csv", "Good Morning", "good_morning"),
    ("generic_csv", "Goodmorning", "good_morning"),
    ("generic_csv", "Hack Squat Machine", "hack_squat"),
    ("generic_csv", "Leg Press Machine", "leg_press"),
    ("spreadsheet", "Legpress", "leg_press"),
    ("spreadsheet", "Leg Curl Machine", "leg_curl"),
    ("spreadsheet", "Leg Extension Machine", "leg_extension"),
    ("generic_csv", "Goblet Squat", "goblet_squat"),
    ("generic_csv", "Goblet Squat Kettlebell", "goblet_squat"),
    ("generic_csv", "Walking Lunge", "walking_lunge"),
    ("generic_csv", "Bulgarian Split Squat", "bulgarian_split_squat"),
    ("generic_csv", "BSS", "bulgarian_split_squat"),
    ("generic_csv", "Lat Pulldown", "lat_pulldown"),
    ("generic_csv", "Lat Pull Down", "lat_pulldown"),
    ("generic_csv", "Pull Up", "pull_up"),
    ("generic_csv", "Pullup", "pull_up"),
    ("generic_csv", "Chin Up", "chin_up"),
    ("generic_csv", "Chinup", "chin_up"),
    ("generic_csv", "Barbell Row", "barbell_row"),
    ("generic_csv", "Bent Over Row", "barbell_row"),
    ("generic_csv", "Pendlay Row", "pendlay_row"),
    ("generic_csv", "T Bar Row", "t_bar_row"),
    ("generic_csv", "T-Bar Row", "t_bar_row"),
    ("generic_csv", "Seated Cable Row", "seated_cable_row"),
    ("generic_csv", "Cable Row", "seated_cable_row"),
    ("generic_csv", "Overhead Press", "overhead_press"),
    ("generic_csv", "OHP", "overhead_press"),
    ("generic_csv", "Military Press", "overhead_press"),
    ("generic_csv", "Push Up", "push_up"),
    ("generic_csv", "Pushup", "push_up"),
    ("generic_csv", "Chest Dip", "dips"),
    ("generic_csv", "Weighted Dip", "dips"),
    ("generic_csv", "Cable Fly", "cable_fly"),
    ("generic_csv", "Cable Crossover", "cable_fly"),
    ("generic_csv", "Lat Raise", "lateral_raise"),
    ("generic_csv", "Dumbbell Lateral Raise", "lateral_raise"),
    ("generic_csv", "Lateral Raises", "lateral_raise"),
    ("generic_csv", "Side Lateral Raise", "lateral_raise"),
    ("generic_csv", "Rear Delt Fly", "rear_delt_fly"),
    ("generic_csv", "Rear Delt Raise", "rear_delt_fly"),
    ("generic_csv", "Face Pull", "face_pull"),
    ("generic_csv", "Barbell Curl", "barbell_curl"),
    ("generic_csv", "BB Curl", "barbell_curl"),
    ("generic_csv", "Dumbbell Curl", "dumbbell_curl"),
    ("generic_csv", "DB Curl", "dumbbell_curl"),
    ("generic_csv", "Hammer Curl", "hammer_curl"),
    ("generic_csv", "Triceps Pushdown", "triceps_pushdown"),
    ("generic_csv", "Tricep Pushdown", "triceps_pushdown"),
    ("generic_csv", "Pushdown", "triceps_pushdown"),
    ("generic_csv", "Plank", "plank"),
    ("generic_csv", "Front Plank", "plank"),
    ("generic_csv", "Side Plank", "side_plank"),
    ("generic_csv", "Hanging Leg Raise", "hanging_leg_raise"),
    ("generic_csv", "Leg Raise", "hanging_leg_raise"),
    ("generic_csv", "Back Extension", "back_extension"),
    ("generic_csv", "45 Degree Back Extension", "back_extension"),
)
#: Labels that are refused, with status, reason, family and candidates.
REFUSED = (
    ("Bench Variation", "partial_family", "unspecified_variation", "bench", ()),
    ("Squat Variation", "partial_family", "unspecified_variation", "squat", ()),
    ("Deadlift Variation", "partial_family", "unspecified_variation", "deadlift", ()),
    ("Variation", "unmapped", "unspecified_variation", "unknown", ()),
    ("Machine Press", "ambiguous", "unspecified_machine", "unknown", ("bench", "dumbbell_bench", "incline_bench")),
    ("Chest Press", "ambiguous", "unspecified_implement", "unknown", ("bench", "dumbbell_bench", "incline_bench")),
    ("Press", "ambiguous", "unspecified_implement", "unknown", ("bench", "overhead_press")),
    ("Squat Machine", "ambiguous", "unspecified_machine", "unknown", ("hack_squat", "leg_press")),
)


def vocabulary() -> Vocabulary:
    definitions = [dict(zip(FIELDS, row)) | {"configuration": list(row[-1])} for row in EXERCISES]
    aliases = [dict(zip(("source_system", "alias", "key"), row)) for row in ALIASES]
    refusals = [dict(zip(("label", "status", "reason", "parent_lift"), row)) | {"candidates": list(row[-1])} for row in REFUSED]
    return Vocabulary.of(definitions, aliases, refusals)
