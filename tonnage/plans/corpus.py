"""Competition export to canonical tables: one projection each over the staged rows.

A source row is a competition; identifiers are computed once, on staging, so tables cannot disagree
about them.  Absence stays null, signs of attempts are results, over-long text is null and counted.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonnage.functions import ids
from tonnage.functions.text import blank_to_null, day, fit, flags, mapped, normalized_key, number, strip, too_long, unreadable
from tonnage.plans.schema import TABLES
from tonnage.sources.competition_csv import COLUMNS, ORDINAL

#: What the source's codes mean.
SEX = {"M": "male", "F": "female", "Mx": "other_self_described"}
EVENT = {"SBD": "sbd", "BD": "bd", "SD": "sd", "SB": "sb", "S": "s", "B": "b", "D": "d"}
EQUIPMENT = {"Raw": "raw", "Wraps": "raw_equip", "Single-ply": "classic_powerlifting", "Multi-ply": "multi_ply", "Unlimited": "unlimited", "Straps": "straps_allowed"}
PLACE = {"G": "guest", "DQ": "disqualified", "DD": "drug_disqualified", "NS": "no_show"}
SANCTIONED = {"Yes": True, "No": False}
#: Widths beyond which text is null.
WIDTHS = {
    "Name": 512, "Division": 256, "Country": 128, "State": 128, "MeetName": 512, "MeetCountry": 128, "MeetState": 128, "MeetTown": 128,
    "Federation": 128, "ParentFederation": 128, "AgeClass": 64, "BirthYearClass": 64, "Equipment": 64, "Place": 64, "Sanctioned": 64, "WeightClassKg": 64,
}
#: The fields that make a meet, and the lifts and kinds of the reported columns.
MEET_FIELDS = ("Date", "Federation", "MeetCountry", "MeetState", "MeetTown", "MeetName")
LIFTS = {"Squat": "squat", "Bench": "bench", "Deadlift": "deadlift"}
REPORTED = {"Best3SquatKg": "squat_best", "Best3BenchKg": "bench_best", "Best3DeadliftKg": "deadlift_best", "TotalKg": "total", "Dots": "dots", "Wilks": "wilks", "Glossbrenner": "other", "Goodlift": "gl_points"}
ATTEMPTS = {f"{name}{n}Kg": (lift, n, "record_fourth" if n == 4 else "ordered") for name, lift in LIFTS.items() for n in (1, 2, 3, 4)}
MEET_VARIANT = ("Date", "Federation", "MeetCountry", "MeetState", "MeetTown", "MeetName", "ParentFederation", "Sanctioned")


@dataclass(frozen=True)
class Build:
    """What every row of a build states."""

    source_id: str
    ingested_at: datetime


def staged(source: DataFrame, build: Build) -> DataFrame:
    """Source rows with width guards and the three identifiers.  A blank name has no identity and is an error."""
    guarded = source.select(ORDINAL, *(fit(F.col(c), WIDTHS[c]).alias(c) if c in WIDTHS else F.col(c) for c in COLUMNS))
    source_part = ids.text_part(build.source_id)
    name = F.coalesce("Name", F.raise_error(F.concat(F.lit("no name in row "), F.col(ORDINAL).cast("string"))).cast("string"))
    keyed = guarded.select(
        "*",
        ids.make_id("athlete", source_part, ids.text_part(name)).alias("athlete_id"),
        ids.make_id("competition_meet", source_part, *(ids.text_part(normalized_key(F.col(c))) for c in MEET_FIELDS)).alias("competition_meet_id"),
    )
    own = ids.make_id("competition", ids.text_part(F.col("athlete_id")), ids.text_part(F.col("competition_meet_id")), ids.text_part(F.col(ORDINAL).cast("string")))
    return keyed.withColumn("competition_id", own)


def canonical(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the columns and types of ``table``; columns it does not have are null."""
    have = set(df.columns)
    fields = TABLES[table].schema
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def _provenance(build: Build, key: Column | None) -> dict[str, Column]:
    found = {"source_id": F.lit(build.source_id), "ingested_at": F.lit(build.ingested_at).cast("timestamp"), "quality_flags": flags()}
    return found | ({} if key is None else {"source_record_key": key})


def _row_key() -> Column:
    #: Fixed value: the key of a source row, counted from 1.
    return F.concat(F.lit("opl:row="), (F.col(ORDINAL) + 1).cast("string"))


def _names(rows: DataFrame) -> DataFrame:
    sex = blank_to_null(F.col("Sex"))
    return rows.groupBy("Name", "athlete_id").agg(F.countDistinct(sex).alias("variants"), F.min(sex).alias("sex"))


def athletes(rows: DataFrame, build: Build) -> DataFrame:
    """One row per name; a name reported under two sexes keeps neither, is flagged and grouped."""
    torn = F.col("variants") > 1
    #: Fixed value: what the group of a torn name is called.
    group = F.when(torn, F.concat(F.lit("opl-name-conflict:"), F.col("Name")))
    columns = _provenance(build, None) | {
        "identity_status": F.lit("single_source_unverified"),
        "ambiguity_group_id": group,
        "is_synthetic": F.lit(False),
        "sex_category_raw": F.when(~torn, F.col("sex")),
        "sex_category": F.when(~torn, mapped(F.col("sex"), SEX)),
        "quality_flags": F.when(torn, flags("ambiguous_identity")).otherwise(flags()),
    }
    return canonical(_names(rows).withColumns(columns), "athlete")


def athlete_source_links(rows: DataFrame, build: Build) -> DataFrame:
    columns = _provenance(build, F.col("Name")) | {"source_athlete_key": F.col("Name"), "link_method": F.lit("exact_attribute_match"), "is_primary": F.lit(True)}
    return canonical(rows.select("Name", "athlete_id").distinct().withColumns(columns), "athlete_source_link")


def competitions(rows: DataFrame, build: Build) -> DataFrame:
    age, mass, place = (number(F.col(c)) for c in ("Age", "BodyweightKg", "Place"))
    ranked = (place > 0) & (place == F.floor(place))  # a fraction is no rank
    kind = F.coalesce(mapped(F.col("Place"), PLACE), F.when(ranked, "placed").otherwise("unknown"))
    mass = F.when(mass > 0, mass)
    date = day(F.col("Date"))
    columns = _provenance(build, _row_key()) | {
        "competition_date": date,
        "event_time_precision": F.lit("date_only"),
        "competition_event": mapped(F.col("Event"), EVENT),
        "name": F.col("MeetName"),
        "federation": F.col("Federation"),
        "sanctioning_body": F.col("ParentFederation"),
        "equipment_class_raw": F.col("Equipment"),
        "equipment_class": F.coalesce(mapped(F.col("Equipment"), EQUIPMENT), F.lit("unknown")),
        "weight_class_raw": F.col("WeightClassKg"),
        "bodyweight_raw": mass,
        "bodyweight_unit": F.when(mass.isNotNull(), "kg"),
        "bodyweight_kg": mass,
        "participation_status": F.col("Place"),
        "participation_place": F.when(kind == "placed", place.try_cast("bigint")),
        "participation_status_kind": kind,
        "is_drug_tested_category": F.when(strip(F.col("Tested")) == "Yes", True),
        "age_reported": age,
        "age_precision": F.when(age.isNotNull(), F.when(F.abs(age - F.floor(age)) < 1e-9, "exact").otherwise("approximate")),
        "age_class_raw": F.col("AgeClass"),
        "birth_year_class_raw": F.col("BirthYearClass"),
        "division_raw": F.col("Division"),
        "athlete_country_raw": F.col("Country"),
        "athlete_region_raw": F.col("State"),
        "observed_at": date,
    }
    return canonical(rows.withColumns(columns), "competition")


def _long(rows: DataFrame, spec: dict[str, dict[str, object]]) -> DataFrame:
    """A row for each cell of the columns of ``spec`` that is not blank, with the number it says and what its column means."""
    entries = [F.when(strip(F.col(c)) != "", F.struct(F.lit(c).alias("column"), F.col(c).alias("cell"), *(F.lit(v).alias(k) for k, v in means.items()))) for c, means in spec.items()]
    long = rows.select(ORDINAL, "competition_id", "athlete_id", "Date", F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return long.select(ORDINAL, "competition_id", "athlete_id", "Date", "e.*").withColumn("number", number(F.col("cell")))


def attempts(rows: DataFrame, build: Build) -> DataFrame:
    """A negative cell is a failed attempt at its magnitude; zero and unreadable cells are no attempts."""
    kept = _long(rows, {c: dict(zip(("lift", "attempt_number", "attempt_role"), v)) for c, v in ATTEMPTS.items()}).where("number <> 0")
    load = F.abs("number")
    columns = _provenance(build, _row_key()) | {
        "competition_attempt_id": ids.make_id("competition_attempt", ids.text_part(F.col("competition_id")), ids.text_part(F.col("lift")), ids.int_part(F.col("attempt_number"))),
        "attempt_order_basis": F.lit("source_explicit"),
        "source_attempt_raw": F.col("number"),
        "load_raw": load,
        "load_unit": F.lit("kg"),
        "load_kg": load,
        "result": F.when(F.col("number") > 0, "good_lift").otherwise("bad_lift"),
        "is_opener": F.col("attempt_number") == 1,
        "observed_at": day(F.col("Date")),
    }
    return canonical(kept.withColumns(columns), "competition_attempt")


def reported_results(rows: DataFrame, build: Build) -> DataFrame:
    """Results as the source reports them; a negative best means that only failed attempts exist."""
    kept = _long(rows, {c: {"result_kind": v} for c, v in REPORTED.items()}).where("number <> 0")
    best = F.col("column").startswith("Best3")
    columns = _provenance(build, _row_key()) | {
        "competition_reported_result_id": ids.make_id("competition_reported_result", ids.text_part(F.col("competition_id")), ids.text_part(F.col("column"))),
        "value": F.abs("number"),
        "unit": F.when(best | (F.col("column") == "TotalKg"), "kg"),
        "source_value_raw": F.col("number"),
        "result_source_field": F.col("column"),
        "reported_best_semantics": F.when(best & (F.col("number") < 0), "failed_attempt_only").when(best, "successful_best"),
        "is_derived": F.lit(False),
        "observed_at": day(F.col("Date")),
    }
    return canonical(kept.withColumns(columns), "competition_reported_result")


def meets(rows: DataFrame, build: Build) -> DataFrame:
    """One row per meet: of its spellings the smallest, field by field, absent ones first."""
    variant = F.struct(*(blank_to_null(F.col(c)).alias(c) for c in MEET_VARIANT))
    order = F.struct(*(F.coalesce(blank_to_null(F.col(c)), F.lit("")) for c in MEET_VARIANT if c != "Date"), day(F.col("Date")).isNull(), F.coalesce("Date", F.lit("")))
    chosen = rows.groupBy("competition_meet_id").agg(F.min_by(variant, order).alias("v")).select("competition_meet_id", "v.*")
    columns = _provenance(build, F.col("competition_meet_id")) | {
        "meet_name": F.col("MeetName"),
        "meet_date": day(F.col("Date")),
        "event_time_precision": F.lit("date_only"),
        "meet_federation": F.col("Federation"),
        "meet_parent_federation": F.col("ParentFederation"),
        "meet_country": F.col("MeetCountry"),
        "meet_state": F.col("MeetState"),
        "meet_town": F.col("MeetTown"),
        "sanctioned_status_raw": F.col("Sanctioned"),
        "is_sanctioned": mapped(F.col("Sanctioned"), SANCTIONED),
    }
    return canonical(chosen.withColumns(columns), "competition_meet")


def build_tables(rows: DataFrame, build: Build) -> dict[str, DataFrame]:
    """The six tables of a corpus over staged ``rows`` (which should be written or cached before)."""
    return {
        "athlete": athletes(rows, build),
        "athlete_source_link": athlete_source_links(rows, build),
        "competition_meet": meets(rows, build),
        "competition": competitions(rows, build),
        "competition_attempt": attempts(rows, build),
        "competition_reported_result": reported_results(rows, build),
    }


def counters(source: DataFrame) -> DataFrame:
    """One row: what a build reads, drops or nulls, all counted in one pass over the source rows."""

    def tally(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    cell = {c: number(F.col(c)) for c in (*ATTEMPTS, *REPORTED)}

    def cells(columns: dict, test) -> Column:
        return reduce(Column.__add__, (tally(test(c)) for c in columns))

    return source.agg(
        F.count("*").alias("source_rows"),
        cells(ATTEMPTS, lambda c: unreadable(F.col(c), cell[c])).alias("attempt_values_unparseable"),
        cells(ATTEMPTS, lambda c: cell[c] == 0).alias("attempt_values_zero"),
        cells(REPORTED, lambda c: unreadable(F.col(c), cell[c])).alias("reported_values_unparseable"),
        cells(REPORTED, lambda c: cell[c] == 0).alias("reported_values_zero"),
        tally(unreadable(F.col("Age"), number(F.col("Age")))).alias("ages_unparseable"),
        tally(unreadable(F.col("BodyweightKg"), number(F.col("BodyweightKg")))).alias("bodyweights_unparseable"),
        tally(unreadable(F.col("Date"), day(strip(F.col("Date"))))).alias("dates_unparseable"),
        tally(blank_to_null(F.col("Federation")).isNull()).alias("rows_without_federation"),
        reduce(Column.__add__, (F.count_if(too_long(F.col(c), n)) for c, n in WIDTHS.items())).alias("values_too_long"),
    )


def unrecognised(source: DataFrame) -> DataFrame:
    """column, value, n: vocabulary values that no mapping knows, over all rows."""
    known = {"Sex": SEX, "Event": EVENT, "Equipment": EQUIPMENT, "Sanctioned": SANCTIONED}
    cells = source.select(*(strip(blank_to_null(F.col(c))).alias(c) for c in known)).unpivot([], list(known), "column", "value")
    entries = [F.struct(F.lit(c).alias("column"), F.lit(v).alias("value")) for c, values in known.items() for v in values]
    return cells.where(F.col("value").isNotNull() & ~F.array_contains(F.array(*entries), F.struct("column", "value"))).groupBy("column", "value").agg(F.count("*").alias("n"))


def sources(build: Build, spark, **facts) -> DataFrame:
    """The ``source`` table of a corpus."""
    row = spark.range(1).select(F.lit(build.source_id).alias("source_id"), F.lit("real").alias("nature"), F.lit("psd_comp").alias("regime"), F.lit(build.ingested_at).cast("timestamp").alias("ingested_at"), *(F.lit(v).alias(k) for k, v in facts.items()))
    return canonical(row, "source")


def window_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key: the lookup a reference index would make."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")
