from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.competition_rows import HOME, ROWS, write_csv
from tonnage import cli
from tonnage.functions import ids
from tonnage.operators import integrity, validation
from tonnage.plans import audit, corpus, history
from tonnage.plans.schema import TABLES
from tonnage.sources import competition_csv as source

BUILD = corpus.Build("openpowerlifting_0123456789abcdef", datetime(2025, 12, 1, tzinfo=timezone.utc))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return source.read_csv(spark, f"file://{write_csv(tmp_path_factory.mktemp('csv') / 'rows.csv')}").cache()


@pytest.fixture(scope="module")
def tables(raw):
    rows = corpus.staged(raw, BUILD).cache()
    return {k: v.cache() for k, v in corpus.build_tables(rows, BUILD).items()}


def test_golden_identifiers(tables):
    names = {r["source_athlete_key"]: r["athlete_id"] for r in tables["athlete_source_link"].collect()}
    assert names["Ada Liftwell#1"] == "ath_c27933c5b0903aad601fd5ec10e63300"
    first = tables["competition"].where("source_record_key = 'opl:row=1'").first()
    assert first["competition_meet_id"] == "cmeet_701be0b9c3091570bc02344d34131530"
    assert first["competition_id"] == "cmp_50a6bf104be5dabad0204b2cd629465b"
    attempt = tables["competition_attempt"].where(f"competition_id = '{first['competition_id']}' and lift = 'squat' and attempt_number = 1").first()
    assert attempt["competition_attempt_id"] == "catt_bee71078fa64f2f839b7cfdb4120a079"
    best = tables["competition_reported_result"].where(f"competition_id = '{first['competition_id']}' and result_kind = 'squat_best'").first()
    assert best["competition_reported_result_id"] == "cres_0125606b111ac4b7b32109f64702b0da"
    assert ids.plain_id("exercise", "squat") == "exd_27a22dfa8570d424dd3f80cb584503f0"


def test_non_bmp_name_hashes_by_code_points(spark):
    name = "Zoë \U0001d49c"
    one = spark.range(1).select(ids.make_id("athlete", ids.text_part("x"), ids.text_part(name)).alias("id")).first()["id"]
    assert one == ids.plain_id("athlete", "x", name)


def test_row_counts_and_types(tables):
    counts = {k: v.count() for k, v in tables.items()}
    assert counts["competition"] == len(ROWS)
    assert counts["athlete"] == 7
    assert counts["competition_meet"] == 4  # a padded date is another spelling
    assert counts["competition_attempt"] == 17
    for name, df in tables.items():
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [(f.name, f.dataType.simpleString()) for f in TABLES[name].schema]


def test_signs_are_results(tables):
    failed = tables["competition_attempt"].where("result = 'bad_lift'")
    assert failed.count() == 6
    assert failed.where("load_kg <= 0 or source_attempt_raw >= 0").count() == 0
    assert tables["competition_attempt"].where("attempt_role = 'record_fourth'").count() == 1
    assert [r["value"] for r in tables["competition_reported_result"].where("reported_best_semantics = 'failed_attempt_only'").collect()] == [195.0]


def test_torn_name_keeps_no_sex(tables):
    torn = tables["athlete"].where("ambiguity_group_id is not null").collect()
    assert [(r["sex_category"], r["quality_flags"]) for r in torn] == [(None, ["ambiguous_identity"])]


def test_meet_spellings_collapse_to_the_smallest(tables):
    meet = ids.plain_id("competition_meet", BUILD.source_id, "2025-10-19", "nord", "norway", "troms", "harstad", "arctic cup")
    row = tables["competition_meet"].where(F.col("competition_meet_id") == meet).first()
    assert row["meet_name"] == " ARCTIC  cup" and row["is_sanctioned"] is True


def test_places_ages_and_absence(tables):
    rows = {r["source_record_key"]: r for r in tables["competition"].collect()}
    assert rows["opl:row=1"]["age_precision"] == "approximate" and rows["opl:row=2"]["age_precision"] == "exact"
    assert (rows["opl:row=4"]["participation_status_kind"], rows["opl:row=4"]["participation_place"]) == ("disqualified", None)
    assert rows["opl:row=6"]["participation_status_kind"] == "unknown"
    assert rows["opl:row=6"]["bodyweight_kg"] is None and rows["opl:row=7"]["competition_date"] is None
    assert rows["opl:row=8"]["division_raw"] is None and rows["opl:row=3"]["equipment_class"] == "unknown"


def test_counters(raw):
    c = corpus.counters(raw).first()
    assert (c["source_rows"], c["attempt_values_zero"], c["attempt_values_unparseable"]) == (9, 1, 2)
    assert (c["ages_unparseable"], c["values_too_long"], c["dates_unparseable"], c["rows_without_federation"]) == (1, 1, 0, 0)
    assert [tuple(r) for r in corpus.unrecognised(raw).collect()] == [("Equipment", "Novel", 1)]


def test_blank_name_is_an_error(spark, tmp_path):
    path = write_csv(tmp_path / "blank.csv", [HOME | {"Name": "  ", "Event": "SBD"}])
    with pytest.raises(Exception, match="no name in row 0"):
        corpus.staged(source.read_csv(spark, f"file://{path}"), BUILD).select("athlete_id").collect()


def test_history(tables):
    row = history.athlete_histories(tables).where("athlete_id = 'ath_c27933c5b0903aad601fd5ec10e63300'").first()
    assert (row["competition_count"], row["meet_count"], row["span_days"], row["attempt_detail_meet_count"]) == (2, 2, 1148, 2)
    assert row["squat_competition_count"] == 2 and row["reported_total_count"] == 1 and row["attempt_detail_fraction"] == 1.0


def test_audit(tables):
    report = audit.audit(tables, snapshot=datetime(2025, 6, 1, tzinfo=timezone.utc))
    assert report["entities"]["rows"]["competition"] == 9
    assert report["performance"]["agreeing"] == 1 and report["performance"]["negative_bests"] == 1
    assert report["chronology"]["future_competitions"] == 4
    assert report["anomalies"]["sex_conflicts"] == 1 and report["identity"]["base_groups"] == 1
    assert report["transitions"]["equipment_class"]["changes"] == 1
    assert report["athlete_context"]["open_ended_classes"] == 1
    assert report["units"]["total"] == 0
    assert all(x["observed"] == 0 for x in report["invariants"]) and len(report["invariants"]) == 15
    assert {x["class"] for x in report["findings"]} <= set(audit.FINDING_CLASSES)
    assert audit.to_json(report) == audit.to_json(report) and "## units" in audit.to_markdown(report)


def test_invariants_see_tampering(tables):
    bad = dict(tables)
    bad["competition_attempt"] = tables["competition_attempt"].withColumn("result", F.lit("good_lift"))
    bad["competition_meet"] = tables["competition_meet"].limit(0)
    found = {r["name"]: r["observed"] for r in audit.invariants(bad).collect()}
    assert found["attempt_sign_agrees_with_result"] == 6 and found["competitions_reference_a_meet"] == 9


@pytest.mark.parametrize(("rule", "broken"), [("documented", 1), ("sql", 0)])
def test_birth_year_rules(spark, rule, broken):
    rows = [("a", "1", datetime(2020, 5, 1), 40.0, "exact"), ("a", "2", datetime(2024, 5, 1), 45.5, "approximate")]
    c = spark.createDataFrame(rows, "athlete_id string, competition_id string, competition_date timestamp, age_reported double, age_precision string")
    years = audit.birth_years(c, rule)
    per = years.groupBy("year").agg(F.countDistinct("observation").alias("n")).where("n = 2").count()
    assert (per == 0) == bool(broken)


def test_validation_of_a_built_corpus(tables, spark):
    d = tables | {"source": corpus.sources(BUILD, spark)}
    found = {r["code"]: r["count"] for r in validation.validate(d).groupBy("code").count().collect()}
    assert set(found) <= {"meet_field_disagreement"}


def test_validation_sees_planted_faults(tables, spark):
    d = tables | {"source": corpus.sources(BUILD, spark)}
    d["competition_attempt"] = d["competition_attempt"].unionByName(d["competition_attempt"].limit(1)).withColumn("load_kg", F.when(F.col("lift") == "squat", 0.0).otherwise(F.col("load_kg"))).withColumn("load_unit", F.lit("kg"))
    d["athlete"] = d["athlete"].where("ambiguity_group_id is null").withColumn("identity_status", F.lit("nonsense"))
    codes = {r["code"] for r in validation.validate(d).select("code").distinct().collect()}
    assert {"duplicate_primary_key", "duplicate_attempt_number", "zero_as_missing", "range_load_kg", "dangling_competition", "vocabulary_identity_status"} <= codes
    assert validation.validate(d, strict=True).where("severity <> 'error'").count() == 0


def test_dataset_round_trip_and_cli(spark, tmp_path):
    csv = write_csv(tmp_path / "openpowerlifting-2025-12-01.csv")
    pinned = source.acquire_local(csv, tmp_path / "data")
    assert pinned == source.acquire_local(csv, tmp_path / "data") and pinned.rows == 9 and pinned.snapshot_date == "2025-12-01"
    folder = tmp_path / "data" / pinned.archive_sha256[:16]
    out = tmp_path / "corpus"
    first = cli.build(str(folder), str(out), BUILD.ingested_at)
    second = cli.build(str(folder), str(tmp_path / "again"), datetime(2026, 1, 1, tzinfo=timezone.utc))
    assert integrity.same_content(spark, out, tmp_path / "again") and first.artifacts["competition"]["rows"] == second.artifacts["competition"]["rows"] == 9
    assert integrity.verify_dataset(spark, out) == []
    assert cli.main(["verify", str(out)]) == 0
    assert cli.main(["audit", str(out), str(tmp_path / "report")]) == 0 and (tmp_path / "report.md").exists()
    assert "competition" in integrity.register_views(spark, out)
    assert spark.sql("select count(*) from competition_attempt where result = 'bad_lift'").first()[0] == 6
    part = next((out / "tables" / "competition.parquet").glob("*.parquet"))
    part.unlink()
    assert integrity.verify_dataset(spark, out)


def test_json_records(spark, tmp_path):
    (tmp_path / "program.json").write_text('[{"program_id": "p", "name": "n", "quality_flags": ["verified"], "ingested_at": "2024-01-01T00:00:00Z"}]')
    tables = integrity.load_records(spark, tmp_path, required=("program",))
    assert tables["program"].first()["quality_flags"] == ["verified"] and tables["athlete"].count() == 0
    with pytest.raises(ValueError, match="missing"):
        integrity.load_records(spark, tmp_path, required=("athlete",))


def test_rows_are_numbered_across_splits(spark, tmp_path):
    names = [f"N{k}" for k in range(3000)]
    path = write_csv(tmp_path / "many.csv", [{"Name": n, "Date": "2024-01-01"} for n in names])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = source.read_csv(spark, f"file://{path}")
        got = {r["row_ordinal"]: r["Name"] for r in df.select("row_ordinal", "Name").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate(names)) and source.count_rows(path) == 3000


def test_header_drift(tmp_path):
    columns = list(source.COLUMNS)
    source.require_header(tuple(columns))
    for drifted in (columns[1:], [*columns, "New"], [columns[1], columns[0], *columns[2:]]):
        with pytest.raises(source.SourceError):
            source.require_header(tuple(drifted))
    source.require_header((*columns, "New"), allow_unknown=("New",))
    with pytest.raises(source.SourceError):
        source.resolve_within(tmp_path, "../x")


def test_rows_are_numbered_through_the_files_of_a_folder(spark, tmp_path):
    for k, n in enumerate((3, 0, 700)):
        write_csv(tmp_path / f"part-{k}.csv", [{"Name": f"N{k}.{i}", "Date": "2024-01-01"} for i in range(n)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        got = {r["row_ordinal"]: r["Name"] for r in source.read_csv(spark, f"file://{tmp_path}").select("row_ordinal", "Name").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate([f"N0.{i}" for i in range(3)] + [f"N2.{i}" for i in range(700)]))


def test_tree_digest_sees_rows_and_not_partitions(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("key"), (F.col("id") / 7).alias("x"))
    one = integrity.tree_digest(df.repartition(1), "t", ["key"], ["key"])
    assert one == integrity.tree_digest(df.repartition(7, "x"), "t", ["key"], ["key"])
    assert one != integrity.tree_digest(df.withColumn("x", F.when(F.col("key") == "7", 1.5).otherwise(F.col("x"))), "t", ["key"], ["key"])
    assert one != integrity.tree_digest(df.where("key <> '7'"), "t", ["key"], ["key"])


def test_units_see_what_is_absent(tables):
    """A load, a value or a unit that is null disagrees; an absent bodyweight must not become zero."""
    bad = dict(tables)
    bad["competition_attempt"] = tables["competition_attempt"].withColumns({"load_kg": F.when(F.col("attempt_number") == 1, F.lit(None).cast("double")).otherwise(F.col("load_kg")), "load_raw": F.when(F.col("attempt_number") == 2, F.lit(None).cast("double")).otherwise(F.col("load_raw"))})
    bad["competition_reported_result"] = tables["competition_reported_result"].withColumns({"value": F.when(F.col("result_kind") == "total", F.lit(None).cast("double")).otherwise(F.col("value")), "unit": F.when(F.col("result_kind") == "dots", F.lit("kg")).otherwise(F.col("unit"))})
    bad["competition"] = tables["competition"].withColumn("bodyweight_kg", F.coalesce("bodyweight_kg", F.lit(0.0)))
    found = audit.units(bad)
    first = tables["competition_attempt"].where("attempt_number in (1, 2)").count()
    assert found["attempt_load_kg_mismatches"] == first and found["reported_value_mismatches"] == found["reported_totals_checked"] == 2
    assert found["scoring_rows_claiming_a_mass_unit"] == 1 and found["bodyweight_absent_became_zero"] == len(ROWS) - found["bodyweight_rows_checked"] > 0
    assert found["total"] == sum(found[x] for x in audit.UNIT_MISMATCHES)
