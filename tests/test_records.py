import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tonnage import cli
from tonnage.functions import ids
from tonnage.operators import exercises, integrity, labels, records, validation
from tonnage.plans.schema import TABLES

SET = {"performed_set_id": "pset_1", "performed_exercise_id": "pex_1", "ordinal": 2, "load_raw": 100, "load_unit": "kg", "load_kg": 100.0, "rpe": 8.5, "quality_flags": ["verified"], "performed_at": "2024-03-01T12:00:00.25+02:00"}


def test_records_come_back_as_they_went_in(spark):
    df = records.to_table(spark, "performed_set", [SET | {"performed_set_id": "pset_2", "ordinal": 1}, SET])
    assert [f.dataType for f in df.schema] == [f.dataType for f in TABLES["performed_set"].schema]
    found = list(records.records_of(df, "performed_set"))
    moment = datetime(2024, 3, 1, 10, 0, 0, 250_000, tzinfo=timezone.utc)
    assert found == [SET | {"performed_set_id": "pset_2", "ordinal": 1, "performed_at": moment, "load_raw": 100.0}, SET | {"performed_at": moment, "load_raw": 100.0}]
    assert next(records.rows_of(df, "performed_set"))["missingness_reason"] is None
    assert records.to_tables(spark, {"performed_set": [SET]})["program"].count() == 0


@pytest.mark.parametrize(
    ("change", "said"),
    [
        ({"colour": "red"}, "no field colour"), ({"performed_set_id": None}, "performed_set_id is missing"), ({"ordinal": "2"}, "no int"), ({"ordinal": True}, "no int"), ({"rpe": float("nan")}, "no finite number"),
        ({"quality_flags": "verified"}, "no list"), ({"quality_flags": ["shiny"]}, "no member"), ({"performed_at": "2024-03-01T12:00:00"}, "no time zone"), ({"rpe": 11.0}, "range_rpe"), ({"load_unit": None}, "contract_mass_triplet"),
    ],
)
def test_a_wrong_record_is_refused(spark, change, said):
    with pytest.raises(records.RecordError, match=said):
        records.to_table(spark, "performed_set", [SET | change])


def test_unknown_tables_are_refused(spark):
    with pytest.raises(records.RecordError, match="no tables: lifts"):
        records.to_tables(spark, {"lifts": []})


def test_what_was_known_when(spark):
    at = lambda month: datetime(2024, month, 1, tzinfo=timezone.utc)
    df = records.to_table(spark, "planned_set", [
        {"planned_set_id": "plset_1", "created_at": at(1), "scheduled_at": at(9)}, {"planned_set_id": "plset_2", "created_at": at(1), "modified_at": at(5)}, {"planned_set_id": "plset_3", "ingested_at": at(12)}, {"planned_set_id": "plset_4", "created_at": at(4)},
    ])
    assert {r.planned_set_id[-1] for r in records.as_known(df, at(2)).collect()} == {"1", "3"}
    assert {r.planned_set_id[-1] for r in records.as_known(df, at(6)).collect()} == {"1", "2", "3", "4"}


def test_json_records_become_a_dataset(spark, tmp_path, capsys):
    (tmp_path / "performed_set.json").write_text(json.dumps([SET]))
    assert cli.main(["canonical-build", str(tmp_path), str(tmp_path / "out"), "sets"]) == 0
    assert cli.main(["inspect-tables", str(tmp_path / "out")]) == 0
    assert '"rows": 1' in capsys.readouterr().out
    assert integrity.verify_dataset(spark, tmp_path / "out") == []
    (tmp_path / "performed_set.json").write_text(json.dumps([SET | {"rpe": 12.0}]))
    assert cli.main(["canonical-build", str(tmp_path), str(tmp_path / "out"), "sets"]) == 2
    manifest = integrity.read_manifest(spark, tmp_path / "out")
    manifest.versions["schema"] = "canonical/9.0.0"
    integrity.write_bytes(spark, integrity.located(tmp_path / "out", "manifest.json"), manifest.to_json())
    with pytest.raises(ValueError, match="does not read"):
        integrity.read_dataset(spark, tmp_path / "out", check=True)


def test_vocabulary_artifact_is_sound_and_the_same_twice(spark, tmp_path):
    words = exercises.vocabulary()
    for out in ("a", "b"):
        integrity.write_dataset(labels.artifact(spark, words, ["Swimming", "Sumo Deadlift?"]), tmp_path / out, "ontology")
    assert integrity.same_content(spark, tmp_path / "a", tmp_path / "b")
    d = integrity.read_dataset(spark, tmp_path / "a", check=True)
    verdicts = d["exercise_normalization"]
    assert verdicts.count() == len(labels.probe_labels(words, ["Swimming", "Sumo Deadlift?"])) and d["exercise_definition"].count() == len(words.definitions)
    bound = verdicts.join(d["exercise_alias"].select("source_system", F.col("alias_raw").alias("raw_label"), F.col("exercise_id").alias("claimed")), ["source_system", "raw_label"])
    assert bound.where("not exercise_id <=> claimed").count() == 0 and bound.count() == d["exercise_alias"].count()
    assert validation.report({n: d[n] for n in ("source", "exercise_definition", "exercise_alias", "exercise_normalization")})["sound"]


def test_derived_data_must_fit_its_parent(spark, tmp_path):
    parent = integrity.write_dataset({"program": records.to_table(spark, "program", [{"program_id": "prg_1"}])}, tmp_path / "p", "p")
    spec = {"program": TABLES["program"]}
    integrity.write_dataset({"program": records.to_table(spark, "program", [{"program_id": "prg_2"}])}, tmp_path / "d", "d", parent_digest=parent.digest(), specs=spec)
    assert integrity.read_derived(spark, tmp_path / "d", spec, parent)["program"].first()["program_id"] == "prg_2"
    with pytest.raises(ValueError, match="not made from"):
        integrity.read_derived(spark, tmp_path / "d", spec, integrity.Manifest("other"))


def test_verbs_without_data(capsys):
    for verb in (["schema-version"], ["schema-dump"], ["ontology-version"], ["exercises", "--family", "bench"], ["paths", "/tmp/x"], ["tables"]):
        assert cli.main(verb) == 0
        assert json.loads(capsys.readouterr().out)


def test_shares_of_identifiers(spark):
    df = spark.range(16).select(F.format_string("ath_%x0", "id").alias("id"))
    assert [r[0] for r in df.select(ids.share(F.col("id"), 4)).collect()] == [k // 4 for k in range(16)]
    with pytest.raises(ValueError, match="17"):
        ids.share(F.col("id"), 17)
