import pytest
from pyspark.sql import functions as F

from tonnage.functions import text
from tonnage.functions.units import kilograms
from tonnage.operators import integrity, labels


def values(spark, cells, expression):
    return [r[0] for r in spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, c string").select("k", expression(F.col("c")).alias("v")).orderBy("k").select("v").collect()]


def test_numbers(spark):
    cells = ["1.5", " -2 ", "1e3", "1.0d", "NaN", "Infinity", "1_000", "", None, ".5", "5."]
    assert values(spark, cells, text.number) == [1.5, -2.0, 1000.0, None, None, None, None, None, None, 0.5, 5.0]


def test_days(spark):
    got = values(spark, ["2025-01-08", "2025-1-8", " 2025-01-08", "2025-02-30", None], lambda c: F.date_format(text.day(c), "yyyy-MM-dd"))
    assert got == ["2025-01-08", None, None, None, None]


def test_unicode_blanks(spark):
    assert values(spark, [" x ", "  ", " ", None, "a  B"], text.normalized_key) == ["x", "", "", "", "a b"]
    assert values(spark, [" ", " x "], text.blank_to_null) == [None, " x "]
    assert values(spark, ["abc", "abcd", None], lambda c: text.fit(c, 3)) == ["abc", None, None]


def test_unknown_unit_raises(spark):
    df = spark.createDataFrame([(100.0, "lb"), (None, "kg")], "v double, u string")
    assert [r[0] for r in df.select(kilograms(F.col("v"), F.col("u"))).collect()] == [45.359237, None]
    with pytest.raises(Exception, match="unknown unit"):
        spark.createDataFrame([(1.0, "stone")], "v double, u string").select(kilograms(F.col("v"), F.col("u"))).collect()


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("Bench Presses", "benchpress"), ("DB  Curls", "dumbbell curl"), ("OHP", "overheadpress"), ("Ｓquat", "squat"), ("Lat Pull-Down", "latpulldown"), ("", ""), ("Rémi", "remi"), ("Squatß", "squatss")],
)
def test_label_normalization(raw, expected):
    found = labels.normalize(raw)[0]
    assert found == expected and labels.normalize(found)[0] == found


@pytest.fixture(scope="module")
def words():
    definitions = [
        {"key": "squat", "name": "Squat", "parent_lift": "squat"},
        {"key": "low_bar_squat", "name": "Low Bar Squat", "parent_lift": "squat", "stance": "low", "implement": "barbell"},
        {"key": "wide_grip_bench", "name": "Wide Grip Bench", "parent_lift": "bench", "grip": "wide", "implement": "barbell"},
        {"key": "wide_grip_dumbbell", "name": "Wide Dumbbell Press", "parent_lift": "bench", "grip": "wide", "implement": "dumbbell"},
    ]
    aliases = [{"source_system": "hevy", "alias": "Back Squat", "key": "squat"}]
    return labels.Vocabulary.of(definitions, aliases, [{"label": "press", "reason": "unspecified_variation", "candidates": ["wide_grip_bench"]}])


@pytest.mark.parametrize(
    ("label", "system", "status", "method", "key"),
    [
        ("SQUATS", "hevy", "exact_canonical", "canonical_identity", "squat"),
        ("Press", "hevy", "ambiguous", "curated_ambiguous", None),
        ("back squat", "hevy", "resolved_alias", "registered_alias", "squat"),
        ("back squat", "strong", "resolved_alias", "cross_source_alias", "squat"),
        ("squat variation", "hevy", "partial_family", "generic_qualifier", None),
        ("lowbar squat barbell", "hevy", "resolved_alias", "structured_interpretation", "low_bar_squat"),
        ("wide grip heavy bench", "hevy", "ambiguous", "structured_interpretation", None),
        ("machine squat", "hevy", "partial_family", "family_keyword", None),
        ("Squat?", "hevy", "ambiguous", "question_form", None),
        ("xyzzy", "hevy", "unmapped", "no_match", None),
        ("exd_27a22dfa8570d424dd3f80cb584503f0", "hevy", "exact_canonical", "canonical_identity", "squat"),
    ],
)
def test_label_ladder(spark, words, label, system, status, method, key):
    row = labels.resolve(spark.createDataFrame([(label, system)], "raw_label string, source_system string"), words).collect()
    assert [(r["resolution_status"], r["resolution_method"], r["exercise_key"]) for r in row] == [(status, method, key)]


def test_contradictory_vocabulary_is_refused():
    with pytest.raises(ValueError, match="twice"):
        labels.Vocabulary.of([{"key": "a", "name": "A"}, {"key": "a", "name": "A"}], [], [])


def test_digest_depends_on_content_not_on_partitions(spark):
    df = spark.range(50).select("id", (F.col("id") / 7).alias("x"), F.array(F.lit("a")).alias("l"), F.lit(None).cast("string").alias("n"))
    one = integrity.content_digest(df.repartition(1), "t", ["id"])
    assert one == integrity.content_digest(df.repartition(7), "t", ["id"])
    assert one != integrity.content_digest(df.withColumn("x", F.col("x") + 1), "t", ["id"])
    assert integrity.parallel_digest(df) == integrity.parallel_digest(df.orderBy(F.desc("id")))
    with pytest.raises(Exception, match="cannot be encoded"):
        integrity.content_digest(df.withColumn("x", F.lit(float("nan"))), "t", ["id"])


def test_own_vocabulary_is_sound_and_refuses(spark):
    from tonnage.operators import exercises

    own = exercises.vocabulary()
    assert (len(own.definitions), len(own.aliases), len(own.refusals)) == (66, 143, 8)
    given = [("RDL", "hevy"), ("Variation", "hevy"), ("Chest Press", "strong"), ("Comp Squat", "generic_csv"), ("Low Bar Squat?", "hevy")]
    found = labels.resolve(spark.createDataFrame(given, "raw_label string, source_system string"), own)
    got = {r["raw_label"]: (r["resolution_status"], r["exercise_key"]) for r in found.collect()}
    assert got["Comp Squat"] == ("resolved_alias", "squat") and got["Chest Press"][0] == "ambiguous" and got["Variation"] == ("unmapped", None)
    assert got["Low Bar Squat?"] == ("ambiguous", None)
    assert labels.definition_table(spark, own).count() == 66
    assert labels.alias_table(spark, own).count() == 143
    table = labels.normalization_table(found)
    assert table.where("exercise_id is not null and exercise_id not rlike '^exd_[0-9a-f]{32}$'").count() == 0 and table.count() == len(given)


def test_versions():
    from datetime import datetime

    from tonnage.functions.versions import Version, as_utc

    old, new = Version.parse("canonical/1.0.3"), Version.parse("canonical/1.1.0")
    assert old.readable_by(new) and not new.readable_by(old) and str(new) == "canonical/1.1.0"
    with pytest.raises(ValueError, match="no version"):
        Version.parse("1.0")
    with pytest.raises(ValueError, match="no time zone"):
        as_utc(datetime(2024, 1, 1))
