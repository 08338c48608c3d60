import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SCHEMA, WORDS, prose, rows
from tonnage.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages_act_on_what_is_left(spark, tmp_path):
    clean = [prose(k, 150) for k in range(6)]
    leak = " ".join(WORDS[k % len(WORDS)] for k in range(0, 60, 3))
    texts = [*clean, clean[2].replace("\n", " ") + " changed", None, "12 34 56", "before " + leak + " after", clean[0]]
    data = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path)).cache()
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert left["language_id"] == set(range(11)) - {7, 8}
    assert left["line_dedup"] == left["language_id"]
    assert left["near_dedup"] >= {0, 1, 2, 3, 4, 5, 9} and 6 not in left["near_dedup"]
    assert left["decontamination"] == left["near_dedup"] - {9} == left["packing"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left["packing"]


CLASHING = ("score", "lang_pred", "kept", "n_removed", "ranges", "contaminated", "items", "spans", "h", "fp", "node", "row", "d", "th", "k", "__text", "__0", "a b", "length", "offset")


def awkward(spark, data):
    """Documents whose further columns are named like the ones that the operators make inside, each with a value of its own."""
    df = spark.createDataFrame(data, SCHEMA)
    return df.select("*", *(F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING))


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stages_change_no_other_column(spark, tmp_path, name, stage):
    """Nulls, empty and repeated rows, clashing names: each row that stays has the values it had."""
    docs = awkward(spark, rows())
    spark.createDataFrame([(1, rows()[9][1]), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    changed = {"text", "n_chars"} if name == "line_dedup" else set()
    columns = [c for c in docs.columns if c not in changed]
    before, after = (Counter(tuple(r[c] for c in columns) for r in df.collect()) for df in (docs, out))
    assert not after - before
    left = {"language_id": len(rows()) - 4, "line_dedup": len(rows()), "near_dedup": None, "decontamination": len(rows()) - 3}[name]
    assert left is None or sum(after.values()) == left
    if name == "near_dedup":
        texts = [r.text for r in out.collect()]
        assert len(texts) == len(set(texts)) and sum(not (t or "").strip() for t in texts) == 1


def test_line_dedup_moves_each_text_once(spark, tmp_path, monkeypatch):
    asked, whole = [], corpus_pipeline.lines.without_repeated_runs
    monkeypatch.setattr(corpus_pipeline.lines, "without_repeated_runs", lambda docs, **x: asked.append(docs) or whole(docs, **x))
    data = [(1, b"a b\xff\nc"), (2, b"x y\nz w\n"), (3, b"x y\nz w\nend"), (4, None), (5, b"")]
    docs = spark.createDataFrame(data, "doc_id long, raw binary").selectExpr("doc_id", "raw as text", "'s' as source")
    docs.write.parquet(str(tmp_path / "raw"))
    docs = spark.read.schema("doc_id long, text string, source string").parquet(str(tmp_path / "raw"))  # bytes that are no UTF-8 stay too
    out = corpus_pipeline.line_dedup(spark, docs, "")
    assert asked[0].schema["row"].dataType.names == ["doc_id", "source"]
    assert {r.doc_id: None if r.t is None else bytes(r.t) for r in out.selectExpr("doc_id", "cast(text as binary) as t").collect()} == dict(data[:2]) | {3: b"end", 4: None, 5: b""}


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, tmp_path, name, stage):
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = stage(spark, awkward(spark, []), str(tmp_path))
    assert out.count() == 0 and (name == "packing" or out.columns == awkward(spark, []).columns)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{DATA}/{file}'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    relation = con.sql(queries.ORACLES[name])
    assert sorted(relation.columns) == columns
    expected = sorted(map(str, relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()))
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == expected


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_one_row_per_document(spark):
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name in ("op3_ppm_scoring", "op5_language_id", "op7_document_fingerprints", "op8_simhash_near_dedup", "op10_token_files"):
        assert queries.QUERIES[name](spark, DATA).count() == n
