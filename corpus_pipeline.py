"""A corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage works on all rows its predecessor kept; all but the last return the columns of
``documents``.  Stages are written as Parquet to the shared folder and read again.

Rows travel whole, in one column: a stage gives back every column as it was, whatever its name, but for
the text and n_chars that line dedup changes.  A null doc_id comes after all others, repeated rows are
rows of their own until near-dedup, an empty table gives an empty table.  What becomes of null and
empty texts is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonnage.llm import decontamination, language, lines, packing, simhash
from tonnage.llm.common import small_batches, staged, table
from tonnage.llm.queries import word_bpe

#: A document is rejected below this score: its n-grams are 50 times less likely, on average, than those of the
#: language they fit best.  That is another script, markup or bare symbols, not unusual prose.
LEAST_SCORE = 0.02


def _whole(docs: DataFrame, *columns: str, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with all its columns but ``without`` in one, ``row``, beside those a stage reads."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without)).alias("row"), *columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language.

    The classifier learns from every labelled document; a document is judged by the half of them that it is not in.
    Null, empty or letterless texts go, as does everything if no document is labelled.
    """
    small_batches(spark)
    found = language.cross_predicted(_whole(docs, "text", "lang"), keep=("row",))
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are deleted; a document of which nothing is left stays, empty; a null text stays null."""
    small_batches(spark)
    # the text comes back as it was where nothing goes: it need not travel in the row a second time
    found = lines.without_repeated_runs(_whole(docs, "doc_id", "text", without=("text",)), run=2, long_words=20, keep=("row",))
    changed = F.col("n_removed") > 0
    columns = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return found.select(*(columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8; texts without words are one group."""
    small_batches(spark)
    return simhash.one_of_each(docs, shingle=5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark; a null text has none."""
    small_batches(spark)
    found = decontamination.contamination(_whole(docs, "text"), table(spark, sf_dir, "benchmark"), window=10, keep=("row",))
    return found.where("not contaminated").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 ids; a null text is the end id alone."""
    small_batches(spark)
    return packing.pack_documents(docs, word_bpe(), capacity=4096, end_id=1)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("packing", best_fit_packing),
]

#: Tokenizer ids, SimHash groups and a trained classifier have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
