"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased code points; every run of 1 to 3 of them is hashed into ``buckets``.  Counts by
language and bucket are summed over all training documents (no sample); their smoothed logarithms
form one matrix of languages by buckets, which is what goes to every task: its size depends on the
number of languages, which is checked, not on the corpus.  A batch of documents is scored at
once: the matrix rows of all n-grams, added up by document.

The odds between languages saturate with the length of a text and say nothing of languages that were
not learned.  The score is therefore the probability of the likeliest language times its fit: how
likely the text's n-grams are on average, against the average in that language's own text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonnage.llm.common import forget, held_out, slices, text_bytes

_HAS_LETTER = re.compile(r"[^\W\d_]").search
_MIX = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
UNDETERMINED = "und"


def grams(texts: list[str], bits: int, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams of all ``texts``, index of each one's text)."""
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    lengths = np.array([len(x) for x in codes])
    flat, owner = np.concatenate(codes), np.repeat(np.arange(len(codes), dtype=np.int32), lengths)
    hashed, owners = [], []
    key = np.zeros(len(flat), np.uint32)
    for n in range(1, min(longest, len(flat)) + 1):
        key = (key[: len(flat) - n + 1] ^ flat[n - 1 :]) * _MIX[n - 1]
        key ^= key >> np.uint32(15)
        same = slice(None) if n == 1 else owner[: len(flat) - n + 1] == owner[n - 1 :]
        hashed.append((key * _MIX[0] >> np.uint32(32 - bits))[same])
        owners.append(owner[: len(flat) - n + 1][same])
    return np.concatenate(hashed), np.concatenate(owners)


def _texts(batch: pa.RecordBatch, column: int) -> list[str | None]:
    return [x if x is None else x.decode("utf-8", "replace") for x in text_bytes(batch.column(column))]


@dataclass(frozen=True)
class Model:
    """Log probability of each bucket (rows) in each language (columns), log priors, mean log probability of a language's own n-grams."""

    languages: list[str]
    table: np.ndarray
    prior: np.ndarray
    own: np.ndarray


def _model(languages: list[str], counts: np.ndarray) -> Model:
    """From counts by language and bucket; the last entry of a language counts its documents."""
    smooth = counts[:, :-1] + 0.5
    table = np.log(smooth / smooth.sum(1, keepdims=True))
    prior = np.log((counts[:, -1] + 1) / (counts[:, -1] + 1).sum())
    return Model(languages, np.ascontiguousarray(table.T.astype(np.float32)), prior, (np.exp(table) * table).sum(1))


def train(labelled: DataFrame, *, fold: Column | None = None, folds: int = 1, bits: int = 15, most_languages: int = 1000) -> list[Model]:
    """Models learned from text and non-null lang of all rows, no sample: one, or one a fold that has not seen the fold's rows."""
    rows = labelled.select("lang", "text", (F.lit(0) if fold is None else fold).cast("int").alias("fold")).where("lang is not null and text is not null")
    languages = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").limit(most_languages + 1).collect()]
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not languages:
        return [Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0), np.zeros(0))] * folds
    place = {x: k for k, x in enumerate(languages)}
    width = (1 << bits) + 1  # the last entry counts documents

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, len(languages), width), np.int64)
        for whole in batches:
            for batch in slices(whole, 1, 2 << 20):
                by: dict[tuple[int, int], list[str]] = {}
                for lang, text, k in zip(batch.column(0).to_pylist(), _texts(batch, 1), batch.column(2).to_pylist()):
                    by.setdefault((k, place[lang]), []).append(text)
                for at, texts in by.items():
                    total[at][:-1] += np.bincount(grams(texts, bits)[0], minlength=width - 1)
                    total[at][-1] += len(texts)
        k, at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(at, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[k, at, bucket])], names=["fold", "lang", "bucket", "n"])

    counts = np.zeros((folds, len(languages), width))
    summed = rows.mapInArrow(count, "fold int, lang int, bucket int, n long").groupBy("fold", "lang", "bucket").agg(F.sum("n").alias("n"))
    for r in summed.groupBy("fold", "lang").agg(F.collect_list(F.struct("bucket", "n")).alias("all")).toLocalIterator():
        pairs = np.array([tuple(x) for x in r["all"]])
        counts[r["fold"], r["lang"], pairs[:, 0]] = pairs[:, 1]
    if folds == 1:
        return [_model(languages, counts[0])]
    return [_model(languages, counts.sum(0) - counts[k]) for k in range(folds)]


def _judged(model: Model, texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the likeliest language, score) of each of ``texts``."""
    hashed, owner = grams(texts, bits)
    sums = np.stack([np.bincount(owner, model.table[:, k][hashed], minlength=len(texts)) for k in range(len(model.languages))], 1)
    odds = sums + model.prior
    odds = np.exp(odds - odds.max(1, keepdims=True))
    best = odds.argmax(1)
    mean = sums[np.arange(len(texts)), best] / np.bincount(owner, minlength=len(texts))
    fit = np.exp(np.minimum(0, mean - model.own[best]))
    return best, odds.max(1) / odds.sum(1) * fit


def identify(docs: DataFrame, models: list[Model], *, fold: Column | None = None, keep: tuple[str, ...] = ("doc_id",), bits: int = 15) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score; a row is judged by the model of its ``fold``."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    languages = models[0].languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for batch in slices(whole, whole.num_columns - 1, 1 << 20):
                texts, folds = _texts(batch, batch.num_columns - 1), batch.column(batch.num_columns - 2).to_pylist()
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                for k, model in enumerate(shared.value):
                    at = [row for row, x in enumerate(texts) if folds[row] == k and x and languages and _HAS_LETTER(x)]
                    if at:
                        for row, best, score in zip(at, *(x.tolist() for x in _judged(model, [texts[row] for row in at], bits))):
                            names[row], scores[row] = languages[best], score
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(names), pa.array(scores, pa.float64())], names=[*batch.schema.names[:-2], "lang_pred", "score"])

    chosen = docs.select(*keep, (F.lit(0) if fold is None else fold).cast("int").alias("__fold"), F.col("text").alias("__text"))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[:-2], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def predicted(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; held-out rows teach nothing.

    Null text, or text without a letter: ``und``, score 0.  Without training rows every text is
    ``und``.  Null doc_ids hash as empty text; repeated ones give a row each.  Null lang: not learned
    from.  Other columns are ignored.
    """
    marked = docs.select("doc_id", "text", "lang", held_out("doc_id", folds, fold).alias("held_out"))
    return identify(marked, train(marked.where("not held_out")), keep=("doc_id", "held_out"))


def cross_predicted(docs: DataFrame, *, keep: tuple[str, ...], folds: int = 2) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score, judged by a model that has not learned from the row.

    Rows are dealt into ``folds`` by a hash of their text, so copies of a text teach nothing about it either.  Rows
    as in :func:`predicted`; columns of ``docs`` beside text, lang and ``keep`` are ignored.
    """
    fold = F.pmod(F.xxhash64("text"), F.lit(folds))
    return identify(docs, train(docs, fold=fold, folds=folds), fold=fold, keep=keep)
