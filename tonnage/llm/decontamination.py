"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.  The automaton's
alphabet is the benchmark's vocabulary; a document is read once, word by word, and every occurrence
of a window comes out with the words it covers, which map back to character offsets of the text.

A benchmark of more than ``block_words`` words is taken in blocks, an automaton each; what goes to
every task has that bound, and further blocks cost further scans instead.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonnage.llm.common import remembered, staged, text_bytes

#: Bytes that separate words become blanks, A-Z become a-z.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets [start, end) of the words of ``text``."""
    inside = np.frombuffer(b" " + text.translate(_WORDS) + b" ", np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return chars[edges[::2]], chars[edges[1::2]]


def _automaton(items: list[tuple[str, bytes]], window: int):
    """(vocabulary, automaton) whose values are (words of the window, ids of its items)."""
    import ahocorasick

    number: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        sequence = tuple(number.setdefault(w, len(number) + 1) for w in words(text))
        for at in range(max(1, len(sequence) - window + 1)) if sequence else ():
            owners.setdefault(sequence[at : at + window], set()).add(item)
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, ids in owners.items():
        found.add_word(key, (len(key), tuple(ids)))
    found.make_automaton()
    return number, found


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block_words: int = 400_000, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    ``spans`` are the character ranges of the text that runs of hit words cover.  Null text: no words.
    Null item text or an item without words: nothing to find.  Null item_id: an item named by the
    empty string.  Repeated item_ids are one item with all their texts; repeated or null doc_ids give
    a row each; an empty benchmark hits nothing.  Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.size(F.split(F.col("text").cast("string"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))
    kept = [F.col(c).alias(f"__{k}") for k, c in enumerate(keep)]
    scanned = docs.select(*kept, F.col("text").alias("__text"), F.lit(None).cast("array<long>").alias("__hit"), F.lit(None).cast("array<string>").alias("__items"))
    kinds = scanned.schema
    added = T._parse_datatype_string("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<start: long, end: long>>")
    out = T.StructType([*kinds.fields[: len(keep)], *added.fields])
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        shared = spark.sparkContext.broadcast([(r["item"], bytes(r["text"])) for r in mine.collect()])
        if block + 1 < n_blocks:
            scanned = staged(scanned.mapInArrow(_scan(shared, window), kinds), "decontamination")
    found = scanned.mapInArrow(_scan(shared, window, last=True), out)
    return found.select(*(F.col(f"__{k}").alias(c) for k, c in enumerate(keep)), *found.columns[len(keep) :])


def _scan(shared, window: int, last: bool = False):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, automaton = remembered(key, lambda: _automaton(shared.value, window))
        get = number.get
        for batch in batches:
            *carried, text_column, hit_column, item_column = batch.columns
            hits, names = hit_column.to_pylist(), item_column.to_pylist()
            for row, text in enumerate(text_bytes(text_column)):
                if not text or not number:
                    continue
                sequence = tuple([get(w, 0) for w in words(text)])
                found: set[str] = set()
                covered = None
                for end, (n, ids) in automaton.iter(sequence):
                    if covered is None:
                        covered = np.zeros(len(sequence) + 1, np.int64)
                    covered[end - n + 1] += 1
                    covered[end + 1] -= 1
                    found.update(ids)
                if found:
                    hits[row] = sorted({*(hits[row] or ()), *np.flatnonzero(np.cumsum(covered) > 0).tolist()})
                    names[row] = sorted({*(names[row] or ()), *found})
            if last:
                yield _summary(batch, hits, names)
                continue
            yield pa.RecordBatch.from_arrays([*carried, text_column, pa.array(hits, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))], names=batch.schema.names)

    return run


def _summary(batch: pa.RecordBatch, hits: list, names: list) -> pa.RecordBatch:
    rows = []
    *carried, text_column, _, _ = batch.columns
    for text, hit, items in zip(text_bytes(text_column), hits, names):
        hit, items, spans = hit or [], items or [], []
        if hit:
            starts, ends = word_spans(text)
            at = np.array(hit)
            cut = np.flatnonzero(np.diff(at) > 1)
            first, last = at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]
            spans = [{"start": int(s), "end": int(e)} for s, e in zip(starts[first], ends[last])]
        rows.append((len(words(text or b"")), len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit), items, spans))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    columns = [*batch.schema.names[: len(carried)], "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"]
    return pa.RecordBatch.from_arrays([*carried, *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=columns)


#: The same rows in SQL: windows by position, joined with the items' windows.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
h AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
