"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that are not blank.  Of every ``run`` neighbouring lines the
one of least hash is a fingerprint, so every repeated run of ``run`` lines or more has fingerprints in
common with its first occurrence; a line of ``long_words`` words is one by itself.  Fingerprints
are joined by hash; those that occur once go no further.  A shared one is extended both ways by the
strings of lines it stands for: overlapping matches join up to the whole repeated run.  All but the
first occurrence of a run are deleted from their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonnage.llm.common import forget, slices, staged, text_bytes
from tonnage.llm.repeats import merged, with_lists


def _spans(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the lines that are not blank, without their line feeds."""
    out, at = [], 0
    for line in text.split(b"\n"):
        if line.strip():
            out.append((at, at + len(line)))
        at += len(line) + 1
    return out


def fingerprints(text: bytes, run: int, long_words: int) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """(hash of a selected line, [(first line, lines, two digests) of the strings it stands for])."""
    lines = [text[a:z] for a, z in _spans(text)]
    hashes = [xxhash.xxh3_64_intdigest(x) for x in lines]
    chosen: dict[int, list[tuple[int, int, int, int]]] = {}

    def add(anchor: int, first: int, n: int) -> None:
        d = np.frombuffer(xxhash.xxh3_128_digest(b"\n".join(lines[first : first + n])), np.int64)
        chosen.setdefault(anchor, []).append((first, n, int(d[0]), int(d[1])))

    for first in range(len(lines) - run + 1):
        add(min(range(first, first + run), key=hashes.__getitem__), first, run)
    for k, line in enumerate(lines):
        if run > 1 and len(line.split()) >= long_words:
            add(k, k, 1)
    return [(int(np.uint64(hashes[k]).view(np.int64)), found) for k, found in sorted(chosen.items())]


def _emit(run: int, long_words: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        runs = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, 2, 4 << 20):
                rows: list[list] = [[], [], [], []]
                for doc, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                    for h, found in fingerprints(text or b"", run, long_words):
                        strings = [dict(zip(("first", "n", "d1", "d2"), x)) for x in found]
                        for column, value in zip(rows, (doc, th, h, strings)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), runs))], names=["doc_id", "th", "h", "runs"])

    return emit


def repeated_runs(docs: DataFrame, run: int, long_words: int) -> DataFrame:
    """doc_id, th, first, n: lines to delete; ranges may overlap.  ``docs``: doc_id, th, text."""
    kinds = "doc_id long, th long, h long, runs array<struct<first: int, n: int, d1: long, d2: long>>"
    chosen = staged(docs.select("doc_id", "th", "text").mapInArrow(_emit(run, long_words), kinds), "winnowed")
    shared = staged(chosen.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "shared")
    # a merge join at every size: the shared hashes grow with the corpus
    strings = chosen.join(shared.hint("merge"), "h").select("doc_id", "th", F.explode("runs").alias("r")).select("r.d1", "r.d2", "r.n", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "r.first").alias("place"))
    classes = strings.groupBy("d1", "d2", "n").agg(F.min("place").alias("earliest"), F.count("*").alias("c")).where("c > 1").drop("c")
    again = strings.join(classes, ["d1", "d2", "n"]).where("place > earliest")
    return again.select("place.doc_id", "place.th", "place.first", "n")


def _delete(columns: int):
    """Adds n_lines, n_removed, n_runs and the text that is left; the last two columns are text and ranges."""

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, columns, 8 << 20):
                rows = []
                for text, found in zip(text_bytes(batch.column(columns)), batch.column(columns + 1).to_pylist()):
                    raw = text or b""
                    spans, gone = _spans(raw), merged([(x["first"], x["first"] + x["n"]) for x in found or ()])
                    kept, at = [], 0
                    for a, z in gone:  # blank lines between deleted ones go with them
                        kept.append(raw[at : spans[a][0]])
                        at = min(len(raw), spans[z - 1][1] + 1)
                    kept.append(raw[at:])
                    left = text if not gone else b"".join(kept).decode("utf-8", "replace").encode()
                    rows.append((len(spans), sum(z - a for a, z in gone), len(gone), left))
                added = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                # bytes as text, unchecked: a text that nothing goes from stays as it is, byte by byte
                valid, ends, data = added[3].buffers()
                added[3] = pa.StringArray.from_buffers(len(rows), ends, data, valid)
                yield pa.RecordBatch.from_arrays([*batch.columns[:columns], *added], names=[*batch.schema.names[:columns], "n_lines", "n_removed", "n_runs", "kept"])

    return delete


def without_repeated_runs(docs: DataFrame, *, run: int = 2, long_words: int = 20, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with n_lines (not blank), n_removed, n_runs and kept, the text that is left.

    Null text: no lines, and null stays null.  A null doc_id comes after all others; documents of one
    doc_id are ordered by a hash of their text; rows equal in doc_id and text are one document with as
    many equal result rows.  Blank lines are no part of a run.  An empty table gives no rows.
    """
    names = [f"__{k}" for k in range(len(keep))]
    keyed = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), "doc_id", F.xxhash64("text").alias("th"), "text")
    lists = repeated_runs(keyed, run, long_words).groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "n")).alias("ranges"))
    joined = with_lists(keyed, lists, "left").select(*names, "text", "ranges")
    added = T._parse_datatype_string("n_lines long, n_removed long, n_runs long, kept string")
    out = joined.mapInArrow(_delete(len(keep)), T.StructType([*joined.schema.fields[: len(keep)], *added.fields]))
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "n_lines", "n_removed", "n_runs", "kept")


#: The same figures in SQL: strings of two lines, and of one long line, by their text; a blank line goes if both lines about it do.
ORACLE = r"""
WITH a AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
l AS (SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM a WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
s AS (
  SELECT doc_id, i, 2 AS n, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l
  UNION ALL SELECT doc_id, i, 1, line FROM l WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 20),
f AS (SELECT n, k, min({'doc_id': doc_id, 'i': i}) AS first FROM s WHERE k IS NOT NULL GROUP BY n, k HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + s.n)) AS i FROM s JOIN f ON s.n = f.n AND s.k = f.k WHERE doc_id <> first.doc_id OR i <> first.i),
r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (opens) AS n_runs FROM (SELECT doc_id, i, coalesce(i > 1 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS opens FROM g) GROUP BY doc_id),
o AS (SELECT doc_id, a.line, pos, i, last_value(i IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS before, count(*) OVER (PARTITION BY doc_id) AS lines FROM a LEFT JOIN l USING (doc_id, pos)),
q AS (
  SELECT o.doc_id, string_agg(line || CASE WHEN pos < lines THEN chr(10) ELSE '' END, '' ORDER BY pos) AS kept
  FROM o LEFT JOIN g AS x ON x.doc_id = o.doc_id AND x.i = o.before LEFT JOIN g AS y ON y.doc_id = o.doc_id AND y.i = o.before + 1
  WHERE CASE WHEN o.i IS NOT NULL THEN x.i IS NULL ELSE x.i IS NULL OR y.i IS NULL END GROUP BY o.doc_id)
SELECT doc_id, CAST((SELECT count(*) FROM l WHERE l.doc_id = d.doc_id) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN r USING (doc_id) LEFT JOIN q USING (doc_id)
"""
