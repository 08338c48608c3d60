"""Removal of repeated byte strings with suffix arrays.

A byte goes if some string of ``length`` bytes that covers it also starts earlier, in a document of
smaller id or at an earlier place of the same one.  A suffix array of the whole corpus fits no
machine, so suffixes are first brought together that can be equal:

1. Every string of ``length`` bytes has an anchor, the least of the hashes of its ``GRAM``-byte
   substrings.  Equal strings have equal anchors at equal distances, so only the contexts of anchors
   that occur more than once matter.  Anchors (one in about 32 bytes) are dealt by their hash.
2. Of equal contexts of an anchor all but the first are repeats as a whole.  Each task keeps the first
   of those it has read before it deals them, and a bucket keeps the first of those it has met.
3. The different contexts of an anchor are joined into a text whose suffixes are sorted by linear
   grouping (:mod:`tonnage.llm.suffixes`); equal strings are then neighbours, and all but the
   first of each class are repeats.
4. An anchor with more than ``most_contexts`` different contexts (a passage that very many documents
   share) is not sorted in one task: its strings are classed by 128-bit digest in a table instead.

Repeats are collected by document and cut out of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.common import forget, offsets_of, slices, staged, text_bytes
from tonnage.llm.suffixes import suffix_arrays

GRAM = 32
_BYTE = np.random.Generator(np.random.PCG64(0x7265)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: An anchor as it is dealt: hash, digest of its context, document (index), first string, strings.
_ANCHOR = np.dtype([("h", "<u8"), ("c", "<u8"), ("doc", "<u4"), ("at", "<u4"), ("n", "<u2")])
_DOC = np.dtype([("none", "?"), ("doc", "<i8"), ("th", "<i8")])
#: Set in an anchor's number of strings if the task that read it has met an equal context before it: a repeat, whatever others meet.
_REPEAT = 0x8000


def _sliding(pick, values: np.ndarray, n: int) -> np.ndarray:
    """``pick`` over each stretch of ``n`` values from its start on (shorter at the end)."""
    out, span = values, 1
    while span < n:
        step = min(span, n - span)
        out = np.concatenate((pick(out[:-step], out[step:]), out[-step:])) if len(out) > step else out
        span += step
    return out


def anchors(texts: list[bytes], length: int) -> np.ndarray:
    """The anchors of all strings of ``length`` bytes in ``texts``, each with the strings it stands for."""
    raw = b"".join(texts)
    starts, lengths = offsets_of(texts)
    fit = lengths >= length
    if not fit.any():
        return np.zeros(0, _ANCHOR)
    h = _BYTE[np.frombuffer(raw, np.uint8)]
    factor, span = 0x9E3779B97F4A7C15, 1
    while span < GRAM:
        h[:-span] = h[:-span] * np.uint64(factor) + h[span:]
        factor, span = factor * factor & (1 << 64) - 1, 2 * span
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    width = length - GRAM + 1
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, starts[fit], 1)
    np.add.at(edge, starts[fit] + lengths[fit] - length + 1, -1)
    least = np.where(np.cumsum(edge[:-1]) > 0, _sliding(np.minimum, h, width), np.uint64(0))
    at = np.flatnonzero(_sliding(np.maximum, least[::-1], width)[::-1] == h)
    h = h[at]
    doc = np.searchsorted(starts, at, side="right") - 1
    low = np.maximum(at - width + 1, starts[doc])
    high = np.minimum(at, starts[doc] + lengths[doc] - length)
    for k in range(1, width):
        near = at[k:] - at[:-k] < width
        if not near.any():
            break
        before = near & (h[:-k] <= h[k:])
        low[k:][before] = np.maximum(low[k:][before], at[:-k][before] + 1)
        after = near & (h[k:] < h[:-k])
        high[:-k][after] = np.minimum(high[:-k][after], at[k:][after] - width)
    good = np.flatnonzero(low <= high)
    out = np.zeros(len(good), _ANCHOR)
    low, high, digest = low[good], high[good], xxhash.xxh3_64_intdigest
    out["h"], out["doc"], out["at"], out["n"] = h[good], doc[good], low - starts[doc[good]], high - low + 1
    out["c"] = np.fromiter((digest(raw[a:z]) for a, z in zip(low.tolist(), (high + length).tolist())), np.uint64, len(good))
    return out


def _planes(found: np.ndarray) -> bytes:
    """``found`` byte by byte of its rows: the high bytes, mostly zero, then compress."""
    return found.view(np.uint8).reshape(-1, found.itemsize).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(_ANCHOR.itemsize, -1).T.copy().view(_ANCHOR).ravel()


def _ordered(tables: list[np.ndarray], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents (in order, none last) and the anchors of all ``parts``, sorted by hash, context and place; equal ones once."""
    base = np.repeat(np.cumsum([0, *map(len, tables)])[:-1], [len(x) for x in parts])
    table, a = np.concatenate(tables), np.concatenate(parts)
    _, key, again = np.unique(table, return_index=True, return_inverse=True)
    a["doc"] = again[a["doc"] + base]
    a = a[np.lexsort((a["at"], a["doc"], a["c"], a["h"]))]
    fresh = np.ones(len(a), bool)  # rows that are the same document
    if len(a) > 1:
        fresh[1:] = (a["h"][1:] != a["h"][:-1]) | (a["c"][1:] != a["c"][:-1]) | (a["doc"][1:] != a["doc"][:-1]) | (a["at"][1:] != a["at"][:-1])
    return table[key], a[fresh]


def _heads(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted anchors: where another hash begins, where another context does."""
    new_h = np.concatenate(([True], a["h"][1:] != a["h"][:-1]))
    return new_h, new_h | np.concatenate(([True], a["c"][1:] != a["c"][:-1]))


def _deal(length: int, buckets: int, flush_bytes: int = 16 << 20):
    """Anchors in one binary value for each flush and bucket: half the size of rows, and no work by row."""

    def dealt(tables: list[np.ndarray], parts: list[np.ndarray]) -> pa.RecordBatch:
        table, found = _ordered(tables, parts)
        known = ~_heads(found)[1]
        found["n"][known] |= _REPEAT
        # repeats need not meet anything: they are spread evenly
        bucket = (np.where(known, found["c"] ^ found["at"] * np.uint64(0x9E3779B97F4A7C15) ^ table["th"][found["doc"]].view(np.uint64), found["h"]) % np.uint64(buckets)).astype(np.int64)
        found = found[np.argsort(bucket, kind="stable")]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets))))
        rows: list[list] = [[], [], []]
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            part = found[bounds[k] : bounds[k + 1]].copy()
            used, part["doc"] = np.unique(part["doc"], return_inverse=True)
            for column, value in zip(rows, (k, table[used].tobytes(), _planes(part))):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], names=["bucket", "docs", "anchors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tables: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        for whole in batches:
            for batch in slices(whole, 2, 2 << 20):
                found = anchors([x or b"" for x in text_bytes(batch.column(2))], length)
                if not len(found):
                    continue
                ids = batch.column(0)
                docs = np.zeros(batch.num_rows, _DOC)
                docs["none"], docs["doc"], docs["th"] = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
                tables.append(docs)
                parts.append(found)
                if sum(map(len, parts)) * _ANCHOR.itemsize > flush_bytes:
                    yield dealt(tables, parts)
                    tables, parts = [], []
        if parts:
            yield dealt(tables, parts)

    return run


def _matched(length: int, most_contexts: int, most_held: int = 2_000_000):
    """Of each bucket's anchors: repeats as a whole (kind 0), contexts to sort (1), contexts to class by digest (2).

    What is held of a bucket is thinned as it grows: of equal contexts the first, and nothing of an anchor that has
    been found to have too many.
    """

    class Bucket:
        def __init__(self, number: int) -> None:
            self.number, self.held, self.limit = number, 0, most_held
            self.tables: list[np.ndarray] = []
            self.parts: list[np.ndarray] = []
            self.crowded = np.zeros(0, np.uint64)

        def add(self, docs: bytes, packed: bytes) -> Iterator[pa.RecordBatch]:
            table, found = np.frombuffer(docs, _DOC), _from_planes(packed)
            known = (found["n"] & _REPEAT) > 0
            if known.any():
                repeats_ = found[known]
                repeats_["n"] &= _REPEAT - 1
                yield from shown(table, repeats_, np.zeros(len(repeats_), np.int8))
                found = found[~known]
            self.tables.append(table)
            self.parts.append(found)
            self.held += len(found)
            if self.held > self.limit:
                yield from self.thin(False)
                self.limit = max(most_held, 2 * self.held)

        def thin(self, last: bool) -> Iterator[pa.RecordBatch]:
            table, a = _ordered(self.tables, self.parts)
            if not len(a):
                return
            new_h, new_c = _heads(a)
            contexts = np.bincount((np.cumsum(new_h) - 1)[new_c])[np.cumsum(new_h) - 1]
            crowded = (contexts > most_contexts) | np.isin(a["h"], self.crowded)
            kind = np.where(new_c, np.where(crowded, 2, np.where(contexts > 1, 1, -1) if last else -1), 0)
            self.crowded = np.union1d(self.crowded, a["h"][crowded])
            out = kind >= 0
            yield from shown(table, a[out], kind[out].astype(np.int8))
            kept = a[~out]
            used, kept["doc"] = np.unique(kept["doc"], return_inverse=True)
            self.tables, self.parts, self.held = [table[used]], [kept], len(kept)

    def shown(table: np.ndarray, a: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(a), 50_000):
            b = a[at : at + 50_000]
            d = table[b["doc"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[at : at + 50_000]), pa.array(d["doc"], mask=d["none"]), pa.array(d["th"]), pa.array(b["h"].view(np.int64)), pa.array(b["at"].astype(np.int32)), pa.array(b["n"].astype(np.int32))],
                names=["kind", "doc_id", "th", "h", "at", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Bucket | None = None
        for batch in batches:
            for bucket, docs, found in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if now and now.number != bucket:
                    yield from now.thin(True)
                    now = None
                now = now or Bucket(bucket)
                yield from now.add(docs, found)
        if now:
            yield from now.thin(True)

    return run


def _contexts(length: int, most_strings: int = 50_000):
    """The bytes of contexts to sort (kind 1).

    Of contexts to class by digest: of equal strings that a task meets only the first is given (2), since
    the others are repeats (0) whatever other tasks meet.
    """
    names, kinds = ["kind", "doc_id", "th", "h", "at", "n", "context", "d1", "d2"], (pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    def classed(strings: list[tuple]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, tuple] = {}
        for digest, place in strings:
            if digest not in first or place < first[digest]:
                first[digest] = place
        rows, again = [], []
        for digest, (none, doc, th, at) in first.items():
            d = np.frombuffer(digest, np.int64)
            rows.append((2, None if none else doc, th, None, at, 1, None, int(d[0]), int(d[1])))
        for digest, place in strings:
            if place > first[digest]:
                again.append(place)
        begin = last = None
        for place in [*sorted(again), None]:
            if last and place != (*last[:3], last[3] + 1) and place != last:
                none, doc, th, at = begin
                rows.append((0, None if none else doc, th, None, at, last[3] - at + 1, None, None, None))
                begin = None
            begin, last = begin or place, place
        for at in range(0, len(rows), 20_000):
            yield table(rows[at : at + 20_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        strings: list[tuple] = []
        for batch in batches:
            rows: list[tuple] = []
            for doc, th, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), batch.column(3).to_pylist()):
                for w in wanted:
                    at, n = w["at"], w["n"]
                    if w["kind"] == 1:
                        rows.append((1, doc, th, w["h"], at, n, text[at : at + n - 1 + length], None, None))
                    else:
                        strings += [(xxhash.xxh3_128_digest(text[k : k + length]), (doc is None, doc or 0, th, k)) for k in range(at, at + n)]
                if len(rows) > 10_000:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)
            if len(strings) > most_strings:
                yield from classed(strings)
                strings = []
        if strings:
            yield from classed(strings)

    return run


def repeated_strings(groups: list[list[bytes]], length: int) -> np.ndarray:
    """[context, first, last] of runs of strings that start earlier in their group too.

    Each group's contexts are in order of place; contexts are counted through all groups.
    """
    # contexts are set apart by 1, the bytes are 2 and more
    whole = np.frombuffer(b"\0".join(c for g in groups for c in g) + b"\0", np.uint8).astype(np.int32) + 2
    ends = np.cumsum([len(c) + 1 for g in groups for c in g])
    whole[ends - 1] = 1
    stops = ends[np.cumsum([len(g) for g in groups]) - 1]
    begins = np.concatenate(([0], stops[:-1]))
    arrays = suffix_arrays([whole[a:z] for a, z in zip(begins.tolist(), stops.tolist())])
    order = np.concatenate(arrays).astype(np.int64) + np.repeat(begins, stops - begins)
    owner = np.repeat(np.arange(len(groups)), stops - begins)
    context_of = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
    full = order + length < ends[context_of[order]]
    order, owner = order[full], owner[full]
    if len(order) < 2:
        return np.zeros((0, 3), np.int64)
    same = owner[1:] == owner[:-1]
    for k in range(0, length, 10):
        some = np.flatnonzero(same)
        for at in range(0, len(some), 200_000):
            part, window = some[at : at + 200_000], np.arange(k, min(length, k + 10))
            same[part] = (whole[order[part][:, None] + window] == whole[order[part + 1][:, None] + window]).all(1)
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    least = np.repeat(np.minimum.reduceat(order, heads), np.diff(np.concatenate((heads, [len(order)]))))
    again = np.sort(order[order != least])
    if not len(again):
        return np.zeros((0, 3), np.int64)
    context = context_of[again]
    cut = np.flatnonzero(np.concatenate(([True], (again[1:] != again[:-1] + 1) | (context[1:] != context[:-1]))))
    stop = np.concatenate((cut[1:], [len(again)])) - 1
    base = np.concatenate(([0], ends))[context[cut]]
    return np.stack((context[cut], again[cut] - base, again[stop] - base), 1)


def _sorted_contexts(length: int, batch_bytes: int = 3 << 20):
    """Repeats among the contexts of each anchor; rows come sorted by anchor and place."""

    def solve(groups: list[list[tuple]]) -> pa.RecordBatch:
        groups = [g for g in groups if len(g) > 1]
        groups.sort(key=lambda g: sum(len(x[3]) for x in g))  # texts of like length step together
        flat = [x for g in groups for x in g]
        runs = repeated_strings([[x[3] for x in g] for g in groups], length).tolist() if groups else []
        rows = [(flat[k][0], flat[k][1], flat[k][2] + a, flat[k][2] + z + length) for k, a, z in runs]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc_id", "th", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        groups: list[list[tuple]] = []
        held, current = 0, None
        for batch in batches:
            for h, doc, th, at, context in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if h != current:
                    if held > batch_bytes:
                        yield solve(groups)
                        groups, held = [], 0
                    groups.append([])
                    current = h
                elif groups[-1][-1][:3] == (doc, th, at):  # rows that are the same document
                    continue
                groups[-1].append((doc, th, at, context))
                held += len(context)
        if groups:
            yield solve(groups)

    return run


def repeats(docs: DataFrame, *, length: int = 100, bucket_bytes: int = 8 << 20, most_contexts: int = 256) -> DataFrame:
    """doc_id, th, start, end: byte ranges to remove; they may overlap.  ``docs``: doc_id, th (hash of the text), text."""
    size = docs.agg(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    buckets = int(max(16, size // bucket_bytes))
    dealt = docs.select("doc_id", "th", "text").mapInArrow(_deal(length, buckets), "bucket int, docs binary, anchors binary")
    dealt = dealt.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    found = staged(dealt.mapInArrow(_matched(length, most_contexts), "kind byte, doc_id long, th long, h long, at int, n int"), "anchors")
    wanted = found.where("kind > 0").groupBy("doc_id", "th").agg(F.collect_list(F.struct("kind", "h", "at", "n")).alias("wanted"))
    joined = with_lists(docs.select("doc_id", "th", "text"), wanted, "inner").select("doc_id", "th", "text", "wanted")
    rows = staged(joined.mapInArrow(_contexts(length), "kind byte, doc_id long, th long, h long, at int, n int, context binary, d1 long, d2 long"), "contexts")
    contexts = rows.where("kind = 1").repartition("h")
    contexts = contexts.sortWithinPartitions("h", F.col("doc_id").asc_nulls_last(), "th", "at").select("h", "doc_id", "th", "at", "context")
    by_array = contexts.mapInArrow(_sorted_contexts(length), "doc_id long, th long, start int, end int")
    strings = rows.where("kind = 2").select("d1", "d2", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "at").alias("place"))
    classes = strings.groupBy("d1", "d2").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = strings.join(classes, ["d1", "d2"]).where(F.col("place") > F.col("first"))
    by_digest = again.select("place.doc_id", "place.th", F.col("place.at").alias("start"), (F.col("place.at") + length).alias("end"))
    whole = found.where("kind = 0").select("doc_id", "th", "at", "n").unionByName(rows.where("kind = 0").select("doc_id", "th", "at", "n")).select("doc_id", "th", F.col("at").alias("start"), (F.col("at") + F.col("n") - 1 + length).alias("end"))
    return whole.unionByName(by_array).unionByName(by_digest)


def with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with a table of at most one row for each (doc_id, th); the lists are the built side."""
    lists = lists.select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), *[c for c in lists.columns if c not in ("doc_id", "th")])
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("th") == F.col("__th"))
    return docs.join(lists.hint("shuffle_hash"), on, how).drop("__doc", "__th")


def merged(ranges: list) -> list[tuple[int, int]]:
    """Disjoint, non-adjacent ranges that cover the same places as ``ranges``."""
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, z) for a, z in out]


def without(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in ranges for x in r), len(text)]
    return b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for whole in batches:
        for batch in slices(whole, 1, 4 << 20):
            rows = []
            for doc, text, found in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                text, spans = text or b"", merged([(x["start"], x["end"]) for x in found or ()])
                rows.append((doc, len(text), sum(z - a for a, z in spans), len(spans), without(text, spans)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=names)


def without_repeats(docs: DataFrame, *, length: int = 100, most_contexts: int = 256) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of every row.

    A null doc_id comes after all others; documents of one doc_id are ordered by a hash of their text,
    and rows equal in doc_id and text are one document with as many equal result rows.  Null text:
    empty.  Texts shorter than ``length`` stay whole.  Other columns are ignored.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = repeats(keyed, length=length, most_contexts=most_contexts)
    lists = ranges.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return with_lists(keyed, lists, "left").select("doc_id", "text", "ranges").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


#: The same rows in SQL: every string by its bytes, the first of each class by place.
ORACLE = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
s AS (SELECT doc_id, i, hex(b[i : i + 99]) AS k FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS i FROM d)),
f AS (SELECT k, min({'doc_id': doc_id, 'i': i}) AS first FROM s GROUP BY k HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM s JOIN f USING (k) WHERE doc_id <> first.doc_id OR i <> first.i),
g AS (SELECT doc_id, i, coalesce(i > 100 + lag(i) OVER w, true) AS opens FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
p AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g) GROUP BY doc_id, span),
q AS (SELECT doc_id, a, z, coalesce(lag(z) OVER w, 1) AS since, lead(a) OVER w IS NULL AS ends FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
t AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans,
    string_agg(hex(b[since : a - 1]), '' ORDER BY a) || coalesce(max(hex(b[z : octet_length(b)])) FILTER (ends), '') AS kept
  FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(kept), b)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
