"""Document fingerprints: content-defined chunks by a normalised gear hash, weighted by length.

The gear hash of a position mixes the 32 bytes up to it, so it is computed for a whole batch in five
shift-and-add steps and a boundary depends on nearby bytes alone: an edit moves the boundaries
around it and no others.  Chunking is normalised: a strict mask before the wanted size, a lax one
after it.  A fingerprint is the set of chunk digests with their lengths; likeness is the share, by
length, of a fingerprint's chunks that the other one contains too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.common import forget, offsets_of, slices

_GEAR = np.random.Generator(np.random.PCG64(0x6765)).integers(0, 1 << 32, 256, dtype=np.uint32)
LEAST, WANTED, MOST = 16, 40, 192
_STRICT, _LAX = np.uint32(0x3F << 26), np.uint32(0x0F << 28)


def _candidates(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which the lax mask allows a boundary, and whether the strict one does."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    at = np.flatnonzero((h & _LAX) == 0)
    return at + 1, (h[at] & _STRICT) == 0


def fingerprints(texts: list[bytes]) -> list[dict[str, int]]:
    """Digest to length (summed over equal chunks) for each of ``texts``."""
    raw = b"".join(texts)
    at, strict = _candidates(np.frombuffer(raw, np.uint8)) if raw else (np.zeros(0, np.int64), np.zeros(0, bool))
    starts, lengths = offsets_of(texts)
    out = []
    for start, n in zip(starts.tolist(), lengths.tolist()):
        # a boundary after fewer than 32 bytes would depend on the text before
        a, z = np.searchsorted(at, (start + 32, start + n))
        where, hard = (at[a:z] - start).tolist(), strict[a:z].tolist()
        found: dict[str, int] = {}
        last = k = 0
        while last < n:
            cut = min(last + MOST, n)
            while k < len(where) and where[k] <= cut:
                size = where[k] - last
                k += 1
                if size >= WANTED or size >= LEAST and hard[k - 1]:
                    cut = where[k - 1]
                    break
            digest = xxhash.xxh3_64_hexdigest(raw[start + last : start + cut])
            found[digest] = found.get(digest, 0) + cut - last
            last = cut
        out.append(found)
    return out


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of ``a``, by length, that ``b`` contains; 1 for two empty fingerprints."""
    total = sum(a.values())
    if not total:
        return float(not b)
    return sum(min(n, b[k]) for k, n in a.items() if k in b) / total


def written(fingerprint: dict[str, int]) -> str:
    return ",".join(f"{k}:{n:x}" for k, n in sorted(fingerprint.items()))


def read(fingerprint: str) -> dict[str, int]:
    return {k: int(n, 16) for k, _, n in (x.partition(":") for x in fingerprint.split(",") if x)}


def _prefix(text: bytes, chars: int) -> bytes:
    """The first ``chars`` code points of ``text``."""
    if chars >= len(text):
        return text
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return text if chars >= len(starts) else text[: starts[chars]]


def _n_chars(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def compared(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  The next
    document is the one before in descending (doc_id, hash of the text), a null doc_id coming last;
    after the last comes the first, and a single document is its own next.  Null text: empty.
    Repeated rows are documents of their own.  Other columns are ignored.

    Documents are dealt into ranges of doc_id; the last document of each range goes to the next range as
    well, so that every range finds its documents' successors in itself.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    keyed = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), F.coalesce(-F.col("doc_id"), F.lit(-(lowest + 1))).alias("at"))
    # descending doc_id is ascending ``at``; null comes last
    ids = keyed.select("at")
    if parts is None:
        size = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
        parts = min(8192, max(8, int(size >> 23)))  # ranges are sorted outside Python and streamed: their size is no bound
    edges = sorted({int(x) for x in ids.approxQuantile("at", [k / parts for k in range(1, parts)], 1 / (4 * parts))})
    bucket = F.lit(0)
    for edge in edges if len(edges) <= 64 else ():
        bucket = bucket + (F.col("at") > edge).cast("int")
    if len(edges) > 64:  # a long sum of comparisons costs more than a lookup
        bucket = F.aggregate(F.lit(edges), F.lit(0), lambda n, x: n + (F.col("at") > x).cast("int"))
    dealt = keyed.withColumn("part", bucket)
    # the first row of each non-empty range, one per range
    heads = dealt.groupBy("part").agg(F.min(F.struct("at", F.xxhash64("text").alias("h"))).alias("head")).collect()
    heads = sorted((r["part"], r["head"]["at"], r["head"]["h"]) for r in heads)
    if not heads:
        return dealt.select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))))
    # the head of a range also ends the range before; the first head ends the last range
    after = {at: before for (_, at, _), (before, _, _) in zip(heads, [heads[-1], *heads[:-1]])}
    table = spark.createDataFrame([(at, h, after[at]) for _, at, h in heads], "at long, h long, part int")
    own = dealt.select("part", F.lit(0).alias("tail"), "at", F.xxhash64("text").alias("h"), "doc_id", "text")
    tails = keyed.where(F.col("at").isin(list(after))).withColumn("h", F.xxhash64("text")).join(F.broadcast(table), ["at", "h"])
    tails = tails.dropDuplicates(["at", "h", "part"]).select("part", F.lit(1).alias("tail"), "at", "h", "doc_id", "text")
    rows = own.unionByName(tails).repartitionById(heads[-1][0] + 1, "part").sortWithinPartitions("part", "tail", "at", "h")
    return rows.select("part", "tail", "doc_id", "text").mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    forget()
    waiting: list[tuple] = []  # at most one row: (part, doc_id, text), its successor not yet seen

    for whole in batches:
        for batch in slices(whole, 3, 4 << 20):
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            line = waiting + [(p, d, t, tail) for p, tail, d, t in rows]
            waiting = [] if line[-1][3] else line[-1:]
            texts = [x[2] for x in line]
            pairs = [k for k in range(len(line) - 1) if not line[k][3]]
            if not pairs:
                continue
            edited, counts = [], []
            for k in pairs:
                n = _n_chars(texts[k])
                counts.append(n)
                edited.append(_prefix(texts[k], n - n // 2) + _prefix(texts[k + 1], n // 2))
            own, changed = fingerprints(texts), fingerprints(edited)
            out = [(line[k][1], n, hashlib.sha256(e).hexdigest(), written(own[k]), written(c), likeness(own[k], c), likeness(own[k], own[k + 1])) for k, n, e, c in zip(pairs, counts, edited, changed)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)
