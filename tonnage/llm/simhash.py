"""SimHash near-duplicates by multi-index hashing.

A fingerprint's bits are majorities over its word shingles' hashes.  Fingerprints are cut into
segments; each enters a table under every segment's value and looks up the values in a small Hamming
ball around it, and whole distances decide.  Equal fingerprints are one entry, however many documents
have them.  A bucket gives a spanning forest of its links, not its pairs; a bucket of many entries is
dealt in blocks, two blocks to a group, so no group is larger than that and none is cut.

``one_of_each`` takes such links for candidates only: within each component of candidates the
shingle sets themselves are compared, and only pairs that are as similar as asked for are linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.common import ASCII_LOWER, forget, staged, text_bytes
from tonnage.llm.components import components, least_labels

#: (positions of the segment's bits in the fingerprint, radius of the ball)
Segment = tuple[tuple[int, ...], int]
#: Distinct fingerprints that a value of a near segment stands for, at most, if they were random.
BUCKET = 8
#: Tables that are searched at a time: what a round shuffles has a bound for each fingerprint.
_ROUND = 8
_PAIRS = 1 << 20
#: Shingles of a block of sets, bits of the map of wanted rows.
_SHINGLES = 1 << 20
_BITMAP = 1 << 23


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles of ``text``, repeats included; of all words if there are fewer."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    starts = [0, *(e + 1 for e in ends[: len(words) - k])]
    return np.array([digest(joined[a:z], 42) for a, z in zip(starts, ends[k - 1 :])], np.uint64)


def fingerprint(text: bytes, shingle: int, words: int) -> bytes:
    """``words`` little-endian 64-bit words; the first has the majorities of the hashes' own bits."""
    return majorities(shingle_hashes(text, shingle), words)


def majorities(h: np.ndarray, words: int) -> bytes:
    if not len(h):
        return bytes(8 * words)
    columns = [h]
    for _ in range(words - 1):  # further words from a mixed hash
        x = columns[-1] + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        columns.append(x ^ x >> np.uint64(31))
    out = b""
    for column in columns:
        ones = np.zeros(64, np.int64)
        for at in range(0, len(column), 1 << 16):
            ones += np.unpackbits(column[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out += np.packbits(2 * ones > len(column), bitorder="little").tobytes()
    return out


def fingerprinted(docs: DataFrame, shingle: int, words: int = 1) -> DataFrame:
    """doc_id, h (a hash of the text) and fp of every row; a null text has no words and the fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [fingerprint(x or b"", shingle, words) for x in text_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "h", "fp"])

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, fp binary")


def exact_segments(distance: int, entries: int) -> list[Segment]:
    """Segments of one 64-bit word that miss no pair within ``distance``.

    Of m segments, one among the first (distance mod m) + 1 differs in distance div m bits at most or one
    of the others in fewer.  Segments are as many as keep their tables sparse for ``entries``.
    """
    m = 3 if math.log2(max(2, entries)) <= 25 and distance < 6 else 2
    radius, more = divmod(distance, m)
    widths = [64 // m + (k < 64 % m) for k in range(m)]
    lows = [0, *accumulate(widths)]
    return [(tuple(range(lows[k], lows[k + 1])), radius if k <= more else radius - 1) for k in range(m) if k <= more or radius]


def _missed(total: int, rate: float, bits: int, tables: int) -> float:
    """The share of pairs, apart in each of ``total`` bits with probability ``rate``, that meet in none of the tables."""
    out = 0.0
    for apart in range(total + 1):
        weight = math.lgamma(total + 1) - math.lgamma(apart + 1) - math.lgamma(total - apart + 1) + apart * math.log(rate) + (total - apart) * math.log(1 - rate)
        same = 1 - apart / total
        out += math.exp(weight) * (1 - same**bits - bits * (1 - same) * same ** (bits - 1)) ** tables
    return out


def near_segments(words: int, entries: int, similarity: float, recall: float = 0.99) -> list[Segment]:
    """Segments of radius 1 that find pairs of sets as similar as ``similarity`` with a probability of ``recall``.

    A segment's bits follow the number of ``entries``: one of its values stands for ``BUCKET`` random fingerprints
    at most, however many there are.  The more bits, the more tables: about as the fourth root of the
    entries.  Bits are dealt by seeded permutations; segments of one permutation have no bit in common.
    """
    total = 64 * words
    bits = max(8, math.ceil(math.log2(max(2, entries) / BUCKET)))
    # sets of one size with that Jaccard similarity have this cosine; each bit tells them apart at its angle
    rate = math.acos(2 * similarity / (1 + similarity)) / math.pi
    tables = 1
    while _missed(total, rate, bits, tables) > 1 - recall:
        tables += 1
    deal = np.random.Generator(np.random.PCG64(0x6E73))
    found: list[Segment] = []
    while len(found) < tables:
        order = deal.permutation(total).tolist()
        found += [(tuple(order[k : k + bits]), 1) for k in range(0, total - bits + 1, bits)]
    return found[:tables]


def _keys(segments: list[tuple[int, Segment]], words: int):
    """(2 * key + 1 if it is looked up, 0 if it is entered; fingerprint) of every (number, segment)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                column = whole.column(0).slice(at, 2000)
                bits_of = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 8 * words), axis=1, bitorder="little").T.astype(np.int64)
                for s, (positions, radius) in segments:
                    bits = len(positions)
                    v = sum(bits_of[p] << k for k, p in enumerate(positions))
                    rows, keys, probe = [np.arange(len(v))], [v], [np.zeros(len(v), np.int64)]
                    for flip in range(bits) if radius else ():
                        # of two values one bit apart, the one without that bit looks the other up
                        mine = np.flatnonzero(v >> flip & 1 == 0) if radius == 1 else rows[0]
                        for second in (None, *range(flip)) if radius == 2 else (None,):
                            rows.append(mine)
                            keys.append(v[mine] ^ (1 << flip) ^ (0 if second is None else 1 << second))
                            probe.append(np.ones(len(mine), np.int64))
                    taken = pa.array(np.concatenate(rows))
                    marked = (np.concatenate(keys) + (s << 40)) * 2 + np.concatenate(probe)
                    yield pa.RecordBatch.from_arrays([pa.array(marked), column.take(taken)], names=["g", "fp"])

    return run


def _forest(words: int, distance: int):
    """Spanning forests of the links within groups; rows come sorted by group, table entries first."""

    def solve(group: np.ndarray, probe: np.ndarray, raw: list[bytes]) -> pa.RecordBatch:
        values = np.frombuffer(b"".join(raw), "<u8").reshape(-1, words)
        n = len(group)
        ends = np.searchsorted(group, group, side="right")
        label = np.arange(n)
        entry = np.flatnonzero(probe == 0)
        counts = ends[entry] - entry - 1
        entry, counts = entry[counts > 0], counts[counts > 0]
        done = np.cumsum(counts)
        at = 0
        while at < len(entry):
            stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + _PAIRS, side="right")))
            c = counts[at:stop]
            left = np.repeat(entry[at:stop], c)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(c) - c, c)
            apart = np.bitwise_count(values[left, 0] ^ values[right, 0]).astype(np.int16)
            for k in range(1, words):
                apart += np.bitwise_count(values[left, k] ^ values[right, k])
            near = apart <= distance
            label = least_labels(label[left[near]], label[right[near]], n)[label]
            at = stop
        linked = [(k, r) for k, r in enumerate(label.tolist()) if k != r and raw[k] != raw[r]]
        edges = list({(raw[k], raw[r]) for k, r in linked})
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges], pa.binary()), pa.array([x for _, x in edges], pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        marks: list[np.ndarray] = []
        raws: list[bytes] = []
        for batch in batches:
            marks.append(batch.column(0).to_numpy())
            raws += batch.column(1).to_pylist()
            if len(raws) < 100_000:
                continue
            held = np.concatenate(marks)
            whole = int(np.searchsorted(held >> 1, held[-1] >> 1))
            if whole:
                yield solve(held[:whole] >> 1, held[:whole] & 1, raws[:whole])
            marks, raws = [held[whole:]], raws[whole:]
        if raws:
            held = np.concatenate(marks)
            yield solve(held >> 1, held & 1, raws)

    return run


def linked(fps: DataFrame, segments: list[Segment], words: int, distance: int, block: int = 1024) -> DataFrame:
    """a, b: for every group of linked fingerprints enough pairs to connect it.  ``fps``: distinct ``fp``.

    Tables are searched in rounds; the links of each are written before the next begins.
    """
    numbered = list(enumerate(segments))
    entered = fps.select("fp").mapInArrow(_keys([(s, (positions, 0)) for s, (positions, _) in numbered], words), "g long, fp binary")
    hot = entered.groupBy(F.shiftright("g", 1).alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > 2 * block)
    hot = staged(hot.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot-buckets")
    found = []
    for at in range(0, len(numbered), _ROUND):
        rows = fps.select("fp").mapInArrow(_keys(numbered[at : at + _ROUND], words), "g long, fp binary")
        dealt = rows.join(hot, F.shiftright("g", 1) == F.col("key"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        # rows of a hot key go by key and pair of blocks; where hashes meet, groups are compared that need not be
        pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
        group = F.when(F.col("blocks") > 1, F.shiftleft(F.shiftright(pair, 1), 1) + F.col("g").bitwiseAND(1)).otherwise(F.col("g"))
        grouped = dealt.select(group.alias("g"), "fp").repartition(F.shiftright("g", 1)).sortWithinPartitions("g")
        edges = grouped.mapInArrow(_forest(words, distance), "a binary, b binary")
        found.append(staged(edges, "links") if len(numbered) > _ROUND else edges)
    return reduce(DataFrame.unionByName, found)


def classes(prints: DataFrame, segments_for, words: int, distance: int) -> DataFrame:
    """fp, component_id (least doc_id of all linked fingerprints) for each distinct fingerprint of ``prints``."""
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(linked(fps, segments_for(fps.count()), words, distance))
    rooted = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, *, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Null or blank text: fingerprint zero, linked like any other.  Null doc_id: fingerprinted and linked,
    never a component's id unless all ids are null.  Repeated rows give a row each.  An empty table
    gives no rows.  Other columns are ignored.
    """
    prints = staged(fingerprinted(docs, shingle).drop("h"), "simhash")
    found = classes(prints, lambda n: exact_segments(distance, n), 1, distance)
    digits = F.lower(F.hex("fp"))  # of the least byte first
    shown = F.concat(*(F.substring(digits, 1 + 2 * k, 2) for k in range(7, -1, -1)))
    return prints.join(found, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct hashes of the word shingles of ``text``, sorted."""
    return np.unique(shingle_hashes(text, shingle))


def _set_digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def sketched(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """doc_id, h (a hash of the text), node (128-bit digest of the shingle set), size (of that set) and its fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [shingle_set(x or b"", shingle) for x in text_bytes(batch.column(2))]
            columns = [pa.array(map(_set_digest, found), pa.binary()), pa.array(map(len, found), pa.int64()), pa.array((majorities(x, words) for x in found), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "h", "node", "size", "fp"])

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, node binary, size long, fp binary")


def similar_sets(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of all pairs whose sets (distinct values) have a Jaccard similarity of ``similarity`` or more."""
    sizes = np.array([len(x) for x in sets])
    value, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    free = np.ones(len(sets), bool)
    edges = []
    for first in range(len(sets)):
        reached = [first] if free[first] else []
        free[first] = False
        while reached:  # what is linked already needs no further comparison
            k = reached.pop()
            start = np.searchsorted(value, sets[k], side="left")
            n = np.searchsorted(value, sets[k], side="right") - start
            at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(sets))
            near = np.flatnonzero(free & (common + 1e-9 >= similarity * (sizes[k] + sizes - common))).tolist()
            if near:
                edges += [(k, x) for x in near]
                reached += near
                free[near] = False
                held = free[owner]
                value, owner = value[held], owner[held]
    return edges


def _similar(similarity: float):
    """Spanning forests of the similar pairs within groups; rows (group, pair, node, shingles) come sorted by the first two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(k).to_pylist() for k in range(4)))

        found: list[tuple[bytes, bytes]] = []

        def drained() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.binary()) for k in range(2)], names=["a", "b"])
            found.clear()
            return out

        for _, members in groupby(rows(), key=lambda r: r[:2]):
            nodes, sets = zip(*((r[2], np.frombuffer(r[3], np.uint64)) for r in members))
            found += [(nodes[a], nodes[b]) for a, b in similar_sets(list(sets), similarity)]
            if len(found) > 10_000:
                yield drained()
        yield drained()

    return run


def _sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """k (a hash of doc_id and text), node, shingles of the rows with a k of ``wanted`` and of few others.

    A bitmap of fixed size keeps most other rows from being hashed and shuffled; the join by k and node drops the rest.
    """
    at = f"(k & {_BITMAP - 1})"
    words = wanted.selectExpr(f"shiftright({at}, 6) as word", f"shiftleft(1L, cast({at} & 63 as int)) as bit").groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    bitmap = np.zeros(_BITMAP >> 6, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            key = whole.column(0).to_numpy() & (_BITMAP - 1)
            batch = whole.take(pa.array(np.flatnonzero(bitmap[key >> 6] >> (key & 63) & 1)))
            found = [shingle_set(x or b"", shingle) for x in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(_set_digest, found), pa.binary()), pa.array((x.tobytes() for x in found), pa.binary())], names=["k", "node", "shingles"])

    return docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("k"), "text").mapInArrow(run, "k long, node binary, shingles binary")


def similar(docs: DataFrame, nodes: DataFrame, shingle: int, similarity: float, block: int = 512) -> DataFrame:
    """a, b: enough pairs to connect all nodes that are as similar within a group of ``nodes`` (node, group, size, k of one row that has it).

    A group of many nodes or long sets is dealt in blocks, two blocks to a task's group, so every pair meets.
    """
    parts = F.greatest(F.count("*") / block, F.sum("size") / _SHINGLES)
    groups = nodes.groupBy("group").agg(F.count("*").alias("n"), F.when(parts > 2, F.ceil(parts)).otherwise(1).cast("int").alias("blocks")).where("n > 1")
    wanted = staged(nodes.join(groups, "group").select("node", "k", "group", "blocks"), "candidates")
    rows = _sets_of(docs, wanted, shingle).join(wanted, ["node", "k"]).dropDuplicates(["node"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("own", "other") * 65536 + F.greatest("own", "other")
    dealt = dealt.select("group", pair.cast("long").alias("pair"), "node", "shingles")
    return dealt.repartition("group", "pair").sortWithinPartitions("group", "pair").mapInArrow(_similar(similarity), "a binary, b binary")


def _rooted(rows: DataFrame, column: str, edges: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: the root of ``column`` in the components of ``edges``, or itself."""
    roots = components(edges).select(F.col("node").alias(column), F.col("root").alias(name))
    return rows.join(roots, column, "left").withColumn(name, F.coalesce(name, column))


def one_of_each(docs: DataFrame, *, shingle: int = 5, words: int = 3, distance: int = 48, similarity: float = 0.8, recall: float = 0.99, block: int = 512) -> DataFrame:
    """``docs`` without near-duplicates: of every group the row of least doc_id stays, with all its columns.

    Groups are the components of pairs whose sets of word shingles (as 64-bit hashes) have a Jaccard similarity of
    ``similarity`` or more; every link is verified on the sets.  Fingerprints of the sets only find candidates: a pair of
    just 0.8 has 29 of 192 bits apart (deviation 5), is within ``distance`` but for one in 10 000 and meets in some
    table with the probability ``recall``, closer ones more surely.
    A null text has no words, like a blank one; of such rows one stays.  A null doc_id counts as the largest; of rows
    equal in doc_id and text one stays.  Columns beside doc_id and text pass through, whatever their names.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", F.xxhash64("text").alias("h"))
    prints = staged(sketched(docs, shingle, words), "simhash")
    fps = staged(prints.select("fp").distinct(), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    nodes = staged(prints.groupBy("node", "fp", "size").agg(F.min(least).alias("k")), "shingle-sets")
    segments = near_segments(words, fps.count(), similarity, recall)
    grouped = _rooted(nodes, "fp", linked(fps, segments, words, distance), "group")
    grouped = staged(grouped.select("node", "group", "size", F.xxhash64("k.doc_id", "k.h").alias("k")), "grouped")
    edges = similar(docs, grouped, shingle, similarity, block)
    found = _rooted(nodes.select("node", "k"), "node", edges, "component_id")
    kept = found.groupBy("component_id").agg(F.min("k").alias("k")).select("k.doc_id", "k.h")
    many = prints.groupBy("doc_id", "h").agg(F.count("*").alias("n")).where("n > 1")
    same = lambda a, b: [F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")), F.col(f"{a}.h") == F.col(f"{b}.h")]
    kept = kept.alias("p").join(many.alias("k"), same("p", "k"), "left").select("p.doc_id", "p.h", (F.coalesce("n", F.lit(1)) > 1).alias("repeated"))
    kept = staged(kept, "kept")
    single = rows.alias("d").join(kept.where("not repeated").alias("k"), same("d", "k"), "left_semi").select("row.*")
    first = rows.alias("d").join(kept.where("repeated").alias("k"), same("d", "k"), "left_semi").dropDuplicates(["doc_id", "h"]).select("row.*")
    return single.unionByName(first)
