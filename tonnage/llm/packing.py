"""Best-fit packing of token sequences: linear grouping for large pieces, best fit for small ones.

The plan is made on the histogram of piece lengths, which has ``capacity`` entries at most however
many documents there are.  Large pieces are dealt into groups of equal cardinality and rounded up to
their group's longest; a linear programme over the few sizes left (column generation, an unbounded
knapsack prices new configurations) says how often each configuration is used.  Whole uses become
sequences, actual lengths take the rounded ones' places; what they leave over is grouped again.
Everything else goes, longest first, where it fits best.  The plan is a list of runs: ranks [r, r + n) of one length go to sequences
[s, s + n) at one offset.  Ranks within a length are dealt by salted windows, so a length that a
third of all pieces share is spread over many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonnage.llm.common import slices, staged, text_bytes
from tonnage.llm.token_files import encoder

#: length, first rank, pieces, first sequence, offset
Run = tuple[int, int, int, int, int]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece; only documents longer than ``capacity`` are cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        end = np.array([end_id], model.kind)
        for whole in batches:
            for batch in slices(whole, 1, 8 << 20):
                rows: list[list] = [[], [], [], [], []]
                for key, ids in zip(batch.column(0).to_pylist(), model.encode([x or b"" for x in text_bytes(batch.column(1))])):
                    ids = np.append(np.frombuffer(ids, model.kind), end).astype("<u4").tobytes()
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        for column, value in zip(rows, (key, k, at // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of ``sizes`` of most ``worth`` that fits: dynamic programme by number of pieces."""
    best, picks = np.zeros(capacity + 1), []
    while True:
        new, pick = best.copy(), np.full(capacity + 1, -1)
        for g, (size, value) in enumerate(zip(sizes.tolist(), worth.tolist())):
            offer = best[: capacity + 1 - size] + value
            better = offer > new[size:] + 1e-12
            new[size:][better], pick[size:][better] = offer[better], g
        if (pick < 0).all():
            break
        picks.append(pick)
        best = new
    at, counts = int(best.argmax()), np.zeros(len(sizes), np.int64)
    for pick in reversed(picks):
        if pick[at] >= 0:
            counts[pick[at]] += 1
            at -= int(sizes[pick[at]])
    return float(best.max()), counts


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Uses of each configuration in an optimum of the cutting-stock linear programme (revised simplex)."""
    s, d = np.array(sizes), np.array(demand, float)
    basis = np.diag((capacity // s).astype(float))
    for _ in range(40 * len(sizes) + 40):
        inverse = np.linalg.inv(basis)
        worth = np.ones(len(s)) @ inverse
        value, column = _best_configuration(s, np.maximum(worth, 0), capacity)
        if value <= 1 + 1e-9:
            break
        direction, level = inverse @ column, inverse @ d
        ratio = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        if not np.isfinite(ratio).any():
            break
        basis[:, int(ratio.argmin())] = column
    uses = np.linalg.solve(basis, d)
    return [(basis[:, k].round().astype(np.int64), float(u)) for k, u in enumerate(uses)]


class _Sequences:
    """Sequences by room left: each class is a list of [first, count) runs."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.made = capacity, 0
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def give(self, room: int, first: int, n: int) -> None:
        if not self.runs[room] and room:
            bisect.insort(self.rooms, room)
        self.runs[room].append((first, n))

    def take(self, size: int) -> tuple[int, int, int]:
        """(room, first, count) of the run with least room for ``size``; (0, 0, 0) if there is none."""
        k = bisect.bisect_left(self.rooms, size)
        if k == len(self.rooms):
            return 0, 0, 0
        room = self.rooms[k]
        first, n = self.runs[room].pop()
        if not self.runs[room]:
            self.rooms.pop(k)
        return room, first, n


def equal_groups(lengths: list[tuple[int, int]], groups: int) -> dict[int, list[list[int]]]:
    """(length, pieces), longest first, in groups of equal cardinality: rounded length to the [length, pieces] it stands for."""
    size = max(1, -(-sum(n for _, n in lengths) // groups))
    found: dict[int, list[list[int]]] = defaultdict(list)
    longest = room = 0
    for length, left in lengths:
        while left:
            if not room:
                longest, room = length, size
            n = min(left, room)
            found[longest].append([length, n])
            left, room = left - n, room - n
    return found


def plan(histogram: dict[int, int], capacity: int, groups: int = 64, large: int = 3) -> tuple[list[Run], int]:
    """Runs that place every piece of ``histogram`` (length to count), and the number of sequences.

    Pieces longer than ``capacity`` / ``large`` are grouped and go by configurations.  What whole uses leave over is
    grouped anew, in finer groups since there are fewer pieces, until a programme has no whole use.
    """
    runs: list[Run] = []
    used: dict[int, int] = defaultdict(int)
    out = _Sequences(capacity)
    big = sorted((x for x in histogram if x > capacity // large), reverse=True)
    while True:
        left = [(x, histogram[x] - used[x]) for x in big if histogram[x] > used[x]]
        # few lengths need no rounding
        by_size = {x: [[x, n]] for x, n in left} if len(left) <= groups else equal_groups(left, groups)
        sizes, before = sorted(by_size, reverse=True), out.made
        demand = [sum(n for _, n in by_size[x]) for x in sizes]
        queues = [by_size[s] for s in sizes]
        for counts, uses in configurations(sizes, demand, capacity) if sizes else ():
            slots = [g for g, k in enumerate(counts.tolist()) for _ in range(k)]
            n = min([int(uses + 1e-9), *(sum(x[1] for x in queues[g]) // int(counts[g]) for g in set(slots))]) if slots else 0
            # stretches of these sequences in which every slot keeps one actual length
            filled = [(0, n, 0)] if n > 0 else []
            for g in slots:
                queue, following = queues[g], []
                for first, count, offset in filled:
                    while count:
                        length, there = queue[0]
                        k = min(count, there)
                        runs.append((length, used[length], k, out.made + first, offset))
                        used[length] += k
                        following.append((first, k, offset + length))
                        first, count = first + k, count - k
                        queue[0][1] -= k
                        if not queue[0][1]:
                            queue.pop(0)
                filled = following
            for first, count, offset in filled:
                out.give(capacity - offset, out.made + first, count)
            out.made += max(0, n)
        if out.made == before:
            break
    # what is left, longest first, into the least room that takes it
    for length in sorted(histogram, reverse=True):
        left = histogram[length] - used[length]
        while left > 0:
            space, first, n = out.take(length)
            if not n:
                fit = capacity // length
                n, space, first = -(-left // fit), capacity, out.made
                out.made += n
            times = min(space // length, -(-left // n)) if n <= left else 1
            k = min(n, left)
            if k < n:
                out.give(space, first + k, n - k)
            rows = k
            for t in range(times):
                k = min(rows, left)
                if k < rows:
                    out.give(space - t * length, first + k, rows - k)
                    rows = k
                if not k:
                    break
                runs.append((length, used[length], k, first, capacity - space + t * length))
                used[length] += k
                left -= k
            else:
                t = times
            if rows:
                out.give(space - t * length, first, rows)
    return runs, out.made


#: Groups and the least large piece (as the divisor of the capacity) of the plans that are tried in turn.
GROUPINGS = ((64, 3), (128, 3), (32, 8), (64, 6))


def best_plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """The plan with fewest sequences over a few groupings; none can have fewer than the pieces' sum needs."""
    bound = -(-sum(length * n for length, n in histogram.items()) // capacity)
    best: tuple[list[Run], int] | None = None
    for groups, large in GROUPINGS:
        found = plan(histogram, capacity, groups, large)
        best = found if best is None or found[1] < best[1] else best
        if best[1] == bound:
            break
    return best


def packed(pieces: DataFrame, capacity: int, salt_rows: int = 1_000_000, salts: int = 1024) -> DataFrame:
    """``pieces`` (with a ``length`` of at most ``capacity``) with sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    runs, _ = best_plan(histogram, capacity)
    runs.sort()
    total = sum(histogram.values())
    # at most capacity rows: the number of salts of each length
    share = [(length, max(-(-n * salts // total), -(-n // salt_rows)), n) for length, n in histogram.items()]
    dealt = spark.createDataFrame(share, "length long, salts long, of_length long")
    salted = pieces.join(F.broadcast(dealt), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts"))
    counted = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    below = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("length", "salt", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("within", F.row_number().over(within) - 1).join(bases, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("base") + F.col("within")).alias("rank"))
    table = np.array(runs, np.int64)
    shared = spark.sparkContext.broadcast((table[:, 0] * (1 << 48) + table[:, 1], table))
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = shared.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "rank"))
            row = rows[np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1]
            columns = [batch.column(batch.schema.get_field_index(x)) for x in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Every document in sequences of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text: the end id alone.  Null and repeated doc_ids are pieces like any other.  An empty
    table gives no rows.  Other columns are ignored.
    """
    return packed(staged(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
