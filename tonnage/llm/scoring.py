"""Corpus language-model scores by prediction by partial matching.

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts of the bytes that follow
them in the training documents.  A byte is predicted in the longest context known; a context that has
never seen it escapes to the next shorter one, whose counts then leave out the bytes the longer
one has seen (symbol exclusion).  Escapes are estimated from the number of different bytes seen
(each first occurrence counts half for its byte, half for the escape).  Below the empty context all bytes
not seen are equally likely.  A document's code length is the sum over its bytes and its end.

Nothing of the trie's or the vocabulary's size goes to one machine.  Documents are read in blocks of a
bounded size; each block asks, for its distinct byte windows and words, by hash bucket.  A bucket holds
all windows that share their last three context bytes, so it works out all longer contexts by itself.
What blocks ask of one bucket is salted: each share of the blocks is summed by itself, the sums (every
window once) meet in the bucket, and its answers go out to the shares again, which are read a block at
a time.  So a context that every text has costs no task more than its different windows and its
share.  Of shorter contexts there are at most 2^24 counts; those go to every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonnage.llm.common import ASCII_LOWER, forget, held_out, slices, staged, text_bytes

ORDER = 5
#: Bytes that UTF-8 text cannot hold: before a document's first byte, and after its last.
_BEFORE, _END = b"\xfe", b"\xff"
_GRAM = np.dtype([("key", "<u8"), ("n", "<u4")])
_SUM = np.dtype([("key", "<u8"), ("n", "<i8")])
_WINDOWS, _WORDS = 0, 1


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ASCII_LOWER).split()


def windows(norms: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(the windows of ``order`` bytes and a predicted one, last byte lowest; number of each text).

    ``norms`` are texts without their end; the end is predicted too.
    """
    raw = np.frombuffer(b"".join(_BEFORE * order + x + _END for x in norms), np.uint8).astype(np.uint64)
    out = raw[order:].copy()
    for k in range(1, order + 1):
        out |= raw[order - k : len(raw) - k] << np.uint64(8 * k)
    counts = np.array([len(x) + 1 for x in norms], np.int64)
    begins = np.cumsum(counts + order) - counts - order
    real = np.ones(len(out), bool)
    real[np.add.outer(begins[1:] - order, np.arange(order)).ravel()] = False
    return out[real], counts


def _tally(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their ``n``."""
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, weights=n, minlength=len(unique)).astype(np.int64)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


_END_WORD = b" "  # no word holds a blank


def _mix(context: np.ndarray) -> np.ndarray:
    x = context * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def _bucket_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    value = _mix(keys >> np.uint64(8) & np.uint64(0xFFFFFF)) if kind == _WINDOWS else keys >> np.uint64(20)
    return (value % np.uint64(buckets)).astype(np.int64)


def _ask(buckets: int):
    """For each block the distinct windows and words of its documents, with their training counts."""

    class Block:
        def __init__(self, block: int) -> None:
            self.block, self.parts, self.held = block, [], 0
            self.learned, self.met = Counter(), set()

        def add(self, texts: list[bytes | None], unseen: list[bool]) -> None:
            lists = [words_of(t) for t in texts]
            keys, counts = windows([b" ".join(x) for x in lists])
            known = np.repeat(~np.array(unseen), counts)
            for learned, some in ((True, keys[known]), (False, keys[~known])):
                unique, n = np.unique(some, return_counts=True)
                self.parts.append((unique, n if learned else np.zeros(len(unique), np.int64)))
                self.held += len(unique)
            if self.held > 4_000_000:
                self.parts = [_tally(*(np.concatenate(x) for x in zip(*self.parts)))]
                self.held = len(self.parts[0][0])
            for x, away in zip(lists, unseen):
                if away:
                    self.met.update(x)
                    self.met.add(_END_WORD)
                else:
                    self.learned.update(x)
                    self.learned[_END_WORD] += 1

        def out(self) -> pa.RecordBatch:
            rows: list[list] = [[], [], [], []]
            fresh = self.met.difference(self.learned)
            hashes = np.fromiter(map(_word_hash, [*self.learned, *fresh]), np.uint64, len(self.learned) + len(fresh))
            n = np.concatenate((np.fromiter(self.learned.values(), np.int64, len(self.learned)), np.zeros(len(fresh), np.int64)))
            both = ((_WINDOWS, *_tally(*(np.concatenate(x) for x in zip(*self.parts)))), (_WORDS, *_tally(hashes, n)))
            for kind, keys, counts in both:
                where = _bucket_of(kind, keys, buckets)
                rank = np.argsort(where, kind="stable")
                table = np.empty(len(keys), _GRAM)
                table["key"], table["n"] = keys[rank], counts[rank]
                bounds = np.concatenate(([0], np.cumsum(np.bincount(where, minlength=buckets))))
                for k in np.flatnonzero(np.diff(bounds)).tolist():
                    for column, value in zip(rows, (self.block, kind, k, table[bounds[k] : bounds[k + 1]].tobytes())):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int8(), pa.int32(), pa.binary()))], names=["block", "kind", "bucket", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        now: Block | None = None
        for whole in batches:
            for batch in slices(whole, 2, 2 << 20):
                blocks, unseen, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))
                at = 0
                while at < len(blocks):
                    stop = next((k for k in range(at, len(blocks)) if blocks[k] != blocks[at]), len(blocks))
                    if now and now.block != blocks[at]:
                        yield now.out()
                        now = None
                    now = now or Block(blocks[at])
                    now.add(texts[at:stop], unseen[at:stop])
                    at = stop
        if now:
            yield now.out()

    return run


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the windows' last three bytes: two bytes of context and the predicted one."""
    parts = []
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            grams = np.frombuffer(raw, _GRAM)
            grams = grams[grams["n"] > 0]
            parts.append(_tally(grams["key"] & np.uint64(0xFFFFFF), grams["n"]))
            if len(parts) > 200:
                parts = [_tally(*(np.concatenate(x) for x in zip(*parts)))]
    if parts:
        keys, n = _tally(*(np.concatenate(x) for x in zip(*parts)))
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["key", "n"])


class _Level:
    """Counts of the grams of one order over the distinct ``keys``, and of their contexts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, order: int) -> None:
        mask = np.uint64((1 << 8 * (order + 1)) - 1)
        self.grams, self.of_key = np.unique(keys & mask, return_inverse=True)
        self.n = np.bincount(self.of_key, weights=n, minlength=len(self.grams))
        contexts, self.context = np.unique(self.grams >> np.uint64(8), return_inverse=True)
        self.total = np.bincount(self.context, weights=self.n, minlength=len(contexts))
        self.kinds = np.bincount(self.context, weights=self.n > 0, minlength=len(contexts))


def log_probabilities(keys: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray], order: int = ORDER) -> np.ndarray:
    """log10 of the probability of each window's last byte after the bytes before it.

    ``keys`` hold every training window of their last three context bytes, with its count ``n``;
    ``short`` has all training counts of two context bytes and a predicted one.
    """
    out, open_ = np.zeros(len(keys)), np.ones(len(keys), bool)
    above: _Level | None = None
    for o in range(order, -1, -1):
        if o > 2:
            level = _Level(keys, n, o)
            seen, total, kinds = (x[level.of_key] for x in (level.n, level.total[level.context], level.kinds[level.context]))
        else:  # counts of all training windows, with zeros for the grams that only ``keys`` have
            asked = np.unique(keys & np.uint64(0xFFFFFF))
            level = _Level(np.concatenate((short[0], asked)), np.concatenate((short[1], np.zeros(len(asked), np.int64))), o)
            mine = np.searchsorted(level.grams, keys & np.uint64((1 << 8 * (o + 1)) - 1))
            seen, total, kinds = level.n[mine], level.total[level.context[mine]], level.kinds[level.context[mine]]
        if above is None:
            barred_n = barred_kinds = 0
        else:  # what the next longer context has seen
            lower = np.searchsorted(level.grams, above.grams & np.uint64((1 << 8 * (o + 1)) - 1))
            barred = np.bincount(above.context, weights=np.where(above.n > 0, level.n[lower], 0), minlength=len(above.total))
            at = above.context[above.of_key] if o >= 2 else above.context[np.searchsorted(above.grams, keys & np.uint64((1 << 8 * (o + 2)) - 1))]
            barred_n, barred_kinds = barred[at], above.kinds[at]
        left, fresh = total - barred_n, kinds - barred_kinds
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = open_ & (seen > 0)
            out[hit] += np.log10(((2 * seen - 1) / (2 * left))[hit])
            escape = open_ & ~hit & (fresh > 0)
            out[escape] += np.log10((fresh / (2 * left))[escape])
        open_ &= ~hit
        above = level
    if open_.any():
        out[open_] -= np.log10(256 - int(above.kinds.max(initial=0)))
    return out


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind, bucket, sums: of each share's rows, which come sorted, every window once."""

    def out(key: tuple, parts: list) -> pa.RecordBatch:
        keys, n = _tally(*(np.concatenate(x) for x in zip(*parts)))
        sums = np.empty(len(keys), _SUM)
        sums["key"], sums["n"] = keys, n
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int8()), pa.array([key[1]], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["kind", "bucket", "sums"])

    now, parts, held = None, [], 0
    for batch in batches:
        for *key, raw in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if now != key and parts:
                yield out(now, parts)
                parts, held = [], 0
            now, grams = key, np.frombuffer(raw, _GRAM)
            parts.append((grams["key"], grams["n"]))
            held += len(grams)
            if held > 4_000_000:
                parts = [_tally(*(np.concatenate(x) for x in zip(*parts)))]
                held = len(parts[0][0])
    if parts:
        yield out(now, parts)


def _solve(shared):
    """kind, bucket, keys and their log probabilities or counts, and the bucket's words and tokens, of each bucket's sums."""

    def out(key: tuple, parts: list) -> pa.RecordBatch:
        keys, n = _tally(*(np.concatenate(x) for x in zip(*parts)))
        windows_ = key[0] == _WINDOWS
        values = log_probabilities(keys, n, shared.value).astype(np.float32) if windows_ else n.astype(np.float64)
        columns = ([key[0]], pa.int8()), ([key[1]], pa.int32()), ([keys.tobytes()], pa.binary()), ([values.tobytes()], pa.binary()), ([0 if windows_ else int((n > 0).sum())], pa.int64()), ([0 if windows_ else int(n.sum())], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(*x) for x in columns], names=["kind", "bucket", "keys", "vals", "words", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for *key, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if now != key and parts:
                    yield out(now, parts)
                    parts = []
                now, sums = key, np.frombuffer(raw, _SUM)
                parts.append((sums["key"], sums["n"]))
                if sum(len(x) for x, _ in parts) > 8_000_000:
                    parts = [_tally(*(np.concatenate(x) for x in zip(*parts)))]
        if parts:
            yield out(now, parts)

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, kind, keys, vals: what each block asked for.  A share's rows come sorted: the bucket's answers, then its blocks'."""
    keys = values = None
    rows: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int8(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["block", "kind", "keys", "vals"])

    for batch in batches:
        for kind, block, raw, vals in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if vals is not None:
                keys, values = np.frombuffer(raw, np.uint64), np.frombuffer(vals, np.float32 if kind == _WINDOWS else np.float64)
                continue
            asked = np.frombuffer(raw, _GRAM)["key"]  # every key once, in order
            rows.append((block, kind, asked.tobytes(), values[np.searchsorted(keys, asked)].tobytes()))
            held += len(raw)
            if held > 8 << 20:
                yield out()
                rows, held = [], 0
    if rows:
        yield out()


class _Lookup:
    """Values of sorted distinct keys: most are found in one slot of a sparse table, the rest by bisection."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values.astype(np.float64)
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        slot = self._slot(keys)
        self.slot_keys, self.slot_values = np.full(1 << bits, ~np.uint64(0)), np.zeros(1 << bits)
        self.slot_keys[slot], self.slot_values[slot] = keys, self.values

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.slot_values[slot]
        rest = np.flatnonzero(self.slot_keys[slot] != keys)
        out[rest] = self.values[np.searchsorted(self.keys, keys[rest])]
        return out


def _score(vocabulary: int, tokens: int):
    """Scores of one block's documents from the answers to what it asked."""
    missing = np.log10(tokens + 0.5 * (vocabulary + 1))

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        forget()
        found: dict[int, list] = {_WINDOWS: [], _WORDS: []}
        for kind, keys, values in zip(*(answers.column(k).to_pylist() for k in ("kind", "keys", "vals"))):
            found[kind].append((np.frombuffer(keys, np.uint64), np.frombuffer(values, np.float32 if kind == _WINDOWS else np.float64)))
        tables = {}
        for kind, parts in found.items():
            if parts:
                keys, values = (np.concatenate(x) for x in zip(*parts))
                rank = np.argsort(keys)
                tables[kind] = keys[rank], values[rank]
        lookup = _Lookup(*tables[_WINDOWS])
        cost: dict[bytes, float] = {}
        unknown: set[bytes] = set()
        rows: list[tuple] = []
        for whole in docs.combine_chunks().to_batches():
            for batch in slices(whole, 3, 2 << 20):
                lists = [words_of(t) for t in text_bytes(batch.column(3))]
                fresh = list({w for x in lists for w in x if w not in cost} | {_END_WORD} - cost.keys())
                keys, values = tables[_WORDS]
                counts = values[np.searchsorted(keys, np.fromiter(map(_word_hash, fresh), np.uint64, len(fresh)))]
                cost.update(zip(fresh, np.log10(counts + 0.5).tolist()))
                unknown.update(w for w, c in zip(fresh, counts.tolist()) if not c)
                asked, n = windows([b" ".join(x) for x in lists])
                lengths = np.add.reduceat(lookup(asked), np.cumsum(n) - n)
                for doc, unseen, x, score in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), lists, lengths.tolist()):
                    x = [*x, _END_WORD]
                    known = len(x) - sum(map(unknown.__contains__, x))
                    rows.append((doc, unseen, len(x), known, tokens, sum(map(cost.__getitem__, x)) - len(x) * missing, score))
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scored(docs: DataFrame, *, block: Column | None = None, folds: int = 5, fold: int = 1, buckets: int | None = None, salts: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``score`` is the log10 probability of the words, lower-cased and joined by blanks, and the end;
    ``base_score`` that of the same words and end by smoothed word counts.  Single log probabilities are
    rounded to 32 bits: a score is exact to a part in 10^7.  ``block`` (a long) brings documents together
    that are scored together, some 30 MB each; rows read together are best.  Null text: the end alone.  A
    null doc_id hashes as empty text; repeated rows give a row each.  Without training rows all bytes and
    all words are equally likely.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    if block is None:
        block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, size >> 24)))
    if buckets is None:
        buckets = int(max(16, size // (12 << 20)))
    if salts is None:  # shares of some 64 blocks
        salts = int(max(1, size >> 30))
    rows = docs.select(block.cast("long").alias("block"), "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "text")
    asked = staged(rows.select("block", "held_out", "text").mapInArrow(_ask(buckets), "block long, kind byte, bucket int, grams binary"), "asked")
    short = asked.where(F.col("kind") == _WINDOWS).select("grams").mapInArrow(_short_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    table = short.orderBy("key").toPandas()  # at most 2^24 rows
    shared = spark.sparkContext.broadcast((table["key"].to_numpy(np.uint64), table["n"].to_numpy(np.int64)))
    shares = ["kind", "bucket", "salt"]
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    sums = salted.select(*shares, "grams").repartition(2 * buckets, *shares).sortWithinPartitions(*shares).mapInArrow(_combine, "kind byte, bucket int, sums binary")
    solved = sums.repartition(2 * buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_solve(shared), "kind byte, bucket int, keys binary, vals binary, words long, tokens long")
    solved = staged(solved, "solved")
    known = solved.agg(F.sum("words"), F.sum("tokens")).first()
    given = solved.select("kind", "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("turn"), F.lit(None).cast("long").alias("block"), "keys", "vals")
    wanted = salted.select(*shares, F.lit(1).alias("turn"), "block", F.col("grams").alias("keys"), F.lit(None).cast("binary").alias("vals"))
    both = given.unionByName(wanted).repartition(2 * buckets, *shares).sortWithinPartitions(*shares, "turn").select("kind", "block", "keys", "vals")
    answers = staged(both.mapInArrow(_answer, "block long, kind byte, keys binary, vals binary"), "answers")
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(known[0] or 0, known[1] or 0), out)


def file_blocks(docs: DataFrame, rows: int = 8192, block_bytes: int = 64 << 20) -> tuple[DataFrame, Column]:
    """``docs``, read from Parquet, with the block of each row: its file and its place in it, however files are split.

    Of a file's stretches of ``rows`` rows those of more than ``block_bytes`` are cut into as many blocks, by a count
    of their bytes; a document of that size is as large as its block.
    """
    found = docs.select("*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    stretch = F.floor(F.col("__row") / rows)
    sizes = found.groupBy("__file", stretch.alias("__stretch")).agg(F.sum(F.octet_length("text")).alias("bytes"))
    large = sizes.where(F.col("bytes") > block_bytes).select("__file", "__stretch", F.ceil(F.col("bytes") / block_bytes).alias("__parts"))
    cut = found.withColumn("__stretch", stretch).join(staged(large, "large-stretches"), ["__file", "__stretch"], "left")
    part = F.floor(F.col("__row") % rows * F.coalesce("__parts", F.lit(1)) / rows)
    return cut, F.xxhash64("__file", "__stretch", part)
