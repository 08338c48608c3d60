"""Token-id files: frequency-ranked ids, byte-aligned variable-length coding, separate control bytes.

A corpus is encoded once with a public tokenizer; ids are re-numbered by descending corpus frequency,
so that most ranks fit in one byte.  A rank takes one to four data bytes; its length minus one takes
two bits of a control byte (four ranks each), kept apart from the data bytes.  Control bytes are
turned into lengths by one numpy table lookup, lengths into offsets by a running sum.

A file is a run of blocks, each followed by a line feed: ``TNB1``, four little-endian 64-bit counts
(documents, ids, control bytes, data bytes), the documents' ids (64-bit), null flags (bytes) and
lengths (unsigned 32-bit), then control and data bytes.  ``dictionary`` beside the files maps ranks to
ids.  Files are in ascending document order by name; Spark's own writer stores them, so that a
task run again on another machine leaves no half-written file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonnage.llm.common import discard, forget, remembered, scratch, slices, staged, text_bytes
from tonnage.llm.tokens import ChunkEncoder

_MAGIC = b"TNB1"
#: Lengths of the four ranks that a control byte describes.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)


def encoder(path: str) -> ChunkEncoder:
    return remembered(("encoder", path), lambda: ChunkEncoder(path))


#: ``ids``: little-endian unsigned, all of one width.  A row with ``counts`` (64-bit, by id) is no document: it has the
#: counts of those before it, so that the ids need not be read to rank them.
TOKENS = "doc_id long, n_tokens long, ids binary, counts binary"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, text_column: str = "text") -> DataFrame:
    """The ids of every row as ``TOKENS``; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        end = np.array([end_id], model.kind).tobytes()
        total, names = np.zeros(max(len(model.ends_word), end_id + 1), np.int64), ["doc_id", "n_tokens", "ids", "counts"]
        for whole in batches:
            for batch in slices(whole, 1, 8 << 20):
                ids = [x + end for x in model.encode([x or b"" for x in text_bytes(batch.column(1))])]
                total += np.bincount(np.frombuffer(b"".join(ids), model.kind), minlength=len(total))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // model.width for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([None], pa.binary()), pa.array([total.tobytes()], pa.binary())], names=names)

    return docs.select("doc_id", text_column).mapInArrow(run, TOKENS)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ``ranks``."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[: len(ranks)] = extra
    control = (quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        ranks[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def _block(ids: list[int | None], lengths: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack_ranks(ranks)
    head = np.array([len(ids), len(ranks), len(control), len(data)], "<i8").tobytes()
    keys = np.array([x or 0 for x in ids], "<i8").tobytes() + np.array([x is None for x in ids], np.uint8).tobytes()
    return b"".join((_MAGIC, head, keys, np.array(lengths, "<u4").tobytes(), control, data))


def blocks(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, lengths, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        if content[at : at + 4] != _MAGIC:
            raise ValueError(f"no block at byte {at}")
        docs, n, n_control, n_data = np.frombuffer(content, "<i8", 4, at + 4).tolist()
        at += 36
        keys = np.frombuffer(content, "<i8", docs, at).tolist()
        nulls = np.frombuffer(content, np.uint8, docs, at + 8 * docs).tolist()
        lengths = np.frombuffer(content, "<u4", docs, at + 9 * docs)
        at += 13 * docs
        ranks = unpack_ranks(content[at : at + n_control], content[at + n_control : at + n_control + n_data], n)
        yield [None if z else k for k, z in zip(keys, nulls)], lengths, ranks
        at += n_control + n_data + 1


def write_token_files(tokens: DataFrame, path: str, vocabulary: int = 1 << 17, block_ids: int = 1 << 20, file_ids: int = 1 << 23) -> None:
    """Writes ``tokens`` (as ``TOKENS``) below ``path``.

    The rank table goes to every task; it has a row for each id of the tokenizer, ``vocabulary`` at
    most, whatever the size of the corpus.
    """
    spark = tokens.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                part = np.frombuffer(raw, np.int64)
                total[: len(part)] += part
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    counts = tokens.where("counts is not null").select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), "id").collect()
    if len(found) > vocabulary:
        raise ValueError("more ids than the vocabulary allows")
    ids = [r["id"] for r in found]
    spark.createDataFrame(list(enumerate(ids)), "rank long, id long").coalesce(1).write.parquet(f"{path}/dictionary")
    ranks = np.zeros(vocabulary, np.uint32)
    ranks[np.array(ids, np.int64)] = np.arange(len(ids))
    shared = spark.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, keys, lengths, raws, held = shared.value, [], [], [], 0
        forget()  # a worker that has tokenized is used again

        def out() -> pa.RecordBatch:
            raw = b"".join(raws)
            block = _block(keys, lengths, rank[np.frombuffer(raw, f"<u{len(raw) // held if held else 2}")])
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

        for batch in batches:
            for key, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and held + n > block_ids:
                    yield out()
                    keys, lengths, raws, held = [], [], [], 0
                keys.append(key)
                lengths.append(n)
                raws.append(raw)
                held += n
        if keys:
            yield out()

    tokens = tokens.where("counts is null").drop("counts")
    total = sum(r["n"] for r in found)
    order = ["doc_id", "n_tokens", F.crc32("ids")]  # so that one repeated doc_id does not fill a partition
    parts = tokens.repartitionByRange(int(min(20_000, max(1, -(-total // file_ids)))), *order).sortWithinPartitions(*order)
    packed = parts.select("doc_id", "n_tokens", "ids").mapInArrow(encode, "block binary")
    packed.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", max(1, file_ids // block_ids)).text(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """path, doc_id, start (in its file), n_tokens, ids_crc32 and, if wanted, ids (32-bit) of each document below ``path``."""
    table = spark.read.parquet(f"{path}/dictionary").orderBy("rank").collect()
    shared = spark.sparkContext.broadcast(np.array([r["id"] for r in table], "<u4"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        forget()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before = 0
                for keys, lengths, ranks in blocks(content):
                    raw, ends = ids[ranks].tobytes(), np.cumsum(lengths, dtype=np.int64)
                    starts = ends - lengths
                    texts = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                    crcs = pa.array([zlib.crc32(x) for x in texts], pa.int64())
                    shown = pa.array(texts, pa.binary()) if with_ids else pa.nulls(len(texts), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(keys)), pa.array(keys, pa.int64()), pa.array(starts + before, pa.int64()), pa.array(lengths.astype(np.int64)), crcs, shown], names=["path", "doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                    before += int(lengths.sum())

    files = spark.read.format("binaryFile").load(f"{path}/blocks").where(F.col("length") > 0).select("path", "content")
    return files.mapInArrow(decode, "path string, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def with_starts(rows: DataFrame) -> DataFrame:
    """``start`` within its file becomes the number of ids before the document in all files (one row a file is summed)."""
    sums = rows.groupBy("path").agg(F.sum("n_tokens").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select("path", before.alias("base"))
    return rows.join(base, "path").withColumn("start", F.col("start") + F.col("base")).drop("path", "base")


def token_file_index(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Encodes every text, writes the files, reads them back: doc_id, start, n_tokens, ids_crc32.

    Null text: the end id alone.  Null doc_id: before all others.  Repeated doc_ids: one row each, in
    order of length, then checksum.  An empty table gives no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    held = scratch(spark, "token-ids")
    tokenized(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(held)
    path = scratch(spark, "token-files")
    write_token_files(spark.read.schema(TOKENS).parquet(held), path)
    discard(spark, held)
    rows = read_token_files(spark, path, with_ids=False).drop("ids")
    return with_starts(staged(rows, "token-index")).select("doc_id", "start", "n_tokens", "ids_crc32")
