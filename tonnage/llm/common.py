"""What the text operators share: tables, shared scratch space, byte-level text access."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z, other bytes as they are.
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB: long documents must not add up in a Python worker.

    Results are lazy, so the setting has to outlast the call: it stays in the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share.

    The cluster names that folder in ``spark.checkpoint.dir``; only where it is unset (tests on
    one machine) a temporary folder is made and recorded in the session.  On a cluster that names none this is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tonnage-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors."""
    return _staged_at(df, scratch(df.sparkSession, label))


def _staged_at(df: DataFrame, path: str) -> DataFrame:
    # nothing reads the write's shuffles again: without this they fill the disks until the driver collects garbage
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path that no later plan reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def offsets_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of ``parts`` in their concatenation."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.cumsum(lengths) - lengths, lengths


def slices(batch: pa.RecordBatch, size_of: int, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` bytes of column ``size_of``; a larger row is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(size_of)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


_HELD: dict = {}


def remembered(key, build):
    """``build()`` once per Python worker and key; a worker holds one such value at a time."""
    _collect_seldom()
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def forget() -> None:
    """Drops what this Python worker has kept for another operator."""
    _collect_seldom()
    _HELD.clear()


def _collect_seldom() -> None:
    """Batches make millions of small objects and no cycles: looking for cycles took a fifth of the time."""
    gc.set_threshold(1_000_000, 50, 1000)


def id_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """crc32 of the id's text modulo ``folds`` equals ``fold``; a null id counts as empty text."""
    return F.crc32(F.encode(id_text(doc_id), "UTF-8")) % folds == fold
