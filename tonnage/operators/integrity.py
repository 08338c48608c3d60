"""Order, digests, manifests and verification of canonical datasets."""

from __future__ import annotations

import hashlib
import json
import math
import platform
import subprocess
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone
from importlib import metadata
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonnage.functions.versions import CURRENT, Version
from tonnage.operators.rules import duplicate_excess
from tonnage.plans.schema import TABLES

#: Name of the content encoding, and the columns that describe a run and not its content.
ENCODING = "psd-canonical-content/2"
RUN_LOCAL = ("ingested_at",)
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
#: Forms of a table's digest: by shares, or serial as published digests are.
DIGESTS = ("tree", "serial")
_LEAVES = 4096
#: How tables are stored.
PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": "65536", "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}
_FILE_ROWS = 8_000_000


def in_order(df: DataFrame, order: list[str] | tuple[str, ...]) -> DataFrame:
    """Ascending total order, nulls last."""
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in order))


def require_total_order(order: tuple[str, ...], key: tuple[str, ...]) -> None:
    if not set(key) <= set(order):
        raise ValueError(f"order {order} does not hold the key {key}")


def _value(x) -> bytes:
    """One value with its type's letter; a number that is not finite has no encoding."""
    if x is None:
        return b"N;"
    if isinstance(x, bool):
        return b"B1;" if x else b"B0;"
    if isinstance(x, int):
        return b"I%d;" % x
    if isinstance(x, float):
        if not math.isfinite(x):
            raise ValueError(f"{x} cannot be encoded")
        return f"F{x.hex()};".encode()
    if isinstance(x, str):
        raw = x.encode()
        return b"S%d:%s;" % (len(raw), raw)
    if isinstance(x, (list, tuple)):
        return b"L%d;" % len(x) + b"".join(map(_value, x))
    raise TypeError(f"{type(x).__name__} cannot be encoded")


def _instant(micros: int | None) -> bytes:
    if micros is None:
        return b"N;"
    return b"T" + (_EPOCH + timedelta(microseconds=micros)).isoformat(timespec="microseconds").replace("+00:00", "Z").encode() + b";"


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = []
        for column in batch.columns:
            if pa.types.is_timestamp(column.type):
                columns.append(map(_instant, column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64()).to_pylist()))
            else:
                columns.append(map(_value, column.to_pylist()))
        rows = [b"".join(row) for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["row"])


def content_digest(df: DataFrame, table: str, order: list[str] | tuple[str, ...]) -> str:
    """SHA-256 over a header and the rows in order.

    Rows are encoded in parallel, in the globally ordered partitions; only the digest itself, which is
    serial by its definition, runs on the driver, a partition at a time.
    """
    names = [c for c in df.columns if c not in RUN_LOCAL]
    dropped = [c for c in df.columns if c in RUN_LOCAL]
    rows = in_order(df, order).select(*names).mapInArrow(_encoded, "row binary").persist()
    try:
        digest = hashlib.sha256(f"{ENCODING}\ntable:{table}\ncolumns:{','.join(names)}\nexcluded:{','.join(dropped)}\nrows:{rows.count()}\n".encode())
        for row in rows.toLocalIterator():
            digest.update(row["row"])
        return digest.hexdigest()
    finally:
        rows.unpersist()


def tree_digest(df: DataFrame, table: str, order: list[str] | tuple[str, ...], key: list[str] | tuple[str, ...]) -> str:
    """SHA-256 over a header and the digests of ``_LEAVES`` shares of the rows, which are dealt by ``key`` and each in order.

    It says the same of the rows as :func:`content_digest` and has another value: shares are digested where they
    lie, so nothing but their digests comes to the driver.  Neither partitions nor files change it.
    """
    names = [c for c in df.columns if c not in RUN_LOCAL]
    leaf = F.pmod(F.xxhash64(*key), F.lit(_LEAVES)).cast("int")
    dealt = df.withColumn("__leaf", leaf).repartition("__leaf").sortWithinPartitions("__leaf", *(F.col(c).asc_nulls_last() for c in order))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n = None, hashlib.sha256(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([n], pa.int64()), pa.array([held.hexdigest()])], names=["leaf", "n", "digest"])

        for batch in batches:
            leaves = batch.column(0).to_pylist()
            for encoded in _encoded([batch.select(batch.schema.names[1:])]):
                for leaf, row in zip(leaves, encoded.column(0).to_pylist()):
                    if leaf != now:
                        if now is not None:
                            yield out()
                        now, held, n = leaf, hashlib.sha256(), 0
                    held.update(row)
                    n += 1
        if now is not None:
            yield out()

    found = dealt.select("__leaf", *names).mapInArrow(digest, "leaf int, n long, digest string").orderBy("leaf").collect()
    head = f"{ENCODING}/tree\ntable:{table}\ncolumns:{','.join(names)}\nrows:{sum(r['n'] for r in found)}\n"
    return hashlib.sha256((head + "".join(f"{r['leaf']}:{r['digest']}\n" for r in found)).encode()).hexdigest()


def _digest(df: DataFrame, spec, form: str | None) -> str | None:
    if form is None:
        return None
    if form not in DIGESTS:
        raise ValueError(f"{form} is none of {DIGESTS}")
    return tree_digest(df, spec.name, spec.order, spec.primary_key) if form == "tree" else content_digest(df, spec.name, spec.order)


def parallel_digest(df: DataFrame) -> str:
    """An order-free digest of all rows by commutative sums: an extension, not the content digest."""
    h = F.xxhash64(*(F.col(c) for c in df.columns if c not in RUN_LOCAL))
    n, total, mixed = df.agg(F.count("*"), F.sum(F.shiftrightunsigned(h, 24).cast("decimal(38,0)")), F.bit_xor(h)).first()
    return hashlib.sha256(f"{n}:{total}:{mixed}".encode()).hexdigest()


@dataclass
class Manifest:
    """What a dataset directory holds, as deterministic JSON."""

    dataset_id: str
    artifacts: dict[str, dict] = field(default_factory=dict)
    sources: list[dict] = field(default_factory=list)
    lineage: list[dict] = field(default_factory=list)
    parent_digest: str | None = None
    environment: dict = field(default_factory=dict)
    versions: dict = field(default_factory=lambda: dict(CURRENT))

    def to_json(self) -> bytes:
        return (json.dumps(asdict(self), indent=2, sort_keys=True, ensure_ascii=False) + "\n").encode()

    def digest(self) -> str:
        """Of everything but the environment, which tells runs apart and not datasets."""
        content = {k: v for k, v in asdict(self).items() if k != "environment"}
        return hashlib.sha256(json.dumps(content, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def environment(root: str = ".") -> dict:
    """Python, its packages that compute, platform and the commit that runs, if there is one, and whether files differ from it."""

    def git(*arguments: str) -> str | None:
        got = subprocess.run(["git", "-C", root, *arguments], capture_output=True, text=True, check=False)
        return got.stdout.strip() if got.returncode == 0 else None

    commit = git("rev-parse", "HEAD")
    packages = {}
    for name in ("pyspark", "pyarrow", "pandas", "numpy"):
        try:
            packages[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            packages[name] = None
    return {"python": platform.python_version(), "platform": platform.platform(), "packages": packages, "commit": commit, "changed": bool(git("status", "--porcelain")) if commit else None}


def located(folder: str | Path, *parts: str) -> str:
    """A URI that every machine reads the same; a plain path is one of this machine's."""
    text = str(folder)
    return "/".join((text if "://" in text else f"file://{Path(text).absolute()}", *parts))


def _file_system(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def write_bytes(spark: SparkSession, uri: str, content: bytes) -> None:
    fs, path = _file_system(spark, uri)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def read_text(spark: SparkSession, uri: str) -> str:
    fs, path = _file_system(spark, uri)
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _file_system(spark, uri)
    return fs.exists(path)


def _files(spark: SparkSession, where: str) -> dict[str, str]:
    """SHA-256 of each data file, computed where the files are read."""
    if not exists(spark, where):
        return {}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(where)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("digest"))
    return {r["name"]: r["digest"] for r in named.orderBy("name").collect()}


def write_dataset(tables: dict[str, DataFrame], folder: str | Path, dataset_id: str, *, digests: str | None = "tree", parent_digest: str | None = None, specs: dict | None = None, **more) -> Manifest:
    """Parquet per table, in its declared order, with a manifest beside it.  Unknown tables and other schemas are refused.

    ``digests`` is the form of the tables' digests; ``serial`` ones equal published digests and pass through the driver.
    """
    specs = TABLES if specs is None else specs
    manifest = Manifest(dataset_id, parent_digest=parent_digest, environment=environment(), **more)
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        spec = specs[name]
        if [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in spec.schema]:
            raise ValueError(f"{name} does not have the canonical columns")
        require_total_order(spec.order, spec.primary_key)
        where = located(folder, "tables", f"{name}.parquet")
        # a range of the order per file, sorted inside: files by name are the total order
        in_order(df, spec.order).write.mode("overwrite").options(**PARQUET, maxRecordsPerFile=_FILE_ROWS).parquet(where)
        written = spark.read.schema(spec.schema).parquet(where)
        manifest.artifacts[name] = {"rows": written.count(), "content_digest": _digest(written, spec, digests), "digest_form": digests, "files": _files(spark, where)}
    write_bytes(spark, located(folder, "manifest.json"), manifest.to_json())
    return manifest


def read_manifest(spark: SparkSession, folder: str | Path) -> Manifest:
    return Manifest(**json.loads(read_text(spark, located(folder, "manifest.json"))))


def require_readable(spark: SparkSession, folder: str | Path, *, specs: dict | None = None) -> Manifest:
    """The manifest, if this build reads its versions and every table's files have exactly the canonical columns and types."""
    specs, manifest = TABLES if specs is None else specs, read_manifest(spark, folder)
    for name, version in manifest.versions.items():
        if name not in CURRENT or not Version.parse(version).readable_by(Version.parse(CURRENT[name])):
            raise ValueError(f"{folder} is of {version}, which this build does not read")
    for name in manifest.artifacts:
        if name not in specs:
            raise ValueError(f"{folder} has an unknown table {name}")
        there = spark.read.parquet(located(folder, "tables", f"{name}.parquet")).schema
        if [(f.name, f.dataType) for f in there] != [(f.name, f.dataType) for f in specs[name].schema]:
            raise ValueError(f"{name} in {folder} does not have the canonical columns")
    return manifest


def read_dataset(spark: SparkSession, folder: str | Path, *, specs: dict | None = None, check: bool = False) -> dict[str, DataFrame]:
    """All tables of the model; those that the dataset does not have are empty.  ``check`` refuses other versions and schemas."""
    specs = TABLES if specs is None else specs
    there = (require_readable(spark, folder, specs=specs) if check else read_manifest(spark, folder)).artifacts
    return {n: spark.read.schema(s.schema).parquet(located(folder, "tables", f"{n}.parquet")) if n in there else spark.createDataFrame([], s.schema) for n, s in specs.items()}


def read_derived(spark: SparkSession, folder: str | Path, specs: dict, parent: Manifest | None = None) -> dict[str, DataFrame]:
    """The tables of a derived dataset, if they are what its manifest says and it was made from ``parent``."""
    manifest = read_manifest(spark, folder)
    if parent is not None and manifest.parent_digest != parent.digest():
        raise ValueError(f"{folder} was not made from this dataset")
    if problems := verify_dataset(spark, folder, specs=specs):
        raise ValueError("; ".join(problems))
    return {n: in_order(df, specs[n].order) for n, df in read_dataset(spark, folder, specs=specs).items()}


def register_views(spark: SparkSession, folder: str | Path) -> list[str]:
    """The dataset's tables as views for ``spark.sql``; a missing or unreadable one is an error."""
    tables = read_dataset(spark, folder)
    names = sorted(read_manifest(spark, folder).artifacts)
    for n in names:
        if not exists(spark, located(folder, "tables", f"{n}.parquet")):
            raise FileNotFoundError(f"{n} is in the manifest and not in {folder}")
        tables[n].createOrReplaceTempView(n)
    return names


def load_records(spark: SparkSession, folder: str | Path, required: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Tables from ``<table>.json`` arrays; a required one that is missing is an error, as is a malformed one."""
    found = {}
    for name, spec in TABLES.items():
        path = located(folder, f"{name}.json")
        if exists(spark, path):
            found[name] = spark.read.schema(spec.schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
        elif name in required:
            raise ValueError(f"{path} is missing")
        else:
            found[name] = spark.createDataFrame([], spec.schema)
    return found


def verify_dataset(spark: SparkSession, folder: str | Path, *, specs: dict | None = None) -> list[str]:
    """Problems of a dataset: files, rows, contents and keys that are not what the manifest says.  None: it is sound."""
    specs = TABLES if specs is None else specs
    manifest = read_manifest(spark, folder)
    tables, problems = read_dataset(spark, folder, specs=specs), []
    unknown = sorted(set(manifest.artifacts) - set(specs))
    problems += [f"{n}: unknown table" for n in unknown]
    for name, said in manifest.artifacts.items():
        if name in unknown:
            continue
        spec = specs[name]
        where = located(folder, "tables", f"{name}.parquet")
        there = _files(spark, where)
        if not there:
            problems.append(f"{name}: no files")
            continue
        if [(f.name, f.dataType) for f in spark.read.parquet(where).schema] != [(f.name, f.dataType) for f in spec.schema]:
            problems.append(f"{name}: the files have other columns")
        if there != said["files"]:
            problems.append(f"{name}: files differ")
        if tables[name].count() != said["rows"]:
            problems.append(f"{name}: rows differ")
        if said["content_digest"] and _digest(tables[name], spec, said.get("digest_form") or "serial") != said["content_digest"]:
            problems.append(f"{name}: content differs")
        if excess := duplicate_excess(tables[name], list(spec.primary_key)).first()[0]:
            problems.append(f"{name}: {excess} rows repeat a key")
    return problems


def same_content(spark: SparkSession, a: str | Path, b: str | Path) -> bool:
    """Whether two builds hold the same artifacts, whatever their runs."""
    x, y = (read_manifest(spark, f).artifacts for f in (a, b))
    return {n: (v["rows"], v["content_digest"]) for n, v in x.items()} == {n: (v["rows"], v["content_digest"]) for n, v in y.items()}
