"""Records (plain dicts) and canonical tables: checked on the way in, complete on the way out.

A record holds the fields of its table and no others; what it leaves out is null.  It must have its key,
types that fit without guessing, members of its vocabularies, and keep its table's contracts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonnage.functions.versions import as_utc
from tonnage.operators import validation
from tonnage.operators.integrity import exists, in_order, load_records, located
from tonnage.plans.schema import TABLES

#: Issues that an error message lists.
_SHOWN = 20
#: When something was meant to happen, happened, was measured, was written down, was changed, was read.
TEMPORAL = ("scheduled_at", "performed_at", "observed_at", "created_at", "modified_at", "ingested_at")


class RecordError(ValueError):
    """A record is not one of its table."""


def _cast(kind: T.DataType, x: object) -> object:
    """``x`` as a value of ``kind``; a ValueError if it is none."""
    if x is None:
        return None
    if isinstance(kind, T.TimestampType):
        return as_utc(datetime.fromisoformat(x) if isinstance(x, str) else x)
    if isinstance(kind, T.ArrayType):
        if not isinstance(x, (list, tuple)) or not all(isinstance(y, str) for y in x):
            raise ValueError(f"{x!r} is no list of text")
        return list(x)
    if isinstance(kind, T.DoubleType):
        if isinstance(x, bool) or not isinstance(x, (int, float)) or not math.isfinite(x):
            raise ValueError(f"{x!r} is no finite number")
        return float(x)
    wanted = {T.StringType: str, T.LongType: int, T.BooleanType: bool}[type(kind)]
    if not isinstance(x, wanted) or (wanted is int and isinstance(x, bool)):
        raise ValueError(f"{x!r} is no {wanted.__name__}")
    return x


def checked(table: str, records: Iterable[Mapping[str, object]]) -> list[tuple]:
    """The records as rows of ``table``, in its columns' order; a RecordError that lists what is wrong with them."""
    spec, problems, rows = TABLES[table], [], []
    fields, members = {f.name: f.dataType for f in spec.schema}, spec.vocabularies
    for n, record in enumerate(records):
        said = len(problems)
        problems += [f"record {n}: {table} has no field {k}" for k in record if k not in fields]
        problems += [f"record {n}: {k} is missing" for k in spec.primary_key if record.get(k) is None]
        row = []
        for name, kind in fields.items():
            try:
                value = _cast(kind, record.get(name))
            except (ValueError, AttributeError, TypeError) as e:
                problems.append(f"record {n}: {name}: {e}")
                continue
            for x in value if isinstance(value, list) else [value]:
                if x is not None and name in members and x not in members[name]:
                    problems.append(f"record {n}: {name}: {x!r} is no member of its vocabulary")
            row.append(value)
        if len(problems) == said:
            rows.append(tuple(row))
    if problems:
        raise RecordError("; ".join(problems[:_SHOWN]) + (f"; and {len(problems) - _SHOWN} more" if len(problems) > _SHOWN else ""))
    return rows


def to_table(spark: SparkSession, table: str, records: Iterable[Mapping[str, object]]) -> DataFrame:
    """``records`` of one table, with its columns and types."""
    return require(table, spark.createDataFrame(checked(table, records), TABLES[table].schema))


def to_tables(spark: SparkSession, records: Mapping[str, Iterable[Mapping[str, object]]]) -> dict[str, DataFrame]:
    """Every table of the model from records by table; a table without any is empty."""
    if unknown := sorted(set(records) - set(TABLES)):
        raise RecordError(f"no tables: {', '.join(unknown)}")
    return {n: to_table(spark, n, records[n]) if n in records else spark.createDataFrame([], s.schema) for n, s in TABLES.items()}


def require(table: str, df: DataFrame) -> DataFrame:
    """``df``, if its columns are those of ``table`` and its rows keep column rules and contracts; one pass each, first issues only."""
    d = {table: df}
    found = reduce(DataFrame.unionByName, (validation.column_issues(d), validation.contract_issues(d)))
    if broken := found.where(F.col("severity") == validation.ERROR).limit(_SHOWN).collect():
        raise RecordError("; ".join(f"{r['record_id']}: {r['code']} {r['message']}" for r in broken))
    return df


def rows_of(df: DataFrame, table: str) -> Iterator[dict[str, object]]:
    """Rows of a table in its order, as they come to the driver a partition at a time; times in UTC."""
    spec = TABLES[table]
    micros = [f.name for f in spec.schema if isinstance(f.dataType, T.TimestampType)]
    shown = in_order(df, spec.order).select(*(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias(c) if c in micros else F.col(c) for c in spec.columns))
    for row in shown.toLocalIterator():
        found = row.asDict()
        yield found | {c: datetime.fromisoformat(found[c]) for c in micros if found[c] is not None}


def records_of(df: DataFrame, table: str) -> Iterator[dict[str, object]]:
    """Records of a table in its order, checked again, without the fields that are null."""
    for row in rows_of(require(table, df), table):
        checked(table, [row])
        yield {k: v for k, v in row.items() if v is not None}


def load(spark: SparkSession, folder: str, required: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Tables from ``<table>.json`` arrays of records, all of them checked."""
    return {n: require(n, df) if exists(spark, located(folder, f"{n}.json")) else df for n, df in load_records(spark, folder, required).items()}


def as_known(df: DataFrame, moment: datetime) -> DataFrame:
    """The rows that could be known at ``moment``: nothing they state of themselves is later.

    A row is known from when it was written down and, once changed, in that form only from the change on; what
    happened or was measured later cannot have been known.  A plan for later can: ``scheduled_at`` does not
    count, nor does ``ingested_at``, which is about this system.  A time that is not stated bars nothing.
    """
    late = F.lit(as_utc(moment)).cast("timestamp")
    for name in TEMPORAL:
        if name in df.columns and name not in ("scheduled_at", "ingested_at"):
            df = df.where(F.col(name).isNull() | (F.col(name) <= late))
    return df
