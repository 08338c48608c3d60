"""Aggregates that Spark has in another form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_distinct_of_few(c: Column | str) -> Column:
    """Exact number of different non-null values where a group has few of them, such as one athlete's events.

    Several ``countDistinct`` in one aggregate copy every row once for each; sets are built in one pass.
    Groups of unbounded variety need ``countDistinct``, which spreads a group's values over tasks.
    """
    return F.size(F.collect_set(c)).cast("long")
