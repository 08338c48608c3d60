"""Masses in kilograms and lengths in centimetres; an unknown unit is an error, not a guess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units and their factors.
MASS = {"kg": 1.0, "lb": 0.45359237}
LENGTH = {"cm": 1.0, "in": 2.54, "m": 100.0}


def _normalized(value: Column, unit: Column, factors: dict[str, float], strict: bool) -> Column:
    name = F.lower(F.trim(unit))
    out = F.when(value.isNull() | unit.isNull(), F.lit(None).cast("double"))
    for known, factor in factors.items():
        out = out.when(name == known, value * factor)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown unit "), unit)).cast("double")) if strict else out


def kilograms(value: Column, unit: Column, strict: bool = True) -> Column:
    return _normalized(value, unit, MASS, strict)


def centimetres(value: Column, unit: Column, strict: bool = True) -> Column:
    return _normalized(value, unit, LENGTH, strict)
