"""Deterministic identifiers: a tag and the start of a digest over length-prefixed parts."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scheme, separator and tags of identifiers.
SCHEME = "psd-ids-v1"
SEPARATOR = "\x1f"
TAGS = {
    "athlete": "ath", "athlete_source_link": "aslk", "body_measurement": "bms", "equipment_state": "eqs", "source": "src", "provenance": "prv",
    "exercise": "exd", "exercise_alias": "exa", "exercise_normalization": "exn", "program": "prg", "program_version": "pver", "program_modification": "pmod",
    "planned_session": "plses", "planned_exercise": "plex", "planned_set": "plset", "performed_session": "pses", "performed_exercise": "pex", "performed_set": "pset",
    "performed_rep": "prep", "observation": "obs", "performance_test": "ptest", "velocity_observation": "vel", "competition": "cmp", "competition_meet": "cmeet",
    "competition_attempt": "catt", "competition_reported_result": "cres",
}
VALID = r"^[a-z]{2,8}_[0-9a-f]{32}$"


def text_part(c: Column | str) -> Column:
    """``s<length>:<text>``; null stays null (``format_string`` would print it)."""
    c = F.lit(c) if isinstance(c, str) else c
    return F.concat(F.lit("s"), F.length(c).cast("string"), F.lit(":"), c)


def int_part(c: Column) -> Column:
    return F.concat(F.lit("i"), c.cast("string"))


def make_id(kind: str, *parts: Column) -> Column:
    """The identifier of ``parts``; null if any of them is."""
    tag = TAGS[kind]
    keyed = [x for p in parts for x in (F.lit(SEPARATOR), p)][1:]
    text = F.concat(F.lit(SEPARATOR.join((SCHEME, tag, ""))), *keyed)
    return F.concat(F.lit(f"{tag}_"), F.substring(F.sha2(text, 256), 1, 32))


def plain_id(kind: str, *parts: str | int | None) -> str:
    """:func:`make_id` of plain values, on the driver."""
    keyed = ("n" if p is None else f"i{p}" if isinstance(p, int) else f"s{len(p)}:{p}" for p in parts)
    text = SEPARATOR.join((SCHEME, TAGS[kind], SEPARATOR.join(keyed)))
    return f"{TAGS[kind]}_{hashlib.sha256(text.encode()).hexdigest()[:32]}"


def is_valid(c: Column) -> Column:
    return c.rlike(VALID)


def share(c: Column, n: int = 16) -> Column:
    """The share of ``n`` (16 at most) that an identifier falls in, by its first hexadecimal digit."""
    if not 1 <= n <= 16:
        raise ValueError(f"{n} shares of 16 digits")
    digit = F.conv(F.substring_index(c, "_", -1).substr(1, 1), 16, 10).cast("int")
    return F.floor(digit * n / 16).cast("int")
