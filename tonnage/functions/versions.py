"""Versions of schemas and vocabularies: ``series/major.minor.patch``."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timezone

#: What this build writes.
CURRENT = {"schema": "canonical/1.1.0", "manifest": "manifest/0.1.0", "ontology": "ontology/1.0.0", "aliases": "ontology-alias/1.0.0"}


@dataclass(frozen=True, order=True)
class Version:
    series: str
    major: int
    minor: int
    patch: int

    @classmethod
    def parse(cls, text: str) -> Version:
        found = re.fullmatch(r"([a-z][a-z0-9-]*)/(\d+)\.(\d+)\.(\d+)", text)
        if not found:
            raise ValueError(f"{text!r} is no version")
        return cls(found[1], *(int(x) for x in found.groups()[1:]))

    def readable_by(self, reader: Version) -> bool:
        """Of one series and not newer in (major, minor); what columns really are is checked on reading."""
        return self.series == reader.series and (self.major, self.minor) <= (reader.major, reader.minor)

    def __str__(self) -> str:
        return f"{self.series}/{self.major}.{self.minor}.{self.patch}"


def as_utc(moment: datetime) -> datetime:
    """The instant in UTC; a time without a zone is refused."""
    if moment.tzinfo is None:
        raise ValueError(f"{moment} has no time zone")
    return moment.astimezone(timezone.utc)


def iso_utc(moment: datetime) -> str:
    return as_utc(moment).isoformat(timespec="microseconds").replace("+00:00", "Z")
