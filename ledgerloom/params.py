"""Parameters of time-dependent and configurable queries. No query reads the clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from . import reference_data as ref


@dataclass(frozen=True)
class AsOf:
    """The moment a report describes: a business date, a UTC instant and the site's zone."""

    date: dt.date
    ts: dt.datetime | None = None
    tz: str = ref.SITE_TIME_ZONE

    @classmethod
    def now(cls, tz: str = ref.SITE_TIME_ZONE) -> "AsOf":
        from zoneinfo import ZoneInfo

        instant = dt.datetime.now(dt.timezone.utc)
        return cls(instant.astimezone(ZoneInfo(tz)).date(), instant.replace(tzinfo=None), tz)


@dataclass(frozen=True)
class BreakRule:
    """Which gaps between two sessions count as a break, in seconds, both ends included."""

    shortest: int | None = 20 * 60
    longest: int | None = 2 * 60 * 60

    @classmethod
    def every_gap(cls) -> "BreakRule":
        return cls(shortest=None, longest=None)


@dataclass(frozen=True)
class SearchPreset:
    max_terms: int
    max_mailboxes: int
    days_back: int
    per_term: int

    @property
    def has_date_floor(self) -> bool:
        return self.days_back < 365


# Search depth by mode.
SEARCH_PRESETS = {
    "FAST": SearchPreset(max_terms=3, max_mailboxes=5, days_back=30, per_term=10),
    "NORMAL": SearchPreset(max_terms=5, max_mailboxes=15, days_back=90, per_term=15),
    "DEEP": SearchPreset(max_terms=10, max_mailboxes=50, days_back=365, per_term=25),
}
