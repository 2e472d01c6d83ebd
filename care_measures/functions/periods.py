"""Reporting periods. All clocks hang off an explicit ``as_of`` date."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta


def add_months(d: date, months: int) -> date:
    """Shift by whole months, clamping the day to the length of the target month."""
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    return date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


@dataclass(frozen=True)
class Period:
    """Inclusive range of days reported on, and the day the report is run."""

    start: date
    end: date
    as_of: date

    @classmethod
    def previous_month(cls, as_of: date) -> "Period":
        first = as_of.replace(day=1)
        return cls(add_months(first, -1), first - timedelta(days=1), as_of)

    def lookback(self, *, years: int = 0, months: int = 0, anchor: str = "start") -> date:
        """First day of a window reaching back from the period's ``start`` or ``end``."""
        if anchor not in ("start", "end"):
            raise ValueError(f"anchor must be 'start' or 'end', not {anchor!r}")
        return add_months(getattr(self, anchor), -(12 * years + months))

    def year_start(self) -> date:
        return self.end.replace(month=1, day=1)

    def prior_month(self, *, end: str = "calendar") -> "Period":
        """The month before the period.

        ``end="clamped"`` shifts the period's last day by one month instead of taking the
        calendar month end, so a period ending on 28 February gives 28 January.
        """
        last = self.start - timedelta(days=1) if end == "calendar" else add_months(self.end, -1)
        return Period(add_months(self.start, -1), last, self.as_of)
