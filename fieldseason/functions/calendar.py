"""Calendar windows inside a year, and the day expressions built from them.

A window is data: a key and two inclusive month-day bounds, written month * 100 +
day. A window whose first bound is after its last one wraps over the year's end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class CalendarWindow:
    key: str
    first: int
    last: int

    def holds(self, mmdd: int) -> bool:
        if self.first <= self.last:
            return self.first <= mmdd <= self.last
        return mmdd >= self.first or mmdd <= self.last

    def contains(self, mmdd: str) -> str:
        if self.first <= self.last:
            return f"{mmdd} between {self.first} and {self.last}"
        return f"({mmdd} >= {self.first} or {mmdd} <= {self.last})"


# Window bounds.
GROWING_SEASON = CalendarWindow("all", 401, 1130)

PHASES = (
    CalendarWindow("cornPlanting", 420, 515),
    CalendarWindow("cornGrowing", 501, 930),
    CalendarWindow("cornHarvest", 901, 1031),
    CalendarWindow("soybeanPlanting", 501, 610),
    CalendarWindow("soybeanGrowing", 501, 1031),
    CalendarWindow("soybeanHarvest", 920, 1031),
    CalendarWindow("wheatPlanting", 920, 1031),
    CalendarWindow("wheatGrowing", 920, 630),
    CalendarWindow("wheatHarvest", 601, 710),
)

MONTHS = tuple(
    CalendarWindow(key, number * 100 + 1, number * 100 + days)
    for number, (key, days) in enumerate(
        [("jan", 31), ("feb", 29), ("mar", 31), ("apr", 30), ("may", 31), ("jun", 30),
         ("jul", 31), ("aug", 31), ("sep", 30), ("oct", 31), ("nov", 30), ("dec", 31)],
        start=1,
    )
)

WINDOWS = (GROWING_SEASON, *PHASES, *MONTHS)

# Astronomical seasons; the rest of the year is winter.
ASTRONOMICAL = (
    CalendarWindow("Spring", 320, 620),
    CalendarWindow("Summer", 621, 922),
    CalendarWindow("Autumn", 923, 1220),
)


def month_day(day: str) -> str:
    return f"(month({day}) * 100 + day({day}))"


def season_name(mmdd: str) -> str:
    """Astronomical season; a null day falls through to winter."""
    cases = " ".join(f"when {w.contains(mmdd)} then '{w.key}'" for w in ASTRONOMICAL)
    return f"case {cases} else 'Winter' end"


def parse_day(text: str) -> str:
    """``yyyy-MM-dd`` to a date, null when it is not one."""
    return f"try_to_date({text}, 'yyyy-MM-dd')"


def expected_days(year: str) -> str:
    """Days of a Gregorian year, null for a null year."""
    leap = f"({year} % 4 = 0 and {year} % 100 != 0) or {year} % 400 = 0"
    return f"case when {year} is null then null when {leap} then 366 else 365 end"


def coverage_pct(days: str, expected: str) -> str:
    return f"round({days} * 100D / ({expected}), 1)"


def coverage_status(days: str, expected: str) -> str:
    return (
        f"case when {days} < ({expected}) * 0.5D then 'SPARSE'"
        f" when {days} < ({expected}) * 0.9D then 'INCOMPLETE' else 'OK' end"
    )


@dataclass(frozen=True)
class YearSegments:
    """The year cut at every bound of a set of windows.

    No window has a bound inside a segment, so a day total per segment is enough to
    get every window's total, however much the windows overlap.
    """

    windows: tuple[CalendarWindow, ...]
    cuts: tuple[int, ...]

    @classmethod
    def of(cls, windows: Sequence[CalendarWindow]) -> YearSegments:
        bounds = {w.first for w in windows} | {_day_after(w.last) for w in windows}
        return cls(tuple(windows), tuple(sorted(bounds - {101})))

    def segment(self, mmdd: str) -> str:
        """Segment number of a day, null for a null day."""
        cases = "".join(f" when {mmdd} < {cut} then {n}" for n, cut in enumerate(self.cuts))
        return f"case when {mmdd} is null then null{cases} else {len(self.cuts)} end"

    def windows_of(self, segment: str, every: str) -> str:
        """Array of (window, inside): a segment's own windows, inside being 1.

        Where ``every`` holds, all windows are listed, inside being 1 or 0. The arrays
        are constants; the one after the last segment serves null days.
        """
        starts = (101, *self.cuts)
        rows = [[(w.key, int(w.holds(start))) for w in self.windows] for start in starts]
        rows.append([(w.key, 0) for w in self.windows])
        full = ", ".join(_entries(row) for row in rows)
        own = ", ".join(_entries([e for e in row if e[1]]) for row in rows)
        index = f"coalesce({segment}, {len(starts)})"
        return f"if({every}, get(array({full}), {index}), get(array({own}), {index}))"


def _entries(row: Sequence[tuple[str, int]]) -> str:
    items = (f"named_struct('window', '{key}', 'inside', {inside})" for key, inside in row)
    return f"cast(array({', '.join(items)}) as array<struct<window: string, inside: int>>)"


def _day_after(mmdd: int) -> int:
    # A leap year, so that both Feb 28 and Feb 29 may end a window.
    following = date(2000, mmdd // 100, mmdd % 100) + timedelta(days=1)
    return following.month * 100 + following.day
