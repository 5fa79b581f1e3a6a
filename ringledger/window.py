"""The time window of one run and the wider spans its models recompute."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Span:
    """Days ``start`` (included) to ``end`` (excluded), ``None`` leaving a side open, and single ``extra`` days."""

    start: date | None = None
    end: date | None = None
    extra: frozenset[date] = frozenset()

    def holds(self, moment: Column) -> Column:
        """Predicate on a date or timestamp column.

        The bounds are date literals, so the column itself is never wrapped in
        a function and the comparison can reach the file scan.
        """
        test = F.lit(True)
        if self.start is not None:
            test = test & (moment >= F.lit(self.start))
        if self.end is not None:
            test = test & (moment < F.lit(self.end))
        for day in sorted(self.extra):
            test = test | ((moment >= F.lit(day)) & (moment < F.lit(day + timedelta(days=1))))
        return test

    def keep(self, df: DataFrame, moment: str) -> DataFrame:
        if self.start is None and self.end is None:
            return df
        return df.where(self.holds(F.col(moment)))

    def holds_day(self, day: date | None) -> bool:
        if day is None:
            return self.start is None and self.end is None
        inside = (self.start is None or day >= self.start) and (self.end is None or day < self.end)
        return inside or day in self.extra

    def listed_days(self) -> list[date] | None:
        """The days one by one, or ``None`` where a side is open."""
        if self.start is None or self.end is None:
            return None
        inside = [self.start + timedelta(days=n) for n in range((self.end - self.start).days)]
        return sorted({*inside, *self.extra})

    def and_days(self, days: Iterable[date | None]) -> Span:
        """The span and single days more."""
        more = frozenset(day for day in days if day is not None and not self.holds_day(day))
        return replace(self, extra=self.extra | more)


EVERYTHING = Span()


@dataclass(frozen=True)
class RunWindow:
    """Days one run is responsible for.

    ``settled`` spans are the ones that make any sequence of runs end in the
    tables a full build gives: days that late records can still change are
    recomputed, and months always as a whole. With ``narrow=True`` scorecards
    only look at the window itself, so late records never reach them.
    """

    start: date
    end: date
    lookback_days: int = 7
    callback_days: int = 3
    narrow: bool = False

    def __post_init__(self) -> None:
        if self.end <= self.start:
            raise ValueError(f"empty run window {self.start}..{self.end}")
        if self.lookback_days < self.callback_days:
            raise ValueError("lookback_days must cover callback_days")

    @classmethod
    def for_day(cls, day: date, **options) -> RunWindow:
        return cls(day, day + timedelta(days=1), **options)

    @classmethod
    def for_days(cls, first: date, last: date, **options) -> RunWindow:
        return cls(first, last + timedelta(days=1), **options)

    @property
    def days(self) -> Span:
        """The window itself."""
        return Span(self.start, self.end)

    @property
    def inclusive_days(self) -> Span:
        """The window with its end day: what an inclusive date filter selects."""
        return Span(self.start, self.end + timedelta(days=1))

    @property
    def revisable(self) -> Span:
        """The window plus the earlier days late records may still change."""
        return Span(self.start - timedelta(days=self.lookback_days), self.end)

    @property
    def callbacks(self) -> Span:
        """Where the callbacks of ``revisable`` tickets may lie.

        A narrow run stops at the window's end. A settled one reads on, so a
        window that is run after a later one still sees its callbacks.
        """
        reach = 0 if self.narrow else self.callback_days + 1
        return Span(self.revisable.start, self.end + timedelta(days=reach))

    def originals(self, changed: Iterable[date | None] = ()) -> Span:
        """Tickets whose callbacks may be others than before: the revisable ones, and those up to a
        callback period before a day on which tickets have changed."""
        days = [day for day in changed if day is not None and not self.narrow]
        return self.revisable.and_days(day - timedelta(days=n) for day in days for n in range(self.callback_days + 1))

    def callbacks_of(self, originals: Span) -> Span:
        """Where the callbacks of these tickets may lie."""
        reach = range(self.callback_days + 2)
        return self.callbacks.and_days(day + timedelta(days=n) for day in originals.extra for n in reach)

    @property
    def scorecard_days(self) -> Span:
        return self.inclusive_days if self.narrow else self.revisable

    @property
    def scorecard_months(self) -> Span:
        """Whole months around the revisable days (a month row is replaced as one)."""
        if self.narrow:
            return self.inclusive_days
        last = self.end - timedelta(days=1)
        following = (last.replace(day=28) + timedelta(days=4)).replace(day=1)
        return Span(self.revisable.start.replace(day=1), following)


def days_of_month(day: date) -> list[date]:
    first = day.replace(day=1)
    return [d for n in range(31) if (d := first + timedelta(days=n)).month == first.month]


def within_inclusive(moment: Column, start: date, end: date) -> Column:
    """Closed timestamp window: midnight of ``end`` is in, anything later is out."""
    return moment.between(F.lit(start), F.lit(end))
