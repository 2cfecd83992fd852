"""Reporting periods and validity intervals.

Intervals include both ends. An interval with a NULL end covers no day, as in
SQL ``between``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Whole days from ``start`` to ``end``, both included."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"period ends {self.end} before it starts {self.start}")

    @property
    def day_before(self) -> date:
        """The day whose balances open the period."""
        return self.start - timedelta(days=1)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def all_days(self) -> list[date]:
        return [self.start + timedelta(days=n) for n in range(self.days)]

    def month_ends(self) -> list[date]:
        """The last days of the months, of a period made of whole months."""
        ends, first = [], self.start
        while first <= self.end:
            following = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
            ends.append(following - timedelta(days=1))
            first = following
        if self.start.day != 1 or ends[-1] != self.end:
            raise ValueError(f"{self.start} to {self.end} are not whole months")
        return ends

    def contains(self, column: str | Column) -> Column:
        column = F.col(column) if isinstance(column, str) else column
        return column.between(F.lit(self.start), F.lit(self.end))


def month_of_report(report_date: date) -> Period:
    """The month a report date closes: reports are dated the first of the next month."""
    if report_date.day != 1:
        raise ValueError(f"a report date is the first day of a month, got {report_date}")
    end = report_date - timedelta(days=1)
    return Period(end.replace(day=1), end)


def valid_on(day: str | Column | date, start: str | Column, end: str | Column) -> Column:
    """Whether ``day`` lies inside the validity interval."""
    if isinstance(day, date):
        day = F.lit(day)
    day = F.col(day) if isinstance(day, str) else day
    return day.between(
        F.col(start) if isinstance(start, str) else start,
        F.col(end) if isinstance(end, str) else end,
    )


def clip_to_period(df: DataFrame, period: Period, start: str, end: str) -> DataFrame:
    """Keep rows valid on some day of the period and add ``valid_from`` and
    ``valid_to``, the part of their interval inside it."""
    return (
        df.where((F.col(start) <= F.lit(period.end)) & (F.col(end) >= F.lit(period.start)))
        .where(F.col(start) <= F.col(end))
        .withColumn("valid_from", F.greatest(F.col(start), F.lit(period.start)))
        .withColumn("valid_to", F.least(F.col(end), F.lit(period.end)))
    )


def _steps(first: Column, last: Column, step: str) -> Column:
    return F.when(first <= last, F.sequence(first, last, F.expr(f"interval {step}"))).otherwise(
        F.array().cast("array<date>")
    )


def days_of(start: Column, end: Column) -> Column:
    """Array of the days from ``start`` to ``end``; empty when they are reversed."""
    return _steps(start, end, "1 day")


def _last_ended_month(end: Column) -> Column:
    return F.add_months(F.trunc(F.date_add(end, 1), "MM"), -1)


def ended_months_of(start: Column, end: Column) -> Column:
    """Array of the first days of months whose last day lies in ``start`` to ``end``."""
    return _steps(F.trunc(start, "MM"), _last_ended_month(end), "1 month")


def whole_months_of(start: Column, end: Column) -> Column:
    """Array of the first days of months that lie wholly in ``start`` to ``end``."""
    first = F.add_months(F.trunc(F.date_sub(start, 1), "MM"), 1)
    return _steps(first, _last_ended_month(end), "1 month")
