"""Month arithmetic, month identifiers and run stamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONTH_ID = "yyyyMM"
STAMP = "yyyyMMdd'T'HHmmss"


def first_of_month(year: Column, month: Column) -> Column:
    """The first day of a month. A month outside 1..12 stops the job."""
    checked = F.when(month.between(1, 12), month).otherwise(
        F.raise_error(F.format_string("month is out of range: %d", month))
    )
    return F.make_date(year, checked, F.lit(1))


def subtract_months(year: Column, month: Column, how_many: Column | int) -> Column:
    """``struct(year, month)`` that lies ``how_many`` months back."""
    n = how_many if isinstance(how_many, Column) else F.lit(how_many)
    shifted = F.add_months(first_of_month(year, month), -n)
    return F.struct(F.year(shifted).alias("year"), F.month(shifted).alias("month"))


def month_of(moment: Column) -> Column:
    """The first day of the month of a date or timestamp, as a date."""
    return F.trunc(moment.cast("date"), "MM")


def month_id(moment: Column) -> Column:
    """``yyyymm`` of a date or timestamp."""
    return F.date_format(moment, MONTH_ID)


def month_id_of(year: Column, month: Column) -> Column:
    """``yyyymm`` of a year and a month; the month is padded to two digits, never cut."""
    return F.format_string("%d%02d", year, month)


def previous_month_id(moment: Column, how_many: int = 1) -> Column:
    """``yyyymm`` of the month ``how_many`` months before."""
    return month_id(F.add_months(month_of(moment), -how_many))


def days_back(moment: Column, days: int = 30) -> Column:
    """``struct(month_id, year, month)``, all strings, of the day ``days`` before."""
    day = F.date_sub(moment.cast("date"), days)
    return F.struct(
        month_id(day).alias("month_id"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
    )


def run_month(as_of: Column | None = None) -> Column:
    """``struct(year, month)`` of the run day, today unless given."""
    day = F.current_date() if as_of is None else as_of
    return F.struct(F.year(day).alias("year"), F.month(day).alias("month"))


def run_stamp(moment: Column | None = None) -> Column:
    """A time stamp that is safe in a path: no colon and no blank."""
    return F.date_format(F.current_timestamp() if moment is None else moment, STAMP)


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months from the month of ``earlier`` to the month of ``later``."""
    years = F.year(later) - F.year(earlier)
    return years * 12 + F.month(later) - F.month(earlier)
