"""Calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def first_weekday(start_of_month: Column) -> Column:
    """First Monday-to-Friday day of the month that begins on the given day."""
    weekday = F.weekday(start_of_month)
    return (
        F.when(weekday == 5, F.date_add(start_of_month, 2))
        .when(weekday == 6, F.date_add(start_of_month, 1))
        .otherwise(start_of_month)
    )


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) integer formula."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    a = year % 19
    century = div(year, 100)
    rest = year % 100
    correction = div(century + 8, 25)
    h = (19 * a + century - div(century, 4) - div(century - correction + 1, 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * div(rest, 4) - h - rest % 4) % 7
    late = div(a + 11 * h + 22 * weekday, 451)
    offset = h + weekday - 7 * late + 114
    return F.make_date(year, div(offset, 31), offset % 31 + 1)
