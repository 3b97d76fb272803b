"""String-to-type parsing with the strict, lenient and defaulting forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerflow.config import MONEY


def strict_date(name: str) -> Column:
    """Under ANSI a bad value fails the job."""
    return F.col(name).cast("date")


def lenient_date(name: str) -> Column:
    """A bad value becomes null."""
    return F.col(name).try_cast("date")


def number(name: str, to: str = MONEY) -> Column:
    """A bad value becomes null and stays null."""
    return F.col(name).try_cast(to)


def number_or(name: str, default, to: str = MONEY) -> Column:
    """A bad or missing value becomes the default."""
    return F.coalesce(number(name, to), F.lit(default).cast(to))


def text_or(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))
