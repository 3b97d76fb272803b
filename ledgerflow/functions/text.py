"""Identifier and slug expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def customer_slug(name: Column) -> Column:
    """First eight characters, upper case, spaces as underscores."""
    return F.upper(F.replace(F.substring(name, 1, 8), F.lit(" "), F.lit("_")))


def invoice_number(n: Column) -> Column:
    return F.format_string("INV-%06d", n)


def deal_number(n: Column) -> Column:
    return F.format_string("DEAL-%05d", n)


def euros(value: Column, digits: int = 0) -> Column:
    return F.concat(F.format_number(value, digits), F.lit("€"))


def percent(value: Column) -> Column:
    return F.concat(F.format_number(value * 100, 1), F.lit("%"))
