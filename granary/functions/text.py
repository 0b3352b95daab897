"""Text functions as Catalyst expressions. White space is Unicode's, digits are ASCII's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def blank(c: Column) -> Column:
    return strip(c) == ""


def whole(c: Column, pattern: str) -> Column:
    """The whole value matches; a newline at the end is no match."""
    return c.rlike(rf"\A(?:{pattern})\z")


def number(c: Column) -> Column:
    """The finite number that a text names, else null."""
    text = strip(c.cast("string"))
    value = F.when(whole(text, NUMBER), text.try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def iso_date(c: Column) -> Column:
    """The date of a text YYYY-MM-DD that the calendar has, else null."""
    text = strip(c)
    return F.when(whole(text, "[0-9]{4}-[0-9]{2}-[0-9]{2}"), text.try_cast("date"))


def iso_instant(c: Column) -> Column:
    """The instant of an ISO 8601 text; without an offset it is taken as the session's zone."""
    shape = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?(?:Z|[+-][0-9]{2}:[0-9]{2})?"
    text = strip(c)
    return F.when(whole(text, shape), text.try_cast("timestamp"))


def shape(c: Column) -> Column:
    """A mask: letters as A, digits as 9, all else as it is."""
    return F.regexp_replace(F.regexp_replace(c, r"[0-9]", "9"), r"[A-Za-z]", "A")


def phone_tail(c: Column, digits: int = 10) -> Column:
    """The last digits of a phone number, or all if there are fewer."""
    only = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(only) >= digits, F.substring(only, -digits, digits)).otherwise(only)


def collapse(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def decimal_of(c: Column, decimal_mark: str = ",", group_mark: str = ".") -> Column:
    """A localised decimal as a number, else null."""
    plain = F.replace(F.replace(strip(c), F.lit(group_mark), F.lit("")), F.lit(decimal_mark), F.lit("."))
    return F.when(whole(plain, r"[+-]?[0-9]+(?:\.[0-9]+)?"), plain.try_cast("decimal(38,10)"))


def fold_case(c: Column) -> Column:
    """Lower case for comparison: sharp s as ss, final sigma as sigma, and no dot left over from a dotted capital I."""
    low = F.translate(F.lower(c), "\u03c2\u1e9e", "\u03c3\u00df")
    return F.replace(F.replace(low, F.lit("i\u0307"), F.lit("i")), F.lit("\u00df"), F.lit("ss"))


def date_of(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy")) -> Column:
    """The date of a text in the first of the formats (Spark's letters) that fits and that the calendar has, else null."""
    text = strip(c)
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats))
