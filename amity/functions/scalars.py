"""Scalar expressions, all of them built-in Spark functions."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(line: Column, separator: str) -> Column:
    """The fields of a text line, empty ones included."""
    return F.split(line, re.escape(separator))


def to_integer(text: Column) -> Column:
    """Text as bigint, NULL where it is not a number."""
    return text.try_cast("bigint")


def to_float(text: Column) -> Column:
    """Text as float, NULL where it is not a number."""
    return text.try_cast("float")


def smaller_id(left: Column, right: Column) -> Column:
    return F.least(left, right)


def larger_id(left: Column, right: Column) -> Column:
    return F.greatest(left, right)


def parse_dob(text: Column) -> Column:
    """Month/day/year at the start of a text as date; NULL if unreadable.

    Numbers past the end of a year or month roll over, as lenient parsers do:
    13/45/1990 is 45 days into January 1991. What follows the year is ignored.
    """
    month, day, year = (
        F.regexp_extract(text, r"^\s*(\d{1,4})/(\d{1,4})/(\d{1,4})(?!\d)", i).try_cast("int")
        for i in (1, 2, 3)
    )
    start = F.make_date(F.when(year > 0, year), F.lit(1), F.lit(1))
    return F.date_add(F.add_months(start, month - 1), day - 1)


def yyyymmdd(date: Column) -> Column:
    """A date as the integer whose digits are year, month and day."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def age_years(dob: Column, as_of: datetime.date | Column | None = None) -> Column:
    """Whole years between a birth date given as text and `as_of` (today by default)."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    difference = yyyymmdd(as_of) - yyyymmdd(parse_dob(dob))
    return F.call_function("div", difference, F.lit(10000)).cast("int")


def joined_text(separator: str, *columns: Column) -> Column:
    """The columns as one text, numbers written out; NULL columns are left out."""
    return F.concat_ws(separator, *[c.cast("string") for c in columns])


def list_length(items: Column) -> Column:
    return F.size(items).cast("bigint")


def id_set_intersection(left: Column, right: Column) -> Column:
    """The ids found in both lists, each once."""
    return F.array_intersect(left, right)


def person_label(first_name: Column, dob: Column) -> Column:
    """`first: dob`, NULL if either is unknown."""
    return F.concat(first_name, F.lit(": "), dob)


def address_label(address: Column, city: Column, state: Column) -> Column:
    """`address, city, state`."""
    return F.concat_ws(", ", address, city, state)
