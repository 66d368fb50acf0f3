"""Partial dates and dates in many formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# English month names, by which dates are written in the catalogue.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def _blank_zero(part: Column) -> Column:
    return F.when(part.isNull() | part.rlike("^0*$"), "").otherwise(part)


def padded(part: Column) -> Column:
    """Digits with two places at least; other text as it is."""
    return F.when(part.rlike(r"^\d$"), F.lpad(part, 2, "0")).otherwise(part)


def partial_date(text: Column) -> Column:
    """(year, month, day) strings of YYYYMMDD or YYYY[-MM[-DD]]; '' for parts that are missing or zero, null otherwise."""
    compact = text.rlike(r"^\d{8}$")
    dashed = F.split(text, "-")
    parts = F.when(compact, F.array(F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))).otherwise(dashed)
    year, month, day = (_blank_zero(padded(F.get(parts, F.lit(i)))) for i in range(3))
    valid = compact | text.rlike(r"^\d{4}(-\d{1,2}){0,2}$")
    return F.when(valid, F.struct(year.alias("year"), month.alias("month"), day.alias("day")))


def month_number(name: Column) -> Column:
    """1 to 12 of an English month name or its first three letters; null otherwise."""
    bare = F.regexp_replace(name, r"[^A-Za-z]", "")
    place = F.array_position(F.transform(F.array(*map(F.lit, MONTHS)), lambda m: F.lower(F.substring(m, 1, 3))), F.lower(F.substring(bare, 1, 3)))
    return F.when((place > 0) & (F.length(bare) >= 3), place.cast("int"))


def month_range(text: Column) -> Column:
    """(start, end) of `Jan./Jun.`; both the same month where there is one."""
    parts = F.split(text, r"[/-]")
    return F.struct(month_number(F.get(parts, F.lit(0))).alias("start"), month_number(F.element_at(parts, -1)).alias("end"))


def ends_of_range(text: Column) -> Column:
    """The first and the last part of a date whose month is a range: 2020-Oct-Dec as 2020-Dec."""
    parts = F.split(text, "-")
    return F.when((F.size(parts) > 2) & month_number(F.get(parts, F.lit(1))).isNotNull() & month_number(F.element_at(parts, -1)).isNotNull(), F.concat_ws("-", F.get(parts, F.lit(0)), F.element_at(parts, -1))).otherwise(text)


def parse_date(text: Column) -> Column:
    """Midnight, as ISO text with microseconds, of a date in any of the catalogue's formats; null if it is none.

    Months are numbers or English names; a month range counts as its last month; from the first part that can't be
    (month 30, day 40) the rest is left out.
    """
    def of_parts(x: Column) -> Column:
        said, place = F.get(x["parts"], F.lit(1)), F.get(x["parts"], F.lit(2)).try_cast("int")
        month = F.coalesce(said.try_cast("int"), month_number(said))
        year = F.when(F.get(x["parts"], F.lit(0)).rlike(r"^\d{4}$"), F.get(x["parts"], F.lit(0)).try_cast("int"))
        return let(of_numbers, year=year, month=F.when(month.between(1, 12), month), day=F.when(place.between(1, 31), place))

    def of_numbers(x: Column) -> Column:
        first = F.make_date(F.when(x["year"] > 0, x["year"]), F.coalesce(x["month"], F.lit(1)), F.lit(1))
        # a day that the month lacks is left out like one above 31
        whole = F.date_add(first, F.when(x["month"].isNotNull() & (x["day"] <= F.day(F.last_day(first))), x["day"] - 1).otherwise(0))
        return F.date_format(whole.cast("timestamp"), ISO)

    return let(of_parts, parts=F.split(ends_of_range(text), "-"))


def document_dates(publication: Column, creation: Column, update: Column, issue: Column) -> Column:
    """(document, issue) partial dates: the document's is the first there is of publication, creation and update."""
    return F.struct(partial_date(F.coalesce(publication, creation, update)).alias("document"), partial_date(issue).alias("issue"))
