"""Predicates and the guarded update of an attribute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Check = Callable[[Column], Column]


def yes(condition: Column) -> Column:
    """False where the condition is null."""
    return F.coalesce(condition, F.lit(False))


def valid_order(value: Column) -> Column:
    return yes(value.try_cast("int").between(1, 99999))


def valid_pid(value: Column) -> Column:
    return yes(F.length(value) == 23)


def valid_language(value: Column) -> Column:
    return yes(F.length(value) == 2)


def valid_issns(issns: Column) -> Column:
    """Of a map by medium: only epub and ppub, one at least, all different, each nine long with a dash in the middle."""
    values = F.map_values(issns)
    shaped = F.forall(values, lambda v: v.rlike(r"^.{4}-.{4}$"))
    known = F.size(F.array_except(F.map_keys(issns), F.array(F.lit("epub"), F.lit("ppub")))) == 0
    return yes(known & (F.size(values) > 0) & (F.size(F.array_distinct(values)) == F.size(values)) & shaped)


def is_asset_href(href: Column) -> Column:
    """A local file: in the journal's image folder or with one dot, and neither an address nor a URL."""
    dots = F.length(href) - F.length(F.replace(href, F.lit("."), F.lit("")))
    return yes((href.contains("img/revistas") | (dots == 1)) & ~href.rlike("[:@]") & ~href.rlike("^(www|http)"))


#: Attributes that may change only from an invalid value to a valid one.
GUARDED: dict[str, Check] = {"pid": valid_pid, "order": valid_order, "language": valid_language, "issns": valid_issns}


def guarded_update(attribute: str, current: Column, new: Column) -> Column:
    """(value, decision): decision is update, same, kept (current is valid) or invalid (new isn't)."""
    check = GUARDED.get(attribute)
    if check is None:
        decision = F.lit("update")
    else:
        decision = F.when(current.eqNullSafe(new), "same").when(check(current), "kept").when(~check(new), "invalid").otherwise("update")
    return F.struct(F.when(decision == "update", new).otherwise(current).alias("value"), decision.alias("decision"))


def is_ahead_of_print(volume: Column, number: Column) -> Column:
    return F.coalesce(volume, F.lit("")).isin("", "0") & F.coalesce(number, F.lit("")).isin("", "0", "ahead")


def is_online_only(fpage: Column, volume: Column, number: Column, elocation: Column) -> Column:
    """No page, and an elocation-id wherever there is a volume or a number."""
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    return ~there(fpage) & (there(elocation) | ~(there(volume) | there(number)))


def is_regular_issue(kind: Column) -> Column:
    """Neither a press release nor ahead of print."""
    return ~F.coalesce(kind, F.lit("")).isin("pressrelease", "ahead")
