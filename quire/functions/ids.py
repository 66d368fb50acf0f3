"""Identifiers of issues, bundles and documents."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .binding import let

# The 48 digits of document ids, least significant place first in an id.
DIGITS = "bcdfghjkmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ3456789"
ID_LENGTH = 23


def blank(value: Column) -> Column:
    """Null for an empty text."""
    return F.nullif(value, F.lit(""))


def unpadded(value: Column) -> Column:
    """Digits without leading zeros, null where that leaves none; other text as it is, null if empty."""
    return F.when(value.rlike(r"^\d+$"), blank(F.regexp_replace(value, "^0+", ""))).otherwise(blank(value))


def volume_and_number(volume: Column, number: Column) -> Column:
    """(volume, number) without padding; both null for an article ahead of print."""
    ahead = F.coalesce(F.lower(number) == "ahead", F.lit(False))
    return F.struct(F.when(~ahead, unpadded(volume)).alias("volume"), F.when(~ahead, unpadded(number)).alias("number"))


def issue_id(issn: Column, year: Column, volume: Column, number: Column, supplement: Column) -> Column:
    """ISSN[-year][-vVolume][-nNumber][-sSupplement]; null where neither volume nor number is given."""
    vn = volume_and_number(volume, number)
    part = lambda mark, x: F.concat(F.lit(mark), x)
    whole = F.concat_ws("-", issn, blank(year), part("v", vn["volume"]), part("n", vn["number"]), part("s", unpadded_zero(supplement)))
    return F.when(vn["volume"].isNotNull() | vn["number"].isNotNull(), whole)


def unpadded_zero(value: Column) -> Column:
    """Like unpadded, but a zero stays: supplement 0 is one."""
    return F.when(value.rlike(r"^\d+$"), F.regexp_replace(value, r"^0+(?=\d)", "")).otherwise(blank(value))


def ahead_id(issn: Column) -> Column:
    return F.concat(issn, F.lit("-aop"))


def bundle_id(issn: Column, year: Column, volume: Column, number: Column, supplement: Column) -> Column:
    return F.coalesce(issue_id(issn, year, volume, number, supplement), ahead_id(issn))


def issue_token(label: Column) -> Column:
    """An issue label as a file-name part: words joined by -, digits with two places, spe for special, s for a supplement."""
    def word(w: Column) -> Column:
        low = F.lower(w)
        return F.when(low.rlike(r"^\d+$"), F.when(F.length(low) < 2, F.lpad(low, 2, "0")).otherwise(low)).when(low.contains("spe"), "spe").when(low.contains("sup"), "s").otherwise(low)

    joined = F.array_join(F.transform(F.filter(F.split(label, r"\s+"), lambda w: w != ""), word), "-")
    glued = F.replace(F.replace(joined, F.lit("spe-"), F.lit("spe")), F.lit("s-"), F.lit("s"))
    return F.when(glued.endswith("s"), F.concat(glued, F.lit("0"))).otherwise(glued)


def issue_number(label: Column) -> Column:
    """The label before its supplement mark, without spaces; null if it begins with the mark."""
    before = F.regexp_replace(F.regexp_replace(F.lower(label), r"sup.*$", ""), r"\s+", "")
    return blank(before)


def issue_supplement(label: Column) -> Column:
    """The last word after the supplement mark, 0 if the mark is the last word; null without a mark."""
    marked = F.regexp_extract(F.lower(label), r"(sup\S*.*)$", 1)
    words = F.split(F.trim(marked), r"\s+")
    return F.when(marked != "", F.when(F.size(words) == 1, "0").otherwise(F.element_at(words, -1)))


def order_of(pid: Column, other: Column, fpage: Column) -> Column:
    """Five places: the first valid of the pid's last five characters, the other id and the first page."""
    def valid(v: Column) -> Column:
        n = F.when(v.rlike(r"^\d{1,5}$"), v.try_cast("int"))
        return F.when(n.between(1, 99999), F.lpad(n.cast("string"), 5, "0"))

    return F.coalesce(valid(F.substring(pid, -5, 5)), valid(other), valid(fpage))


def pid_of_path(path: Column) -> Column:
    """S + ISSN + year + order + sequence of `.../ISSN/year/order/sequence.mst`; null for other paths."""
    found = F.regexp_extract(path, r"([\w-]{9})/(.{4})/(.{4})/(.{5})\.mst$", 0)
    return F.when(found != "", F.concat(F.lit("S"), F.regexp_replace(F.replace(found, F.lit(".mst"), F.lit("")), "/", "")))


def package_name(issn: Column, acron: Column, volume: Column, number: Column, page: Column, year: Column, doi: Column) -> Column:
    """issn-acron-volume-number-page; of an article ahead of print issn-acron-ahead-year-doi."""
    ahead = blank(volume).isNull() & blank(number).isNull()
    rest = F.regexp_replace(F.regexp_replace(doi, r"^.*/", ""), r"[^\w]", "-")
    return F.when(ahead, F.concat_ws("-", issn, acron, F.lit("ahead"), blank(year), blank(rest))).otherwise(F.concat_ws("-", issn, acron, blank(volume), blank(number), blank(page)))


def package_name_of(meta: Column, prefix: Column) -> Column:
    """The package name of a document by its metadata(): issn-acron-volume-issue-fpage-lpage-elocation, parts that there are.

    Ahead of print (no volume or issue) ahead, year and doi follow, or the other id without one; of an issue's document
    without pages and doi the other id follows. Where nothing is known, the prefix of the original file names.
    """

    def named(m: Column) -> Column:
        pages = [m["meta"][n] for n in ("fpage", "lpage", "elocation_id")]
        ahead = m["meta"]["volume"].isNull() & m["issue"].isNull()
        last = F.coalesce(m["doi"], m["meta"]["other"])
        unpaged = F.coalesce(*pages, m["doi"]).isNull()
        more = F.when(ahead & last.isNotNull(), F.concat_ws("-", F.lit("ahead"), m["meta"]["bundle_year"], last)).when(~ahead & unpaged, m["meta"]["other"])
        name = F.concat_ws("-", m["meta"]["issn"], m["meta"]["acron"], m["meta"]["volume"], m["issue"], *pages, more)
        return F.when(name != "", name).otherwise(prefix)

    # the metadata are worked out once, whatever refers to them
    return let(lambda v: let(named, meta=v["meta"], issue=issue_token(v["meta"]["issue"]), doi=F.regexp_replace(v["meta"]["doi"], "^[^/]*/", "")), meta=meta)


def asset_name(package: Column, prefix: Column, filename: Column) -> Column:
    """package-g + what follows the prefix in filename."""
    return F.concat(package, F.lit("-g"), F.when(filename.startswith(prefix), F.substring(filename, F.length(prefix) + 1, F.length(filename))).otherwise(filename))


def media_prefix(issn: Column, pid: Column) -> Column:
    """issn/pid; null without a pid."""
    return F.concat_ws("/", issn, pid) if pid is None else F.when(blank(pid).isNotNull(), F.concat(issn, F.lit("/"), pid))


def content_key(prefix: Column, content: Column, extension: Column) -> Column:
    """prefix/sha1 + extension: the same bytes always have the same key."""
    return F.concat(prefix, F.lit("/"), F.sha1(content.cast("binary")), extension)


def to_digits(value: uuid.UUID) -> str:
    n, out = value.int, []
    for _ in range(ID_LENGTH):
        n, digit = divmod(n, len(DIGITS))
        out.append(DIGITS[digit])
    return "".join(out)


def from_digits(text: str) -> uuid.UUID:
    return uuid.UUID(int=sum(DIGITS.index(c) * len(DIGITS) ** i for i, c in enumerate(text)))


@F.pandas_udf(StringType())
def base48(ids: pd.Series) -> pd.Series:
    """The 23 digits of a UUID's 128 bits: no SQL number type holds them. Null stays null."""
    return ids.map(lambda x: to_digits(uuid.UUID(x)), na_action="ignore")


@F.pandas_udf(StringType())
def base48_uuid(ids: pd.Series) -> pd.Series:
    return ids.map(lambda x: str(from_digits(x)), na_action="ignore")
