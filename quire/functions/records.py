"""Catalogue records: JSON of numbered fields, each a list of subfield maps.

Functions that take a `record` want it parsed: select parsed(text) first, so that each text is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path(text: Column, where: str, default: str | None = None) -> Column:
    """The text at a JSON path, or the default where the path or the JSON isn't there."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(text), where, "string"), F.lit(default))


def parsed(text: Column) -> Column:
    """The record as a VARIANT; null for text that isn't JSON."""
    return F.try_parse_json(text)


def field(record: Column, tag: str, subfield: str = "_") -> Column:
    """A field's first subfield, as one text or, in ragged records, as a list of which the first counts."""
    one = f"$.{tag}[0]['{subfield}']"
    return F.coalesce(F.try_variant_get(record, f"{one}[0]", "string"), F.try_variant_get(record, one, "string"))


def subfields(content: Column) -> Column:
    """`zero^1one^2two` as [(_, zero), (1, one), (2, two)], keys in lower case; ^^ is no mark but a caret."""
    escaped = F.replace(content, F.lit("^^"), F.lit("\x00"))
    parts = F.split(escaped, r"\^")
    back = lambda x: F.replace(x, F.lit("\x00"), F.lit("^"))
    first = F.when(F.get(parts, F.lit(0)) != "", F.array(F.struct(F.lit("_").alias("key"), back(F.get(parts, F.lit(0))).alias("value"))))
    empty = F.array().cast("array<struct<key:string,value:string>>")
    rest = F.transform(F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p != ""), lambda p: F.struct(F.lower(F.substring(p, 1, 1)).alias("key"), back(F.substr(p, F.lit(2))).alias("value")))
    return F.concat(F.coalesce(first, empty), rest)


def issue_folder(volume: Column, volume_supplement: Column, number: Column, number_supplement: Column) -> Column:
    """v31s0n2s1 and the like: each part with its mark, absent parts left out."""
    part = lambda mark, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(mark), c)).otherwise("")
    return F.concat(part("v", volume), part("s", volume_supplement), part("n", number), part("s", number_supplement))


def fixed_renditions(renditions: Column, folder: Column) -> Column:
    """Rendition paths by language, their issue folder in its own spelling.

    Where a path has the folder as it is, all stay as they are; else those with the folder in lower case are mended and
    others go.
    """
    right = F.concat(F.lit("/"), folder, F.lit("/"))
    wrong = F.lower(right)
    mended = F.transform_values(F.map_filter(renditions, lambda _, v: F.contains(v, wrong)), lambda _, v: F.replace(v, wrong, right))
    return F.when(F.exists(F.map_values(renditions), lambda v: F.contains(v, right)), renditions).otherwise(mended)


def issns_of_issue(record: Column) -> Column:
    """Distinct ISSNs of an issue record: the journal's and every further one."""
    more = F.transform(F.try_variant_get(record, "$.v435", "array<map<string,string>>"), lambda m: F.try_element_at(m, F.lit("_")))
    both = F.concat(F.array(F.try_variant_get(record, "$.v35[0]['_']", "string")), F.coalesce(more, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(both, lambda x: F.coalesce(x, F.lit("")) != ""))


def every(record: Column, tag: str) -> Column:
    """All subfield maps of a field; null without it."""
    return F.try_variant_get(record, f"$.{tag}", "array<map<string,string>>")


def texts(record: Column, tag: str) -> Column:
    """The texts of a field's occurrences; null without one."""
    found = F.filter(F.transform(every(record, tag), lambda m: F.try_element_at(m, F.lit("_"))), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.when(F.size(found) > 0, found)


def manifest_of_journal(record: Column) -> Column:
    """The journal manifest of a title record; null without the id ISSN, parts that the record lacks null."""
    one = lambda tag, sub="_": F.nullif(field(record, tag, sub), F.lit(""))
    day = lambda text: F.date_format(F.try_to_timestamp(text, F.lit("yyyyMMdd")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")  # parsed and shown in one zone
    sub = lambda m, k: F.try_element_at(m, F.lit(k))
    mission = F.transform(every(record, "v901"), lambda m: F.struct(sub(m, "l").alias("language"), sub(m, "_").alias("value")))
    kind = lambda code: F.get(F.filter(every(record, "v435"), lambda m: F.upper(F.coalesce(sub(m, "t"), F.lit(""))) == code), 0)["_"]
    status = F.transform(every(record, "v51"), lambda m: F.struct(sub(m, "b").alias("status"), day(sub(m, "a")).alias("date"), sub(m, "c").alias("reason")))
    named = lambda tag: F.transform(texts(record, tag), lambda x: F.struct(x.alias("name")))
    institutions = F.transform(texts(record, "v480"), lambda x: F.struct(x.alias("name"), one("v490").alias("city"), one("v320").alias("state"), one("v310").alias("country_code")))
    contact = F.struct(one("v64").alias("email"), one("v63").alias("address"))
    return F.when(
        one("v400").isNotNull(),
        F.struct(
            one("v400").alias("id"), day(one("v940")).alias("created"), day(one("v940")).alias("updated"), mission.alias("mission"), one("v100").alias("title"), one("v151").alias("title_iso"), one("v150").alias("short_title"), F.lower(one("v68")).alias("acronym"),
            kind("PRINT").alias("print_issn"), kind("ONLIN").alias("electronic_issn"), status.alias("status_history"), texts(record, "v441").alias("subject_areas"), named("v140").alias("sponsors"), texts(record, "v854").alias("subject_categories"),
            one("v692").alias("online_submission_url"), one("v710").alias("next_journal"), one("v610").alias("previous_journal"), F.when(one("v64").isNotNull() | one("v63").isNotNull(), contact).alias("contact"), institutions.alias("institution_responsible_for"),
        ),
    )
