"""Changes of an article document's metadata as column expressions: each takes and returns the XML as text.

Start tags and the places of metadata are found by patterns, so documents should be well formed (`xmltree.fault`); text
that has no such place stays as it is. Values are escaped; metadata are those of the first `article-meta`, so a
sub-article's stay.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import xmltree as T
from .binding import let

# Attributes of the dates of a document and of its issue, by the version that the article's specific-use ends with.
DOCUMENT_DATE = {"-1.9": {"publication-format": "electronic", "date-type": "pub"}, "-1.8": {"pub-type": "epub"}, "": {"pub-type": "epub"}}
BUNDLE_DATE = {"-1.9": {"publication-format": "electronic", "date-type": "collection"}, "-1.8": {"pub-type": "collection"}, "": {"pub-type": "epub-ppub"}}


def first_only(xml: Column, pattern: str, by: str) -> Column:
    """xml with the first occurrence of a pattern replaced; groups of the pattern count from 2."""
    return F.regexp_replace(xml, rf"(?s)^(.*?)(?:{pattern})", f"$1{by}")


def upgraded_dates(xml: Column) -> Column:
    """The first date of each type with date-type in place of pub-type, and as an electronic publication."""
    for old, new in (("epub", "pub"), ("collection", "collection"), ("epub-ppub", "collection")):
        xml = first_only(xml, rf"""<pub-date\b([^>]*?)\s+pub-type=["']{old}["']([^>]*)>""", rf"""<pub-date$2$3 date-type="{new}">""")
    for kind in ("pub", "collection"):
        xml = first_only(xml, rf"""(?=<pub-date\b[^>]*?\sdate-type=["']{kind}["'])(<pub-date\b[^>]*?)(?:\s+publication-format=["'][^"']*["'])?([^>]*?)>""", '$2$3 publication-format="electronic">')
    return xml


def without_counts(xml: Column) -> Column:
    """Without the first counts element."""
    return first_only(xml, r"<counts\b[^>]*/>|<counts\b[^>]*>.*?</counts\s*>", "")


def metadata_end(xml: Column) -> Column:
    """Place (from 1) of the end tag of the first article-meta; 0 without one."""
    return F.instr(xml, F.lit("</article-meta"))


def spliced(xml: Column, at: Column, gone: Column, put: Column) -> Column:
    """xml with `gone` characters from place `at` on replaced."""
    return F.concat(F.substr(xml, F.lit(1), at - 1), put, F.substr(xml, at + gone))


def having(attributes: dict[str, str]) -> str:
    """Pattern of the rest of a start tag with these attributes, in any order."""
    return "".join(rf"""(?=[^>]*\s{a}\s*=\s*["']{v}["'])""" for a, v in attributes.items()) + "[^>]*>"


def with_article_id(xml: Column, value: Column, use: str | None = None, kind: str = "publisher-id", override: bool = False) -> Column:
    """With an article-id of a use (or, without one, of a kind) before the first, or last in the metadata.

    An existing one stays, or with override has the value in place of its own. A null value changes nothing.
    """
    attributes = {"specific-use": use} if use else {"pub-id-type": kind}
    text = T.escaped(value)
    node = F.concat(F.lit(f'<article-id pub-id-type="{kind}"' + (f' specific-use="{use}"' if use else "") + ">"), text, F.lit("</article-id>"))

    def put(v: Column) -> Column:
        first = F.instr(v["head"], F.lit("<article-id"))
        added = spliced(v["xml"], F.when(first > 0, first).otherwise(v["end"]), F.lit(0), node)
        replaced = spliced(v["xml"], F.length(v["before"]) + 1, F.length(v["old"]), text) if override else v["xml"]
        return F.when((v["end"] == 0) | v["value"].isNull(), v["xml"]).when(v["before"] != "", replaced).otherwise(added)

    def existing(v: Column) -> Column:
        pattern = rf"(?s)^(.*?<article-id{having(attributes)})([^<]*)"
        return let(put, xml=v["xml"], end=v["end"], value=value, head=v["head"], before=F.regexp_extract(v["head"], pattern, 1), old=F.regexp_extract(v["head"], pattern, 2))

    return let(lambda v: let(existing, xml=v["xml"], end=v["end"], head=F.substr(v["xml"], F.lit(1), v["end"] - 1)), xml=xml, end=metadata_end(xml))


def with_issns(xml: Column, issns: Column) -> Column:
    """With a map's ISSNs by type, in the types' order, after the journal's titles, else its ids; where there is any, none is added."""
    nodes = F.array_join(F.transform(F.array_sort(F.map_entries(issns)), lambda e: F.concat(F.lit('<issn pub-type="'), T.escaped(e["key"]), F.lit('">'), T.escaped(e["value"]), F.lit("</issn>"))), "")

    def put(v: Column) -> Column:
        titles = F.regexp_extract(v["xml"], r"(?s)^(.*<journal-meta\b.*</journal-title-group\s*>)", 1)
        ids = F.regexp_extract(v["xml"], r"(?s)^(.*<journal-meta\b.*</journal-id\s*>)", 1)
        return let(lambda w: added(v["xml"], F.when(w["titles"] != "", w["titles"]).otherwise(w["ids"])), titles=titles, ids=ids)

    def added(text: Column, head: Column) -> Column:
        there = text.rlike(r"(?s)<journal-meta\b.*<issn\b.*</journal-meta")
        return F.when(there | (head == "") | issns.isNull(), text).otherwise(F.concat(head, nodes, F.substr(text, F.length(head) + 1)))

    return let(put, xml=xml)


def with_language(xml: Column, language: Column) -> Column:
    """With the article's language, where it has none."""

    def put(v: Column) -> Column:
        changed = F.concat(F.regexp_replace(v["tag"], "\\s*/?>$", ' xml:lang="'), T.escaped(language), F.lit('"'), F.regexp_extract(v["tag"], "(/?>)$", 1))
        return F.when((v["tag"] == "") | F.contains(v["tag"], F.lit("xml:lang=")) | language.isNull(), v["xml"]).otherwise(spliced(v["xml"], F.instr(v["xml"], v["tag"]), F.length(v["tag"]), changed))

    return let(lambda x: let(put, xml=x["xml"], tag=F.regexp_extract(x["xml"], r"(<article\b[^>]*>)", 1)), xml=xml)


def date_node(attributes: dict[str, str], year: Column, month: Column, day: Column) -> Column:
    part = lambda tag, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"<{tag}>"), T.escaped(c), F.lit(f"</{tag}>"))).otherwise("")
    start = "<pub-date" + "".join(f' {a}="{v}"' for a, v in attributes.items()) + ">"
    return F.concat(F.lit(start), part("day", day), part("month", month), part("year", year), F.lit("</pub-date>"))


def with_date_of(xml: Column, attributes: dict[str, str], node: Column) -> Column:
    """With node in place of the metadata's first date that has these attributes, else last in the metadata."""

    def put(v: Column) -> Column:
        old = F.regexp_extract(v["head"], rf"(?s)(<pub-date{having(attributes)}.*?</pub-date\s*>)", 1)
        placed = lambda w: F.when(w["old"] != "", spliced(v["xml"], F.instr(v["xml"], w["old"]), F.length(w["old"]), node)).otherwise(spliced(v["xml"], v["end"], F.lit(0), node))
        return F.when(v["end"] == 0, v["xml"]).otherwise(let(placed, old=old))

    return let(lambda v: let(put, xml=v["xml"], end=v["end"], head=F.substr(v["xml"], F.lit(1), v["end"] - 1)), xml=xml, end=metadata_end(xml))


def with_date(xml: Column, kind: str, year: Column, month: Column, day: Column) -> Column:
    """With the date of a pub-type, in place of the one that is there, else last in the metadata; empty parts left out."""
    return with_date_of(xml, {"pub-type": kind}, date_node({"pub-type": kind}, year, month, day))


def by_version(xml: Column, attributes: dict[str, dict[str, str]], year: Column, month: Column, day: Column) -> Column:
    """With the date whose attributes the article's version (its specific-use) asks for."""

    def put(v: Column) -> Column:
        out = None
        for version, those in attributes.items():
            changed = with_date_of(v["xml"], those, date_node(those, year, month, day))
            this = v["version"].endswith(version)
            out = F.when(this, changed) if out is None else out.when(this, changed)
        return out

    return let(put, xml=xml, version=F.coalesce(T.attribute(F.regexp_extract(xml, rf"<article{T.IN_TAG}/?>", 0), "specific-use"), F.lit("")))


def with_document_date(xml: Column, year: Column, month: Column, day: Column) -> Column:
    return by_version(xml, DOCUMENT_DATE, year, month, day)


def with_bundle_date(xml: Column, year: Column, month: Column, day: Column) -> Column:
    return by_version(xml, BUNDLE_DATE, year, month, day)


def without_bundle_date(xml: Column) -> Column:
    """Without the issue's date, as of an article ahead of print: the first of its kinds that the metadata have."""

    def cut(v: Column) -> Column:
        kinds = ({"pub-type": "epub-ppub"}, {"pub-type": "collection"}, {"date-type": "collection"})
        old = F.coalesce(*[F.nullif(F.regexp_extract(v["head"], rf"(?s)(<pub-date{having(k)}.*?</pub-date\s*>)", 1), F.lit("")) for k in kinds])
        return let(lambda w: F.when(w["old"].isNull(), v["xml"]).otherwise(spliced(v["xml"], F.instr(v["xml"], w["old"]), F.length(w["old"]), F.lit(""))), old=old)

    return let(cut, xml=xml, head=F.substr(xml, F.lit(1), metadata_end(xml) - 1))


def with_names(xml: Column, names: Column) -> Column:
    """With each link whose target is a key of the map leading to its value."""
    parts = F.regexp_extract_all(xml, F.lit(r'''(?s)xlink:href="[^"]*+"|[^x]++|x'''), F.lit(0))

    def renamed(part: Column) -> Column:
        new = F.try_element_at(names, T.decoded(F.regexp_extract(part, '^xlink:href="([^"]*)"$', 1)))
        return F.when(part.startswith('xlink:href="') & new.isNotNull(), F.concat(F.lit('xlink:href="'), T.escaped(new), F.lit('"'))).otherwise(part)

    return F.array_join(F.transform(parts, renamed), "")
