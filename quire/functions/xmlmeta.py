"""Metadata of an article document. One that isn't well formed gets nulls, and metadata() says where it breaks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import xmltree as T
from .binding import let

# Kinds of a publication date, as (attribute, value), in the order in which they are looked for.
DOCUMENT_DATES = (("pub_type", "epub"), ("date_type", "pub"), None)
BUNDLE_DATES = (("pub_type", "epub-ppub"), ("pub_type", "collection"), ("date_type", "collection"))
BUNDLE_YEARS = (("pub_type", "collection"), ("date_type", "collection"), ("pub_type", "epub-pub"), ("pub_type", "epub"))
ASSET_TAGS = ["graphic", "inline-graphic", "media", "inline-supplementary-material", "supplementary-material"]
FIELDS = ["pid_v1", "pid_v2", "pid_v3", "aop_pid", "publisher_id", "other", "acron", "elocation_id", "doi", "issn", "volume", "issue", "fpage", "lpage", "languages", "assets", "document_date", "bundle_date", "bundle_year"]
ATTRIBUTES = {"use": "specific-use", "id_type": "pub-id-type", "pub_type": "pub-type", "date_type": "date-type"}


def on_sound(xml: Column, use) -> Column:
    """use(document of tags and text), null where xml isn't well formed."""
    return let(lambda v: F.when(v["fault"].isNull(), use(v["x"])), fault=T.fault(xml), x=T.plain(xml))


def value(inner: Column) -> Column:
    """An element's text; null if empty."""
    return F.nullif(T.text_of(inner), F.lit(""))


def two_places(number: Column) -> Column:
    return F.when(number.rlike(r"^\d$"), F.lpad(number, 2, "0")).otherwise(number)


def item(nodes: Column, test) -> Column:
    """The first of the nodes that pass a test; null without one."""
    return F.get(F.filter(nodes, test), F.lit(0))


def of_kind(dates: Column, kind: tuple[str, str] | None) -> Column:
    return item(dates, (lambda d: d[kind[0]] == kind[1]) if kind else (lambda d: F.lit(True)))


def parts(date: Column) -> Column:
    """(year, month, day) of a publication date, missing parts empty, numbers of two places."""
    return F.struct(*[two_places(F.coalesce(date[p], F.lit(""))).alias(p) for p in ("year", "month", "day")])


def no_date() -> Column:
    return F.struct(*[F.lit(None).cast("string").alias(p) for p in ("year", "month", "day")])


def document_date(dates: Column) -> Column:
    """Of the electronic publication, else of the first date unless it is the issue's; nulls where that has no year."""
    def taken(v: Column) -> Column:
        d = v["date"]
        return F.when((F.coalesce(d["date_type"], d["pub_type"], F.lit("")) == "collection") | d["year"].isNull(), no_date()).otherwise(parts(d))

    return let(taken, date=F.coalesce(*[of_kind(dates, kind) for kind in DOCUMENT_DATES]))


def bundle_date(dates: Column) -> Column:
    return let(lambda v: F.when(v["date"]["year"].isNull(), no_date()).otherwise(parts(v["date"])), date=F.coalesce(*[of_kind(dates, kind) for kind in BUNDLE_DATES]))


def last_of_each(entries: Column) -> Column:
    """A map of (key, value), the last of equal keys counting; entries without key or value are left out."""
    known = F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())

    def kept(v: Column) -> Column:
        later = lambda i: F.transform(F.slice(v["e"], i + 2, F.size(v["e"])), lambda e: e["key"])
        return F.map_from_entries(F.filter(v["e"], lambda e, i: ~F.array_contains(later(i), e["key"])))

    return let(kept, e=known)


def asset_names(x: Column) -> Column:
    links = F.transform(F.transform(T.tags(x, ASSET_TAGS), lambda t: T.raw_attribute(t, "xlink:href")), T.decoded)
    return F.array_distinct(F.filter(links, lambda h: h.isNotNull() & ~h.rlike("[:/]")))


def language_codes(x: Column) -> Column:
    def found(v: Column) -> Column:
        spoken = F.concat(F.filter(F.array(v["root"]), lambda t: T.name_of(t) == "article"), F.filter(v["subs"], lambda t: T.raw_attribute(t, "article-type") == "translation"))
        return F.filter(F.transform(spoken, lambda t: T.attribute(t, "xml:lang")), lambda c: c.isNotNull())

    return let(found, root=F.regexp_extract(x, T.TAG, 0), subs=T.tags(x, ["sub-article"]))


def issn_nodes(x: Column) -> Column:
    """(type, value) of elements issn, in document order."""
    return F.transform(T.elements(x, "issn"), lambda e: F.struct(T.raw_attribute(e["tag"], "pub-type").alias("type"), value(e["inner"]).alias("value")))


def first_issns(nodes: Column) -> dict[str, Column]:
    typed = lambda kind: item(nodes, lambda n: n["type"] == kind)["value"]
    return {"eissn": typed("epub"), "pissn": typed("ppub"), "issn": F.get(nodes, F.lit(0))["value"]}


def acronym(x: Column) -> Column:
    return value(item(T.elements(x, "journal-id"), lambda e: T.raw_attribute(e["tag"], "journal-id-type") == "publisher-id")["inner"])


def assets(xml: Column) -> Column:
    """Local file names that graphics, media and supplements link to, once each, in document order."""
    return on_sound(xml, asset_names)


def languages(xml: Column) -> Column:
    """The article's language and those of its translations, in document order."""
    return on_sound(xml, language_codes)


def issns(xml: Column) -> Column:
    """Map of the journal's ISSNs by their type, the last of each; null without one."""
    def found(x: Column) -> Column:
        typed = F.transform(issn_nodes(T.first(x, "journal-meta")), lambda n: F.struct(n["type"].alias("key"), n["value"].alias("value")))
        return let(lambda v: F.when(F.size(v["m"]) > 0, v["m"]), m=last_of_each(typed))

    return on_sound(xml, found)


def renditions(xml: Column) -> Column:
    """Map of rendition files by language, as the document's self-uri say, the last of each."""
    def found(x: Column) -> Column:
        links = T.tags(T.first(x, "article-meta"), ["self-uri"])
        return last_of_each(F.transform(links, lambda t: F.struct(T.attribute(t, "xml:lang").alias("key"), T.attribute(t, "xlink:href").alias("value"))))

    return on_sound(xml, found)


def journal_fields(x: Column) -> Column:
    """journal_meta() of a document of tags and text without fault."""
    known = lambda v: {**first_issns(v["issns"]), "acron": v["acron"]}
    return let(lambda v: F.filter(F.array(*[F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in known(v).items()]), lambda e: e["value"].isNotNull()), issns=issn_nodes(x), acron=acronym(x))


def journal_meta(xml: Column, error: Column | None = None) -> Column:
    """(key, value) of electronic, print and first ISSN and the acronym, those that there are.

    error: the document's, where metadata() has found it already, so that it isn't looked for once more.
    """
    if error is None:
        return on_sound(xml, journal_fields)
    return F.when(error.isNull(), let(lambda v: journal_fields(v["x"]), x=T.plain(xml)))


def metadata(xml: Column, collection: str = "pid") -> Column:
    """All fields of a document; its ids are those of the collection's `specific-use`, such as pid-v2.

    The document is cut into tokens once for its fault and its metadata into elements once for all fields. All are null, and
    `error` says where it breaks, in a document that isn't well formed.
    """
    names = ("volume", "issue", "fpage", "lpage", "elocation-id")
    nonzero = lambda c: F.when(~c.rlike("^0+$"), c)
    named = lambda v, n: F.filter(v["nodes"], lambda e: e["name"] == n)

    def node(e: Column) -> Column:
        date = e["name"] == "pub-date"
        raw = F.array(F.when(~date, e["inner"]), *[F.when(date, T.first(e["inner"], p)) for p in ("year", "month", "day")])
        given = [F.when((date if n.endswith("_type") and n != "id_type" else e["name"] == "article-id"), T.raw_attribute(e["tag"], a)).alias(n) for n, a in ATTRIBUTES.items()]
        read = lambda v: F.struct(e["name"].alias("name"), *given, *[F.get(v["t"], F.lit(i)).alias(n) for i, n in enumerate(("text", "year", "month", "day"))])
        return let(read, t=F.transform(raw, value))

    def fields(v: Column) -> Column:
        ids, dates = v["ids"], v["dates"]
        by_use = lambda use: item(ids, lambda n: n["use"] == f"{collection}-{use}" if use != "previous-pid" else n["use"] == use)["text"]
        by_type = lambda kind: item(ids, lambda n: n["id_type"] == kind)["text"]
        plain = {n: F.get(named(v, n), F.lit(0))["text"] for n in names}
        year = F.coalesce(*[of_kind(dates, kind)["year"] for kind in BUNDLE_YEARS])
        issn = first_issns(v["issns"])
        known = {
            "pid_v1": by_use("v1"), "pid_v2": by_use("v2"), "pid_v3": by_use("v3"), "aop_pid": by_use("previous-pid"), "publisher_id": v["publisher_id"], "other": by_type("other"), "acron": v["acron"], "elocation_id": plain["elocation-id"],
            "doi": F.regexp_replace(by_type("doi"), r"^https?://(dx\.)?doi\.org/", ""), "issn": F.coalesce(issn["eissn"], issn["pissn"], issn["issn"]), **{n: nonzero(plain[n]) for n in names[:-1]},
            "languages": v["languages"], "assets": v["assets"], "document_date": document_date(dates), "bundle_date": bundle_date(dates), "bundle_year": year,
        }
        return F.struct(*[c.alias(n) for n, c in known.items()])

    def of_document(x: Column) -> Column:
        main = item(T.elements(x, "article-id"), lambda e: ~T.raw_attribute(e["tag"], "specific-use").eqNullSafe(collection) & (T.raw_attribute(e["tag"], "pub-id-type") == "publisher-id"))
        found = {"issns": issn_nodes(x), "acron": acronym(x), "languages": language_codes(x), "assets": asset_names(x), "publisher_id": value(main["inner"])}
        return let(lambda v: let(fields, nodes=v["nodes"], ids=named(v, "article-id"), dates=named(v, "pub-date"), **{n: v[n] for n in found}), nodes=F.transform(T.children(T.first(x, "article-meta")), node), **found)

    def checked(v: Column) -> Column:
        return let(lambda w: F.struct(*[w["found"][n].alias(n) for n in FIELDS], v["fault"].alias("error")), found=F.when(v["fault"].isNull(), of_document(v["x"])))

    return let(checked, fault=T.fault(xml), x=T.plain(xml))
