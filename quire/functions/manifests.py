"""Manifests of journals' issues and of documents, as structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dates as D
from . import ids as I
from . import records as R
from .binding import let

# Media types by extension.
MEDIA_TYPES = {".pdf": "application/pdf", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".gif": "image/gif", ".tif": "image/tiff", ".tiff": "image/tiff", ".svg": "image/svg+xml", ".xml": "text/xml", ".html": "text/html", ".zip": "application/zip", ".mp4": "video/mp4"}


def media_type(filename: Column) -> Column:
    """By the last extension, whatever its case; application/octet-stream for any other."""
    known = F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(F.regexp_extract(filename, r"(\.[^.]*)$", 1))), F.lit("application/octet-stream"))


def supplement(volume_supplement: Column, number_supplement: Column) -> Column:
    return F.coalesce(I.blank(volume_supplement), I.blank(number_supplement))


def issue(record: Column) -> Column:
    """The bundle manifest of an issue record: id, year, volume, number, supplement and months; null without an ISSN.

    months: a range where the record names one, else the month of the date, else null.
    """
    get = lambda tag, sub="_": R.field(record, tag, sub)

    def of_fields(f: Column) -> Column:
        vn = I.volume_and_number(f["volume"], f["number"])
        return let(lambda x: of_parts(f, x), day=D.partial_date(f["date"]), vn=vn, extra=supplement(f["vs"], f["ns"]), named=D.month_range(f["months"]))

    def of_parts(f: Column, x: Column) -> Column:
        start, end = x["named"]["start"], x["named"]["end"]
        span = F.when(start.isNotNull() & (start != end), F.struct(start.alias("start"), end.alias("end")))
        month = I.blank(x["day"]["month"]).try_cast("int")
        months = F.struct(F.when(span.isNull(), F.coalesce(start, month)).alias("month"), span.alias("range"))
        id_ = I.bundle_id(f["issn"], x["day"]["year"], f["volume"], f["number"], x["extra"])
        return F.when(f["issn"].isNotNull(), F.struct(id_.alias("id"), x["day"]["year"].alias("publication_year"), x["vn"]["volume"].alias("volume"), x["vn"]["number"].alias("number"), x["extra"].alias("supplement"), months.alias("publication_months")))

    return let(of_fields, issn=get("v35"), date=get("v65"), volume=get("v31"), number=get("v32"), vs=get("v131"), ns=get("v132"), months=get("v43", "m"))


def issue_kind(record: Column) -> Column:
    """pressrelease, ahead or regular."""
    return F.when(R.field(record, "v41") == "pr", "pressrelease").when(F.lower(R.field(record, "v32")) == "ahead", "ahead").otherwise("regular")


def document(pid: Column, url: Column, stamp: Column, assets: Column, renditions: Column) -> Column:
    """The manifest of a document's first version; null without its id.

    assets: array of (asset_id, url); renditions: array of (filename, url, size_bytes, lang).
    """
    dated = F.map_from_entries(F.transform(assets, lambda a: F.struct(a["asset_id"], F.array(F.array(stamp, a["url"])))))
    files = F.transform(renditions, lambda r: F.struct(r["filename"].alias("filename"), media_type(r["filename"]).alias("mimetype"), r["lang"].alias("lang"), F.array(F.struct(stamp.alias("timestamp"), r["url"].alias("url"), r["size_bytes"].alias("size_bytes"))).alias("data")))
    version = F.struct(url.alias("data"), dated.alias("assets"), stamp.alias("timestamp"), files.alias("renditions"))
    return F.when(I.blank(pid).isNotNull(), F.struct(pid.alias("id"), F.array(version).alias("versions")))


def completed_dates(document_date: Column, bundle_date: Column, new_document: Column, new_bundle: Column, ahead: Column) -> Column:
    """(document, bundle) dates: missing ones filled in; an article ahead of print has no bundle date."""
    missing = lambda d: F.coalesce(I.blank(d), F.lit("")) == ""
    bundle = F.when(~ahead, F.when(missing(bundle_date), new_bundle).otherwise(bundle_date))
    return F.struct(F.when(missing(document_date), new_document).otherwise(document_date).alias("document"), bundle.alias("bundle"))


def bundle(id_: Column, stamp: Column) -> Column:
    """The manifest of a bundle without documents yet; null without its id."""
    return F.when(I.blank(id_).isNotNull(), F.struct(id_.alias("id"), stamp.alias("created"), stamp.alias("updated"), F.array().cast("array<string>").alias("items"), F.create_map().cast("map<string,string>").alias("metadata")))


def dated(stamp: Column, value: Column) -> Column:
    """A metadata value in the form that later ones are added to: pairs of a time and a value."""
    return F.array(F.struct(stamp.alias("date"), value.alias("value")))


def article_result(meta: Column, journal: Column) -> Column:
    """What an imported document's issue is found by, from metadata() and journal_meta(): eleven texts, null where unknown."""
    of = lambda name: F.get(F.filter(journal, lambda e: e["key"] == name), F.lit(0))["value"]
    fields = {
        "pid_v3": meta["pid_v3"], "eissn": of("eissn"), "pissn": of("pissn"), "issn": of("issn"), "acron": of("acron"), "pid": meta["pid_v2"], "year": I.blank(meta["bundle_date"]["year"]), "volume": meta["volume"],
        "number": I.issue_number(meta["issue"]), "supplement": I.issue_supplement(meta["issue"]), "order": I.order_of(meta["pid_v2"], meta["other"], meta["fpage"]),
    }
    return F.struct(*[c.alias(n) for n, c in fields.items()])
