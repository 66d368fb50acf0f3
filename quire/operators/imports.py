"""Import of document packages as one unit: documents, their changes, ids and places in bundles appear together or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids as I
from ..functions import manifests as MA
from ..functions import xmledit as E
from ..functions import xmlmeta as X
from . import snapshots, store

DOCUMENTS = "id string, package string, xml string, digest string, imported string"
CHANGES = "timestamp string, entity string, id string, content_sha1 string"
PIDS = "v2 string, v3 string, previous string"
PLACES = "bundle_id string, id string, position string"
SCHEMAS = {"documents": DOCUMENTS, "changes": CHANGES, "pids": PIDS, "places": PLACES}


def described(packages: DataFrame) -> DataFrame:
    """packages (package, xml, ...) with the document's metadata and what keeps it out: error, null for a sound document."""
    x = F.col("xml")
    rows = packages.select("*", X.metadata(x).alias("meta")).withColumn("journal", X.journal_meta(x, F.col("meta.error")))
    fault = F.when(x.isNull(), "there is no XML file in the package").when(F.col("meta.error").isNotNull(), F.concat(F.lit("could not parse the document: "), F.col("meta.error"))).when(F.col("meta.pid_v2").isNull() & F.col("meta.pid_v3").isNull(), "no id")
    return rows.withColumn("error", fault)


def named(rows: DataFrame, known: DataFrame, fresh: Column) -> DataFrame:
    """rows with pid_v3: the document's own, else that known for its ids, else a fresh one, and whether it is_new to the register."""
    asked = rows.withColumns({"pid_v2": F.col("meta.pid_v2"), "previous_pid": F.col("meta.aop_pid")})
    out = store.pid_pairs(asked, known.select("v2", "v3"), fresh)
    return out.withColumns({"pid_v3": F.coalesce("meta.pid_v3", "pid_v3"), "is_new": F.col("is_new") & F.col("pid_v2").isNotNull()})


def import_documents(spark: SparkSession, root: str, packages: DataFrame, stamp: str, fresh: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Import packages (package, xml, n_renditions) into the store at root; (results, errors).

    Four tables of the store get rows in one commit: documents (with their v3 id written into the XML), changes (one of
    the document, one more if it has renditions), pids (new pairs) and places (bundle and position). A document whose id
    the store has is left as it is; of packages with one id the first by name counts. results: what each sound package's
    issue is found by, whether it was imported now or before. errors: (package, error) of the others. An import that is
    broken off before its commit shows nothing, and one that is repeated adds nothing.
    """
    fresh = F.substring(F.sha2(F.concat(F.lit("document "), F.coalesce("meta.pid_v2", "package")), 256), 1, I.ID_LENGTH) if fresh is None else fresh
    stored = {t: snapshots.read(spark, root, t, schema) for t, schema in SCHEMAS.items()}
    seen = described(packages)
    commit = snapshots.Commit(spark, root)
    # every package is parsed once: what follows reads what this has written
    work = commit.write("imports", named(seen, stored["pids"], fresh).withColumn("result", MA.article_result(F.col("meta"), F.col("journal"))).withColumn("imported", F.lit(stamp)), replace=True)
    sound = work.where("error is null")
    new = sound.join(stored["documents"].select(F.col("id").alias("pid_v3")), "pid_v3", "left_anti")
    first = new.groupBy("pid_v3").agg(F.min_by(F.struct(*[c for c in new.columns if c != "pid_v3"]), "package").alias("d")).select("pid_v3", "d.*")
    xml = E.with_article_id(F.col("xml"), F.col("pid_v3"), "pid-v3")
    documents = first.select(F.col("pid_v3").alias("id"), "package", xml.alias("xml"), F.sha1(F.encode(xml, "UTF-8")).alias("digest"), "imported", "meta", "journal", "pid_v2", "previous_pid", "is_new", "result", "n_renditions")
    kept = commit.write("documents", documents)
    entity = F.array(F.lit("Document"), F.when(F.coalesce("n_renditions", F.lit(0)) > 0, "DocumentRendition"))
    commit.write("changes", kept.select(F.col("imported").alias("timestamp"), F.explode(F.filter(entity, lambda e: e.isNotNull())).alias("entity"), "id", F.col("digest").alias("content_sha1")))
    commit.write("pids", kept.where("is_new").select(F.col("pid_v2").alias("v2"), F.col("id").alias("v3"), F.col("previous_pid").alias("previous")))
    bundle = I.bundle_id(F.col("meta.issn"), F.col("result.year"), F.col("result.volume"), F.col("result.number"), F.col("result.supplement"))
    commit.write("places", kept.select(bundle.alias("bundle_id"), "id", F.col("result.order").alias("position")).where("bundle_id is not null"))
    if kept.limit(1).count():
        commit.publish()
    results = sound.select("package", "pid_v3", F.col("result").dropFields("pid_v3").alias("r")).select("package", "pid_v3", "r.*")
    return results, work.where("error is not null").select("package", "error")
