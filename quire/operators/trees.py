"""XML documents as rows: every node an interval of its text, so that relations between nodes are equi-joins.

A node has the place of its first character (start, from 1) and that after its last (end), its depth, its parent's start and
its position among its siblings. Parent and child meet by (document, parent = start), neighbours by (document, parent,
position), descendants by start and end. All windows run within a document over its tags, with one shuffle for both.
Operators take the nodes as `every` where they are written already, so that they aren't worked out for each of its joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import xmltree as T
from ..functions.binding import let
from ..sources import shared

COMMENT = "#comment"
#: Documents whose tokens a task sorts, about.
DOCUMENTS = 1000


def routed(docs: DataFrame, xml: str) -> tuple[DataFrame, DataFrame]:
    """(docs whose xml is well formed, the others with `error`, where and why it breaks)."""
    judged = docs.withColumn("error", T.fault(F.col(xml)))
    return judged.where("error is null").drop("error"), judged.where("error is not null")


def nodes(docs: DataFrame, key: str, xml: str, total: int | None = None) -> DataFrame:
    """Elements and comments of well-formed documents: (key, start, end, depth, parent, position, name, tag).

    name is the element's, or #comment; tag its start tag, or the whole comment. The root has depth 1, parent 0 and position
    1. Documents that break are left out (`routed` has them); key names one document. The declaration and DOCTYPE aren't
    counted: places are those of `xmltree.bare`. total: the number of docs or more, if known.
    """
    text = T.bare(F.col(xml))
    rows = docs.where(T.fault(F.col(xml)).isNull()).select(key, F.posexplode(T.tokens(text)).alias("n", "tag"))
    rows = rows.select(key, "n", F.length("tag").alias("size"), T.kind(F.col("tag")).alias("kind"), F.when(F.col("tag").startswith("<"), F.col("tag")).alias("tag"))
    # windows sort what a task has: tokens are dealt over tasks by the number of documents
    rows = rows.repartition(shared.tasks(docs, DOCUMENTS, total), key)
    order = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("kind") == T.START, 1).when(F.col("kind") == T.END, -1).otherwise(0)
    rows = rows.select("*", (F.sum("size").over(order) - F.col("size") + 1).cast("int").alias("start"), F.sum(step).over(order).cast("int").alias("open"))
    noted = (F.col("kind") != T.TEXT) & ((F.col("kind") != T.OTHER) | F.col("tag").startswith("<!--"))
    # the depth of an element is that inside its start tag; of others it is one more than is open around them
    depth = F.when(F.col("kind") == T.START, F.col("open")).otherwise(F.col("open") + 1)
    # a start tag also stands at the depth below, where it is the parent of what follows until the next
    at = F.array(depth, F.when(F.col("kind") == T.START, depth + 1))
    rows = rows.where(noted).select("*", F.posexplode(F.filter(at, lambda d: d.isNotNull())).alias("opener", "depth"))
    level = Window.partitionBy(key, "depth").orderBy("n")
    parent = F.last(F.when(F.col("opener") == 1, F.col("start")), ignorenulls=True).over(level)
    after = F.lead(F.col("start") + F.col("size")).over(level)
    rows = rows.withColumns({"parent": F.coalesce(parent, F.lit(0)), "end": F.when(F.col("kind") == T.START, after).otherwise(F.col("start") + F.col("size"))})
    rows = rows.where((F.col("opener") == 0) & (F.col("kind") != T.END))
    place = F.row_number().over(Window.partitionBy(key, "parent").orderBy("start"))
    name = F.when(F.col("kind") == T.OTHER, COMMENT).otherwise(T.name_of(F.col("tag")))
    return rows.select(key, "start", "end", "depth", "parent", place.alias("position"), name.alias("name"), "tag")


def with_parent(rows: DataFrame, every: DataFrame, key: str, prefix: str = "parent_") -> DataFrame:
    """rows with start, end, name and parent of the node that their column `parent` names, under a prefix; nulls at the root."""
    side = every.select(key, F.col("start").alias("parent"), *[F.col(c).alias(prefix + c) for c in ("start", "end", "name", "parent", "position")])
    return rows.join(side, [key, "parent"], "left")


def with_neighbour(rows: DataFrame, every: DataFrame, key: str, by: int, prefix: str) -> DataFrame:
    """rows with start, end, name and tag of the sibling `by` places on (-1: the one before), under a prefix; nulls without one."""
    side = every.select(key, "parent", (F.col("position") - by).alias("position"), *[F.col(c).alias(prefix + c) for c in ("start", "end", "name", "tag")])
    return rows.join(side, [key, "parent", "position"], "left")


def text_in(xml: Column, span: Column) -> Column:
    """All text inside a span of xml (without a declaration)."""
    return T.decoded(F.regexp_replace(F.regexp_replace(F.substr(xml, span["start"], span["end"] - span["start"]), "(?s)<!--.*?-->", ""), T.TAG, ""))


def with_text(rows: DataFrame, docs: DataFrame, key: str, xml: str, columns: list[str]) -> DataFrame:
    """(key, start, end, columns, text) of these nodes, text being all text inside them; a document's text is read once for all of its nodes."""
    spans = rows.groupBy(key).agg(F.collect_list(F.struct("start", "end", *columns)).alias("spans"))  # one document's
    whole = docs.select(key, T.bare(F.col(xml)).alias("__xml")).join(spans, key)
    found = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), *[s[c].alias(c) for c in columns], text_in(F.col("__xml"), s).alias("text")))
    return whole.select(key, F.inline(found))


def outermost(spans: DataFrame, key: str) -> DataFrame:
    """(key, __spans): a document's spans (start, end) that don't lie in another, in order."""
    order = Window.partitionBy(key).orderBy("start", F.desc("end"))
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    outer = spans.select(key, "start", "end").distinct().withColumn("__before", before).where("__before is null or __before <= start")
    return outer.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))  # one document's


def cut(xml: Column, spans: Column) -> Column:
    """xml (without a declaration) without what lies in spans, which are in order."""

    def rest(v: Column) -> Column:
        since = lambda i: F.coalesce(F.get(v["spans"], i - 1)["end"], F.lit(1))
        gaps = F.transform(v["spans"], lambda s, i: F.substr(v["text"], since(i), s["start"] - since(i)))
        return F.concat(F.array_join(gaps, ""), F.substr(v["text"], F.element_at(v["spans"], -1)["end"]))

    return let(rest, text=T.bare(xml), spans=spans)


def without_spans(docs: DataFrame, spans: DataFrame, key: str, xml: str) -> DataFrame:
    """docs with what lies in their spans (key, start, end) cut out of xml, and n_removed, the number of spans that don't lie in another."""
    out = docs.join(outermost(spans, key), key, "left")
    whole = F.col("__spans").isNull()
    return out.withColumns({xml: F.when(whole, F.col(xml)).otherwise(cut(F.col(xml), F.col("__spans"))), "n_removed": F.coalesce(F.size("__spans"), F.lit(0))}).drop("__spans")


def link(tag: Column) -> Column:
    """The name that an anchor's href within the document leads to; null for any other."""
    href = T.attribute(tag, "href")
    return F.when(href.startswith("#"), F.substr(href, F.lit(2)))


def note_labels(docs: DataFrame, key: str, xml: str, every: DataFrame | None = None) -> DataFrame:
    """Anchors that stand right before a link elsewhere with the same label (xml_text): a note's own anchor and its way back.

    (key, anchor, target, label): at a[@name=anchor], whose next sibling is a[@href='#target'].
    """
    every = nodes(docs, key, xml) if every is None else every
    anchors = every.where(F.col("name") == "a").select(key, "parent", "position", T.attribute(F.col("tag"), "name").alias("anchor"), T.attribute(F.col("tag"), "xml_text").alias("label")).where("anchor is not null")
    links = every.where(F.col("name") == "a").select(key, "parent", (F.col("position") - 1).alias("position"), link(F.col("tag")).alias("target"), T.attribute(F.col("tag"), "xml_text").alias("label"))
    pairs = anchors.join(links.where("target is not null"), [key, "parent", "position", "label"])
    return pairs.where("anchor <> target").select(key, "anchor", "target", "label")


def appendix_labels(docs: DataFrame, key: str, xml: str, every: DataFrame | None = None) -> DataFrame:
    """Appendices without a label of their own and the text of the first link with text that leads to them: (key, id, label)."""
    every = nodes(docs, key, xml) if every is None else every
    labels = every.where(F.col("name") == "label").select(key, F.col("parent").alias("start")).distinct()
    apps = every.where(F.col("name") == "app").join(labels, [key, "start"], "left_anti").select(key, T.attribute(F.col("tag"), "id").alias("id")).where("id is not null").distinct()
    links = every.where(F.col("name") == "xref").withColumn("id", T.attribute(F.col("tag"), "rid")).where("id is not null").join(apps, [key, "id"], "left_semi")
    said = with_text(links, docs, key, xml, ["id"]).withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " "))).where("text <> ''")
    first = said.groupBy(key, "id").agg(F.min_by("text", "start").alias("label"))
    return apps.join(first, [key, "id"], "left")


def without_references(docs: DataFrame, key: str, xml: str, references: str, every: DataFrame | None = None) -> DataFrame:
    """docs without the paragraphs that end a reference by a comment `end-ref`, if they are as many as the document has references.

    Such a paragraph or list item is the comment's parent, else its grandparent, else the item right before it. The heading
    right before the first comment `ref` goes with them where its text begins with REF. n_removed counts what went.
    """
    # documents without such a comment, or without references, stay as they are
    some = docs.where(F.contains(xml, F.lit("end-ref")) & (F.col(references) > 0))
    every = shared.written(nodes(some, key, xml, docs.count()), "nodes") if every is None else every
    said = every.where(F.col("name") == COMMENT).withColumn("said", F.trim(F.regexp_extract("tag", "(?s)^<!--(.*)-->$", 1)))
    ends = with_parent(said.where("said = 'end-ref'"), every, key, "p_")
    ends = with_parent(ends.withColumnRenamed("parent", "own").withColumn("parent", F.col("p_parent")), every, key, "g_").drop("parent").withColumnRenamed("own", "parent")
    ends = with_neighbour(ends, every, key, -1, "b_")
    span = lambda of: F.struct(F.col(f"{of}_start").alias("start"), F.col(f"{of}_end").alias("end"))
    holder = F.when(F.col("p_name").isin("p", "li"), span("p")).when(F.col("g_name").isin("p", "li"), span("g")).when(F.col("b_name") == "li", span("b"))
    marked = ends.select(key, holder.alias("h")).where("h is not null").select(key, "h.start", "h.end").distinct()
    counted = marked.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    # of the first ref comment that has something before it
    headings = with_neighbour(said.where("said = 'ref'"), every, key, -1, "b_").where("b_start is not null").groupBy(key).agg(F.min_by(F.struct(F.col("b_start").alias("start"), F.col("b_end").alias("end"), F.col("b_name").alias("name")), "start").alias("__h"))
    # a document meets its spans once; its heading is read where it is
    out = docs.join(outermost(marked, key).join(counted, key).join(headings, key, "left"), key, "left")
    h = F.col("__h")
    heading = F.when(h["name"] != COMMENT, F.upper(F.ltrim(text_in(T.bare(F.col(xml)), h))).startswith("REF"))
    around = F.exists("__spans", lambda s: (s["start"] <= h["start"]) & (s["end"] >= h["end"]))
    beside = F.filter("__spans", lambda s: (s["start"] < h["start"]) | (s["end"] > h["end"]))
    spans = F.when(heading & ~around, F.array_sort(F.concat(beside, F.array(F.struct(h["start"].alias("start"), h["end"].alias("end")))))).otherwise(F.col("__spans"))
    out = out.withColumn("__spans", F.when(F.col("__n") == F.col(references), spans))
    whole = F.col("__spans").isNull()
    return out.withColumns({xml: F.when(whole, F.col(xml)).otherwise(cut(F.col(xml), F.col("__spans"))), "n_removed": F.coalesce(F.size("__spans"), F.lit(0))}).drop("__spans", "__n", "__h")
