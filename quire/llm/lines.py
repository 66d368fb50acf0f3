"""Line dedup by site-relative frequency, with DataFrame functions only.

A line is boilerplate on a host if the share of the host's pages that contain it exceeds a ratio. Pages count a line
once; counts are aggregated per task before they are shuffled, under 16-byte digests in place of the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import cut

#: Of lines of sf0.1 on over 1 % of a host's pages nearly all stand in many different texts; those on fewer are mostly of copied texts.
RATIO = 0.01
#: On small hosts two pages with a line are mostly copies of one text; three are not, and a host of three pages isn't exempt.
LEAST_PAGES = 3
#: Boilerplate lines of all hosts that are broadcast at most (16 bytes each, and their host).
BROADCAST_LINES = 50_000


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def digest(line: Column) -> Column:
    """16 bytes of the line without the white space at its ends; null for a blank line, which is never boilerplate."""
    bare = F.btrim(line, F.lit(" \t\r\f\x0b"))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def drop_boilerplate(docs: DataFrame, *, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """docs with every boilerplate line taken out of text, and lines_dropped (long), the number of such lines.

    A line goes where over `ratio` of the host's pages, and at least `least_pages` of them, contain it. Blank lines
    stay. A null text stays null with 0 dropped; a null host is a host of its own; repeated rows are pages of their
    own. Documents keep all other columns (one named lines_dropped is replaced), and none is dropped: a text of
    boilerplate alone becomes empty, an empty or very long one is treated like any other. An empty table gives none.
    """
    on = F.col(f"`{host}`")
    pages = docs.select(F.col("doc_id").alias("__id"), on.alias("__host"), F.filter(F.array_distinct(F.transform(lines(F.col("text")), digest)), lambda d: d.isNotNull()).alias("__lines"))
    held = pages.select("__id", "__host", F.explode("__lines").alias("__line"))
    counts = held.groupBy("__host", "__line").agg(F.count(F.lit(1)).alias("__pages")).where(F.col("__pages") >= least_pages)
    totals = pages.groupBy("__host").agg(F.count(F.lit(1)).alias("__all"))
    same_host = lambda a, b: F.col(f"{a}.__host").eqNullSafe(F.col(f"{b}.__host"))
    common = counts.alias("c").join(totals.alias("t"), same_host("c", "t")).where(F.col("__pages") > F.col("__all") * F.lit(str(ratio)).cast("decimal(12,10)")).select("c.__host", "__line")
    common = cut(common)
    names = [c for c in docs.columns if c != "lines_dropped"]
    if common.count() <= BROADCAST_LINES:  # counted, so safe to broadcast: documents aren't shuffled
        drops = common.groupBy("__host").agg(F.collect_set("__line").alias("__drop"))
        found = docs.alias("d").join(F.broadcast(drops).alias("x"), F.col(f"d.`{host}`").eqNullSafe(F.col("x.__host")), "left")
    else:  # each document gets those of its own lines
        hits = held.alias("h").join(common.alias("b"), same_host("h", "b") & (F.col("h.__line") == F.col("b.__line"))).select("h.__id", "h.__host", "h.__line")
        hits = hits.groupBy("__id", "__host").agg(F.collect_set("__line").alias("__drop"))
        found = docs.alias("d").join(hits.alias("x"), F.col("d.doc_id").eqNullSafe(F.col("x.__id")) & F.col(f"d.`{host}`").eqNullSafe(F.col("x.__host")), "left")
    kept = F.filter(lines(F.col("d.text")), lambda line: ~F.coalesce(F.array_contains(F.col("x.__drop"), digest(line)), F.lit(False)))
    text = F.when(F.col("x.__drop").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n"))
    gone = F.when(F.col("x.__drop").isNull(), 0).otherwise(F.size(lines(F.col("d.text"))) - F.size(kept))
    return found.select(*[text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in names], gone.cast("long").alias("lines_dropped"))


ORACLE = f"""
WITH l AS (SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS bare
           FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
c AS (SELECT source, bare, count(DISTINCT doc_id) AS pages FROM l WHERE bare <> '' GROUP BY ALL),
t AS (SELECT source, count(*) AS total FROM documents GROUP BY ALL),
b AS (SELECT c.source, c.bare FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE pages >= {LEAST_PAGES} AND pages > total * {RATIO}),
k AS (SELECT l.doc_id, l.pos, l.line, b.bare IS NOT NULL AS gone FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.bare = b.bare),
r AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*) FILTER (WHERE gone) AS lines_dropped FROM k GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text, d.lang, d.source, d.n_chars, coalesce(r.lines_dropped, 0) AS lines_dropped
FROM documents d LEFT JOIN r USING (doc_id)"""
