"""How alike two renderings of a document are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def compare(left: DataFrame, right: DataFrame, key: str, mark: float) -> DataFrame:
    """(key, similarity, percent, below, left_text, right_text) of documents with a text on both sides.

    Texts are kept only where the similarity is at or below the mark (in percent): those are the ones to look at.
    """
    a = left.select(key, T.normalize_text(F.col("text")).alias("a"))
    b = right.select(key, T.normalize_text(F.col("text")).alias("b"))
    both = a.join(b, key).withColumn("similarity", T.jaccard(F.col("a"), F.col("b")))
    below = F.col("similarity") * 100 <= mark
    return both.select(key, "similarity", T.percent(F.col("similarity")).alias("percent"), below.alias("below"), F.when(below, F.col("a")).alias("left_text"), F.when(below, F.col("b")).alias("right_text"))


#: Rows of (item, word) that are broadcast at most; more are joined by a shuffle.
BROADCAST_WORDS = 200_000


def contained_items(docs: DataFrame, items: DataFrame, doc: str, item: str, least: float) -> DataFrame:
    """(doc, item, containment): pairs in which a document has at least the share `least` (over 0) of an item's words.

    Exact by prefix filtering: such a pair shares one of all but ceil(least * n) - 1 of the item's n words, and those
    that fewest items have are probed. If the counted rows of probed words are few enough to broadcast, a document is
    normalised once and compared where it is. Otherwise documents and items meet as rows of (document, word) and only
    those that share a probed word are fetched with all their words, once for each item that they may hold.
    """
    i = items.select(item, T.words(T.normalize_text(F.col("text"))).alias("iw")).where("size(iw) > 0")
    words = i.select(item, F.explode("iw").alias("w"))
    counted = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    rare = F.struct("n", (-F.length("w")).alias("l"), "w")  # of words as rare the longer, which documents have less often
    ranked = words.join(counted, "w").groupBy(item).agg(F.array_sort(F.collect_list(rare)).alias("by_rarity"))
    size = F.size("by_rarity")
    probe = ranked.select(item, F.explode(F.slice("by_rarity", 1, size - F.ceil(size * least).cast("int") + 1)).alias("p")).select(item, "p.w")
    of_docs = docs.select(doc, T.words(T.normalize_text(F.col("text"))).alias("dw"))
    if probe.count() <= BROADCAST_WORDS:
        pairs = of_docs.select(doc, "dw", F.explode("dw").alias("w")).join(F.broadcast(probe), "w").join(F.broadcast(i), item)
    else:
        hits = of_docs.select(doc, F.explode("dw").alias("w")).join(probe, "w").select(doc, item).distinct()
        pairs = hits.join(of_docs, doc).join(i, item)
    out = pairs.withColumn("containment", F.size(F.array_intersect("dw", "iw")) / F.size("iw"))
    return out.where(F.col("containment") >= least).select(doc, item, "containment").distinct()
