"""What an anchor or a link stands for, from its name, its text or the file that it leads to.

Rules are (clue, tag) rows; of several that fit the longest clue counts, then the last by clue and tag. Distinct texts
meet rules by equality of a part as long as a clue, so that rules are never paired with all texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Types of references whose name isn't the element's, and what links to other parts of a text begin with.
REFERENCE_TYPES = {"table-wrap": "table", "ref": "bibr"}
OTHER_SECTIONS = ["text"]


def reference_type(tag: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in REFERENCE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, tag), tag)


def typed(tag: Column) -> Column:
    """(tag, ref_type) of a tag; null for null."""
    return F.when(tag.isNotNull(), F.struct(tag.alias("tag"), reference_type(tag).alias("ref_type")))


def kind(tag: str, ref_type: str) -> Column:
    return F.struct(F.lit(tag).alias("tag"), F.lit(ref_type).alias("ref_type"))


def clue_lengths(rules: DataFrame, least: int = 1) -> list[int]:
    """The lengths that clues have: no more numbers than the longest clue has characters."""
    return sorted(r[0] for r in rules.select(F.length("clue")).distinct().collect() if r[0] is not None and r[0] >= least)


def meeting(texts: DataFrame, text: str, rules: DataFrame, parts: Column) -> DataFrame:
    """texts with each rule whose clue is one of their parts."""
    return texts.withColumn("__part", F.explode(F.array_distinct(F.array_compact(parts)))).join(rules.select("clue", "tag", F.col("clue").alias("__part")), "__part").drop("__part")


def beginnings(text: Column, sizes: list[int]) -> Column:
    return F.array(*[F.when(F.length(text) >= n, F.substring(text, 1, n)) for n in sizes]) if sizes else F.array().cast("array<string>")


def substrings(text: Column, sizes: list[int]) -> Column:
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))).otherwise(F.array().cast("array<string>"))
    return F.concat(*[of(n) for n in sizes]) if sizes else F.array().cast("array<string>")


def longest(pairs: DataFrame, key: str, name: str, *more: str) -> DataFrame:
    """Per key the rule that counts, as a struct."""
    return pairs.groupBy(key).agg(F.max(F.struct(F.length("clue").alias("n"), "clue", "tag", *more)).alias(name))


def from_names(anchors: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """(name, tag, ref_type) of distinct anchor names: by a clue that begins it, else one of several letters within it.

    A clue of one letter counts only before a number. A name that begins with no letter or number is a symbol's; any
    other that no rule fits is a footnote's. An empty name has nulls.
    """
    n = F.col(name)
    names = anchors.select(name).distinct()
    begun = longest(meeting(names, name, rules, beginnings(n, clue_lengths(rules))), name, "__begun")
    held = longest(meeting(names.join(begun, name, "left_anti"), name, rules, substrings(n, clue_lengths(rules, 2))), name, "__held")
    out = names.join(begun, name, "left").join(held, name, "left")
    short = (F.col("__begun.n") == 1) & ~F.substr(n, F.lit(2)).rlike(r"^\d+$")
    found = F.when(n.rlike(r"^\p{L}"), F.when(short, kind("fn", "fn")).otherwise(typed(F.coalesce("__begun.tag", "__held.tag"))))
    other = F.when(n.rlike(r"^[^\p{L}\p{N}]"), kind("symbol", "fn")).otherwise(kind("fn", "fn"))
    return out.select(name, F.when(n != "", F.coalesce(found, other)).alias("__k")).select(name, "__k.tag", "__k.ref_type")


def from_texts(links: DataFrame, text: str, rules: DataFrame) -> DataFrame:
    """(text, tag, ref_type) of distinct link texts: by a clue of several letters after what isn't a letter or number.

    Of the others a lone letter or one without a letter is a footnote's; further words tell some; the rest is undefined.
    A blank text has nulls.
    """
    texts = links.select(text).distinct().withColumn("__t", F.lower(F.trim(F.col(text)))).withColumn("__b", F.regexp_replace("__t", r"^[^\p{L}\p{N}]+(?=.)", ""))
    sizes = clue_lengths(rules, 2)
    begun = longest(meeting(texts, text, rules, beginnings(F.col("__b"), sizes)), text, "__begun")
    t, b = F.col("__t"), F.col("__b")
    has = lambda *words: F.forall(F.array(*[F.lit(w) for w in words]), lambda w: ~F.contains(b, w)) == F.lit(False)
    said = F.when(F.length(t) == 1, kind("fn", "fn")).when(F.substring(t, 1, 4).isin(OTHER_SECTIONS), kind("target", "other")).when(has("corresp", "address", "endereço"), kind("corresp", "corresp")).when(has("image"), kind("fig", "fig")).when(has("annex"), kind("app", "app")).otherwise(kind("undefined", "undefined"))
    other = F.when(t.rlike(r"^\p{L}"), said).otherwise(kind("fn", "fn"))
    out = texts.join(begun, text, "left")
    return out.select(text, F.when(t != "", F.coalesce(typed(F.col("__begun.tag")), other)).alias("__k")).select(text, "__k.tag", "__k.ref_type")


def from_files(files: DataFrame, path: str, rules: DataFrame, element: str | None = None) -> DataFrame:
    """(path, tag, ref_type, id) of distinct file paths: by a clue in the name that no letters touch and something follows.

    id is the clue with what follows; the whole name where it is the clue. With element, its rules and its first letter
    count. A path that no rule fits has nulls.
    """
    if element:
        rules = rules.where(F.col("tag") == element).select("clue", "tag").unionByName(rules.sparkSession.createDataFrame([(element[0], element)], "clue string, tag string"))
    paths = files.select(path).distinct().withColumn("__name", T.stem_and_extension(F.col(path))["stem"])
    pairs = meeting(paths, path, rules, substrings(F.col("__name"), clue_lengths(rules)))
    name, clue = F.col("__name"), F.col("clue")
    before = F.split_part(name, clue, F.lit(1))
    after = F.substr(name, F.length(before) + F.length(clue) + 1)
    first = F.split_part(after, clue, F.lit(1))
    stands = ~before.rlike(r"\p{L}$") & ~first.rlike(r"^\p{L}") & (first != "")
    id_ = F.when(name == clue, name).when(stands, F.concat(clue, F.replace(after, clue, F.lit(""))))
    best = longest(pairs.withColumn("id", id_).where("id is not null"), path, "__best", "id")
    return paths.select(path).join(best, path, "left").select(path, "__best.tag", reference_type(F.col("__best.tag")).alias("ref_type"), "__best.id")


def link_groups(links: DataFrame) -> DataFrame:
    """(doc, kind, key, pos) of links (doc, pos, href, text): by text those within the document and those out of it, and by file name."""
    href = F.trim("href")
    inside = F.startswith(href, F.lit("#"))
    local = (href != "") & ~inside & ~href.rlike("[:@]")
    by_text = links.where("text <> ''").select("doc", F.when(inside, "text inside").otherwise("text outside").alias("kind"), F.col("text").alias("key"), "pos")
    by_file = links.where(local).select("doc", F.lit("file").alias("kind"), T.stem_and_extension(href)["stem"].alias("key"), "pos")
    return by_text.unionByName(by_file)


def image_path(location: Column) -> Column:
    """Paths to images of the older collection under /img/revistas; links elsewhere and within a page stay as they are."""
    theirs = location.rlike("fbpe|revistas|img") & ~location.rlike("^#|:")
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(location, "^img", "/img"), r"\s+", ""), "/img/fbpe", "/img/revistas")
    from_root = F.regexp_extract(path, "(/img/revistas.*)$", 1)
    return F.when(theirs, F.when(from_root != "", from_root).otherwise(path)).otherwise(location)
