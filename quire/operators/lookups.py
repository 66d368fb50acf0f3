"""Joins by which records find each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from ..functions.binding import let
from ..sources import shared


def last_wins(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key, the last by order; null and empty keys go. Partial maxima are taken before the shuffle."""
    names = [c for c in rows.columns if c != key]
    packed = rows.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").groupBy(key).agg(F.max_by(F.struct(*names), order).alias("__row"))
    return packed.select(key, *[F.col(f"__row.{c}").alias(c) for c in names])


#: Rows that a task joins, about; keys with more are joined apart.
ROWS = 250_000


def frequent(rows: DataFrame, keys: list[Column], total: int) -> list:
    """Values that a key of rows has more than ROWS times: of `total` rows and each key total / ROWS at most."""
    if total <= ROWS:
        return []
    return [r[0] for r in rows.select(F.explode(F.array(*keys)).alias("k")).where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ROWS).collect()]


def looked_up(rows: DataFrame, key: Column, lookup: DataFrame, by: str, n: int, hot: list) -> DataFrame:
    """rows with the columns of the lookup's row of their key, nulls without one, by n tasks.

    Rows without a key and those of `hot` ones, which are joined by broadcast, are dealt by what else they have. The lookup
    has one row per key and no column of rows.
    """
    plain = [f.name for f in rows.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]  # maps and variants have no hash
    often = F.coalesce(key.isin(hot), F.lit(False))
    salt = F.when(key.isNull() | often, F.pmod(F.xxhash64(*plain), F.lit(1 << 20))).otherwise(F.lit(0).cast("long"))
    placed = rows.withColumns({"__key": F.when(~often, key), "__salt": salt}).repartition(n, "__key", "__salt")
    # always 0, but no constant, which the optimizer would take out of the join and with it out of the shuffle
    side = lookup.withColumnRenamed(by, "__key").withColumn("__salt", F.pmod(F.xxhash64("__key"), F.lit(1))).repartition(n, "__key", "__salt")
    out = placed.join(side, ["__key", "__salt"], "left").drop("__key", "__salt")
    if not hot:
        return out
    names = [c for c in lookup.columns if c != by]
    few = lookup.where(F.col(by).isin(hot)).select(F.col(by).alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in names])
    out = out.join(F.broadcast(few), key == F.col("__hot"), "left")
    return out.withColumns({c: F.coalesce(c, f"__hot_{c}") for c in names}).drop("__hot", *[f"__hot_{c}" for c in names])


def resolve_first(rows: DataFrame, keys: list[str], lookup: DataFrame, key: str, value: str) -> DataFrame:
    """rows with value of the first of several keys that the lookup has, and matched_by, the column it was found by.

    Keys are tried in order of what is found, not of what is given. The lookup has one row per key.
    """
    total, given = rows.count(), [F.trim(F.col(c)) for c in keys]
    n, hot = shared.tasks(rows, ROWS, total), frequent(rows, given, total)
    out = rows
    for i, k in enumerate(given):
        out = looked_up(out, k, lookup.select(F.col(key).alias(f"__k{i}"), F.col(value).alias(f"__v{i}")), f"__k{i}", n, hot)
    found = F.coalesce(*[F.col(f"__v{i}") for i in range(len(keys))])
    by = F.coalesce(*[F.when(F.col(f"__v{i}").isNotNull(), c) for i, c in enumerate(keys)])
    return out.withColumn(value, found).withColumn("matched_by", by).drop(*[f"__v{i}" for i in range(len(keys))])


def unmatched(rows: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(lookup.select(*on).distinct(), on, "left_anti")


#: Ids of a class that meet another class's at a time, about; a task holds the pairs of two blocks.
BLOCK = 125
#: Ids of a key and side that one task pairs, about, and how many such squares all pairs are: with more, squares become
#: larger and not more, so that what is copied into them grows with the ids and not with the pairs.
SIDE, SQUARES = 4000, 1000
#: Rows of a side for each task that puts pairs together.
PAIRED = 50_000


def alike(rows: DataFrame, id_: str, keys: str, name: str) -> DataFrame:
    """Classes of ids with the same set of keys, in blocks of about BLOCK ids: (name, the keys; name_at; name_ids)."""
    one = rows.select(F.col(id_).alias("__id"), F.explode(keys).alias("__key")).where("__key is not null").groupBy("__id").agg(F.array_sort(F.collect_set("__key")).alias(name))  # one id's
    large = one.groupBy(name).count().where(F.col("count") > BLOCK).select(name, F.ceil(F.col("count") / BLOCK).alias("__n"))  # one for BLOCK ids at most
    at = F.pmod(F.xxhash64("__id"), F.coalesce("__n", F.lit(1)))
    ids = F.collect_list(F.struct("__id")).alias("__ids")  # a null id stays
    return one.join(F.broadcast(large), name, "left").groupBy(name, at.alias(f"{name}_at")).agg(ids).select(name, f"{name}_at", F.col("__ids.__id").alias(f"{name}_ids"))


def meetings(left: DataFrame, right: DataFrame, left_id: str, left_keys: str, right_id: str, right_keys: str) -> DataFrame:
    """(__a_ids, __b_ids): blocks of ids whose classes share a key, each two blocks once, at the first key that both have.

    The blocks of a key with many ids are dealt over squares of about SIDE by SIDE ids. Only for these are blocks copied,
    once for each square of their row or column.
    """
    a, b = alike(left, left_id, left_keys, "__a"), alike(right, right_id, right_keys, "__b")
    held = lambda rows, keys, n: rows.select(F.explode(F.array_distinct(keys)).alias("__key")).groupBy("__key").agg(F.count(F.lit(1)).cast("double").alias(n))
    both = held(left, left_keys, "__na").join(held(right, right_keys, "__nb"), "__key")
    pairs = both.agg(F.sum(F.col("__na") * F.col("__nb"))).first()[0] or 0
    side = max(SIDE, (pairs / SQUARES) ** 0.5)
    tasks = max(shared.tasks(left, PAIRED) + shared.tasks(right, PAIRED), 2 * int(pairs / side**2))
    rows, columns = (F.ceil(F.col(n) / side) for n in ("__na", "__nb"))
    many = both.where(F.greatest("__na", "__nb") > side).select("__key", rows.alias("__rows"), columns.alias("__columns"))  # one for `side` keys at most

    def squares(blocks: DataFrame, c: str, own: str, other: str) -> DataFrame:
        keyed = blocks.withColumn("__key", F.explode(c)).join(F.broadcast(many), "__key", "left")
        n = {x: F.coalesce(f"{x}s", F.lit(1).cast("long")) for x in (own, other)}
        dealt = keyed.withColumn(own, F.pmod(F.xxhash64(c, f"{c}_at"), n[own])).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), n[other] - 1)))
        return dealt.select("__key", "__row", "__column", c, f"{c}_ids").repartition(tasks, "__key", "__row", "__column")

    met = squares(a, "__a", "__row", "__column").join(squares(b, "__b", "__column", "__row"), ["__key", "__row", "__column"])
    # Spark compiles no lambda into a join's loop: what becomes of two blocks leaves before the next two meet, and isn't kept for all
    return met.where(~F.exists("__a", lambda x: (x < F.col("__key")) & F.array_contains("__b", x))).select("__a_ids", "__b_ids")


def overlap_join(left: DataFrame, right: DataFrame, left_id: str, left_keys: str, right_id: str, right_keys: str) -> DataFrame:
    """Pairs of ids whose key arrays share a key, once each.

    Ids with the same keys are a class. Blocks of classes meet, and the pairs of ids come from two blocks of ids each, so
    that they are neither shuffled nor made distinct, and ids are shuffled once for each of their keys and not for each class
    that theirs meets.
    """
    met = meetings(left, right, left_id, left_keys, right_id, right_keys)
    return met.select(F.explode("__a_ids").alias(left_id), "__b_ids").select(left_id, F.explode("__b_ids").alias(right_id))


def match_ignoring_case(names: DataFrame, name: str, files: DataFrame, file: str) -> DataFrame:
    """Each name with its file: the exact one, else the first that differs by case only; null without one."""
    side = files.select(F.col(file).alias("__file"), F.upper(file).alias("__upper")).distinct()
    pairs = names.select(name).distinct().withColumn("__upper", F.upper(name)).join(side, "__upper", "left")
    best = F.min_by(F.col("__file"), F.struct(F.when(F.col("__file") == F.col(name), 0).otherwise(1), F.col("__file")))
    return pairs.groupBy(name).agg(best.alias("found"))


def first_candidate(candidates: DataFrame, group: list[str], priority: str, file: str, existing: DataFrame) -> DataFrame:
    """For each group the existing file of the least priority; groups without one are left out."""
    there = candidates.join(existing.select(file).distinct(), file, "left_semi")
    return there.groupBy(*group).agg(F.min_by(file, priority).alias(file))


def with_fallback(rows: DataFrame, first: Column, second: Column, existing: DataFrame, file: str) -> DataFrame:
    """rows with found: the first path if such a file exists, else the second if it does."""
    side = existing.select(file).distinct()
    a, b = side.withColumnRenamed(file, "__a"), side.withColumnRenamed(file, "__b")
    out = rows.join(a, first == F.col("__a"), "left").join(b, second == F.col("__b"), "left")
    return out.withColumn("found", F.coalesce("__a", "__b")).drop("__a", "__b")


def by_ordinal(rows: DataFrame, items: str, texts: DataFrame, keys: list[str], position: str, text: str) -> DataFrame:
    """The items of an array column with the text of their 1-based position, matched as text; null without one."""
    placed = rows.select(*keys, F.posexplode(items).alias("__at", "item")).withColumn(position, (F.col("__at") + 1).cast("string"))
    return placed.join(texts.select(*keys, position, text), [*keys, position], "left").select(*keys, position, "item", text)


#: Length of the parts of names by which stems find them.
GRAM = 4
#: Files of a folder that each of its assets is compared with; those of larger folders are looked up by an index.
FEW_FILES = 100


def grams(name: Column, length: int) -> Column:
    """Distinct parts of a name of that length; none if it is shorter."""
    starts = F.when(F.length(name) >= length, F.sequence(F.lit(1), F.length(name) - length + 1))
    return F.array_distinct(F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.substring(name, i, F.lit(length))))


def containing(stems: DataFrame, names: DataFrame, group: str, stem: str, name: str, q: int = GRAM) -> DataFrame:
    """(group, stem, name): the names of its group that contain a stem, by an inverted index of their parts.

    A stem is looked up by that of its parts of q characters that fewest names of the group have (shorter stems by
    themselves, an empty one by the whole group), so that the names it is compared with are nearly those that contain it;
    a part that no name has ends the search. A group with many names is spread over its parts.
    """
    asked = stems.select(group, F.col(stem).alias("__stem")).where(F.col(stem).isNotNull()).distinct()
    there = names.select(group, F.col(name).alias("__name")).where("__name is not null").distinct().join(asked.select(group).distinct(), group, "left_semi")
    # names have parts of the lengths that stems are looked up by
    lengths = F.array(*[F.struct(F.lit(n).alias("n"), grams(F.col("__name"), n).alias("g")) for n in range(1, q + 1)])
    wanted = asked.where(F.col("__stem") != "").select(group, F.least(F.length("__stem"), F.lit(q)).alias("n")).groupBy(group).agg(F.collect_set("n").alias("__ns"))  # q numbers at most
    index = there.join(wanted, group).select(group, "__name", F.explode(F.flatten(F.transform(F.filter(lengths, lambda x: F.array_contains("__ns", x["n"])), lambda x: x["g"]))).alias("__gram"))
    parts = F.when(F.length("__stem") >= q, grams(F.col("__stem"), q)).otherwise(F.array("__stem"))
    probes = asked.where(F.col("__stem") != "").select(group, "__stem", F.explode(parts).alias("__gram"))
    counts = index.groupBy(group, "__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = probes.join(counts, [group, "__gram"], "left").groupBy(group, "__stem").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__gram"))).alias("p"))
    rarest = rarest.where(F.col("p.n") > 0).select(group, "__stem", F.col("p.__gram").alias("__gram"))
    found = rarest.join(index, [group, "__gram"]).where(F.contains(F.col("__name"), F.col("__stem"))).select(group, "__stem", "__name")
    every = asked.where(F.col("__stem") == "").join(there, group).select(group, "__stem", "__name")
    return found.unionByName(every).select(group, F.col("__stem").alias(stem), F.col("__name").alias(name))


def contained_assets(assets: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """Each asset (folder, asset) with the best of its folder's files (folder, file).

    Best is the file of that name, then a .tif whose name contains the asset's stem, then any that contains it.
    Rows of a folder meet in its own row, with one shuffle of both sides, if there are few; those of folders with more than
    FEW_FILES rows are joined (`assets_of_large`), so that no row holds more.
    """
    asked, there = assets.select(folder, "asset"), files.select(folder, "file")
    n = shared.tasks(assets, ROWS) + shared.tasks(files, ROWS)
    both = asked.select(folder, F.struct("asset").alias("a"), F.lit(None).cast("struct<file:string>").alias("f")).unionByName(there.where("file is not null").select(folder, F.lit(None).cast("struct<asset:string>").alias("a"), F.struct("file").alias("f")))
    large = both.groupBy(folder).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > FEW_FILES).select(folder).where(F.col(folder).isNotNull())
    some = bool(large.limit(1).count())
    dealt = both.where(F.col(folder).isNotNull()).repartition(n, folder)
    dealt = dealt.join(large, folder, "left_anti") if some else dealt
    met = dealt.groupBy(folder).agg(F.collect_set("a").alias("a"), F.collect_set("f").alias("f")).where("size(a) > 0")  # FEW_FILES at most
    rank = lambda file: F.when(F.lower(file).endswith(".tif"), 1).otherwise(2)

    def best(a: Column) -> Column:
        def among(v: Column) -> Column:
            ranked = lambda f: F.when(f["file"] == a["asset"], F.struct(F.lit(0).alias("r"), f["file"].alias("file"))).when(F.contains(f["file"], v["stem"]), F.struct(rank(f["file"]).alias("r"), f["file"].alias("file")))
            return F.struct(a["asset"].alias("asset"), F.array_min(F.transform("f", ranked))["file"].alias("file"))

        return let(among, stem=F.regexp_replace(a["asset"], r"\.[^.]*$", ""))

    out = met.select(folder, F.inline(F.transform("a", best)))
    # without a folder an asset has no file
    out = out.unionByName(asked.where(F.col(folder).isNull()).distinct().withColumn("file", F.lit(None).cast("string")))
    return out.unionByName(assets_of_large(asked.join(large, folder, "left_semi"), there.join(large, folder, "left_semi"), folder)) if some else out


def assets_of_large(assets: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """contained_assets of folders of any size, by joins.

    Exact names meet by equality; only assets without one are compared with their folder's other files, in folders with
    many with those alone that an index of parts of names finds.
    """
    asked = assets.select(folder, "asset").distinct()
    exact = asked.join(files.select(folder, F.col("file").alias("asset")).distinct(), [folder, "asset"], "left_semi").withColumn("file", F.col("asset"))
    left = asked.join(exact, [folder, "asset"], "left_anti").withColumn("stem", F.regexp_replace("asset", r"\.[^.]*$", ""))
    rank = F.when(F.lower("file").endswith(".tif"), 1).otherwise(2)
    large = files.groupBy(folder).agg(F.count(F.lit(1)).alias("__files")).where(F.col("__files") > FEW_FILES).select(folder)
    near = left.join(files.select(folder, "file").join(large, folder, "left_anti"), folder).where(F.contains(F.col("file"), F.col("stem"))).select(folder, "stem", "file")
    far = files.select(folder, "file").join(large, folder, "left_semi")
    found = near.unionByName(containing(left, far, folder, "stem", "file")) if large.limit(1).count() else near
    best = found.groupBy(folder, "stem").agg(F.min_by("file", F.struct(rank, F.col("file"))).alias("file"))
    best = left.join(best, [folder, "stem"]).select(folder, "asset", "file").unionByName(exact)
    return asked.join(best, [folder, "asset"], "left")


def alternatives(assets: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """(folder, asset, file): the other files of an asset's folder whose names differ by the extension only."""
    stem = lambda c: F.regexp_replace(c, r"(?<=[^.])\.[^.]*$", "")
    n = shared.tasks(assets, ROWS) + shared.tasks(files, ROWS)
    a = assets.select(folder, "asset", stem(F.col("asset")).alias("__stem")).repartition(n, folder, "__stem").distinct()
    b = files.select(folder, "file", stem(F.col("file")).alias("__stem")).repartition(n, folder, "__stem").distinct()
    return a.join(b, [folder, "__stem"]).select(folder, "asset", "file")


def anchors_with_links(anchors: DataFrame, links: DataFrame) -> DataFrame:
    """Anchors (doc, name, pos) with the links (doc, href, pos) that lead to them: one self equi-join per document."""
    target = F.when(F.col("href").startswith("#"), F.substr("href", F.lit(2)))
    side = links.select("doc", target.alias("name"), F.col("pos").alias("link_pos")).where("name is not null")
    return anchors.join(side, ["doc", "name"], "left")


def longest_rule(items: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """Each name with the longest rule (clue, tag) that it begins with; ties to the smaller clue.

    Names meet rules by equality of a beginning as long as a clue: one row per name and length that clues have. A name
    for which no rule fits has null clue and tag.
    """
    lengths = sorted(r[0] for r in rules.select(F.length("clue")).distinct().collect() if r[0])
    named = items.select(name).distinct()
    begins = F.array(*[F.when(F.length(name) >= n, F.substring(F.lower(name), 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    pairs = named.select(name, F.explode(begins).alias("__begin")).join(rules.select("clue", "tag", F.lower("clue").alias("__begin")), "__begin")
    best = pairs.groupBy(name).agg(F.max_by(F.struct("clue", "tag"), F.struct(F.length("clue"), F.translate(F.col("clue"), "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba"))).alias("__rule"))
    return named.select(name).join(best, name, "left").select(name, "__rule.clue", "__rule.tag")


def issn_fixes(documents: DataFrame, pid: str, fixes: DataFrame, issn: str) -> DataFrame:
    """documents with the columns that the fixes have for the ISSN in their id (its second to tenth character); null without one."""
    return documents.join(fixes.withColumnRenamed(issn, "__issn"), F.substring(pid, 2, 9) == F.col("__issn"), "left").drop("__issn")


def propagate_label(links: DataFrame) -> DataFrame:
    """links (doc, pos, text) with label: that of the last link before with letters, if a link's text is a number only."""
    order = Window.partitionBy("doc").orderBy("pos")
    own = F.when(F.col("text").rlike(r"\p{L}"), F.trim(F.regexp_replace("text", r"\s*\d+.*$", "")))
    before = F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return links.withColumn("label", F.coalesce(own, F.when(F.col("text").rlike(r"^\s*\d+\s*$"), before)))
