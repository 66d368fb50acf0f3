"""Filter interaction audit: what each filter takes out in every order, from one CUBE over the failure flags.

Each text is judged once, by all filters at once. Rows are then counted by (part, flags), and a CUBE over the flags and
the part gives, for every subset of filters, how many rows survive it: the row of its grouping set in which all selected
flags are false. Any step of any order is a pair of such subsets, before and after, so that all orders together cost a
join over small tables and no further look at the texts.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut

#: Characters between words.
BLANKS = " \t\n\x0b\f\r"
#: The filter that needs the other rows: a text that a row of a smaller id has too.
COPIED = "E"
COUNTS = ("n", "good", "toxic")


def words(text: Column) -> Column:
    """Maximal runs of characters other than white space."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def few_words(text: Column, found: Column) -> Column:
    return F.size(found) < 100


def repeated_words(text: Column, found: Column) -> Column:
    return F.lit(100).cast("long") * F.size(F.array_distinct(found)) < F.lit(80).cast("long") * F.size(found)


def many_capitals(text: Column, found: Column) -> Column:
    return F.lit(100).cast("long") * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > F.lit(10).cast("long") * F.length(text)


def marks(text: Column, found: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: Failure condition of each filter that sees its own text alone, given the text and its words.
FILTERS: dict[str, Callable[[Column, Column], Column]] = {"A": few_words, "B": repeated_words, "C": many_capitals, "D": marks}


def judged(docs: DataFrame, filters: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """One row per (id, text, part): digest of the text, a flag per filter and the number n of such rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("t"))
    rows = rows.select("id", "part", "t", words(F.col("t")).alias("w"))
    flags = [f(F.col("t"), F.col("w")).alias(name) for name, f in filters.items()]
    rows = rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), *flags)
    return rows.groupBy("id", "part", "digest", *filters).agg(F.count(F.lit(1)).alias("n"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good and toxic, the number of their rows so labelled; a label counts if any row of that id has it."""
    marked = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "is_good"), ("toxic", "is_toxic"))]
    known = labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1))).groupBy(F.col("doc_id").alias("id")).agg(*marked)
    # rows without id have no label; their part of the key spreads them over the tasks
    rows = rows.withColumn("spread", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    out = rows.join(known.withColumn("spread", F.lit(0).cast("long")), ["id", "spread"], "left")
    count = lambda c: F.when(F.col(c), F.col("n")).otherwise(F.lit(0).cast("long"))
    return out.withColumns({"good": count("is_good"), "toxic": count("is_toxic")}).drop("spread", "is_good", "is_toxic")


def flag_counts(rows: DataFrame, filters: list[str]) -> DataFrame:
    """Rows by part and all flags, that of copies included: (part, flags, n, good, toxic).

    Rows of one text agree in all other flags, so copies collapse per (text, part) inside each task. Those of the least
    id, and those without id, are no copies; the least id of a text over all parts then says which of them that are.
    """
    total = [F.sum(c).alias(c) for c in COUNTS]
    firsts = F.min_by(F.struct(*COUNTS), "id")
    unnamed = [F.sum(F.when(F.col("id").isNull(), F.col(c)).otherwise(F.lit(0).cast("long"))).alias(f"{c}_unnamed") for c in COUNTS]
    # one row of the least id in each part: judged() has made rows of one id, text and part one
    texts = rows.groupBy("digest", "part", *filters).agg(*total, *unnamed, F.min("id").alias("least"), firsts.alias("first"))
    texts = texts.withColumn("first_id", F.min("least").over(Window.partitionBy("digest")))  # a row per part
    own = lambda c: F.col(f"{c}_unnamed") + F.when(F.col("least") == F.col("first_id"), F.col(f"first.{c}")).otherwise(F.lit(0).cast("long"))
    single = F.struct(F.lit(False).alias(COPIED), *[own(c).alias(c) for c in COUNTS])
    copies = F.struct(F.lit(True).alias(COPIED), *[(F.col(c) - own(c)).alias(c) for c in COUNTS])
    rows = texts.select("part", *filters, F.explode(F.array(single, copies)).alias("x")).select("part", *filters, "x.*").where("n > 0")
    return rows.groupBy("part", *filters, COPIED).agg(*total)


def survivors(counts: DataFrame, filters: list[str]) -> DataFrame:
    """(part, mask, n, good, toxic) for each subset of filters, as a mask of bits: the rows of the part that fail none of them."""
    selected = " + ".join(f"(1 - grouping({f})) * {1 << i}" for i, f in enumerate(filters))
    passed = " AND ".join(f"NOT coalesce({f}, false)" for f in filters)
    sums = ", ".join(f"sum({c}) AS {c}" for c in COUNTS)
    cube = f"SELECT part, {', '.join(filters)}, grouping(part) AS whole, CAST({selected} AS INT) AS mask, {sums} FROM {{counts}} GROUP BY CUBE(part, {', '.join(filters)})"
    found = counts.sparkSession.sql(cube, counts=counts).where(f"whole = 0 AND {passed}").select("part", "mask", *COUNTS)
    # a subset that no row survives has no row of its own
    every = counts.select("part").distinct().withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))))
    return every.join(found, ["part", "mask"], "left").na.fill(0, list(COUNTS))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """For each part (lang), each order of the filters and each step of it, what the step keeps, takes out and finds gone already.

    docs has doc_id, text and lang, labels doc_id, quality and toxic. Columns: part, filter_order, step, filter, kept,
    removed, redundant (failing the step's filter, removed earlier), unique_fails (failing that filter alone), good_lost,
    toxic_lost, shapley (what the filter takes out, summed over all orders). A null text is an empty one; a null lang
    shares the part of the empty name; a row without id has no label and is no copy, nor is a row of the least id of its
    text, repeated or not. Further columns of either table are left out, whatever their names. Texts are taken whole
    whatever their length. An empty table has no part, so no row.
    """
    filters = FILTERS if filters is None else filters
    names = [*filters, COPIED]
    counts = cut(flag_counts(labelled(judged(docs, filters), labels), list(filters)))
    alive = cut(survivors(counts, names))  # a row per part and subset
    bit = {f: 1 << i for i, f in enumerate(names)}
    steps = []
    for order in permutations(names):
        gone = 0
        for k, f in enumerate(order):
            steps.append(("".join(order), k + 1, f, gone, gone | bit[f], bit[f], sum(bit.values()) - bit[f]))
            gone |= bit[f]
    plan = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, before int, after int, alone int, others int")

    def side(mask: str) -> DataFrame:
        """Survivors of the step's subset `mask`, in columns of that name."""
        return alive.select(F.col("part"), F.col("mask").alias(mask), *[F.col(c).alias(f"{mask}_{c}") for c in COUNTS])

    rows = F.broadcast(plan).join(side("before"), "before")  # one row per step of all orders: a number of the filters alone
    for mask in ("after", "alone", "others"):
        rows = rows.join(side(mask), ["part", mask])
    whole = alive.groupBy("part").agg(F.max_by("n", "mask").alias("clean_n"), F.min_by("n", "mask").alias("all_n"))
    rows = rows.join(whole, "part").withColumn("removed", F.col("before_n") - F.col("after_n"))
    each = rows.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    out = rows.join(each, ["part", "filter"])
    return out.select(
        "part", "filter_order", "step", "filter", F.col("after_n").alias("kept"), "removed", (F.col("all_n") - F.col("alone_n") - F.col("removed")).alias("redundant"),
        (F.col("others_n") - F.col("clean_n")).alias("unique_fails"), (F.col("before_good") - F.col("after_good")).alias("good_lost"), (F.col("before_toxic") - F.col("after_toxic")).alias("toxic_lost"), "shapley",
    )


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
l AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
      (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
      + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
      + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN w.doc_id > first_id THEN 16 ELSE 0 END) AS fails
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT list_aggregate(list_transform([a, b, c, d, e], lambda i: substr('ABCDE', i, 1)), 'string_agg', '') AS filter_order, [a, b, c, d, e] AS ord, unnest([1, 2, 3, 4, 5]) AS step FROM o),
m AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS filter, CAST(1 << (ord[step] - 1) AS INT) AS own,
      CAST(coalesce(list_sum(list_transform(ord[1:step - 1], lambda i: 1 << (i - 1))), 0) AS INT) AS before FROM s),
n AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
r AS (SELECT part, filter_order, step, filter,
      CAST(coalesce(sum(n) FILTER (WHERE fails & (before | own) = 0), 0) AS BIGINT) AS kept,
      CAST(coalesce(sum(n) FILTER (WHERE fails & before = 0 AND fails & own > 0), 0) AS BIGINT) AS removed,
      CAST(coalesce(sum(n) FILTER (WHERE fails & before > 0 AND fails & own > 0), 0) AS BIGINT) AS redundant,
      CAST(coalesce(sum(n) FILTER (WHERE fails = own), 0) AS BIGINT) AS unique_fails,
      CAST(coalesce(sum(good) FILTER (WHERE fails & before = 0 AND fails & own > 0), 0) AS BIGINT) AS good_lost,
      CAST(coalesce(sum(toxic) FILTER (WHERE fails & before = 0 AND fails & own > 0), 0) AS BIGINT) AS toxic_lost
      FROM n CROSS JOIN m GROUP BY part, filter_order, step, filter)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r"""
