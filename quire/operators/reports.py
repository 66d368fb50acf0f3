"""Funnels, differences and log analysis."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let

# What the log's messages say, whatever the case, with the names of what stands in them; what each is called, and its group.
PACK_MESSAGES = [
    ("resource-not-found", "renditions", "[{pid}] - Could not find asset '{uri}' during packing XML '{xml}'"),
    ("resource-not-found", "renditions", "[{pid}] - Could not find rendition '{uri}' during packing XML '{xml}'"),
    ("xml-not-update", None, "Could not update xml '{uri}'. The exception '{exception}' was raised"),
    ("xml-not-update", None, "Could not update xml '{uri}'"),
    ("xml-not-found", None, "Could not find the XML file '{uri}'"),
    ("missing-metadata", None, 'Missing "{metadata}" into "{uri}"'),
]
IMPORT_MESSAGES = [
    ("missing-manifest", None, "No such file or directory: '{file_path}'"),
    ("xml-not-found", None, "There is no XML file into package '{package_path}'"),
    ("xml-parser-error", None, "Could not parse the '{file_path}' file"),
    ("bundle-not-found", None, "The bundle '{bundle}' was not updated"),
    ("issn-not-found", None, "No ISSN in document '{pid}'"),
    ("package-not-import", None, "Could not import package '{package_path}'"),
]
FIELDS = ("pid", "uri", "xml", "file_path", "package_path", "bundle", "exception", "metadata")
PARTS = ("date", "time", "level", "module", "message")
FORMAT = "<date> <time> <level> <module> <message>"


def literal(text: str) -> str:
    """Pattern of a text as it is; a run of blanks stands for white space."""
    return r"\s+".join(re.sub(r"([^\w\s])", r"\\\1", part) for part in re.split(" +", text))


def template(said: str, marks: str) -> tuple[list[str], str]:
    """(names, pattern) of a text with named places between two marks.

    What stands in a place goes on to the character after it: to white space where a blank follows, to the end if nothing does.
    """
    names, pattern = [], ""
    pieces = re.split(f"{re.escape(marks[0])}(\\w+){re.escape(marks[1])}", said)
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            pattern += literal(piece)
        else:
            after = pieces[i + 1][:1]
            names.append(piece)
            pattern += "(.*)" if not after else r"(\S+)" if after == " " else f"([^{re.sub(r'([^\w\s])', r'\\\1', after)}]+)"
    return names, pattern


def first_of(cases: dict[int, Column], which: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, value in cases.items():
        out = F.when(which == i, value).otherwise(out)
    return out


def first_fit(column: Column, patterns: list[str]) -> Column:
    """The number of the first pattern that is in column, -1 without one; each is looked for once at most."""
    fits = F.lit(-1)
    for i, pattern in reversed(list(enumerate(patterns))):
        fits = F.when(column.rlike(pattern), i).otherwise(fits)
    return fits


def parse_lines(lines: DataFrame, value: str = "value", messages: list | None = None, formats: tuple[str, ...] = (FORMAT,)) -> DataFrame:
    """Log lines as (date, time, level, module, message, error, error_group, and what the message names: FIELDS).

    formats say how a line is made up, parts between < and > as in FORMAT; messages are (error, group, text with {names}).
    Of either the first that fits a line counts; a part or name that it lacks is null, and lines of no format go.
    """
    made = [template(f, "<>") for f in formats]
    known = [(error, group, *template(said, "{}")) for error, group, said in (PACK_MESSAGES + IMPORT_MESSAGES if messages is None else messages)]
    shapes, said = [f"(?s)^{pattern}$" for _, pattern in made], [f"(?is){pattern}" for _, _, _, pattern in known]
    # as rows of their own, what was found isn't worked out anew by later filters
    bare = lines.select(F.inline(F.array(F.struct(F.trim(F.col(value)).alias("line"))))).select("line", F.inline(F.array(F.struct(first_fit(F.col("line"), shapes).alias("shape"))))).where("shape >= 0")
    part = {n: {i: F.regexp_extract("line", shapes[i], names.index(n) + 1) for i, (names, _) in enumerate(made) if n in names} for n in PARTS}
    parts = bare.select(*[first_of(cases, F.col("shape")).alias(n) for n, cases in part.items()])
    named = {n: {i: F.nullif(F.regexp_extract("message", said[i], names.index(n) + 1), F.lit("")) for i, (_, _, names, _) in enumerate(known) if n in names} for n in FIELDS}
    plain = {"error": {i: F.lit(error) for i, (error, *_) in enumerate(known)}, "error_group": {i: F.lit(group) for i, (_, group, *_) in enumerate(known) if group}}
    found = lambda v: F.struct(*[first_of(cases, v["rule"]).alias(n) for n, cases in {**plain, **named}.items()])
    return parts.select("*", F.inline(F.array(let(found, rule=first_fit(F.col("message"), said)))))


def errors_by_pid(parsed: DataFrame) -> DataFrame:
    """Per pid, error and group of errors: the sorted distinct uris (those of one document), the number of lines and the latest time."""
    known = parsed.where("error is not null and pid is not null")
    return known.groupBy("pid", "error", "error_group").agg(F.array_sort(F.collect_set("uri")).alias("uris"), F.count(F.lit(1)).alias("n"), F.max(F.concat_ws(" ", "date", "time")).alias("last"))


def errors_without_pid(parsed: DataFrame) -> DataFrame:
    """Errors that name no document, as they are; a missing resource always names one."""
    return parsed.where("error is not null and pid is null and error <> 'resource-not-found'").select("date", "time", "level", "error", *[f for f in FIELDS if f != "pid"])


def linking_errors(lines: DataFrame, value: str = "value") -> DataFrame:
    """Error lines of the linking step with the id of the document that lacks an ISSN, else null."""
    line = F.trim(F.col(value))
    pid = F.when(F.contains(line, F.lit("No ISSN in document")), F.substring(F.right(line, F.lit(25)), 2, 23))
    return lines.where(F.contains(F.col(value), F.lit("ERROR"))).select(line.alias("line"), pid.alias("pid"))


def known_ids(names: DataFrame, name: str, mark: str = ".", ending: str = "") -> DataFrame:
    """Distinct ids of file names with an ending, an id being what stands before the first mark; empty ones go."""
    ids = names.where(F.endswith(F.col(name), F.lit(ending))).select(F.substring_index(F.col(name), mark, 1).alias("pid"))
    return ids.where("pid <> ''").distinct()


def funnel(stages: dict[str, DataFrame], key: str, group: str) -> DataFrame:
    """Per group the number of keys that reach each stage, each counted where it is in all stages before.

    Stages are joined one after the other on the key; counting is one aggregation.
    """
    names = list(stages)
    out = stages[names[0]].select(key, group).distinct().withColumn(names[0], F.lit(True))
    for before, name in zip(names, names[1:], strict=False):
        reached = stages[name].select(key, F.lit(True).alias("__here")).distinct()
        out = out.join(reached, key, "left").withColumn(name, F.coalesce("__here", F.lit(False)) & F.col(before)).drop("__here")
    return out.groupBy(group).agg(*[F.count_if(F.col(n)).alias(n) for n in names])


def sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every key with where it is: both, left or right."""
    a, b = left.select(key).distinct().withColumn("__a", F.lit(True)), right.select(key).distinct().withColumn("__b", F.lit(True))
    side = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "left").otherwise("right")
    return a.join(b, key, "full").select(key, side.alias("side"))


def packing_errors(lines: DataFrame, value: str = "value") -> DataFrame:
    """Error lines by kind: a missing image, a missing rendition, or other; and the pid they name."""
    payload = F.from_json(F.regexp_extract(value, r"(\{.*\})", 1), "map<string,string>", {"allowSingleQuotes": "true"})
    kind = F.when(F.map_contains_key(payload, "img") | (F.map_contains_key(payload, "pid") & ~F.map_contains_key(payload, "pdf")), "image").when(F.map_contains_key(payload, "pdf"), "pdf").otherwise("other")
    return lines.where(F.contains(F.col(value), F.lit("ERROR"))).select(F.try_element_at(payload, F.lit("pid")).alias("pid"), F.coalesce(kind, F.lit("other")).alias("kind"), F.col(value).alias("line"))
