"""Readers of catalogue exports: ISO-2709 and JSON records, documents, tables and logs. All lazy and splittable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARTICLE_COLUMNS = ["pid", "aop_pid", "file_path", "date_collection", "date_created", "date_updated", "acron", "volnum", "lang"]


#: What Windows-1252 has at 0x80 to 0x9F, where Latin-1 has control characters; the rest of both is the same.
LATIN_1_CONTROLS = "".join(map(chr, range(0x80, 0xA0)))
WINDOWS_1252 = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")


def read_iso2709(spark: SparkSession, path: str) -> DataFrame:
    """(label, fields) of every record: fields is an array of (tag, value), tags without leading zeros.

    Records are split at their terminator by Spark's text reader, so large files are read in parts. Line ends inside
    a record are layout and go first. Text is Windows-1252. A record whose label or directory can't be read has null fields.
    """
    lines = spark.read.option("lineSep", "\x1d").text(path)
    record = F.regexp_replace(F.translate(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), LATIN_1_CONTROLS, WINDOWS_1252), r"[\r\n]", "")
    return lines.select(record.alias("record")).where("record <> ''").select(F.substring("record", 1, 24).alias("label"), iso_fields(F.col("record")).alias("fields"))


def iso_fields(record: Column) -> Column:
    base = F.substring(record, 13, 5).try_cast("int")
    entries = F.regexp_extract_all(F.substring(record, F.lit(25), base - 25), F.lit(r"\d{3}\d{4}\d{5}"), F.lit(0))

    def entry(e: Column) -> Column:
        size, start = F.substring(e, 4, 4).cast("int"), F.substring(e, 8, 5).cast("int")
        value = F.regexp_replace(F.substring(record, base + start + 1, size), "\x1e$", "")
        return F.struct(F.regexp_replace(F.substring(e, 1, 3), "^0+(?=.)", "").alias("tag"), value.alias("value"))

    return F.when(base.isNotNull(), F.transform(entries, entry))


def as_record(fields: Column, prefix: str = "v") -> Column:
    """Fields as a map of prefixed tag to its values, repeated tags together, in order."""
    tags = F.array_distinct(F.transform(fields, lambda f: f["tag"]))
    return F.map_from_entries(F.transform(tags, lambda t: F.struct(F.concat(F.lit(prefix), t), F.transform(F.filter(fields, lambda f: f["tag"] == t), lambda f: f["value"]))))


def read_json_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): lines that are JSON, as text and mfn, and those that aren't."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("__json", F.try_parse_json("value"))
    good = lines.where("__json is not null").select(F.try_variant_get("__json", "$.mfn", "bigint").alias("mfn"), "value")
    return good, lines.where("__json is null").select("value")


def read_documents(spark: SparkSession, path: str, suffix: str = ".xml") -> DataFrame:
    """(pid, path, content): whole text files below path; the pid is the file's name up to its first dot."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1)
    return files.select(F.regexp_extract(name, r"^([^.]*)", 1).alias("pid"), F.input_file_name().alias("path"), F.col("value").alias("content"))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, name, length, modified) of files below path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """The nine-column table of articles, without header, all text."""
    return spark.read.csv(path, schema=", ".join(f"{c} string" for c in ARTICLE_COLUMNS))


def read_import_results(spark: SparkSession, path: str) -> DataFrame:
    """Result lines of all imports; of a pid's several the one of the last file by name counts."""
    rows = spark.read.schema("pid_v3 string, pid string, eissn string, pissn string, issn string, acron string, year string, volume string, number string, supplement string, `order` string").json(path)
    rows = rows.withColumn("__file", F.input_file_name())
    names = [c for c in rows.columns if c not in ("pid", "__file")]
    return rows.where("pid is not null").groupBy("pid").agg(F.max_by(F.struct(*names), "__file").alias("r")).select("pid", "r.*")


def write_json_lines(rows: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """JSON lines; null columns are left out of their line."""
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).json(path)


def write_by_year(rows: DataFrame, date: str, path: str) -> None:
    """One folder per year of a date text; each year's rows are brought together first, split where they are many."""
    dated = rows.withColumn("year", F.regexp_extract(date, r"^\s*(\d{4})", 1))
    dated.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").json(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a text file, one a line; empty lines go."""
    return spark.read.text(path).select(F.trim("value").alias("pid")).where("pid <> ''").distinct()


def read_binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files whole, with name, length and content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", "content")
