"""WARC archives of pages, and their index by external merge.

Archives are written by Spark's text sink (gzip; a record per row, its separator the two line ends that close a
record), so any shared file system and its commit protocol serve. Readers parse by Content-Length, never by the
separator. Each archive's captures form a run sorted by URL key and time; runs are cut at common splitters, and the
pieces of a key range undergo a k-way merge in a loser tree, which gives globally ordered capture histories.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import cut, fresh_path

#: (bytes of HTML and URL, records of at most so many in an archive): archives stay under some 300 MB unless one record is larger.
ARCHIVES = [(1 << 16, 4096), (1 << 20, 256), (1 << 24, 16), (None, 1)]
#: Sampled captures per key range, and at most in all.
PER_RANGE, SPLITTER_SAMPLE = 50, 200_000
RANGE_ROWS = 50_000
BROADCAST_ROWS = 20_000
#: Bits of the map of shared digests: 8 MB.
BITMAP = 1 << 26
NEWLINE = "\r\n"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four groups of 40 bits, each eight digits of five bits."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Host parts reversed, then path and query in lower case, without scheme, "www.", port and fragment; null as ''."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^[a-z][a-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]*)", 1), r"^www\d*\.", "")
    rest = F.regexp_extract(bare, r"^[a-z][a-z0-9+.-]*://[^/?]*(.*)$", 1)
    return F.when(host == "", bare).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest)))


def utc(captured: Column) -> Column:
    """ISO 8601 of a timestamp in UTC, whatever the session's time zone."""
    seconds = F.unix_seconds(captured)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")).cast("string")
    part = lambda n, of: F.lpad((F.floor(seconds / n) % of + of).cast("int") % of, 2, "0")
    return F.concat(day, F.lit("T"), part(3600, 24), F.lit(":"), part(60, 60), F.lit(":"), part(1, 60), F.lit("Z"))


def maybe_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows with maybe: false only where keys lacks the row's key, by a broadcast bitmap of BITMAP bits whatever the keys' number."""
    spot = F.pmod(F.xxhash64(key), F.lit(BITMAP))
    maps = keys.groupBy(F.bitmap_bucket_number(spot).alias("__part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("__bits"))
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substr("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("__part", F.bitmap_bucket_number(spot)).join(F.broadcast(maps), "__part", "left")
    return found.withColumn("maybe", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("__part", "__bits")


def with_types(pages: DataFrame, least_bytes: int) -> DataFrame:
    """pages with payload, payload_bytes, payload_digest, record_type and refers_to."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", "captured", *[c for c in pages.columns if c == "__kind"], payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), sha1_base32(payload).alias("payload_digest"))
    same = base.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    same = cut(same.where("n > 1 and first is not null").drop("n"))
    if same.count() <= BROADCAST_ROWS:
        out = base.join(F.broadcast(same), "payload_digest", "left")
    else:  # only payloads that may be shared are shuffled
        marked = maybe_in(base, same, "payload_digest")
        alone = marked.where("not maybe").drop("maybe").withColumn("first", F.lit(None).cast(same.schema["first"].dataType))
        out = marked.where("maybe").drop("maybe").join(same, "payload_digest", "left").unionByName(alone)
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("payload_bytes") >= least_bytes)
    return out.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("first"))).drop("first")


def record(captured: Column) -> Column:
    """The text of a WARC/1.1 record less its two closing line ends."""
    uuid = lambda c: F.regexp_replace(F.md5(F.concat(F.lit("page "), c.cast("string"))), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    header = lambda name, c: F.coalesce(F.concat(F.lit(f"{name}: "), c.cast("string"), F.lit(NEWLINE)), F.lit(""))
    page = F.col("page_id")
    revisit = F.col("record_type") == "revisit"
    # control characters in a URL would end its header early
    target = F.regexp_replace("url", r"[\x00-\x1f\x7f]", "")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{NEWLINE}Content-Type: text/html; charset=utf-8{NEWLINE}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(NEWLINE * 2))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    lines = [
        F.lit(f"WARC/1.1{NEWLINE}"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.coalesce(uuid(page), F.lit("<urn:uuid:00000000-0000-0000-0000-000000000000>"))),
        header("WARC-Date", utc(captured)),
        header("WARC-Target-URI", target),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("WARC-Refers-To", uuid(F.col("refers_to"))),
        F.when(revisit, f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{NEWLINE}").otherwise(""),
        header("X-Page", page),
        header("X-Refers-To-Page", F.col("refers_to")),
        header("X-URL-Key", F.regexp_replace(url_key(F.col("url")), r"[\x00-\x1f\x7f]", "")),
        F.lit(f"Content-Type: application/http; msgtype=response{NEWLINE}"),
        header("Content-Length", F.octet_length(block)),
        F.lit(NEWLINE),
        block,
    ]
    return F.concat(*lines)


def write_archives(pages: DataFrame, path: str, *, least_bytes: int = 0, archives: list[tuple[int | None, int]] | None = None) -> int:
    """Write pages (page_id, url, html, captured) as gzipped WARC files, bounded in bytes; the number of pages.

    Records of each size class of `archives` go to files of their own with at most as many records as it says.
    """
    archives = archives or ARCHIVES
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.coalesce(F.octet_length("url"), F.lit(0))
    kind = F.lit(len(archives) - 1)
    for i, (bound, _) in reversed(list(enumerate(archives[:-1]))):
        kind = F.when(size <= bound, i).otherwise(kind)
    counts = {r["kind"]: r["n"] for r in pages.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect()}
    typed = with_types(pages.withColumn("__kind", kind), least_bytes)
    for i in sorted(counts) or [0]:
        rows = typed.where(F.col("__kind") == i).select(record(F.col("captured")).alias("value"))
        rows.write.option("lineSep", NEWLINE * 2).option("maxRecordsPerFile", archives[i][1]).option("zlib.compress.level", "BEST_SPEED").text(f"{path}/size={i}", compression="gzip")
    return sum(counts.values())


def parse_records(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, length) of each record of an archive that arrives in chunks; at most one record is held.

    offset and length are of the record, less its closing line ends, in the archive without compression.
    """
    chunks, held, at = iter(chunks), bytearray(), 0

    def need(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while need(2) and held[:2] == b"\r\n":
            del held[:2]
            at += 2
        if not need(1):
            return
        end, seen = -1, 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not need(seen + 1):
                raise ValueError("a record's header doesn't end")
        lines = bytes(held[:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
        stop = end + 4 + int(headers["content-length"])
        if not need(stop):
            raise ValueError("a record's block is cut short")
        yield headers, bytes(held[end + 4 : stop]), at, stop
        del held[:stop]
        at += stop


def unzipped(content: memoryview, step: int = 1 << 20) -> Iterator[bytes]:
    """Chunks of a gzip file of one or more members."""
    reader = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        data = bytes(content[at : at + step])
        while data:
            yield reader.decompress(data)
            data = b""
            if reader.eof:
                data, reader = reader.unused_data, zlib.decompressobj(31)


def capture(archive: str, headers: dict[str, str], block: bytes, offset: int, length: int) -> tuple:
    """(url_key, time, page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset, length) of a record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: int(headers[k]) if k in headers else None
    if headers["warc-type"] == "revisit":
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if "sha1:" + digest != headers["warc-payload-digest"]:
            raise ValueError(f"payload of {headers['warc-record-id']} differs from its digest")
    return (headers.get("x-url-key", ""), headers.get("warc-date", ""), number("x-page"), size, digest, headers["warc-type"], number("x-refers-to-page"), archive, offset, length)


def order(c: tuple) -> tuple:
    return (c[0], c[1], c[2] is not None, c[2] or 0)


class LoserTree:
    """k-way merge of sorted runs: a tournament whose inner nodes keep the losers, log2 k comparisons per row."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs = runs
        self.at = [0] * len(runs)
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k
        for leaf in range(len(runs)):
            self._replay(leaf)

    def _key(self, run: int) -> tuple:
        """Exhausted runs come last; equal keys in order of runs."""
        if self.at[run] >= len(self.runs[run]):
            return (1,)
        return (0, order(self.runs[run][self.at[run]]), run)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner  # first to arrive here: waits for its opponent
                return
            if self._key(other) < self._key(winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            winner = self.losers[0]
            if self.at[winner] >= len(self.runs[winner]):
                return
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            self._replay(winner)


def splitters(pages: DataFrame, ranges: int) -> list[tuple]:
    """ranges - 1 (url_key, time, page_id) that cut the captures about evenly, from PER_RANGE sampled rows for each."""
    if ranges < 2:
        return []
    keys = pages.select(F.regexp_replace(url_key(F.col("url")), r"[\x00-\x1f\x7f]", "").alias("k"), F.coalesce(utc(F.col("captured")), F.lit("")).alias("t"), "page_id")
    got = sorted(order((r["k"], r["t"], r["page_id"])) for r in keys.orderBy(F.xxhash64("k", "t", "page_id")).limit(min(SPLITTER_SAMPLE, PER_RANGE * ranges)).collect())
    return sorted({got[len(got) * i // ranges] for i in range(1, ranges)}) if got else []


def read_index(spark: SparkSession, path: str, bounds: list[tuple], page_type: str = "bigint") -> DataFrame:
    """Captures of all archives under path in global order: (index_part, index_pos) ascend with url_key, time, page_id.

    A run is one archive's captures, sorted where it is read. `bounds` (sorted order() tuples) cut the runs. archive,
    record_offset and record_length say where a record stands (in the archive without compression).
    """
    fields = f"url_key string, captured string, page_id {page_type}, payload_bytes long, payload_digest string, record_type string, refers_to {page_type}, archive string, record_offset long, record_length long"
    names = [f.split()[0] for f in fields.split(", ")]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to", "record_offset", "record_length") else pa.string()) for n in names]))
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                run = sorted((capture(f"{name.split('/')[-2]}/{name.split('/')[-1]}", *r) for r in parse_records(unzipped(memoryview(content.as_buffer())))), key=order)
                pieces: dict[int, list[dict]] = {}
                for c in run:
                    pieces.setdefault(bisect_right(bounds, order(c)), []).append(dict(zip(names, c, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), pa.array([name] * len(pieces), pa.string()), pa.array(list(pieces.values()), struct)], ["index_part", "run", "captures"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("run")
        tree = LoserTree([[tuple(c[n] for n in names) for c in run] for run in rows["captures"]])
        out = pd.DataFrame(list(tree), columns=names)
        out["page_id"], out["refers_to"] = out["page_id"].astype("Int64"), out["refers_to"].astype("Int64")
        out.insert(0, "index_part", rows["index_part"].iat[0])
        out.insert(1, "index_pos", range(len(out)))
        return out

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    pieces = files.mapInArrow(runs, f"index_part int, run string, captures array<struct<{', '.join(f.replace(' ', ': ', 1) for f in fields.split(', '))}>>")
    return pieces.groupBy("index_part").applyInPandas(merge, f"index_part int, index_pos long, {fields}")


def archive(pages: DataFrame, path: str | None = None, *, least_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html, captured) to archives under path and return their merged index.

    Of records with equal payloads of at least least_bytes, the one with the largest page_id is a response and the
    others are revisits that refer to it; rows that repeat that largest page_id are responses too. A null html is an
    empty payload; null ids and URLs stay null or empty. Very large pages go to archives of their own. Rows that repeat
    a page_id are records with one record id, captures each. Other columns are left out, whatever their names. An empty
    table gives an empty index.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    bounds = splitters(pages, max(1, -(-write_archives(pages, path, least_bytes=least_bytes) // RANGE_ROWS)))
    return read_index(spark, path, bounds)
