"""Operator 1: WARC archives and their external index merge.

Pages are written as WARC 1.1 records, one sorted run per archive file: each
task sorts its rows by URL key and time and Spark's text writer, with the
record terminator as line separator, streams them out, so archives go to any
file system Spark knows and a lost executor's files are written again by the
commit protocol.  Archives are read back by walking record headers (payloads
may hold any bytes, the terminator included) and every stored payload's digest
is verified.  Index entries, which inherit the order of their archive, are
dealt by range of (URL key, time) and each task merges the runs that it got
with a k-way loser tree, so the concatenated tasks are one globally ordered
capture history.

Defined results: null html is an empty payload; payloads under MIN_REVISIT
bytes are never revisits; of equal payloads those rows that carry the smallest
page_id are responses (all of them, if a row is repeated), others revisit it;
a null page_id is never smallest unless all are null, and then all are
responses; a null url has an empty key; line breaks in a url become %0D/%0A,
blanks at its ends are kept; every record has an identifier of its own, and a
revisit refers to all records of its page; record_offset counts bytes of the
archive without compression, as an archive is one gzip stream;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import staged, table, work_dir

MIN_REVISIT = 100
#: Payload bytes, before compression, that an archive is meant to hold.
ARCHIVE_BYTES = 24 << 20
#: Index entries that one merging task is meant to hold.
ENTRIES_PER_TASK = 100_000
#: Duplicated digests that are broadcast; with more, the join is shuffled.
BROADCAST_ROWS = 100_000
#: Without a capture time, page i is taken to be fetched i seconds after this.
EPOCH = 1_704_067_200
CRLF = "\r\n"
ENTRY = "page_id long, url_key string, captured string, archive string, seq long, record_offset long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then path and query; fragment dropped."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    surt = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(url, pattern, 2))
    return F.coalesce(F.when(host != "", surt).otherwise(url), F.lit(""))


def page_time(page_id: Column) -> Column:
    seconds = F.lit(EPOCH) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000))
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _checked(page: DataFrame, firsts: DataFrame) -> DataFrame:
    """firsts, broadcast only if few enough."""
    return F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts


def with_revisits(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """page_id, url_key, captured, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Equal payloads are counted by digest first (a third of all rows with one
    payload is one row then) and only digests that occur twice are joined."""
    page = pages.select(
        F.col("page_id").cast("long"), F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"), (page_time(F.col("page_id")) if captured is None else captured).alias("captured"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256), "url_key": url_key(F.col("url"))})
    firsts = staged(page.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"))
    joined = page.join(_checked(page, firsts), "payload_digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("first"))).withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).drop("first")


def record(stored: Column) -> Column:
    """Text of a WARC record up to its terminator, which the writer adds."""
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), F.monotonically_increasing_id().cast("string"), F.lit(">"))),
        line("WARC-Date", F.col("captured")), line("WARC-Target-URI", F.col("url")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")), line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.when(stored, F.lit("")).otherwise(F.concat(line("WARC-Refers-To", ident(F.col("refers_to"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))),
        line("Content-Length", F.when(stored, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")), F.lit(CRLF), F.when(stored, F.col("payload")).otherwise(F.lit("")),
    )


def write_archives(captures: DataFrame, path: str) -> None:
    """One locally sorted run per gzip archive of about ARCHIVE_BYTES."""
    rows, size = captures.select(F.count(F.lit(1)), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()
    per_file = max(1, int(ARCHIVE_BYTES * max(rows, 1) / max(size, 1)))
    runs = captures.sortWithinPartitions("url_key", "captured", F.asc_nulls_first("page_id"))
    (runs.select(record(F.col("record_type") == "response").alias("value")).write
     .option("lineSep", CRLF * 2).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", per_file).text(path))


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an uncompressed WARC stream."""
    while True:
        at = stream.tell()
        version = stream.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            # one space after the colon and the line's end are the format's, all other blanks the value's
            headers[name.lower()] = value.removesuffix("\n").removesuffix("\r").removeprefix(" ")
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        yield at, headers, block


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in ENTRY.split(", ")]
    ident = lambda text: int(page) if text and (page := text[10:-1].partition(":")[0]) else None
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            archive, rows = path.as_py().rsplit("/", 1)[-1], []
            with io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 20) as stream:
                for seq, (at, h, block) in enumerate(read_records(stream)):
                    digest = h["warc-payload-digest"].removeprefix("sha256:")
                    if h["warc-type"] == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"{archive}: payload at {at} does not have its digest")
                    size = len(block) if h["warc-type"] == "response" else int(h["x-payload-length"])
                    rows.append((ident(h["warc-record-id"]), h["warc-target-uri"], h["warc-date"], archive, seq, at, size, digest, h["warc-type"], ident(h.get("warc-refers-to"))))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i in (1, 2, 3, 7, 8) else pa.int64()) for i, c in enumerate(columns)], names)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives under path; seq is the place in the run."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_entries, ENTRY).withColumn("url_key", url_key(F.col("url_key")))


class LoserTree:
    """K-way merge: inner nodes keep the loser of their match, so that one pass
    from a leaf to the root, log2 k comparisons, finds the next winner."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, len(runs)
        self.head: list = [next(r, None) for r in runs]
        self.tree = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._replay(leaf, build=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _replay(self, leaf: int, build: bool = False) -> None:
        node = (leaf + self.k) // 2
        while node > 0:
            if build and self.tree[node] < 0:
                self.tree[node] = leaf
                return
            if self._beats(self.tree[node], leaf):
                self.tree[node], leaf = leaf, self.tree[node]
            node //= 2
        self.tree[0] = leaf

    def __iter__(self) -> Iterator:
        while self.k and (item := self.head[winner := self.tree[0]]) is not None:
            yield item
            self.head[winner] = next(self.runs[winner], None)
            if self.head[winner] is not None and self.head[winner] < item:
                raise ValueError("a run is not sorted")
            self._replay(winner)


def _merged(key: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        runs: dict[str, list[int]] = {}
        for i, archive in enumerate(rows.column("archive").to_pylist()):
            runs.setdefault(archive, []).append(i)
        keys = list(zip(*(rows.column(c).to_pylist() for c in key[:2]), [-(1 << 64) if x is None else x for x in rows.column("page_id").to_pylist()], strict=True))
        order = [x[1] for x in LoserTree([iter([(keys[i], i) for i in part]) for part in runs.values()])]
        merged = rows.take(pa.array(order, pa.int64()))
        merged = merged.append_column("merge_rank", pa.array(range(len(order)), pa.int64()))
        yield from merged.combine_chunks().to_batches()

    return run


def merge_index(entries: DataFrame) -> DataFrame:
    """Globally ordered histories: (merge_partition, merge_rank) is the order of (url_key, captured, page_id)."""
    tasks = max(1, math.ceil(entries.count() / ENTRIES_PER_TASK))
    order = ["url_key", "captured", F.asc_nulls_first("page_id"), "archive", "seq"]
    dealt = entries.repartitionByRange(tasks, *order).sortWithinPartitions("archive", "seq")
    return dealt.mapInArrow(_merged(["url_key", "captured"]), ENTRY + ", merge_rank long").withColumn("merge_partition", F.spark_partition_id())


def archive_and_index(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """Write pages to archives in the shared folder, read these, merge their index."""
    spark, path = pages.sparkSession, work_dir(pages.sparkSession)
    write_archives(with_revisits(pages, captured), path)
    return merge_index(staged(read_index(spark, path)))


def with_global_rank(merged: DataFrame) -> DataFrame:
    """merged with capture_rank, its place in the order of all histories."""
    merged = staged(merged)
    # a row for each merging task, that is for ENTRIES_PER_TASK entries
    parts = merged.groupBy("merge_partition").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("merge_partition").rowsBetween(Window.unboundedPreceding, -1))
    firsts = staged(parts.select("merge_partition", F.coalesce(before, F.lit(0)).alias("_first")))
    side = F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts
    return merged.join(side, "merge_partition").withColumn("capture_rank", F.col("_first") + F.col("merge_rank")).drop("_first")


def op1_external_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = with_global_rank(archive_and_index(table(spark, sf_dir, "pages")))
    return ranked.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "capture_rank")


OP1_SQL = r"""
WITH page AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, coalesce(html, '') AS payload,
         replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS url
  FROM pages),
sized AS (
  SELECT page_id, url, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
         min(page_id) OVER (PARTITION BY sha256(payload)) AS first_id
  FROM page),
keyed AS (
  SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND first_id IS DISTINCT FROM page_id AS revisit,
         lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)', 1)) AS host,
         regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)', 2) AS rest
  FROM sized),
named AS (
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN first_id END AS refers_to,
       CASE WHEN host <> '' THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest ELSE url END AS url_key,
       strftime(to_timestamp(1704067200 + (coalesce(page_id, 0) % 1000000000)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM keyed)
SELECT *, row_number() OVER (ORDER BY url_key, captured, page_id NULLS FIRST) - 1 AS capture_rank FROM named
"""
