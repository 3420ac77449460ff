"""WARC archives of pages, and their capture index by external merging.

Pages are written as WARC 1.1 records; a page whose payload another record holds
becomes a revisit. Reading an archive file back gives a run of index
entries sorted by URL key and time. Range partitioning deals the runs' rows
out, and in each range a loser tree merges them, so the ranges one
after the other are the capture histories in global order.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.support import Scratch, by_value, joined_small, table

by_value(__name__)

# Payloads from this size on are stored once.
LEAST_BYTES = 1000
RECORDS_PER_FILE = 2000
ROWS_PER_RANGE = 200_000
# Where the table has no capture time, pages are dated one second apart from here.
EPOCH = 1_704_067_200
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "url_key string, captured_at string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


def url_key(url: str) -> str:
    """Host labels from the top level down, then path and query: captures of a site sort side by side."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = [x for x in host.split(".") if x]
    if len(labels) > 1 and labels[0] == "www":
        labels = labels[1:]
    path = parts.path or "/"
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{','.join(reversed(labels))}{port}){path.lower()}{query.lower()}"


def records(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """One WARC record per page as text, without the empty lines that end it."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("size"),
        F.sha1(payload).alias("sha1"),
        F.sha2(payload, 256).alias("same"),
    )
    groups = rows.where(F.col("size") >= LEAST_BYTES).groupBy("same").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
    groups = scratch.save(groups.where("n > 1").select("same", "keep"), "same")
    rows = joined_small(rows, groups, "same", "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    name = lambda c: F.concat(F.lit("<urn:page:"), text(c), F.lit(">"))
    second = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)))
    line = lambda *parts: F.concat(*parts, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), text(F.col("size")), F.lit(END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "[\\x00-\\x1F\\x7F]", ""), " ", "%20")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        line(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        line(F.lit("WARC-Date: "), F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line(F.lit("WARC-Target-URI: "), url),
        line(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(line(F.lit(f"WARC-Profile: {PROFILE}")), line(F.lit("WARC-Refers-To: "), name(F.col("keep"))))).otherwise(""),
        line(F.lit("Content-Type: application/http; msgtype=response")),
        F.lit("Content-Length: "),
        text(F.octet_length(block)),
        F.lit(END),
    )
    return rows.select(F.concat(header, block).alias("record"))


def write_archives(pages: DataFrame, path: str, scratch: Scratch) -> None:
    """Gzipped WARC files; the text sink puts the two empty lines after each record."""
    writer = records(pages, scratch).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(fields["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        if len(block) != size or data[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, block
        at = stop + 8 + size


def page_of(name: str) -> int | None:
    number = re.sub(r"\D*?(-?\d*)>$", r"\1", name)
    return int(number) if number else None


def entry(fields: dict[str, str], block: bytes) -> tuple:
    """An index entry; the payload of a response is held against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    declared = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", head)[1])
    digest = fields["warc-payload-digest"].partition(":")[2]
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != declared or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    return (
        url_key(fields.get("warc-target-uri", "")),
        fields["warc-date"],
        page_of(fields["warc-record-id"]),
        kind,
        declared,
        digest,
        page_of(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    )


def order_key(row: tuple) -> tuple:
    """URL key, time, page; a NULL page comes first."""
    return row[0].encode("utf-8", "surrogatepass"), row[1], row[2] is not None, row[2] or 0


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index entries of each archive file, sorted: one run per file."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            found = sorted((entry(f, b) for f, b in parse(gzip.decompress(content.as_py()))), key=order_key)
            columns = [*zip(*found, strict=True)] if found else [[]] * 7
            yield as_batch(columns, pa.array([path.as_py()] * len(found), pa.string()), "run")


def as_batch(columns: list, last: pa.Array, name: str) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [x.split()[0] for x in ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], last], names=[*names, name]
    )


class LoserTree:
    """k-way merge: inner nodes hold the losers of their matches, so each row costs one path of log2 k matches."""

    def __init__(self, sources: list[Iterator[tuple[tuple, tuple]]]):
        self.sources, self.k = sources, len(sources)
        self.heads = [next(s, None) for s in sources]
        self.losers = [-1] * self.k
        self.winner = self.play(1) if self.k > 1 else 0

    def before(self, a: int, b: int) -> bool:
        """Whether source a's head comes first; ended sources come last, ties go to the earlier source."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self.play(2 * node), self.play(2 * node + 1)
        first, second = (a, b) if self.before(a, b) else (b, a)
        self.losers[node] = second
        return first

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i][1]
            self.heads[i] = next(self.sources[i], None)
            node = (i + self.k) // 2
            while node:
                if self.before(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: the rows of each run keep their order, the loser tree merges the runs."""
    held: dict[str, list[tuple]] = {}
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for run, *row in zip(columns[-1], *columns[:-1], strict=True):
            held.setdefault(run, []).append((order_key(row), row))
    sources = []
    for name in sorted(held):
        rows = held[name]
        # Blocks of a run may be fetched in any order.
        if any(a[0] > b[0] for a, b in zip(rows, rows[1:], strict=False)):
            rows.sort(key=lambda r: r[0])
        sources.append(iter(rows))
    out, place = [], 0
    for row in LoserTree(sources):
        out.append(row)
        if len(out) == 10_000:
            yield as_batch([*zip(*out, strict=True)], pa.array(range(place, place + len(out)), pa.int64()), "place")
            place, out = place + len(out), []
    if out:
        yield as_batch([*zip(*out, strict=True)], pa.array(range(place, place + len(out)), pa.int64()), "place")


def capture_index(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """Index entries of all archives below ``path`` with range_no and place, which give their global order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    entries = files.select("path", "content").mapInArrow(runs, f"{ENTRY}, run string")
    dealt = entries.repartitionByRange(max(1, -(-rows // ROWS_PER_RANGE)), "url_key", "captured_at", "page_id")
    merged = dealt.mapInArrow(merge, f"{ENTRY}, place bigint")
    return merged.withColumn("range_no", F.spark_partition_id())


def archived(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` from its archived record, in capture order by (range_no, place).

    NULL html is an empty payload and a NULL url an empty one. Of equal payloads
    of at least 1,000 bytes the largest page_id is the response, also for rows
    that repeat that page_id; rows without page_id revisit it. No rows give none.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    path = f"{scratch.root}/000-archives"
    write_archives(pages, path, scratch)
    return capture_index(spark, path, pages.count())


def op2_warc(spark: SparkSession, directory: str) -> DataFrame:
    found = archived(table(spark, directory, "pages"))
    first = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return found.select(*first, "url_key", "captured_at")

