r"""WARC archives of pages, and their globally ordered capture index.

Writing: every page becomes a WARC/1.1 record. Of records with equal payloads of
at least ``MIN_REVISIT`` bytes the one with the largest key is the response
and the others are revisit records that refer to it; the response is found
with a partial ``max`` per digest, so a hot payload never gathers its copies.
A record is one value of Spark's text writer with ``\r\n\r\n`` as line
separator, which is exactly the end of a WARC record, so the archives are
plain WARC files on whatever storage the path names, one per input split and class of
page sizes. A class holds pages up to some size and so many records a file that an
archive is some ``ARCHIVE_BYTES`` at most; a larger page has an archive of its own.

Reading: archives are read whole (binary file source), parsed by
Content-Length, and their payload digests recomputed; a damaged archive is an
error. Each archive gives a run of index entries sorted by (URL key, time,
key). The runs are dealt to ranges of that order. Within a range the parts of the
runs are written to files of the task's own (gone with it), and a loser tree merges
up to ``FAN`` of them at a time from blocks of ``HEADS`` rows, over as many passes as
it takes, so a task's memory does not grow with its range; the ranges in sequence
are the globally ordered capture history. A hot URL key is split between ranges by
time and key.

Defined results: null html is an empty payload; a null url has an empty key
and sorts first; rows with a null key are revisits of an equal long payload
that has a key, else responses; repeated rows are archived repeatedly, and
rows that share the largest key are all responses; an empty table gives an
empty archive; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import common as C
from hirescope.session import scratch_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
RECORDS_PER_FILE = 8_000  # of pages up to ARCHIVE_BYTES / RECORDS_PER_FILE, and so on by a factor of 32
FAN = 128
HEADS = 200
EPOCH = 1_700_000_000  # pages carry no capture time: key seconds after this
CRLF = "\r\n"
INDEX = ("urlkey string, ts string, page_id long, url string, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string, archive string, at long, length long")
NAMES = [c.split()[0] for c in INDEX.split(", ")]
ORDER = ("urlkey", "ts", "page_id")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(value, size): the WARC record of every page, without its final empty lines, and its payload's size."""
    src = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"),
                       F.coalesce(F.col(html), F.lit("")).alias("payload"))
    src = src.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    twins = C.stored(
        src.filter(F.col("size") >= MIN_REVISIT).groupBy("digest", "size")
        .agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
        .select(F.col("digest").alias("d"), F.col("size").alias("s"), "first"), "warc-twins")
    j = src.join(C.small_side(twins), (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("first")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    date = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce("id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.regexp_replace("url", r"[\r\n]", "%0A")
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", kind), _line("WARC-Date", date),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")),
                                         F.lit(":"), F.col("digest"), F.lit(">"))),
        _line("WARC-Target-URI", uri), _line("X-Page-ID", F.col("id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Length", F.col("size").cast("string")),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(":"),
                                                         F.col("digest"), F.lit(">")))),
        _line("WARC-Profile", F.when(revisit, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("Content-Length", length.cast("string")), F.lit(CRLF))
    return j.select(F.concat(head, block).alias("value"), "size")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    size = F.coalesce(F.octet_length(html), F.lit(0))
    found = pages.select(F.max(size)).first()[0] or 0
    out, over, per_file = records(pages, key, url, html), -1, RECORDS_PER_FILE
    while True:
        upto = ARCHIVE_BYTES // per_file if per_file > 1 else found
        part = out.filter((F.col("size") > over) & (F.col("size") <= upto)).select("value")
        (part.write.mode("append").option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file).text(path))
        if upto >= found:
            return
        over, per_file = upto, max(1, per_file // 32)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then the rest, lower-cased."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0].lower()
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2]
    name, _, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + slash + path


def parse_archive(content: bytes, archive: str) -> list[tuple]:
    """The index entries of an archive, in order of the records."""
    out, at = [], 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/1.", at):
            raise ValueError(f"{archive}: no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in content[at:end].decode().split(CRLF)[1:])
        begin, size = end + 4, int(head["Content-Length"])
        stop = begin + size
        if content[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"{archive}: the record at byte {at} is cut off")
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        n = int(head["X-Payload-Length"])
        if head["WARC-Type"] == "response":
            body = content.find(b"\r\n\r\n", begin, stop) + 4
            payload = content[body:stop]
            if len(payload) != n or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"{archive}: wrong payload digest at byte {at}")
        refers = head.get("WARC-Refers-To")
        page, url = head.get("X-Page-ID"), head.get("WARC-Target-URI")
        out.append((url_key(url), head["WARC-Date"], None if page is None else int(page), url, head["WARC-Type"],
                    None if refers is None else int(refers.split(":")[2]), n, digest, archive, at, stop + 4 - at))
        at = stop + 4
    return out


def sort_key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merge of sorted runs: each inner node keeps the loser of its match, so a
    step replays only the winner's path to the root (log2 k comparisons)."""

    def __init__(self, runs: Sequence[Iterator[tuple]]) -> None:
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * max(self.k, 1)
        self.winner = self._play(1) if self.k else -1

    def _next(self, i: int) -> tuple | None:
        row = next(self.runs[i], None)
        return None if row is None else (sort_key(row), i, row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and x[:2] < y[:2]

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w][2]
            self.heads[w] = self._next(w)
            node = (w + self.k) // 2
            while node:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def _batches(rows: Iterator[tuple], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], pa.string() if c.split()[1] == "string" else pa.int64())
                        for c in INDEX.split(", ")])
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) >= size:
            yield pa.RecordBatch.from_pylist([dict(zip(NAMES, x, strict=True)) for x in part], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_pylist([dict(zip(NAMES, x, strict=True)) for x in part], schema=schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives, each archive's sorted: one run per archive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1), strict=True):
                entries = parse_archive(content.as_buffer().to_pybytes(), name.as_py().rpartition("/")[2])
                yield from _batches(iter(sorted(entries, key=sort_key)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, INDEX)


def merge_runs(runs: DataFrame) -> DataFrame:
    """The runs as one, globally ordered by (urlkey, ts, page_id) over the partitions in sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            yield from _batches(merged(folder, spilled(folder, batches)))

    dealt = runs.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ORDER])
    return dealt.sortWithinPartitions("archive", *[F.col(c).asc_nulls_first() for c in ORDER]).mapInArrow(run, INDEX)


def spilled(folder: str, batches: Iterator[pa.RecordBatch]) -> list[str]:
    """The rows, which come archive by archive, each sorted, as one file per archive."""
    files: list[str] = []
    out, name = None, None
    for b in batches:
        archives = b.column(NAMES.index("archive")).to_pylist()
        at = 0
        while at < len(archives):
            to = at + 1
            while to < len(archives) and archives[to] == archives[at]:
                to += 1
            if out is None or archives[at] != name:
                if out is not None:
                    out.close()
                name = archives[at]
                files.append(f"{folder}/{len(files)}")
                out = pa.ipc.new_stream(files[-1], b.schema)
            for lo in range(at, to, HEADS):
                out.write_batch(b.slice(lo, min(HEADS, to - lo)))
            at = to
    if out is not None:
        out.close()
    return files


def merged(folder: str, files: list[str], fan: int = FAN) -> Iterator[tuple]:
    """All rows of the sorted files in order; at most ``fan`` blocks of rows are held."""
    def rows(file: str) -> Iterator[tuple]:
        with pa.OSFile(file) as f, pa.ipc.open_stream(f) as s:
            for b in s:
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)
        os.unlink(file)

    passes = 0
    while len(files) > fan:
        passes, more = passes + 1, []
        for at in range(0, len(files), fan):
            out = None
            more.append(f"{folder}/{passes}-{at}")
            for b in _batches(iter(LoserTree([rows(x) for x in files[at:at + fan]])), HEADS):
                out = out or pa.ipc.new_stream(more[-1], b.schema)
                out.write_batch(b)
            out.close()
        files = more
    return iter(LoserTree([rows(x) for x in files]))


def capture_history(pages: DataFrame) -> DataFrame:
    """Archive the pages, read the archives back, and order all captures."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return merge_runs(C.stored(read_runs(spark, path), "warc-runs"))


def op8_warc_index(spark: SparkSession, base: str) -> DataFrame:
    """Every page as archived and read back."""
    return capture_history(C.read(spark, base, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "ts")


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, url, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d),
k AS (SELECT *, payload_bytes >= 1000 AND first_id IS NOT NULL AND (page_id IS NULL OR page_id < first_id) AS again,
             regexp_replace(regexp_extract(coalesce(url, ''), '^(?:.*?://)?([^#]*)', 1), '^[^/]*@', '') AS rest FROM f)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to,
       CASE WHEN coalesce(url, '') = '' THEN '' ELSE
         array_to_string(list_reverse(string_split(string_split(lower(rest), '/')[1], '.')), ',') || ')'
         || substr(lower(rest), length(string_split(lower(rest), '/')[1]) + 1) END AS urlkey,
       strftime(to_timestamp(1700000000 + coalesce(page_id, 0)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS ts
FROM k
"""
