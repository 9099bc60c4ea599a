"""WARC archives of captures, and their index by external merge.

Writing: captures are ordered by (URL key, time) within range partitions and
written as WARC records, a bounded number of bytes a file.  Of captures with
equal payloads one is a response with the payload, the others are revisits.

Reading: each archive file is parsed record by record by its Content-Length and
gives one locally sorted run of index entries.  Runs are merged: a range
exchange hands each task the stretch of every run that falls in its range,
and the task merges those runs with a loser tree by URL key and time.  So
entries are in global order over partitions, and captures of one URL stand together as
its history; a URL captured very often spans several ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed, lower_ascii
from vitrina.session import scratch_path, ship_package

#: Payloads from this size on are deduplicated.
MIN_REVISIT = 1000
#: Upper bound of payload bytes of a record, and records a file, by size class; so a file has at most 64 MB of payload, or one record.
CLASSES = ((16 << 10, 4_096), (256 << 10, 256), (4 << 20, 16), (None, 1))
#: Repeated digests (some 100 bytes each) that are broadcast at most.
MAX_BROADCAST_DIGESTS = 200_000
RECORD_ID = "urn:capture:"
_INDEX = "url_key string, captured timestamp, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, file string, offset long"
_FIELDS = ("url_key", "captured", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "file", "offset")


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels in reverse order, then the rest; empty for null."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(rest, r"(?s)^[^/?#]*", ""))


def _header(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1F\x7F]+", "%20")


def with_revisits(captures: DataFrame) -> DataFrame:
    """Adds ``payload_bytes, payload_digest, refers_to`` to captures (``page_id, payload`` string).

    ``refers_to`` is the largest page_id with an equal payload of at least
    ``MIN_REVISIT`` bytes, null for that capture itself and for small payloads.
    Digests are counted first.  The table of those that occur again has one row
    for each; it is broadcast if it has at most ``MAX_BROADCAST_DIGESTS`` rows, so
    payloads stay where they are, and else joined by a shuffle.
    """
    c = captures.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1(F.col("payload").cast("binary")))
    again = (c.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"))
             .agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n"))
    again = checkpointed(again)
    few = again.count() <= MAX_BROADCAST_DIGESTS
    return (c.join(F.broadcast(again) if few else again, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left")
            .withColumn("refers_to", F.when(F.col("target") != F.coalesce("page_id", F.lit(-(1 << 63))), F.col("target"))).drop("d", "b", "target"))


def _record(first: str) -> Column:
    """The text of one WARC record."""
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    rid = lambda c: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit(first))), line("WARC-Record-ID", rid(F.col("page_id"))),
        line("WARC-Date", F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")), line("WARC-Target-URI", _header(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", rid(F.col("refers_to"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body)


def write_archives(captures: DataFrame, path: str) -> None:
    """Write captures (``page_id, url, captured, payload``) as WARC files under ``path``.

    Null payloads are empty, null times are the epoch, and control characters
    in a URL are written as %20.  Files are WARC 1.1 in gzip.
    """
    c = with_revisits(captures.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("captured", F.timestamp_seconds(F.lit(0))).alias("captured"),
                                      F.coalesce("payload", F.lit("")).alias("payload"))).withColumn("key", url_key(F.col("url")))
    held = F.when(F.col("refers_to").isNotNull(), F.lit(0)).otherwise(F.col("payload_bytes"))
    size_class = F.lit(len(CLASSES) - 1)
    for i in range(len(CLASSES) - 2, -1, -1):
        size_class = F.when(held < CLASSES[i][0], F.lit(i)).otherwise(size_class)
    # the records of a class are cut into files by their number within the task
    runs = c.withColumn("size_class", size_class).repartitionByRange("size_class", "key", "captured", "page_id").sortWithinPartitions("size_class", "key", "captured", "page_id")
    per_file = F.element_at(F.array(*[F.lit(n) for _, n in CLASSES]), F.col("size_class") + 1)
    numbered = runs.withColumn("n", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    (numbered.select(_record("response").alias("value"), F.concat_ws("-", "size_class", F.lpad(F.floor(F.col("n") / per_file).cast("string"), 10, "0")).alias("part"))
     .write.partitionBy("part").option("lineSep", "\r\n\r\n").option("compression", "gzip").mode("overwrite").text(path))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of whole archive files as index entries; a file is one run, in its order."""
    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = memoryview(data.as_buffer())
            data = memoryview(gzip.decompress(data)) if bytes(data[:2]) == b"\x1f\x8b" else data  # at most a file's bound of payload
            at, rows = 0, []
            while at < len(data):
                end = _find(data, at)
                fields = {}
                for text in bytes(data[at:end]).decode("utf-8").split("\r\n")[1:]:
                    key, _, value = text.partition(": ")
                    fields[key.lower()] = value
                size = int(fields["content-length"])
                body = data[end + 4 : end + 4 + size]
                revisit = fields["warc-type"] == "revisit"
                digest = fields["warc-payload-digest"].removeprefix("sha1:") if revisit else hashlib.sha1(body).hexdigest()
                number = lambda k: None if (x := fields.get(k, "<none>")[1:-1].removeprefix(RECORD_ID)) == "none" else int(x)
                when = datetime.strptime(fields["warc-date"], "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc)
                rows.append((fields["warc-target-uri"], when, number("warc-record-id"), fields["warc-type"], None if revisit else size, digest, number("warc-refers-to"), name, at))
                at = end + 4 + size + 4
                if len(rows) >= 10_000:
                    yield _entries(rows)
                    rows = []
            yield _entries(rows)


def _find(data: memoryview, at: int) -> int:
    """Where the header that starts at ``at`` ends; headers are short, so the search goes by small steps."""
    step = 2048
    while True:
        i = bytes(data[at : at + step]).find(b"\r\n\r\n")
        if i >= 0:
            return at + i
        if at + step > len(data):
            raise ValueError(f"a record at {at} has no end of header")
        step *= 2


_TYPES = (pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], ["url" if f == "url_key" else f for f in _FIELDS])


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the winner of all is on top."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, max(1, len(runs))
        self.head = [next(r, None) for r in runs] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, i: int) -> None:
        at = (i + self.k) // 2
        while at > 0:
            if self.tree[at] == -1:
                self.tree[at] = i
                return
            if self._less(self.tree[at], i):
                self.tree[at], i = i, self.tree[at]
            at //= 2
        self.tree[0] = i

    def __iter__(self):
        while (x := self.head[w := self.tree[0]]) is not None:
            yield x
            self.head[w] = next(self.runs[w], None)
            at, i = (w + self.k) // 2, w
            while at > 0:
                if self._less(self.tree[at], i):
                    self.tree[at], i = i, self.tree[at]
                at //= 2
            self.tree[0] = i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs in a partition: rows of a file come in its order, and a step back starts another run."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    keys = list(zip(table.column("url_key").to_pylist(), table.column("captured").cast(pa.int64()).to_pylist(),
                    [-1 if x is None else x for x in table.column("page_id").to_pylist()], strict=True))
    runs: list[list] = []
    open_run: dict = {}
    for i, (file, key) in enumerate(zip(table.column("file").to_pylist(), keys, strict=True)):
        run = open_run.get(file)
        if run is None or run[-1][0] > key:
            run = open_run[file] = []
            runs.append(run)
        run.append((key, i))
    order = pa.array([i for _, i in LoserTree([iter(r) for r in runs])], pa.int64())
    yield from table.take(order).combine_chunks().to_batches(max_chunksize=10_000)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index of the archives under ``path``, in global order of (url_key, captured, page_id) over partitions.

    Columns: ``url_key, captured, page_id, record_type, payload_bytes,
    payload_digest, refers_to, file, offset`` (in the uncompressed file); a
    revisit's ``payload_bytes`` is null.
    Payload size and digest of responses are taken from the bytes read.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    parsed = files.mapInArrow(_parse, _INDEX.replace("url_key", "url")).withColumn("url_key", url_key(F.col("url"))).select(*_FIELDS)
    ranges = parsed.repartitionByRange("url_key", "captured", "page_id")
    return ranges.mapInArrow(_merge, _INDEX)


def archive_round_trip(captures: DataFrame, path: str | None = None) -> DataFrame:
    """Write captures as archives, read them back and return the merged index with full payload sizes.

    Columns as ``read_index``; a revisit's ``payload_bytes`` is that of the record it
    refers to.  Null payloads are empty, null URLs have an empty key and
    null ids are kept (they are never referred to unless all equal captures lack one, which then are
    all responses); rows that repeat with the referred id are all responses; no rows give no rows.
    """
    spark = captures.sparkSession
    path = path or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archives(captures, path)
    if captures.limit(1).count() == 0:
        return spark.createDataFrame([], _INDEX)
    index = checkpointed(read_index(spark, path))
    target = (index.where("record_type = 'response' AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("t_id"), F.col("payload_digest").alias("t_digest"))
              .agg(F.max("payload_bytes").alias("t_bytes")))
    return (index.join(target, (F.col("refers_to") == F.col("t_id")) & (F.col("payload_digest") == F.col("t_digest")), "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "t_bytes")).select(*_FIELDS))
