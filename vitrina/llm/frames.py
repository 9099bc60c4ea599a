"""Fill-in-the-middle over seekable compressed texts.

A text is stored as independent zstandard frames of at most ``frame_bytes`` (cut
between code points), each with the number of units, code points and bytes before
it.  A unit is a word with the white space before it; white space at the end is a
unit of its own.  A unit belongs to the frame that holds its last byte, so frames
stay small however long a word is.

To cut a text after so many units, the running counts name one frame; only that
frame is decompressed to find the place.  The output (the text, or its parts behind
markers in one of two orders) is put together from ordered frames as a stream, is
framed again and digested on the way, and is read back from its frames to restore
the text.  No task holds more of a text uncompressed than Spark's own cell of it in
the first pass and a frame at a time after that.  Nothing is shuffled.

Defined cases: a null text is empty; a text without units, or one that holds a
marker, stays plain (cut lengths are null then); a null id takes part with an empty
id; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tokens import _SPACE
from vitrina.session import scratch_path, ship_package

FRAME_BYTES = 1 << 16
SEED = 42
#: Of 100 texts with units so many stay plain, and of 100 others so many are suffix first.
PLAIN_OF_100 = 50
SUFFIX_FIRST_OF_100 = 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Rows handed on at once by a task hold about so many bytes.
BATCH_BYTES = 1 << 22

FRAME = pa.struct([("units_before", pa.int64()), ("chars_before", pa.int64()), ("bytes_before", pa.int64()), ("data", pa.binary())])
STORED = pa.schema([("doc_id", pa.int64()), ("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("marked", pa.bool_()), ("frames", pa.list_(FRAME))])
STORED_DDL = ("doc_id long, units long, chars long, bytes long, marked boolean, "
              "frames array<struct<units_before: long, chars_before: long, bytes_before: long, data: binary>>")
FORMED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                    ("output_sha256", pa.string()), ("restored_sha256", pa.string()), ("output", pa.list_(pa.binary()))])
FORMED_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, output array<binary>"


def _unit_ends(piece: np.ndarray) -> np.ndarray:
    """Ends of the words that are followed by white space within the piece."""
    space = _SPACE[piece]
    return np.flatnonzero(~space[:-1] & space[1:]) + 1


def _chars(piece: np.ndarray) -> int:
    """Code points that begin in a piece of UTF-8."""
    return int(np.count_nonzero((piece & 0xC0) != 0x80))


def cut_frames(text: bytes, frame_bytes: int = FRAME_BYTES) -> tuple[list[dict], int, int]:
    """Frames of a text, and its units and code points."""
    pack, whole = zstandard.ZstdCompressor(), np.frombuffer(text, np.uint8)
    frames, units, chars, at = [], 0, 0, 0
    while at < len(text):
        end = min(at + frame_bytes, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        piece = whole[at:end]
        frames.append({"units_before": units, "chars_before": chars, "bytes_before": at, "data": pack.compress(text[at:end])})
        last_ends = end == len(text) or bool(not _SPACE[text[end - 1]] and _SPACE[text[end]])
        units += len(_unit_ends(piece)) + last_ends
        chars += _chars(piece)
        at = end
    return frames, units, chars


class Frames:
    """A framed text that is read by place."""

    def __init__(self, frames: list[dict], units: int, size: int):
        self.frames, self.units, self.size = frames, units, size
        self.starts = np.array([f["bytes_before"] for f in frames], np.int64)
        self.firsts = np.array([f["units_before"] for f in frames], np.int64)
        self._unpack, self._held = zstandard.ZstdDecompressor(), (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._held[0] != k:
            self._held = k, self._unpack.decompress(self.frames[k]["data"])
        return self._held[1]

    def place(self, n: int) -> tuple[int, int]:
        """(bytes, code points) up to the end of the ``n``-th unit; one frame is read."""
        if n == 0:
            return 0, 0
        k = int(np.searchsorted(self.firsts, n, "left")) - 1
        piece = np.frombuffer(self.frame(k), np.uint8)
        ends = _unit_ends(piece)
        j = n - int(self.firsts[k]) - 1
        end = int(ends[j]) if j < len(ends) else len(piece)
        return int(self.starts[k]) + end, self.frames[k]["chars_before"] + _chars(piece[:end])

    def stream(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes from ``start`` to ``end``, a frame at a time."""
        k = max(int(np.searchsorted(self.starts, start, "right")) - 1, 0)
        while start < end:
            piece, at = self.frame(k), int(self.starts[k])
            yield piece[start - at : end - at]
            start, k = at + len(piece), k + 1

    def find(self, marker: bytes, start: int) -> int:
        """First place of ``marker`` from ``start`` on."""
        tail, at = b"", start
        for piece in self.stream(start, self.size):
            joined = tail + piece
            found = joined.find(marker)
            if found >= 0:
                return at - len(tail) + found
            tail, at = joined[1 - len(marker) :], at + len(piece)
        return -1


class _Writer:
    """Frames and digest of a stream."""

    def __init__(self, frame_bytes: int):
        self.frame_bytes, self.digest, self.size = frame_bytes, hashlib.sha256(), 0
        self.frames: list[dict] = []
        self._pack, self._open = zstandard.ZstdCompressor(), bytearray()

    def write(self, piece: bytes) -> None:
        self.digest.update(piece)
        self._open += piece
        while len(self._open) >= self.frame_bytes:
            self._close(self.frame_bytes)

    def _close(self, n: int) -> None:
        self.frames.append({"units_before": 0, "bytes_before": self.size, "data": self._pack.compress(bytes(self._open[:n]))})
        self.size += n
        del self._open[:n]

    def done(self) -> Frames:
        if self._open:
            self._close(len(self._open))
        return Frames(self.frames, 0, self.size)


def _digest(parts: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The text, streamed from the frames of an output and its form alone."""
    if form == "plain":
        yield from output.stream(0, output.size)
        return
    head, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    a = output.find(second, len(head))
    b = output.find(MIDDLE, a + len(second))
    one, two, middle = (len(head), a), (a + len(second), b), (b + len(MIDDLE), output.size)
    for part in ((one, middle, two) if form == "psm" else (two, middle, one)):
        yield from output.stream(*part)


def _form(row: dict, seed: int, plain: int, suffix_first: int, frame_bytes: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output digest, restored digest, output frames) of a stored text."""
    name = "" if row["doc_id"] is None else row["doc_id"]
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    text, n = Frames(row["frames"], row["units"], row["bytes"]), row["units"]
    out, prefix_chars, middle_chars = _Writer(frame_bytes), None, None
    if n == 0 or row["marked"] or h3 % 100 >= plain:
        form = "plain"
        for piece in text.stream(0, text.size):
            out.write(piece)
    else:
        first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
        (a, prefix_chars), (b, chars) = text.place(first), text.place(last)
        middle_chars = chars - prefix_chars
        form = "spm" if h4 % 100 < suffix_first else "psm"
        one, two = (PREFIX, (0, a)), (SUFFIX, (b, text.size))
        for marker, part in ((two, one) if form == "spm" else (one, two)) + ((MIDDLE, (a, b)),):
            out.write(marker)
            for piece in text.stream(*part):
                out.write(piece)
    made = out.done()
    return n, form, prefix_chars, middle_chars, out.digest.hexdigest(), _digest(restored(made, form)), [f["data"] for f in made.frames]


def _store(frame_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py() or b""
                frames, units, chars = cut_frames(data, frame_bytes)
                rows.append({"doc_id": doc_id.as_py(), "units": units, "chars": chars, "bytes": len(data),
                             "marked": any(m in data for m in (PREFIX, SUFFIX, MIDDLE)), "frames": frames})
                held += sum(len(f["data"]) for f in frames)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, STORED)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, STORED)
    return run


def _transform(seed: int, plain: int, suffix_first: int, frame_bytes: int, keep_output: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for j in range(batch.num_rows):
                row = {name: batch.column(name)[j].as_py() for name in STORED.names}
                *values, frames = _form(row, seed, plain, suffix_first, frame_bytes)
                rows.append(dict(zip(FORMED.names, (row["doc_id"], *values, frames if keep_output else None), strict=True)))
                held += sum(map(len, frames)) if keep_output else 0
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, FORMED)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, FORMED)
    return run


def framed(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """One row a document: its counts and its frames in order."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_store(frame_bytes), STORED_DDL)


def stored_frames(docs: DataFrame, path: str | None = None, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the frames as a table (in the shared scratch folder unless ``path`` is given) and read it."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"frames-{uuid.uuid4().hex}")
    # frames are compressed already
    framed(docs, frame_bytes).write.option("compression", "uncompressed").parquet(path)
    return spark.read.schema(STORED_DDL).parquet(path)


def fill_in_middle(stored: DataFrame, seed: int = SEED, plain: int = PLAIN_OF_100, suffix_first: int = SUFFIX_FIRST_OF_100,
                   frame_bytes: int = FRAME_BYTES, keep_output: bool = True) -> DataFrame:
    """Stored texts in fill-in-the-middle form: counts, digests and, if kept, the output as zstandard frames in order."""
    ship_package(stored.sparkSession)
    out = stored.mapInArrow(_transform(seed, plain, suffix_first, frame_bytes, keep_output), FORMED_DDL)
    return out if keep_output else out.drop("output")
