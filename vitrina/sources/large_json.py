"""Large JSON documents cut into small ones while they are read.

A statistical message is one JSON document, however many series it holds.  A
document over a size is not read as one row: the task that has it scans its text
once to check it and to keep what is common to all series (structure, labels), and once more to
hand on groups of series, each as a small document with the common part.  So what leaves is
parsed and decoded by Spark as any other message, the task holds the common part and
one group, and a document that is no JSON is reported before any of its series is handed on.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READ_CHARS = 1 << 20
#: A handed-on document has series of about so many characters.
GROUP_CHARS = 1 << 20
_SPACE = re.compile(r"[ \t\n\r]*")
_decoder = json.JSONDecoder()


class Scanner:
    """A JSON text that is read forward, a buffer at a time."""

    def __init__(self, blocks: Iterator[bytes]):
        self._blocks, self._decode = blocks, codecs.getincrementaldecoder("utf-8-sig")()
        self.text, self.at, self.ended = "", 0, False

    def _more(self) -> bool:
        """Read on and forget what is behind; whether there was more."""
        if self.ended:
            return False
        parts, size = [self.text[self.at :]], 0
        want = max(READ_CHARS, len(parts[0]))  # a long value is tried again on twice as much
        while size < want and not self.ended:
            block = next(self._blocks, None)
            self.ended = block is None
            parts.append(self._decode.decode(block or b"", self.ended))
            size += len(parts[-1])
        self.text, self.at = "".join(parts), 0
        return True

    def peek(self) -> str:
        """The next character that is no white space; empty at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text):
                return self.text[self.at]
            if not self._more():
                return ""

    def take(self, chars: str) -> str:
        c = self.peek()
        if not c or c not in chars:
            raise ValueError(f"expected one of {chars!r}, found {c!r}")
        self.at += 1
        return c

    def value(self) -> str:
        """The text of the next value, which is held whole."""
        self.peek()
        while True:
            try:
                _, end = _decoder.raw_decode(self.text, self.at)
            except ValueError:
                if not self._more():
                    raise
                continue
            if end == len(self.text) and self._more():
                continue  # a number may go on in the next buffer
            found, self.at = self.text[self.at : end], end
            return found

    def members(self) -> Iterator[str]:
        """Texts of an object's keys; the value of each is to be taken before the next is asked for."""
        self.take("{")
        if self.peek() == "}":
            self.at += 1
            return
        while True:
            if self.peek() != '"':
                raise ValueError("expected a key")
            key = self.value()
            self.take(":")
            yield key
            if self.take(",}") == "}":
                return

    def elements(self) -> Iterator[None]:
        """One for each of an array's values, which is to be taken before the next is asked for."""
        self.take("[")
        if self.peek() == "]":
            self.at += 1
            return
        while True:
            yield None
            if self.take(",]") == "]":
                return


def _series_of_message(s: Scanner, common: dict[str, str]) -> Iterator[str]:
    """SDMX: ``dataSets`` is a list of objects whose ``series`` has a member for each series."""
    for key in s.members():
        if json.loads(key) != "dataSets" or s.peek() != "[":
            common[json.loads(key)] = s.value()
            continue
        for _ in s.elements():
            if s.peek() != "{":
                s.value()
                continue
            for inner in s.members():
                if json.loads(inner) != "series" or s.peek() != "{":
                    s.value()
                    continue
                for name in s.members():
                    yield f"{name}:{s.value()}"


def _series_of_list(s: Scanner, common: dict[str, str]) -> Iterator[str]:
    """Decoded files: ``series`` is a list with an object for each series."""
    for key in s.members():
        if json.loads(key) != "series" or s.peek() != "[":
            common[json.loads(key)] = s.value()
            continue
        for _ in s.elements():
            yield s.value()


#: How series are found, which members are common to them, and how a group of them is written.
LAYOUTS = {
    "sdmx": (_series_of_message, {"structure"}, lambda group: '"dataSets":[{"series":{' + ",".join(group) + "}}]"),
    "series": (_series_of_list, {"flow", "label", "has_es", "fetched_at", "total_series"}, lambda group: '"series":[' + ",".join(group) + "]"),
}


def cut_document(blocks: Callable[[], Iterator[bytes]], layout: str, group_chars: int = GROUP_CHARS) -> Iterator[tuple[int, str]]:
    """(number of its first series, text) of the small documents that a document is cut into; one at least.

    ``blocks`` opens the document; it is read twice.  Raises ValueError, before anything is handed on, for what is no such document.
    """
    walk, common_names, write = LAYOUTS[layout]
    common: dict[str, str] = {}
    scan = Scanner(blocks())
    try:
        for _ in walk(scan, common):
            pass
    except RecursionError as e:
        raise ValueError("nested too deeply") from e
    if scan.peek():
        raise ValueError("text after the document")
    head = "".join(f"{json.dumps(k)}:{v}," for k, v in common.items() if k in common_names)
    group: list[str] = []
    first = size = 0
    for text in walk(Scanner(blocks()), {}):
        group.append(text)
        size += len(text)
        if size >= group_chars:
            yield first, "{" + head + write(group) + "}"
            first, size = first + len(group), 0
            group = []
    if group or not first:
        yield first, "{" + head + write(group) + "}"


def _cut(layout: str, group_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from vitrina.sources.files import blocks_of
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    for first, text in cut_document(lambda p=path: blocks_of(p), layout, group_chars):
                        yield pa.RecordBatch.from_pylist([{"path": path, "first": first, "text": text, "error": None}], _CUT)
                except ValueError as e:
                    yield pa.RecordBatch.from_pylist([{"path": path, "first": 0, "text": None, "error": str(e)}], _CUT)
    return run


_CUT = pa.schema([("path", pa.string()), ("first", pa.int64()), ("text", pa.string()), ("error", pa.string())])


def cut_files(spark: SparkSession, path: str, layout: str, over: int, group_chars: int = GROUP_CHARS) -> DataFrame:
    """``(path, first, text, error)``: the small documents of every file of more than ``over`` bytes, or its error."""
    from vitrina.session import ship_package
    ship_package(spark)
    listed = spark.read.format("binaryFile").load(path).filter(F.col("length") > over).select("path")
    return listed.repartition("path").mapInArrow(_cut(layout, group_chars), "path string, first long, text string, error string")
