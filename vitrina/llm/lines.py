"""Line dedup by a deletion-neighbourhood join.

A line is its words, A-Z lower-cased.  Lines of at least ``exact_words`` words
repeat an earlier line if they have the same words, and lines of at least
``edit_words`` also if one word is changed, added or missing.  The earliest
line, by (document id, line number), stays; a later one goes if some
earlier line is that close to it.

Lines within one edit share a deletion variant: the line itself or the line less
one word.  Every variant is emitted as a hashed key with the place of the
deletion; lines that meet under a key are joined and verified word by word.
Of a key's lines only the earliest has to be met by the others, so the join is
linear however many lines share a variant, and a task hands on no more than
one line for a key that it sees often.  Before variants are made, a sieve leaves
out lines that cannot have a partner: one edit leaves one half of a line as
it is, so partners share a half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import WORD, checkpointed, wrapped
from vitrina.llm.tokens import _power_tables, mix, salt, word_hashes
from vitrina.session import ship_package

EXACT_WORDS = 4
EDIT_WORDS = 8
#: A task hands on one line instead of all for a variant that more lines than this share in one piece.
MANY = 8
#: Lines whose places are broadcast at most; beyond, the same join is a shuffle.
MAX_BROADCAST_LINES = 2_000_000


class _Ranges:
    """Polynomial hashes of any range of a word sequence."""

    def __init__(self, words: np.ndarray):
        self.up, self.down = _power_tables(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.up[: len(words)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _line_rows(exact_words: int, edit_words: int):
    """(doc_id, line_no, n, h1, h2, half keys) of each line that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split(b"\n") for t in batch.column(1).to_pylist()]
            count = np.array([len(t) for t in texts], np.int64)
            doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), count)
            line = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            for first, bounds, words in word_hashes([x for t in texts for x in t]):
                n = np.diff(bounds)
                take = np.flatnonzero(n >= exact_words)
                s, e, n = bounds[take], bounds[take + 1], n[take]
                r1, r2 = _Ranges(words), _Ranges(mix(words + salt(21)))
                halves = []
                for p in (n // 2, (n - 1) // 2):
                    for side, (a, b) in enumerate(((s, s + p), (e - p, e))):
                        halves.append(mix(r1(a, b) + salt(22 + side) + mix(p.astype(np.uint64))))
                keys = np.stack(halves, axis=1) if len(n) else np.zeros((0, 4), np.uint64)
                # an odd line's two splits are one; short lines have no halves
                width = np.where(n < edit_words, 0, np.where(n % 2 == 1, 2, 4))
                flat = keys[np.arange(4)[None, :] < width[:, None]].view(np.int64)
                offsets = np.r_[0, np.cumsum(width)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[first + take]), pa.array(line[first + take].astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(mix(r1(s, e) + mix(n.astype(np.uint64))).view(np.int64)), pa.array(mix(r2(s, e) + mix(n.astype(np.uint64))).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    ["doc_id", "line_no", "n", "h1", "h2", "halves"])
    return run


def _line_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, line_no, words) of the wanted lines."""
    for batch in batches:
        ids, lines, place = [], [], []
        for i, t, wanted in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            parts = (t or b"").split(b"\n")
            for at in sorted(set(wanted)):
                if at < len(parts):
                    ids.append(i), place.append(at), lines.append(parts[at])
        for first, bounds, words in word_hashes(lines):
            m = len(bounds) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[first : first + m], pa.int64()), pa.array(place[first : first + m], pa.int32()),
                 pa.array([words[bounds[j] : bounds[j + 1]].tobytes() for j in range(m)], pa.binary())], ["doc_id", "line_no", "words"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (v, slot, doc_id, line_no, e_doc, e_line): a line under the variant that lacks the word at ``slot`` (-1: none).

    Where many lines of a piece share (v, slot), the earliest stands for them
    and the others come with it as (e_doc, e_line).
    """
    for batch in batches:
        doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        line = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        arrays = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
        at = 0
        while at < len(arrays):
            end, total = at, 0
            while end < len(arrays) and (end == at or total + len(arrays[end]) <= 1 << 18):
                total += len(arrays[end])
                end += 1
            n = np.array([len(x) for x in arrays[at:end]], np.int64)
            bounds = np.r_[0, np.cumsum(n)]
            words = np.concatenate(arrays[at:end])
            hashed = _Ranges(words)
            of = np.repeat(np.arange(len(n)), n)
            i = np.arange(len(words))
            s, e = bounds[of], bounds[of + 1]
            less = hashed(s, i) + hashed(i + 1, e) * hashed.up[i - s]
            v = mix(np.r_[hashed(bounds[:-1], bounds[1:]) + mix(n.astype(np.uint64)), less + mix((n[of] - 1).astype(np.uint64))])
            slot = np.r_[np.full(len(n), -1), i - s]
            owner = np.r_[np.arange(len(n)), of] + at
            d, ln = doc[owner], line[owner]
            order = np.lexsort((ln, d, slot, v))
            v, slot, d, ln = v[order], slot[order], d[order], ln[order]
            begin = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (slot[1:] != slot[:-1])]) if len(v) else np.zeros(0, np.int64)
            size = np.diff(np.r_[begin, len(v)])
            lead = np.repeat(begin, size)
            met = (np.repeat(size, size) > MANY) & (lead != np.arange(len(v)))
            mask = ~met
            yield pa.RecordBatch.from_arrays(
                [pa.array(v.view(np.int64)), pa.array(slot.astype(np.int32)), pa.array(d), pa.array(ln.astype(np.int32)),
                 pa.array(d[lead], mask=mask), pa.array(ln[lead].astype(np.int32), mask=mask)],
                ["v", "slot", "doc_id", "line_no", "e_doc", "e_line"])
            at = end


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (later line, earlier line) that meet under a variant; rows come in the order of v, slot, place."""
    out: list[tuple] = []
    v0, slot0, whole, first = None, None, None, None

    def pair(x, y):
        if x != y:
            out.append((*max(x, y), *min(x, y)))

    def flush():
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32()) * 2, strict=True)], ["doc_id", "line_no", "e_doc", "e_line"])
        out.clear()
        return got

    for batch in batches:
        v = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(v):
            continue
        same = v[1:] == v[:-1]
        many = np.r_[True, same] | np.r_[same, True] | batch.column(4).is_valid().to_numpy(zero_copy_only=False)
        part = batch.filter(pa.array(many))
        for vv, slot, d, ln, ed, el in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if vv != v0:
                v0, slot0, whole = vv, None, None
            here = (d, ln)
            if ed is not None:
                pair(here, (ed, el))
                continue  # the line it met stands for it from here on
            if slot == -1:
                whole = here if whole is None else whole
            elif slot != slot0:
                slot0, first = slot, here
                if whole is not None:
                    pair(whole, here)
            else:
                pair(here, first)
                if whole is not None:
                    pair(whole, here)
            if len(out) >= 50_000:
                yield flush()
    yield flush()


def within_one_edit(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether one word changed, added or missing turns one sequence into the other."""
    if abs(len(x) - len(y)) > 1:
        return False
    m = min(len(x), len(y))
    if not m:
        return True
    head = int(np.argmin(np.r_[x[:m] == y[:m], False]))
    tail = int(np.argmin(np.r_[x[len(x) - m :][::-1] == y[len(y) - m :][::-1], False]))
    return head + tail >= max(len(x), len(y)) - 1


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [within_one_edit(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
              for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["doc_id", "line_no"]).filter(pa.array(ok, pa.bool_()))


def repeated_lines(docs: DataFrame, exact_words: int = EXACT_WORDS, edit_words: int = EDIT_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines that go: ``doc_id, line_no`` (from 0), ``kind`` (``exact`` or ``near``).

    Lines stand between ``\\n``.  Null and empty texts have no such lines;
    rows that share an id are taken for copies of one document, rows with a null
    id are left alone; no rows give no rows; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("doc_id IS NOT NULL")
    lines = checkpointed(texts.mapInArrow(_line_rows(exact_words, edit_words), "doc_id long, line_no int, n int, h1 long, h2 long, halves array<long>"))
    place = F.struct("doc_id", "line_no")
    distinct = checkpointed(lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.min_by("halves", place).alias("halves")))
    repeated = distinct.where(F.col("first") < F.col("last")).select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first")
    exact = (lines.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))).where(place != F.col("first"))
             .select("doc_id", "line_no", F.lit("exact").alias("kind")))
    # the sieve: lines that share a half with another
    halves = distinct.select(F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no"), F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    wanted = checkpointed(halves.join(shared, "half").groupBy("doc_id").agg(F.collect_set("line_no").alias("wanted")))
    few = (wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0) <= MAX_BROADCAST_LINES
    words = checkpointed(texts.join(F.broadcast(wanted) if few else wanted, "doc_id").select("doc_id", "text", "wanted")
                         .mapInArrow(_line_words, "doc_id long, line_no int, words binary").groupBy("doc_id", "line_no").agg(F.max("words").alias("words")))
    variants = words.mapInArrow(_variants, "v long, slot int, doc_id long, line_no int, e_doc long, e_line int")
    met = (variants.repartition("v").sortWithinPartitions("v", "slot", "doc_id", "line_no")
           .mapInArrow(_meet, "doc_id long, line_no int, e_doc long, e_line int").distinct())
    pairs = (met.join(words.select("doc_id", "line_no", F.col("words").alias("x")), ["doc_id", "line_no"])
             .join(words.select(F.col("doc_id").alias("e_doc"), F.col("line_no").alias("e_line"), F.col("words").alias("y")), ["e_doc", "e_line"])
             .select("doc_id", "line_no", "x", "y"))
    near = pairs.mapInArrow(_verify, "doc_id long, line_no int").distinct().withColumn("kind", F.lit("near"))
    return exact.unionByName(near).groupBy("doc_id", "line_no").agg(F.min("kind").alias("kind"))


def dedup_lines(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; all columns stay.

    ``n_chars``, if there, follows the text.  A document all of whose words go
    is left out; one that had none before stays as it is.
    """
    gone = repeated_lines(docs, **params).groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_set("line_no").alias("gone"))
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    out = wrapped(docs, "doc_id", "text").join(gone, F.col("doc_id") == F.col("gone_id"), "left").withColumn("rest", F.when(F.col("gone").isNotNull(), rest))
    out = out.where(F.col("gone").isNull() | F.col("rest").rlike(WORD))
    changed = F.col("row").withField("text", F.col("rest"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length("rest").cast(docs.schema["n_chars"].dataType))
    return out.select(F.when(F.col("gone").isNull(), F.col("row")).otherwise(changed).alias("row")).select("row.*")
