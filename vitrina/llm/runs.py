"""Periodic runs of words, from Lyndon arrays under two opposite orders.

A run is a stretch of words with smallest period ``q``, at least ``min_words`` and
``min_exponent * q`` long, that no neighbouring word extends with that period.
Under one of two opposite orders of the words, each full period of a run that
begins with its least rotation is the longest Lyndon word at its place.  So all
runs are found from the two arrays of longest Lyndon words: a word that comes
twice in a row is a root, and longest common extensions (by range hashes, verified
word by word) lead from it to both ends of its run.

``lyndon_array`` is phase one of a suffix sorter that groups by Lyndon prefixes:
groups of positions with one prefix are taken from the highest down; each hands its
prefix to the nearest position on the left that is in a lower group, which thereby
leaves its own group for a new one just above.  A group's prefix is final when it
is taken, so nothing has to be compared.  It is linear in the number of words.

Runs cover only a small part of most texts, so a sieve first cuts out what may hold
one: a run at least as long as asked is covered by repeated grams of
``min_words * (min_exponent - 1) / min_exponent`` words (16 by default) whose copies lie in the
same stretch.  Stretches without such grams hold no run, and all others go through the Lyndon
arrays whole.  No document meets another, so nothing is shuffled and no key can be hot.

Defined cases: a null or blank text has no words and no run, and its collapsed text
is empty; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import word_array
from vitrina.llm.tokens import _power_tables, mix
from vitrina.session import ship_package

MIN_WORDS = 24
MIN_EXPONENT = 3
#: Texts are worked on together up to so many bytes.
PIECE_BYTES = 1 << 22
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
FOUND_DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place."""
    n = len(symbols)
    left, right, found = list(range(-1, n - 1)), list(range(1, n + 1)), [0] * n
    members: list[list[int]] = []
    number: dict[int, int] = {}
    for s in sorted(set(symbols)):
        number[s] = len(members)
        members.append([])
    group = [number[s] for s in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(members)
    above, below = list(range(1, len(members) + 1)), list(range(-1, len(members) - 1))
    g = len(members) - 1
    if g >= 0:
        above[g] = -1
    while g >= 0:
        size, taken = length[g], []
        last, count = -1, 0
        for s in members[g]:
            if group[s] != g:
                continue  # has left for a higher group
            found[s] = size
            p, r = left[s], right[s]
            if r < n:
                left[r] = p
            if p >= 0:
                right[p] = r
                if p == last:
                    count += 1
                else:
                    if last >= 0:
                        taken.append((group[last], count, last))
                    last, count = p, 1
        if last >= 0:
            taken.append((group[last], count, last))
        if len(taken) > 1:
            taken.sort()
        old = times = top = -1
        for a, k, p in taken:
            if a != old or k != times:
                # the prefix of group a, with this one behind it k times: above those with fewer
                under = a if a != old else top
                old, times, top = a, k, len(members)
                up = above[under]
                members.append([])
                length.append(length[a] + k * size)
                above.append(up), below.append(under)
                above[under] = top
                if up >= 0:
                    below[up] = top
            members[top].append(p)
            group[p] = top
        members[g] = []
        g = below[g]
    return found


class _Extensions:
    """Longest common extensions within one sequence, by hashes of its ranges."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.up, self.down = _power_tables(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * self.up[: self.n], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def reach(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """How far the words from (or, backwards, before) ``i`` and ``j > i`` agree."""
        low, high = np.zeros(len(i), np.int64), i.copy() if back else self.n - j
        while len(i) and (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashes(i - mid, i) == self.hashes(j - mid, j) if back else self.hashes(i, i + mid) == self.hashes(j, j + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _borne_out(codes: np.ndarray, start: int, end: int, q: int) -> bool:
    """Whether the words from ``start`` to ``end`` have period ``q`` and no neighbour goes on with it."""
    return (np.array_equal(codes[start : end - q], codes[start + q : end]) and (start == 0 or codes[start - 1] != codes[start + q - 1])
            and (end == len(codes) or codes[end] != codes[end - q]))


def _from_root(codes: np.ndarray, root: int, q: int) -> tuple[int, int]:
    """A root extended word by word."""
    start, end = root, root + q
    while end < len(codes) and codes[end] == codes[end - q]:
        end += 1
    while start > 0 and codes[start - 1] == codes[start + q - 1]:
        start -= 1
    return start, end


def runs_of(codes: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> set[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbered words."""
    ext, n, out = _Extensions(codes), len(codes), set()
    symbols = codes.tolist()
    for order in (symbols, [-s for s in symbols]):
        q = np.array(lyndon_array(order), np.int64)
        i = np.arange(n)
        if min_exponent > 2:  # two whole roots then follow each other
            i = np.flatnonzero(i + 2 * q <= n)
            q = q[i]
            twice = ext.hashes(i, i + q) == ext.hashes(i + q, i + 2 * q)
            i, q = i[twice], q[twice]
        start, end = i - ext.reach(i, i + q, True), i + q + ext.reach(i, i + q, False)
        long = end - start >= np.maximum(min_words, min_exponent * q)
        i, q, start, end = i[long], q[long], start[long], end[long]
        claims, of = np.unique(np.stack([start, end, q], axis=1), axis=0, return_inverse=True)
        for k, (s, e, period) in enumerate(claims.tolist()):
            # where two different ranges had one hash, each root is extended by itself
            ends = {(s, e)} if _borne_out(codes, s, e, period) else {_from_root(codes, x, period) for x in i[of.ravel() == k].tolist()}
            out |= {(s, e - s, period) for s, e in ends if e - s >= max(min_words, min_exponent * period)}
    return out


def _stretches(marked: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that grams beginning at ``marked`` places cover."""
    edge = np.zeros(len(marked) + 1, np.int64)
    at = np.flatnonzero(marked)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + gram, len(marked)), -1)
    inside = np.cumsum(edge[:-1]) > 0
    turn = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def candidate_stretches(codes: np.ndarray, text: np.ndarray, gram: int, min_words: int) -> list[tuple[int, int]]:
    """Stretches that may hold a run; ``text`` numbers the text of each word (ascending)."""
    n = len(codes)
    if n < min_words:
        return []
    ext, at = _Extensions(codes), np.arange(n - gram + 1)
    at = at[text[at] == text[at + gram - 1]]
    keys = ext.hashes(at, at + gram) + mix(text[at].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    one, next_ = at[order[same]], at[order[same + 1]]  # neighbouring copies of a gram in one text
    for last in (False, True):
        marked = np.zeros(n, bool)
        marked[one] = marked[next_] = True
        starts, ends = _stretches(marked, gram)
        if not last:
            together = np.searchsorted(starts, one, "right") == np.searchsorted(starts, next_, "right")
            one, next_ = one[together], next_[together]
    # neighbouring texts may touch
    return [(a, b) for s, e in zip(starts.tolist(), ends.tolist(), strict=True) for a, b in _by_text(text, s, e) if b - a >= min_words]


def _by_text(text: np.ndarray, start: int, end: int) -> list[tuple[int, int]]:
    cuts = [start, *(np.flatnonzero(np.diff(text[start:end])) + start + 1).tolist(), end]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _piece(texts: list[bytes], min_words: int, min_exponent: int) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs, collapsed text) of each text."""
    split = [t.split() for t in texts]  # bytes split at 20 and 09-0D, as words are defined
    count = np.array([len(w) for w in split], np.int64)
    first = np.cumsum(count) - count
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for words in split for w in words), np.int64, int(count.sum()))
    text = np.repeat(np.arange(len(texts)), count)
    gram = max(min_words * (min_exponent - 1) // min_exponent, 1)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in candidate_stretches(codes, text, gram, min_words):
        k = int(text[a])
        runs[k] += [(a - int(first[k]) + s, n, q) for s, n, q in runs_of(codes[a:b], min_words, min_exponent)]
    out = []
    for words, found in zip(split, runs, strict=True):
        found.sort(key=lambda r: (r[0], r[2]))
        if found:
            edge = np.zeros(len(words) + 1, np.int64)
            for s, n, q in found:
                edge[s + q] += 1
                edge[s + n] -= 1
            kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
        else:
            kept = words
        out.append((len(words), found, b" ".join(kept)))
    return out


def _find(min_words: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, size, i = batch.column(0), np.diff(np.asarray(_offsets(batch.column(1)))), 0
            while i < batch.num_rows:
                j, held = i, 0
                while j < batch.num_rows and (j == i or held + size[j] <= PIECE_BYTES):
                    held += int(size[j])
                    j += 1
                done = _piece([t or b"" for t in batch.column(1).slice(i, j - i).to_pylist()], min_words, min_exponent)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).cast(pa.int64()), pa.array([n for n, _, _ in done], pa.int64()),
                     pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for _, r, _ in done], pa.list_(RUN)),
                     pa.array([t for _, _, t in done], pa.binary()).cast(pa.string())], schema=FOUND)
                i = j
    return run


def _offsets(column: pa.Array) -> np.ndarray:
    """Running byte lengths of a binary column."""
    import pyarrow.compute as pc
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))])


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per document its number of words, all its runs by start and period, and its text without the repeats.

    A word is left out of the collapsed text if some run contains it after that
    run's first period.  ``min_exponent`` is 2 at least.
    """
    if min_exponent < 2 or min_words < 2:
        raise ValueError("a run has two periods at least")
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_find(min_words, min_exponent), FOUND_DDL)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth end periodically, from a place and with a period drawn from the id.

    With h = crc32 of the id and g = floor(h / 10), where h is divisible by ten
    every word from a = g mod n on is replaced so that the p = 1 + floor((n - a) / (3 + g mod 8))
    words at a come again and again.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.coalesce("text", F.lit(""))
    chosen = docs.select("doc_id", text.alias("text"), h.alias("h"), F.when(h % 10 == 0, word_array(text)).alias("words"))
    sized = chosen.withColumn("n", F.size(F.coalesce("words", F.array().cast("array<string>"))))
    g = F.floor(F.col("h") / 10)
    placed = sized.withColumn("a", F.when(F.col("n") > 0, (g % F.col("n")).cast("int")))
    tail = F.col("n") - F.col("a")
    placed = placed.withColumn("p", (F.floor(tail / (g % 8 + 3)) + 1).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil(tail / F.col("p")).cast("int"))), F.lit(1), tail)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Of the found runs: how many, the one of greatest exact exponent (ties: first start, then period), and digests."""
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
