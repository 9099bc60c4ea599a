"""Language-model scoring with a probabilistic suffix tree over words.

The tree's states are word contexts of up to ``max_depth`` words.  Every context of the
training texts is a candidate, and becomes a state if its next-word distribution
diverges enough from that of its longest proper suffix.  A state keeps the next words that
follow it twice or more with discounted probabilities; what is left goes
to all other words in proportion to the suffix's distribution, down to add-one
word frequencies.  A token is scored by the longest suffix of what precedes it
that is a state.

Words, contexts and next words are counted over every training document: each task
counts its own texts, and one shuffle adds the counts up.  The tree is a table for each
depth and grows with the corpus; the divergence test is a grouping by context.  With
each state's factor for what is left, and each next word's share over what the suffix gives it,
the logarithm of a text's probability is a sum over the word sequences in it,
so a text fetches what it needs by one join on sequences.  Two bounded things are broadcast and save
shuffling only: what makes up at least ``hot`` of all tokens, and
one bit for each sequence's slot, which tells most sequences that no table holds.  A sequence is known by
64 bits.

Sequences to be counted or fetched are dealt out by their bits to buckets, whose number grows with the corpus;
a task hands on one row for each bucket, with lists.  What the buckets of a part add to a text is summed in one pass over them.  A step's shuffle files are removed once its table is stored,
and so is a table that no later step reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed
from vitrina.llm.tokens import mix, salt, word_hashes
from vitrina.session import scratch_path, ship_package

MAX_DEPTH = 2
#: Least shares of all tokens; by default every word, context and next word (seen twice) takes part.
MIN_WORD = MIN_CONTEXT = MIN_ENTRY = 0.0
DISCOUNT = 0.75
#: What makes up this share of all tokens is held in memory rather than joined.
HOT = 2.0**-20
#: There is a bucket for so many tokens of the training texts, in a fixed number of parts: a text gets one sum from each part.
BUCKET_TOKENS, PARTS = 1_000_000, 32
_SLOT_BITS = 27
#: Hash of the token that ends a text.
END = int(salt(31).view(np.int64))
_BITS = 20  # a frequent word's number has this many bits
#: Distinct keys that a task counts before it hands them on.
_HELD = 2_000_000


class _Counter:
    """Counts of 64-bit keys, merged as they come, with columns that depend on the key."""

    def __init__(self, more: int = 0):
        self.more, self.parts, self.size = more, [], 0

    def add(self, keys: np.ndarray, *more: np.ndarray) -> None:
        if more:
            keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
            self._put(keys, counts, *[x[first] for x in more])
        else:
            self._put(*np.unique(keys, return_counts=True))

    def _put(self, *columns) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def full(self) -> bool:
        if self.size > _HELD:
            self.merge()
        return self.size > _HELD // 2

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, counts, *more = [np.concatenate(column) for column in zip(*self.parts, strict=True)]
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.parts, self.size = [], 0
            self._put(keys[first], np.add.reduceat(counts, first) if len(first) else counts, *[x[order[first]] for x in more])

    def taken(self) -> tuple[np.ndarray, ...]:
        """Keys, counts and the other columns, which are then held no more."""
        self.merge()
        columns = self.parts[0] if self.parts else [np.zeros(0, np.int64)] * (2 + self.more)
        self.parts, self.size = [], 0
        return tuple(x.view(np.int64) for x in columns)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in self.taken()], ["key", "c"])


def _tokens(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As ``word_hashes``, with the end token after each text's words."""
    for first, bounds, words in word_hashes(texts):
        yield first, bounds + np.arange(len(bounds)), np.insert(words.view(np.int64), bounds[1:], END)


def _lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of keys in a sorted table; -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _sequence(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Key of a word sequence from those of the sequences without its last and without its first word."""
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(after + salt(32)))


def _sequences(tokens: np.ndarray, bounds: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one word, two words and so on: the places where a sequence within one text ends, and keys by place."""
    place = np.arange(len(tokens)) - np.repeat(bounds[:-1], np.diff(bounds))
    keys = tokens.view(np.uint64)
    for n in range(most):
        if n:
            keys = np.r_[keys[:1], _sequence(keys[:-1], keys[1:])]
        yield np.flatnonzero(place >= n), keys


@dataclass
class Tree:
    """A tree in one memory: frequent words and, by depth from 1, contexts and next words."""

    words: np.ndarray  # hashes, ascending; a word's number is its place
    word_log: np.ndarray  # log10 of add-one frequencies
    contexts: list[np.ndarray] = field(default_factory=list)  # codes, ascending: shorter context's number and the last word's
    entries: list[np.ndarray] = field(default_factory=list)  # codes, ascending: the context's number and the next word's
    entry_log: list[np.ndarray] = field(default_factory=list)
    rest_log: list[np.ndarray] = field(default_factory=list)  # factor of what is left
    state: list[np.ndarray] = field(default_factory=list)  # whether the context is a state

    def numbers(self, tokens: np.ndarray) -> np.ndarray:
        return _lookup(self.words, tokens)

    def states(self, ids: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """For each depth, the number of the context before each token, or -1."""
        first = np.zeros(len(ids), bool)
        first[bounds[:-1][bounds[:-1] < len(ids)]] = True
        out, shorter = [], np.zeros(len(ids), np.int64)  # the empty context stands before every token
        for table in self.contexts:
            code = np.where((shorter >= 0) & (ids >= 0), (shorter << _BITS) + ids, -1)
            ending = np.full(len(ids), -1, np.int64)  # context that ends with each token
            ok = np.flatnonzero(code >= 0)
            ending[ok] = _lookup(table, code[ok])
            before = np.r_[-1, ending[:-1]] if len(ids) else ending
            before[first] = -1
            out.append(before)
            shorter = before
        return out

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """log10 probability of each token; for a word that is not frequent, without its frequency."""
        logp = np.zeros(len(ids))
        todo = np.ones(len(ids), bool)
        for d, before in reversed(list(enumerate(self.states(ids, bounds)))):
            if d >= len(self.state):
                continue
            at = np.flatnonzero(todo & (before >= 0))
            at = at[self.state[d][before[at]]]
            found = np.where(ids[at] >= 0, _lookup(self.entries[d], (before[at] << _BITS) + ids[at]), -1)
            logp[at] += np.where(found >= 0, self.entry_log[d][np.maximum(found, 0)] if len(self.entry_log[d]) else 0.0, self.rest_log[d][before[at]])
            todo[at[found >= 0]] = False
        known = todo & (ids >= 0)
        logp[known] += self.word_log[ids[known]]
        return logp

    def prob(self, depth: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Probability of frequent words after contexts of a depth (0: none)."""
        if depth == 0:
            return 10.0 ** self.word_log[word]
        d = depth - 1
        shorter = self.prob(d, self._suffix(depth, context), word)
        found = _lookup(self.entries[d], (context << _BITS) + word)
        own = np.where(found >= 0, 10.0 ** self.entry_log[d][np.maximum(found, 0)] if len(self.entry_log[d]) else 0.0, 10.0 ** self.rest_log[d][context] * shorter)
        return np.where(self.state[d][context], own, shorter)

    def _suffix(self, depth: int, context: np.ndarray) -> np.ndarray:
        """Number of the context less its first word."""
        if depth == 1:
            return np.zeros(len(context), np.int64)
        code = self.contexts[depth - 1][context]
        head, last = code >> _BITS, code & ((1 << _BITS) - 1)
        return _lookup(self.contexts[depth - 2], (self._suffix(depth - 1, head) << _BITS) + last)

    def grow(self, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> None:
        """Next words of the deepest contexts: tests their divergence and adds the depth to the tree."""
        depth = len(self.contexts)
        of, word = codes >> _BITS, codes & ((1 << _BITS) - 1)
        n, m = len(self.contexts[-1]), sizes.astype(float)
        p = (counts - DISCOUNT) / m[of]
        shorter = self.prob(depth - 1, self._suffix(depth, of), word)
        rest = np.maximum(1 - np.bincount(of, p, n), 1e-12)
        rest_shorter = np.maximum(1 - np.bincount(of, shorter, n), 1e-12)
        gain = m * (np.bincount(of, p * np.log(p / shorter), n) + rest * np.log(rest / rest_shorter))
        self.entries.append(codes)
        self.entry_log.append(np.log10(p))
        self.rest_log.append(np.log10(rest / rest_shorter))
        # the evidence must outweigh the cost of the numbers that a state holds
        self.state.append(gain > 0.5 * np.bincount(of, minlength=n) * np.log(np.maximum(m, 2)) + 3)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Counter()
    for batch in batches:
        for _, _, tokens in _tokens(batch.column(0).to_pylist()):
            held.add(tokens)
            if held.full():
                yield held.batch()
    yield held.batch()


def _count_next(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, held = tree.value, _Counter()
        for batch in batches:
            for _, bounds, tokens in _tokens(batch.column(0).to_pylist()):
                ids = t.numbers(tokens)
                before = t.states(ids, bounds)[-1]
                ok = (before >= 0) & (ids >= 0)
                held.add((before[ok] << _BITS) + ids[ok])
                if held.full():
                    yield held.batch()
        yield held.batch()
    return run


def _slot(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _slots(tables: list[DataFrame]) -> np.ndarray:
    """One bit for each slot that a key of the tables falls into: 16 MB whatever their size."""
    slot = reduce(lambda a, b: a.unionByName(b), [t.select(F.shiftrightunsigned("key", 64 - _SLOT_BITS).alias("slot")) for t in tables])
    got = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("bits")).toArrow()
    bits = np.zeros(1 << (_SLOT_BITS - 6), np.uint64)
    bits[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return bits


def _in_slots(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = _slot(keys)
    return bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1) == 1


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _dealt(bucket: np.ndarray, first: np.ndarray, *more: np.ndarray) -> list[pa.Array]:
    """A row for each bucket: its number and lists of its values, by the first column, so that equal ones lie together."""
    order = np.lexsort((first, bucket))
    there, at = np.unique(bucket[order], return_index=True)
    ends = pa.array(np.r_[at, len(order)].astype(np.int32))
    return [pa.array(there), *[pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (first, *more)]]


def _listed(column: pa.ChunkedArray, dtype: type = np.int64) -> np.ndarray:
    """All values of a column of lists."""
    return np.concatenate([np.zeros(0, dtype), *[x.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False) for x in column.chunks]])


def _count_sequences(words: int, seen, buckets: int):
    """Sequences of two words or more, by their longest beginning and longest end, both of which must be ``seen``."""
    def dealt(held: _Counter) -> pa.RecordBatch:
        keys, counts, prefix, suffix = held.taken()
        return pa.RecordBatch.from_arrays(_dealt(_bucket(keys, buckets), prefix, suffix, counts.astype(np.int64)), ["bucket", "prefix", "suffix", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counter(2)
        for batch in batches:
            for _, bounds, tokens in _tokens(batch.column(0).to_pylist()):
                *_, (_, shorter), (at, keys) = _sequences(tokens, bounds, words)
                if seen is not None:
                    ok = _in_slots(seen.value, shorter)
                    at = at[ok[at] & ok[at - 1]]
                held.add(keys[at], shorter[at - 1], shorter[at])
                if held.full():
                    yield dealt(held)
        yield dealt(held)
    return run


def _add_up(least: float):
    """The sequences of a bucket that are seen ``least`` times or more in all."""
    def run(table: pa.Table) -> pa.Table:
        prefix, suffix, c = (_listed(table.column(name)) for name in ("prefix", "suffix", "c"))
        keys = _sequence(prefix.view(np.uint64), suffix.view(np.uint64))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        c = np.add.reduceat(c[order], first) if len(first) else c
        often = c >= least
        at = order[first[often]]
        return pa.table({"prefix": prefix[at], "suffix": suffix[at], "c": c[often]})
    return run


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        before, after = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(_sequence(before, after).view(np.int64)), *batch.columns[2:]], ["key", *batch.schema.names[2:]])


#: Of a text: its number, its id and what is known of it before anything is fetched.
_TEXT = "row long, doc_id long, n long, known long, base double, score double"
_PARTS = [x.split(" ")[0] for x in _TEXT.split(", ")]


def _score(shared, most: int, buckets: int):
    """A row for each text, and for each bucket rows with the sequences to fetch and the texts that they are for."""
    def asked(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        row, key = (np.concatenate(x) for x in zip(*held, strict=True))
        dealt = _dealt(_bucket(key, buckets), row, key)
        return pa.RecordBatch.from_arrays([*dealt, *[pa.nulls(len(dealt[0]), pa.float64() if p in ("base", "score") else pa.int64()) for p in _PARTS]], ["bucket", "rows", "keys", *_PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, word_log, hot, hot_value, slots = shared.value
        none = np.zeros(0, np.int64)
        held, size = [(none, none)], 0
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for first, bounds, tokens in _tokens(batch.column(2).to_pylist()):
                m = len(bounds) - 1
                of = np.repeat(np.arange(m), np.diff(bounds))
                row = rows[first : first + m]
                place = _lookup(words, tokens)
                known = place >= 0
                base = np.bincount(of[known], word_log[place[known]], m).astype(float)
                own, there = np.zeros(m), np.ones(len(tokens), bool)
                held.append((row[of[~known]], tokens[~known]))
                for n, (at, keys) in enumerate(_sequences(tokens, bounds, most)):
                    if n == most - 1:  # of the longest, only those that begin with a state are in a table
                        at = at[there[at - 1]]
                    at = at[_in_slots(slots, keys[at])]
                    there = np.zeros(len(tokens), bool)
                    there[at] = True
                    key = keys[at].view(np.int64)
                    found = _lookup(hot, key)
                    inside = found >= 0
                    own += np.bincount(of[at[inside]], hot_value[found[inside]], m)
                    if n:  # single words that are not hot are joined anyway
                        held.append((row[of[at[~inside]]], key[~inside]))
                lists = pa.nulls(m, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((row % buckets).astype(np.int32)), lists, lists, pa.array(row), batch.column(1).slice(first, m), pa.array(np.diff(bounds)), pa.array(np.bincount(of[known], minlength=m)), pa.array(base), pa.array(base + own)],
                    ["bucket", "rows", "keys", *_PARTS])
                size += len(tokens)
                if size > _HELD // 2:
                    yield asked(held)
                    held, size = [(none, none)], 0
        yield asked(held)
    return run


#: Texts and the sequences they ask for; sequences of the tree, counts and values.
_LISTS = ["rows", "keys", "tree", "c", "v"]


def _deal(buckets: int):
    """Lists of a table ``(key, c, v)`` by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt() -> pa.RecordBatch:
            key, c, v = (np.concatenate(x) for x in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays(_dealt(_bucket(key, buckets), key, c, v), ["bucket", "tree", "c", "v"])

        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        held, size = [none], 0
        for batch in batches:
            held.append(tuple(x.to_numpy() for x in batch.columns))
            size += batch.num_rows
            if size > _HELD // 2:
                yield dealt()
                held, size = [none], 0
        yield dealt()
    return run


def _in_bucket(table: pa.Table, unit: float) -> tuple[np.ndarray, ...]:
    """What a bucket's sequences add to texts: numbers of texts, logarithms of rare words, how many of them are known, and values of the tree."""
    row, key, keys, c, v = (_listed(table.column(name), float if name == "v" else np.int64) for name in _LISTS)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    # a sequence may be a word, a state and a next word
    c, v = (np.add.reduceat(x[order], first) if len(first) else x for x in (c, v))
    found = _lookup(keys[first], key)
    row, found = row[found >= 0], found[found >= 0]
    return _summed([(row, np.where(c > 0, np.log10((c + 1) / unit), 0.0)[found], (c > 0)[found], v[found])])


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sums by the first column."""
    row, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
    rows, of = np.unique(row, return_inverse=True)
    return rows, *[np.bincount(of, x, len(rows)).astype(float) for x in values]


def _fetch(unit: float):
    """From rows in the order of buckets: the texts, and what the buckets add to them."""
    sums = ["rare", "rare_known", "v"]

    def fetched(parts: list[tuple[np.ndarray, ...]], types: list[pa.DataType]) -> pa.RecordBatch:
        row, rare, known, v = _summed(parts)
        return pa.RecordBatch.from_arrays([pa.array(row), *[pa.nulls(len(row), t) for t in types], pa.array(rare), pa.array(known.astype(np.int64)), pa.array(v)], [*_PARTS, *sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, parts, size, types = None, [], [], 0, []
        for batch in batches:
            texts = batch.filter(batch.column("row").is_valid())
            m, types = texts.num_rows, [batch.schema.field(p).type for p in _PARTS[1:]]
            yield pa.RecordBatch.from_arrays([*[texts.column(p) for p in _PARTS], pa.array(np.zeros(m)), pa.array(np.zeros(m, np.int64)), pa.array(np.zeros(m))], [*_PARTS, *sums])
            bucket, lists = batch.column("bucket").to_numpy(), batch.select(_LISTS)
            cuts = np.r_[np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1)), len(bucket)]
            for at, end in zip(cuts[:-1], cuts[1:], strict=True):
                if held and bucket[at] != now:
                    parts.append(_in_bucket(pa.Table.from_batches(held), unit))
                    held, size = [], size + len(parts[-1][0])
                    if size > _HELD:
                        parts = [_summed(parts)]
                        size = len(parts[0][0])
                        if size > _HELD // 2:
                            yield fetched(parts, types)
                            parts, size = [], 0
                now = bucket[at]
                held.append(lists.slice(at, end - at))
        if held:
            parts.append(_in_bucket(pa.Table.from_batches(held), unit))
        if parts:
            yield fetched(parts, types)
    return run


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _collected(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Key and count columns in the order of keys; only for tables whose size is bounded by the tree's shares."""
    got = df.orderBy("key").toArrow()
    return got.column("key").to_numpy().astype(np.int64), got.column("c").to_numpy().astype(np.int64)


def _word_counts(texts: DataFrame) -> tuple[DataFrame, int, int]:
    """Table of word counts, tokens, distinct tokens."""
    counts = checkpointed(texts.mapInArrow(_count_words, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    return counts, total, distinct


def train(texts: DataFrame, max_depth: int, min_word: float, min_context: float, min_entry: float):
    """(tree, table of word counts, tokens, distinct tokens) of ``texts (text binary)``, the tree in memory: its size is bounded by the shares only."""
    counts, total, distinct = _word_counts(texts)
    keys, c = _collected(counts.where(F.col("c") >= max(1, min_word * total)))
    tree = Tree(keys, np.log10((c + 1) / (total + distinct + 1)))
    end = _lookup(keys, np.array([END]))[0]
    codes, sizes = np.arange(len(keys), dtype=np.int64), c  # contexts of one word: the empty context has number 0
    sc = texts.sparkSession.sparkContext
    for _ in range(max_depth):
        often = (sizes >= min_context * total) & (codes & ((1 << _BITS) - 1) != end)
        if not often.any():
            break
        tree.contexts.append(codes[often])
        shared = sc.broadcast(tree)
        found = texts.mapInArrow(_count_next(shared), "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= max(2, min_entry * total))
        codes, counted = _collected(found)
        shared.unpersist()
        tree.grow(sizes[often], codes, counted)
        sizes = counted
    return tree, counts, total, distinct


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of an action are removed as it ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _removed(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)  # noqa: SLF001


def _buckets(total: int) -> int:
    return PARTS * -(-max(total, 1) // (PARTS * BUCKET_TOKENS))


def grow(texts: DataFrame, counts: DataFrame, total: int, distinct: int, max_depth: int = MAX_DEPTH, min_word: float = MIN_WORD, min_context: float = MIN_CONTEXT,
         min_entry: float = MIN_ENTRY) -> list[DataFrame]:
    """The whole tree as tables ``(key, n, v)``: what each occurrence of a word sequence, seen ``n`` times, adds to a text's log10 probability."""
    spark = texts.sparkSession
    path = scratch_path(spark, f"suffix-tree-{uuid.uuid4().hex}")
    level = counts.where(F.col("c") >= max(1, min_word * total)).select("key", "c", F.log10((F.col("c") + 1) / F.lit(float(total + distinct + 1))).alias("lp"))
    values, seen = [], None
    for depth in range(1, max_depth + 1 if total else 1):
        counted = texts.mapInArrow(_count_sequences(depth + 1, seen, _buckets(total)), "bucket int, prefix array<long>, suffix array<long>, c array<long>")
        counted = counted.groupBy("bucket").applyInArrow(_add_up(max(2, min_entry * total)), "prefix long, suffix long, c long")
        counted = _stored(counted, f"{path}/counted{depth}")
        contexts = level.where(F.col("c") >= min_context * total).select(F.col("key").alias("prefix"), F.col("c").alias("m"))
        nexts = counted.join(contexts, "prefix").join(level.select(F.col("key").alias("suffix"), F.col("lp").alias("shorter")), "suffix")
        nexts = _stored(nexts.select("prefix", "suffix", "c", "m", "shorter"), f"{path}/nexts{depth}")
        _removed(spark, f"{path}/counted{depth}")
        if seen is not None:
            seen.unpersist()
        p, q = (F.col("c") - DISCOUNT) / F.col("m"), F.pow(F.lit(10.0), F.col("shorter"))
        sums = nexts.groupBy("prefix").agg(F.count("*").alias("k"), F.first("m").alias("m"), F.sum(p).alias("p"), F.sum(q).alias("q"), F.sum(p * F.log(p / q)).alias("d"))
        left, left_shorter = F.greatest(1 - F.col("p"), F.lit(1e-12)), F.greatest(1 - F.col("q"), F.lit(1e-12))
        gain = F.col("m") * (F.col("d") + left * F.log(left / left_shorter))
        # the evidence must outweigh the cost of the numbers that a state holds
        states = sums.where(gain > 0.5 * F.col("k") * F.log(F.greatest("m", F.lit(2))) + 3).select("prefix", "m", F.log10(left / left_shorter).alias("rest"))
        states = _stored(states, f"{path}/states{depth}")
        last = depth == max_depth
        grown = nexts.join(states.select("prefix", "rest"), "prefix", "inner" if last else "left")
        lp = F.when(F.col("rest").isNotNull(), F.log10(p)).otherwise(F.col("shorter"))
        grown = grown.select("prefix", "suffix", "c", lp.alias("lp"), (lp - F.col("rest") - F.col("shorter")).alias("v"))
        level = grown.mapInArrow(_with_key, "key long, c long, lp double, v double")
        level = _stored(level.drop("lp") if last else level, f"{path}/level{depth}")
        _removed(spark, f"{path}/nexts{depth}")
        values += [states.select(F.col("prefix").alias("key"), F.col("m").alias("n"), F.col("rest").alias("v")), level.where("v IS NOT NULL").select("key", F.col("c").alias("n"), "v")]
        if not last:
            seen = spark.sparkContext.broadcast(_slots([level]))
    return values


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: float = HOT, max_depth: int = MAX_DEPTH, **shares) -> DataFrame:
    """Scores of all documents by a tree that learns from those that are not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``.  Null text is empty (its one token is the end); a null id is
    never held out; repeated rows are learned from and returned as often as they
    occur; other columns are ignored; no rows give no rows; with nothing to
    learn from, every token has probability 1.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    texts = rows.where(~_held_out(F.col("doc_id"))).select("text")
    with _shuffles_removed(spark):
        counts, total, distinct = _word_counts(texts)
        values, unit, often = grow(texts, counts, total, distinct, max_depth, **shares), float(total + distinct + 1), max(1, hot * total)
        none = counts.where("false").select("key", F.col("c").alias("n"), F.lit(0.0).alias("v"))
        values = reduce(lambda a, b: a.unionByName(b), values, none)
        words, c = _collected(counts.where(F.col("c") >= often))
        # a sequence is a state, a next word or both, seen the same number of times
        held = values.where(F.col("n") >= often).groupBy("key").agg(F.sum("v").alias("c")).orderBy("key").toArrow()
        slots = _slots([values])
    shared, buckets = spark.sparkContext.broadcast((words, np.log10((c + 1) / unit), held.column("key").to_numpy(), held.column("c").to_numpy(), slots)), _buckets(total)
    asked = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _score(shared, max_depth + 1, buckets), f"bucket int, rows array<long>, keys array<long>, {_TEXT}")
    table = counts.where(F.col("c") < often).select("key", "c", F.lit(0.0).alias("v")).unionByName(values.where(F.col("n") < often).select("key", F.lit(0).cast("long").alias("c"), "v"))
    table = table.mapInArrow(_deal(buckets), "bucket int, tree array<long>, c array<long>, v array<double>")
    both = asked.unionByName(table, allowMissingColumns=True).withColumn("part", F.floor(F.col("bucket") / (buckets // PARTS)))
    full = both.repartition("part").sortWithinPartitions("part", "bucket").mapInArrow(_fetch(unit), f"{_TEXT}, rare double, rare_known long, v double")
    done = full.groupBy("row").agg(*[F.max(p).alias(p) for p in _PARTS[1:]], *[F.sum(x).alias(x) for x in ("rare", "rare_known", "v")])
    rare = F.col("rare") - (F.col("n") - F.col("known") - F.col("rare_known")) * F.lit(float(np.log10(unit)))
    return done.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + F.col("rare_known")).alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + rare).alias("base_score"), (F.col("score") + rare + F.col("v")).alias("score"))
