"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Two sets link when ``den * intersection >= num * union``.  Such a pair cannot
differ in more than a few shingles, and that bound gives keys that it must share:

* small sets emit hashes of all their subsets of a fixed size (the least
  overlap that a pair of their sizes needs), so a linked pair meets under one;
* large sets are posted in inverted lists.  The order of shingle hashes is cut
  into more cells than a linked pair can have differing shingles, so at least
  one cell holds the same shingles in both: lists are kept by cell and content.
  (Lists of single shingles would be as long as a common passage is frequent.)

The size at which the second way takes over is chosen by cost from the histogram
of set sizes.  Lists are scanned after one shuffle by key.  A list of few
members gives all its pairs; a long one gives pairs with its smallest member
only.  If one of these turns out not to link, and the list's members do not all come to lie in one
component by other lists, they are compared with the list's most central one, and what is
then still apart by inverted lists of its rarest shingles.
So a group of near copies costs a number of pairs in proportion to its size, and
no link between different texts is lost.  Every pair is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed, kept, wrapped
from vitrina.llm.components import components
from vitrina.llm.tokens import mix, salt, shingle_sets
from vitrina.session import ship_package

#: Lists up to this length give all their pairs at once.
SHORT = 16
#: A posting in an inverted list costs this many times a subset's: what it meets may not link.
LIST_COST = 4
#: Sizes that are considered for the boundary.
MAX_SMALL = 48
#: Members of a list whose sketches say what its content usually is.
VOTERS = 64
#: Hash buckets in which shingles are counted at most (4 bytes each, broadcast), and buckets a row.
MAX_BUCKETS = 1 << 23
SLICE = 1 << 14
#: Document ids that are broadcast at most (16 bytes each); beyond, the same join is a shuffle.
MAX_BROADCAST_IDS = 2_000_000


# --- sizes ---------------------------------------------------------------------------------------------------------

def least_overlap(a: int, b: int, num: int, den: int) -> int:
    """Shingles that sets of these sizes must share to link."""
    return -(-num * (a + b) // (num + den))


def overlaps(n: int, small: int, num: int, den: int) -> list[int]:
    """The subset sizes that a set of ``n`` emits, for partners such that the smaller of both is at most ``small``."""
    lo, hi = -(-num * n // den), den * n // num
    return sorted({least_overlap(n, p, num, den) for p in range(lo, hi + 1) if min(n, p) <= small})


def boundary(sizes: dict[int, int], num: int, den: int) -> int:
    """The size up to which subsets cost less than inverted lists, for this many sets of each size (all larger ones under ``MAX_SMALL``)."""
    best, best_cost = 0, None
    for small in range(0, MAX_SMALL):
        cost = 0
        for n, count in sizes.items():
            cost += count * sum(math.comb(n, c) for c in overlaps(n, small, num, den)) if n <= MAX_SMALL * den // num else 0
            if n > small:
                level = level_of(np.array([n]), num, den)[0]
                cost += count * LIST_COST * (cells(level, num, den)[1] + 1)
        if best_cost is None or cost <= best_cost:
            best, best_cost = small, cost
    return best


_levels: dict[tuple[int, int], list[int]] = {}


def _starts(num: int, den: int, upto: int) -> list[int]:
    """Least size of each level; a linked pair's sizes are in one level or in neighbours."""
    s = _levels.setdefault((num, den), [1])
    while s[-1] <= upto:
        s.append(max(s[-1] + 1, -(-s[-1] * den // num)))
    return s


def level_of(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.searchsorted(np.array(_starts(num, den, int(n.max()) + 1 if len(n) else 1)), n, side="right") - 1


def cells(level: int, num: int, den: int) -> tuple[int, int]:
    """(most shingles in which a linked pair differs, number of cells) where the smaller set is of this level."""
    s = _starts(num, den, 1)
    while len(s) < level + 2:
        _starts(num, den, s[-1])
    most = (den - num) * (s[level + 1] - 1) // num
    return most, most + 1 + (max(2, most // 5) if most else 0)


# --- keys, inside tasks --------------------------------------------------------------------------------------------

def _small_keys(h: np.ndarray, small: int, num: int, den: int) -> np.ndarray:
    total, out = h.sum(dtype=np.uint64, keepdims=True), []
    for c in overlaps(len(h), small, num, den):
        less = len(h) - c
        if less:
            drop = np.fromiter((i for combo in combinations(range(len(h)), less) for i in combo), np.int64).reshape(-1, less)
            out.append(mix(total - h[drop].sum(axis=1, dtype=np.uint64) + salt(1000 + c)))
        else:
            out.append(mix(total + salt(1000 + c)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _list_keys(of: np.ndarray, h: np.ndarray, n: np.ndarray, level: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of each cell for sets at the given levels; ``of`` and ``h`` are ascending, ``n`` and ``level`` by set."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    most = np.zeros(len(n), np.int64)
    width = np.ones(len(n), np.int64)
    for x in np.unique(level[n > 0]):
        most[level == x], width[level == x] = cells(int(x), num, den)
    cell = ((h >> np.uint64(32)) * width[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (cell[1:] != cell[:-1])])
    content = np.add.reduceat(mix(h + salt(7)), first)
    of_c, cell_c = of[first], cell[first]
    level_salt = np.array([salt(2000 + int(x)) for x in range(int(level.max()) + 1)], np.uint64)
    key = mix(content + level_salt[level[of_c]] + mix(cell_c.astype(np.uint64) + salt(8)))
    # a set with many empty cells may share only empty ones with its partner, which then has as many: those become keys too
    filled = np.bincount(of_c, minlength=len(n))
    more_of, more_key = [], []
    for s in np.flatnonzero((n > 0) & (filled <= most)):
        none = np.setdiff1d(np.arange(width[s]), cell_c[of_c == s])
        more_of.append(np.full(len(none), s))
        more_key.append(mix(level_salt[level[s]] + mix(none.astype(np.uint64) + salt(9))))
    return np.concatenate([of_c, *more_of]), np.concatenate([key, *more_key])


def keys_of(ids: np.ndarray, bounds: np.ndarray, h: np.ndarray, small: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, key) of all keys of the sets of one piece."""
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)
    out_id, out_key = [], []
    for s in np.flatnonzero((n > 0) & (-(-num * n // den) <= small)):
        k = _small_keys(mix(h[bounds[s] : bounds[s + 1]] + salt(6)), small, num, den)
        out_id.append(np.full(len(k), ids[s]))
        out_key.append(k)
    level = level_of(np.maximum(n, 1), num, den)
    start = np.array(_starts(num, den, int(n.max()) + 1 if len(n) else 1))
    # under its own level, and under the one below if a partner can be there
    for lower in (0, 1):
        take = (n > small) & ((lower == 0) | ((level > 0) & (-(-num * n // den) < start[level]) & (start[level] - 1 > small)))
        part = take[of] if len(of) else np.zeros(0, bool)
        s, k = _list_keys(of[part], h[part], np.where(take, n, 0), np.maximum(level - lower, 0), num, den)
        out_id.append(ids[s])
        out_key.append(k)
    return np.concatenate(out_id) if out_id else np.zeros(0, np.int64), np.concatenate(out_key) if out_key else np.zeros(0, np.uint64)


def _postings(k: int, small: int, num: int, den: int, only: np.ndarray | None, gather: bool = True) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, a, b): b is null for a posting; where a piece has many sets under one key, one posting and pairs with it.

    With ``only`` (ascending keys) or without ``gather`` all rows are postings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_all = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, bounds, h in shingle_sets(batch.column(1).to_pylist(), k):
                ids = ids_all[first : first + len(bounds) - 1]
                a, key = keys_of(ids, bounds, h, small, num, den)
                if only is not None:
                    at = np.minimum(np.searchsorted(only, key), len(only) - 1)
                    hit = only[at] == key
                    a, key = a[hit], key[hit]
                order = np.lexsort((a, key))
                a, key = a[order], key[order]
                new = np.r_[True, (key[1:] != key[:-1]) | (a[1:] != a[:-1])] if len(key) else np.zeros(0, bool)
                a, key = a[new], key[new]
                b, none = np.zeros(len(a), np.int64), np.ones(len(a), bool)
                if only is None and gather and len(key):
                    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                    size = np.diff(np.r_[begin, len(key)])
                    for s, z in zip(begin[size > SHORT], size[size > SHORT], strict=True):
                        b[s + 1 : s + z], none[s + 1 : s + z] = a[s + 1 : s + z], False
                        a[s + 1 : s + z] = a[s]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(a), pa.array(b, mask=none)], ["key", "a", "b"])
    return run


def _scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, key) of each list; rows come in the order of key and a.  ``key`` is null where all pairs of the list are given."""
    held: list[int] = []
    star, pivot, last = False, None, None
    out: tuple[list, list, list] = ([], [], [])

    def emit(x, y, k):
        if x != y:
            out[0].append(min(x, y)), out[1].append(max(x, y)), out[2].append(k)

    def close():
        if pivot is None:
            for x, y in combinations(held, 2):
                emit(x, y, None)

    def row(k, a, b):
        nonlocal star, pivot, last, held
        if k != last:
            close()
            held, star, pivot, last = [], False, None, k
        if pivot is None and (not held or held[-1] != a):
            held.append(a)
        if b is not None:
            emit(a, b, k)
        if pivot is None and (b is not None or len(held) > SHORT):
            pivot = held[0]
            for x in held[1:]:
                emit(pivot, x, k)
        elif pivot is not None:
            emit(pivot, a, k)

    def flush():
        got = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b", "key"])
        for x in out:
            x.clear()
        return got

    for batch in batches:
        key, a, b = (batch.column(i) for i in range(3))
        k = key.to_numpy(zero_copy_only=False)
        if not len(k):
            continue
        # rows alone under their key are passed over in one go, but for the batch's ends
        same = k[1:] == k[:-1]
        many = np.r_[True, same] | np.r_[same, True]
        a, b = a.filter(pa.array(many)).to_pylist(), b.filter(pa.array(many)).to_pylist()
        for x in zip(k[many].tolist(), a, b, strict=True):
            row(*x)
            if len(out[0]) >= 50_000:
                yield flush()
    close()
    yield flush()


def _sets(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, h in shingle_sets(batch.column(1).to_pylist(), k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(bounds) - 1), pa.array([h[bounds[i] : bounds[i + 1]].tobytes() for i in range(len(bounds) - 1)], pa.binary())], ["id", "items"])
    return run


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (mix(h + salt(11)) >> np.uint64(64 - bits)).astype(np.int64)


def _bucket_counts(k: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (slice, counts) of a task: shingles by hash bucket, ``SLICE`` buckets a row; slices without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for _, _, h in shingle_sets(batch.column(1).to_pylist(), k):
                np.add.at(counts, _bucket(h, bits), 1)
        rows = [(i, counts[i * SLICE : (i + 1) * SLICE]) for i in range((1 << bits) // SLICE)]
        rows = [(i, zstandard.compress(c.tobytes())) for i, c in rows if c.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())], ["slice", "counts"])
    return run


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(SLICE, np.uint32)
    for c in table.column("counts"):
        total += np.frombuffer(zstandard.decompress(c.as_py()), np.uint32)
    return pa.table([table.column("slice").combine_chunks().slice(0, 1), pa.array([zstandard.compress(total.tobytes())], pa.binary())], ["slice", "counts"])


def _prefixes(k: int, num: int, den: int, often) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (g, id, n, place, indexed) of the first shingles of each set, rare ones first, as far as a partner must share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = len(often.value).bit_length() - 1
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, bounds, h in shingle_sets(batch.column(1).to_pylist(), k):
                n = np.diff(bounds)
                of = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((h, often.value[_bucket(h, bits)], of))
                h, place = h[order], np.arange(len(h)) - np.repeat(bounds[:-1], n) + 1
                probe, index = n + num * n // -den + 1, n + 2 * n * num // -(num + den) + 1
                take = place <= probe[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[take].view(np.int64)), pa.array(ids[first : first + len(n)][of[take]]), pa.array(n[of[take]].astype(np.int32)),
                     pa.array(place[take].astype(np.int32)), pa.array((place <= index[of])[take])], ["g", "id", "n", "place", "indexed"])
    return run


def _summaries(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, size, two sums over the set that stand for its content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, h in shingle_sets(batch.column(1).to_pylist(), k):
                cols = []
                for s in (3, 4):
                    sums = np.r_[np.uint64(0), np.cumsum(mix(h + salt(s)), dtype=np.uint64)]
                    cols.append(pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(bounds) - 1), pa.array(np.diff(bounds)), *cols], ["doc_id", "n", "s1", "s2"])
    return run


def _sketch(h: np.ndarray, level: int, num: int, den: int) -> bytes:
    """A byte for each cell of a set at a level; 0 for an empty one."""
    _, width = cells(level, num, den)
    cell = ((h >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    out = np.zeros(width, np.uint8)
    out[cell[first]] = mix(np.add.reduceat(mix(h + salt(7)), first)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def _sketches(k: int, num: int, den: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, level, sketch at that level, sketch at the level below)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, h in shingle_sets(batch.column(1).to_pylist(), k):
                n = np.diff(bounds)
                level = level_of(np.maximum(n, 1), num, den)
                at = lambda i, x: _sketch(h[bounds[i] : bounds[i + 1]], x, num, den) if n[i] and x >= 0 else b""  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(level.astype(np.int32)),
                     *[pa.array([at(i, int(level[i]) - lower) for i in range(len(n))], pa.binary()) for lower in (0, 1)]], ["id", "level", "own", "below"])
    return run


def _alike(num: int, den: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs with as many cells alike as a linked pair must have, at the level of the smaller set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level_x, own_x, below_x, level_y, own_y, below_y = (batch.column(i) for i in range(2, 8))
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(level_x.to_pylist(), level_y.to_pylist(), strict=True)):
                if abs(x - y) <= 1:
                    a = np.frombuffer((own_x if x <= y else below_x)[i].as_buffer(), np.uint8)
                    b = np.frombuffer((own_y if y <= x else below_y)[i].as_buffer(), np.uint8)
                    most, width = cells(min(x, y), num, den)
                    keep[i] = np.count_nonzero(a == b) >= width - most
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))
    return run


def _links(num: int, den: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * both >= num * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])
    return run


def _usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row's sketches the byte that most have, cell by cell."""
    for batch in batches:
        out = []
        for x in batch.column(2):
            rows = np.stack([np.frombuffer(b.as_buffer(), np.uint8) for b in x.values])
            main = np.empty(rows.shape[1], np.uint8)
            for at in range(0, rows.shape[1], 4096):
                part = rows[:, at : at + 4096]
                seen = np.zeros((part.shape[1], 256), np.int32)
                np.add.at(seen, (np.broadcast_to(np.arange(part.shape[1]), part.shape), part), 1)
                main[at : at + 4096] = seen.argmax(axis=1)
            out.append(main.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["key", "level", "usual"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, level, a, c, cells in which a sketch has its list's usual byte)."""
    for batch in batches:
        score = [int(np.count_nonzero(np.frombuffer(x.as_buffer(), np.uint8) == np.frombuffer(y.as_buffer(), np.uint8))) for x, y in zip(batch.column(4), batch.column(5), strict=True)]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(score, pa.int64())], ["key", "level", "a", "c", "score"])


# --- the join ------------------------------------------------------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def _only(df: DataFrame, ids: DataFrame, on: Column) -> DataFrame:
    """Rows of ``df`` whose id is among ``ids``; broadcast if they are few enough."""
    few = ids.count() <= MAX_BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, on, "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b, ok) of ``pairs (a, b)``.

    A linked pair has more than a few cells alike; sketches of a byte a cell
    sort out most others, so that few pairs are verified by the whole sets.
    """
    ids = _ids(pairs)
    wanted = _only(texts, ids, F.col("doc_id") == F.col("p_id"))
    sketch = kept(wanted.mapInArrow(_sketches(k, num, den), "id long, level int, own binary, below binary")
                  .groupBy("id").agg(F.max(F.struct("level", "own", "below")).alias("s")))
    beside = (pairs.join(sketch.select(F.col("id").alias("a"), F.col("s").alias("x")), "a")
              .join(sketch.select(F.col("id").alias("b"), F.col("s").alias("y")), "b"))
    alike = kept(beside.select("a", "b", "x.*", *[F.col(f"y.{c}").alias(f"y_{c}") for c in ("level", "own", "below")]).mapInArrow(_alike(num, den), "a long, b long"))
    ids = _ids(alike)
    sets = _only(texts, ids, F.col("doc_id") == F.col("p_id")).mapInArrow(_sets(k), "id long, items binary")
    one = checkpointed(sets.groupBy("id").agg(F.max("items").alias("items")))  # ids that repeat have one set
    both = (alike.join(one.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
            .join(one.select(F.col("id").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y"))
    linked = both.mapInArrow(_links(num, den), "a long, b long, ok boolean")
    return kept(pairs.select("a", "b").join(linked, ["a", "b"], "left").select("a", "b", F.coalesce("ok", F.lit(False)).alias("ok")))


def _ids(pairs: DataFrame) -> DataFrame:
    """The documents ``p_id`` of ``pairs (a, b)``."""
    return kept(pairs.select(F.col("a").alias("p_id")).distinct().unionByName(pairs.select(F.col("b").alias("p_id")).distinct()).distinct())


def _often(texts: DataFrame, total: int, k: int) -> np.ndarray:
    """How often the shingles of ``texts`` occur, counted together for shingles of one hash bucket.

    The table has about as many buckets as there are shingles, up to ``MAX_BUCKETS``, and is put
    together from a row for each task and slice.  It only orders shingles, so bucket-mates do no harm.
    """
    bits = min(max(total.bit_length(), 16), MAX_BUCKETS.bit_length() - 1)
    parts = texts.mapInArrow(_bucket_counts(k, bits), "slice int, counts binary")
    added = parts.groupBy("slice").applyInArrow(_added, "slice int, counts binary").collect()  # one row for each slice
    out = np.zeros(1 << bits, np.uint32)
    for r in added:
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(zstandard.decompress(r["counts"]), np.uint32)
    return out


def _apart(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Of ``members (key, a)``, with their component ``c``, the lists that lie in several components."""
    placed = members.select("key", "a").join(comp, F.col("a") == F.col("node"), "left").select("key", "a", F.coalesce("component", "a").alias("c"))
    spread = placed.groupBy(F.col("key").alias("s_key")).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("s_key")
    return kept(placed.join(spread, F.col("key") == F.col("s_key"), "left_semi"))


def _central_pairs(members: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) across components of each list's most central member with the others.

    A list's usual content is, cell by cell, what most of ``VOTERS`` of its members
    have in their sketches; its central member is the one, of all, that has most of it.
    Which member that is decides only how many pairs are left to the next round.
    """
    ids = kept(members.select(F.col("a").alias("m_id")).distinct())
    sketch = (_only(texts, ids, F.col("doc_id") == F.col("m_id")).mapInArrow(_sketches(k, num, den), "id long, level int, own binary, below binary")
              .groupBy("id").agg(F.max(F.struct("level", "own")).alias("s")).select("id", "s.level", "s.own"))
    drawn = checkpointed(members.join(sketch, F.col("a") == F.col("id")).select("key", "level", "a", "c", "own"))
    order = Window.partitionBy("key", "level").orderBy(F.xxhash64("a"), "a")
    voters = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= VOTERS)
    usual = (voters.groupBy("key", "level").agg(F.collect_list("own").alias("own")).mapInArrow(_usual, "key long, level int, usual binary")
             .select(F.col("key").alias("u_key"), F.col("level").alias("u_level"), "usual"))
    scored = drawn.join(usual, (F.col("key") == F.col("u_key")) & (F.col("level") == F.col("u_level"))).select("key", "level", "a", "c", "own", "usual")
    scored = scored.mapInArrow(_agreement, "key long, level int, a long, c long, score long")
    center = (scored.groupBy(F.col("key").alias("c_key"), "level").agg(F.max_by(F.struct("a", "c"), F.struct("score", -F.col("a"))).alias("center"))
              .select("c_key", F.col("center.a").alias("center"), F.col("center.c").alias("center_c")).distinct())
    return (members.join(center, F.col("key") == F.col("c_key")).where("c <> center_c")
            .select(F.least("a", "center").alias("a"), F.greatest("a", "center").alias("b")).distinct())


def _prefix_pairs(members: DataFrame, comp: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b) across components, by inverted lists of the rarest shingles.

    In one order of all shingles, rare ones first, two sets that link share a shingle among the first
    ``b - least overlap with any smaller partner + 1`` of the larger and the first
    ``a - least overlap with its own size + 1`` of the smaller set, so no more than these are
    handed on.  Near copies of one text that differ too much to link have shingles of their own in
    front, so most do not meet.
    """
    ids = kept(members.select(F.col("a").alias("m_id")).distinct())
    wanted = _only(texts, ids, F.col("doc_id") == F.col("m_id"))
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 4
    often = wanted.sparkSession.sparkContext.broadcast(_often(wanted, total, k))  # MAX_BUCKETS numbers at most
    first = wanted.mapInArrow(_prefixes(k, num, den, often), "g long, id long, n int, place int, indexed boolean").distinct()
    first = checkpointed(first.join(comp, F.col("id") == F.col("node"), "left").select("g", "id", "n", "place", "indexed", F.coalesce("component", "id").alias("c")))
    x = first.where("indexed").select("g", F.col("id").alias("x"), F.col("n").alias("x_n"), F.col("c").alias("x_c"), F.col("place").alias("x_p"))
    y = first.select("g", F.col("id").alias("y"), F.col("n").alias("y_n"), F.col("c").alias("y_c"), F.col("place").alias("y_p"))
    # from the first shingle that both have, enough must be left in either set
    enough = F.lit(num) * (F.col("x_n") + F.col("y_n"))
    left = lambda s: (F.col(f"{s}_n") - F.col(f"{s}_p") + 1) * F.lit(num + den) >= enough
    met = x.join(y, "g").where((F.col("x_c") != F.col("y_c")) & (F.struct("x_n", "x") < F.struct("y_n", "y")) & (F.lit(den) * F.col("x_n") >= F.lit(num) * F.col("y_n"))
                               & left("x") & left("y"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def jaccard_groups(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents that are linked, over any number of steps, by ``k``-word shingle sets of similarity ``num/den`` or more.

    Returns one row per row of ``docs``: ``doc_id, n_shingles, component_id``
    (the smallest id of the group, its own if it is alone).  Null, empty and
    blank texts have no shingles and link with nothing; a text of fewer than
    ``k`` words has its whole sequence as its one shingle; rows that share an id
    are one node, compared by one of their texts; a null id links with nothing and has no component; other
    columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = _texts(docs, id_col, text_col)
    slim = checkpointed(texts.mapInArrow(_summaries(k), "doc_id long, n long, s1 long, s2 long"))
    # equal sets link by their content sums
    same = slim.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
    copies = (slim.join(same.where("c > 1").withColumnsRenamed({"n": "r_n", "s1": "r_1", "s2": "r_2"}),
                        (F.col("n") == F.col("r_n")) & (F.col("s1") == F.col("r_1")) & (F.col("s2") == F.col("r_2")))
              .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).where("u <> v").distinct())
    copies = kept(copies)
    histogram = {r["n"]: r["c"] for r in slim.where(F.col("n").between(1, MAX_SMALL * 2)).groupBy("n").agg(F.count("*").alias("c")).collect()}
    small = boundary(histogram, num, den)

    known = texts.where("doc_id IS NOT NULL")
    posted = known.mapInArrow(_postings(k, small, num, den, None), "key long, a long, b long")
    lists = posted.repartition("key").sortWithinPartitions("key", "a", "b")
    found = checkpointed(lists.mapInArrow(_scan_lists, "a long, b long, key long").distinct())
    # a copy's pairs are those of its representative
    named = copies.select(F.col("u").alias("copy"), F.col("v").alias("rep"))

    def by_rep(pairs: DataFrame) -> DataFrame:
        for c in ("a", "b"):
            pairs = pairs.join(named, F.col(c) == F.col("copy"), "left").withColumn(c, F.coalesce("rep", c)).drop("copy", "rep")
        return pairs.withColumn("lo", F.least("a", "b")).withColumn("hi", F.greatest("a", "b")).where("lo <> hi").drop("a", "b").withColumnsRenamed({"lo": "a", "hi": "b"})

    found = kept(by_rep(found).distinct())
    checked = _verified(found.select("a", "b").distinct(), texts, k, num, den)
    links = checked.where("ok").select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(copies)
    comp = kept(components(links))

    # long lists in which a pair with the pivot does not link: their members are compared across components
    open_keys = kept(found.where("key IS NOT NULL").join(checked.where("NOT ok"), ["a", "b"]).select("key").distinct())
    n_open = open_keys.count()
    if n_open:
        if n_open <= MAX_BROADCAST_IDS:
            only = np.sort(np.array([r[0] for r in open_keys.collect()], np.int64).view(np.uint64))
            again = known.mapInArrow(_postings(k, small, num, den, only), "key long, a long, b long")
        else:
            again = known.mapInArrow(_postings(k, small, num, den, None, False), "key long, a long, b long").join(open_keys, "key", "left_semi")
        members = kept(again.select("key", "a").join(named, F.col("a") == F.col("copy"), "left").select("key", F.coalesce("rep", "a").alias("a")).distinct())
        for step in ("center", "prefix"):
            members = _apart(members, comp)
            if members.isEmpty():
                break
            if step == "center":
                cross = _central_pairs(members, texts, k, num, den)
            else:
                cross = _prefix_pairs(members, comp, texts, k, num, den)
            more = _verified(kept(cross.join(checked.select("a", "b"), ["a", "b"], "left_anti")), texts, k, num, den)
            checked = checked.unionByName(more)
            links = links.unionByName(more.where("ok").select(F.col("a").alias("u"), F.col("b").alias("v")))
            comp = kept(components(links))
    return (slim.join(comp, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def one_per_group(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with only the smallest id of each group; all columns stay, and rows without a group stay."""
    gone = jaccard_groups(docs, k, num, den).where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return wrapped(docs, "doc_id").join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti").select("row.*")
