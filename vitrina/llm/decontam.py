"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a mask over consecutive tokens; the hash of a window covers only
the positions that the mask keeps, so a changed token at an ignored position
does not lose the hit.  Windows of the documents meet windows of the benchmark
by (mask, hash); around each hit document and item are laid side by side
and compared token by token, and a stretch with enough equal tokens counts.  The
masks cover each other: wherever the changed tokens of such a stretch stand, a mask
at some place keeps none of them, so every overlap has a hit.  An item of fewer tokens
than a mask spans is met whole and word for word by the documents' windows of its length.
An item of fewer than ``MIN_ITEM`` tokens is no evidence of a leak, as its words stand in any text: it is left out, and
``items_left_out`` lists it (the filter logs how many there are).

Texts are cut into pieces first, so that no row of a window carries a whole document.
Items of equal tokens are one text, and their ids come back at the end.
Keys of a small benchmark, its size checked first, are broadcast: windows are then made, probed
and verified in the row, and only verified overlaps are aggregated.  With more keys
than ``MAX_BROADCAST_KEYS`` a sieve of bounded size is broadcast in their place; the few windows that pass it
are shuffled to the keys, each with the tokens around it.  The benchmark's tokens
are broadcast up to ``max_broadcast_tokens`` and joined by shuffles beyond.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import wrapped

#: Kept token positions of each seed.  Of a stretch of 8 to 13 tokens, ``SHARE`` of them equal, one seed meets equal tokens only.
SEEDS = ((0, 2, 6, 7), (0, 1, 4, 6), (2, 4, 5, 7), (1, 2, 3, 5), (1, 3, 4, 7), (0, 3, 5, 6))
SPAN = 8
#: An overlap is ``WINDOW`` aligned tokens (or the whole item, if shorter), of which this share is equal.
WINDOW = 13
SHARE = 0.75
#: A stretch of eight tokens may have so many outside of the document.
_EDGE = 2
#: The window at which a seed meets equal tokens has this many: a stretch has three changed tokens at most.
_LEAST = 5
MAX_BROADCAST_TOKENS = 1_000_000
#: Keys, each with the tokens of its window, that are broadcast as a table: about 130 bytes each.
MAX_BROADCAST_KEYS = 300_000
#: Windows that start in one piece of a text.
PIECE = 64
#: The sieve: cells of 2^12 bits (64 longs), of which a key sets ``_MARKS`` in one cell; 2^16 cells (34 MB) at most.
KEYS_A_CELL = 128
MAX_CELLS = 1 << 16
_MARKS = 5
#: Tokens of the shortest item that is looked for.
MIN_ITEM = 4
_log = logging.getLogger(__name__)

#: Tokens are runs of letters and digits, in lower case: punctuation and layout do not hide a leak.
_BREAK = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """64-bit hashes of the tokens of a text; empty for null or blank."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), _BREAK)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _edged(h: Column) -> Column:
    """Tokens between places that equal no token (a token has no blank)."""
    edge = F.array_repeat(F.xxhash64(F.lit(" ")), _EDGE)
    return F.concat(edge, h, edge)


def _seeds(h: Column, i: Column) -> Column:
    """For each seed the key of the window that starts at ``i``."""
    return F.array(*[F.xxhash64(F.lit(s), *[F.get(h, i + p) for p in keep]) for s, keep in enumerate(SEEDS)])


def _pieces(rows: DataFrame, h: str, around: int, *carry: str) -> DataFrame:
    """Texts cut into pieces: the number ``piece``, the token ``at`` which it begins, the place ``lead`` of its first window, and its tokens.

    The ``PIECE`` windows from ``lead`` on belong to it, and it holds ``around`` tokens on both sides of each.
    """
    first = F.sequence(F.lit(0), F.greatest(F.size(h) - SPAN, F.lit(0)), F.lit(PIECE))
    at = lambda p: F.greatest(p - around, F.lit(0))
    cut = F.transform(first, lambda p: F.struct((p / PIECE).cast("int").alias("piece"), at(p).alias("at"), (p - at(p)).alias("lead"),
                                                F.slice(F.col(h), at(p) + 1, p - at(p) + PIECE - 1 + SPAN + around).alias(h)))
    return rows.where(F.size(h) >= SPAN).select(*carry, F.inline(cut))


def _windows(pieces: DataFrame, h: str, *carry: str) -> DataFrame:
    """A row for each full window: its start ``i`` in the piece and what is carried."""
    last = F.least(F.col("lead") + PIECE - 1, F.size(h) - SPAN)
    return pieces.select(*carry, h, F.explode(F.sequence("lead", last)).alias("i"))


def _marks(key: Column) -> list[tuple[Column, Column]]:
    """Places of a key in its cell: number of the long and the bit in it."""
    at = [F.shiftrightunsigned(key, 12 * n).bitwiseAND(F.lit(4095)) for n in range(_MARKS)]
    return [(F.shiftright(p, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))) for p in at]


def _sieved(windows: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """Windows whose ``key`` may be a ``b_key``: all that are and few others.  The sieve does not grow beyond ``MAX_CELLS``."""
    cells = min(max(n_keys // KEYS_A_CELL, 1), MAX_CELLS) | 1
    set_bits = keys.select(F.pmod("b_key", F.lit(cells)).alias("cell"), F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in _marks(F.col("b_key"))])).alias("m"))
    longs = set_bits.groupBy("cell", "m.w").agg(F.bit_or("m.b").alias("b")).groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    sieve = longs.select("cell", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias("longs"))
    met = F.pmod("key", F.lit(cells)) == F.col("cell")
    for w, b in _marks(F.col("key")):
        met = met & (F.get("longs", w).bitwiseAND(b) != 0)
    return windows.join(F.broadcast(sieve), met, "left_semi")


def _short_leaks(rows: DataFrame, short: DataFrame, lengths: list[int], n_short: int, few: bool) -> DataFrame:
    """Places where all tokens of a short text stand; at most seven lengths."""
    n = F.size("h")
    first = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(PIECE))
    pieces = rows.where(n >= min(lengths)).select("doc_id", F.inline(F.transform(first, lambda p: F.struct(p.alias("at"), F.slice(F.col("h"), p + 1, PIECE + SPAN).alias("h")))))
    starts = pieces.select("doc_id", "at", "h", F.explode(F.sequence(F.lit(0), F.least(F.lit(PIECE), n) - 1)).alias("i"))
    windows = starts.select("doc_id", (F.col("at") + F.col("i")).alias("start"), F.explode(F.array(*[F.when(F.col("i") + k <= n, F.slice("h", F.col("i") + 1, k)) for k in lengths])).alias("w"))
    windows = windows.where("w IS NOT NULL").withColumn("key", F.xxhash64("w"))
    if few:
        met = windows.join(F.broadcast(short), F.col("w") == F.col("b"))
    else:
        met = _sieved(windows, short.select(F.xxhash64("b").alias("b_key")), n_short).join(short, F.col("w") == F.col("b"))
    return met.select("doc_id", "t", F.size("b").alias("matched"), F.size("b").alias("stretch"), "start")


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE, max_broadcast_tokens: int = MAX_BROADCAST_TOKENS,
          id_col: str = "doc_id", min_item_tokens: int = MIN_ITEM) -> DataFrame:
    """Overlaps of documents with benchmark items.

    ``docs`` has ``id_col, text``; ``items`` has ``item_id, text``.  Returns one
    row per (document id, item): ``doc_id, item_id, matched`` (equal tokens in
    the best stretch), ``stretch`` (its length), ``doc_start`` (token at which the
    first aligned stretch begins).  A document without a row is clean.  Null
    or blank texts match nothing, items of fewer than eight tokens only where all
    of their tokens are equal, those of fewer than ``min_item_tokens`` nothing at all; rows that share an id are one document; empty tables give no rows.  All overlaps are found
    for stretches of 8 to 13 tokens and shares from 0.75 on; others may have no hit.
    """
    whole = items.select("item_id", token_hashes(F.col("text")).alias("b")).where(F.size("b") >= max(min_item_tokens, 1)).withColumn("t", F.xxhash64("b"))
    texts = whole.select("t", "b").distinct()
    is_short = F.size("b") < SPAN
    tokens, n_short, lengths = texts.agg(F.coalesce(F.sum(F.size("b")), F.lit(0)), F.count(F.when(is_short, 1)), F.collect_set(F.when(is_short, F.size("b")))).first()
    held = tokens <= max_broadcast_tokens
    near = F.broadcast if held else (lambda df: df)
    n_keys = len(SEEDS) * tokens  # at most
    few = held and n_keys <= MAX_BROADCAST_KEYS
    bench = _pieces(texts.withColumn("n_b", F.size("b")), "b", window, "t", "n_b").withColumnsRenamed({"at": "b_at", "lead": "b_lead"})
    keys = (_windows(bench.withColumnRenamed("b_lead", "lead"), "b", "t", "piece").withColumnRenamed("i", "item_at")
            .select("t", "piece", "item_at", F.slice("b", F.col("item_at") + 1, SPAN).alias("b_window"), F.explode(_seeds(F.col("b"), F.col("item_at"))).alias("b_key")))
    rows = docs.select(F.col(id_col).alias("doc_id"), _edged(token_hashes(F.col("text"))).alias("h"))
    windows = _windows(_pieces(rows, "h", window, "doc_id"), "h", "doc_id", "at").select("doc_id", "h", "i", "at", F.explode(_seeds(F.col("h"), F.col("i"))).alias("key"))
    if not few:  # only the tokens around the window are shuffled
        cut = F.greatest(F.col("i") - window, F.lit(0))
        windows = _sieved(windows, keys, n_keys).select("doc_id", F.slice("h", cut + 1, F.col("i") - cut + SPAN + window).alias("h"), (F.col("i") - cut).alias("i"), (F.col("at") + cut).alias("at"), "key")
    least = _LEAST if window <= WINDOW and share >= SHARE else 0
    same = sum((F.get("h", F.col("i") + p) == F.get("b_window", F.lit(p))).cast("int") for p in range(SPAN))
    hits = windows.join(F.broadcast(keys) if few else keys, (F.col("key") == F.col("b_key")) & (same >= least)).drop("key", "b_key", "b_window")
    # the text's tokens around the hit beside the document's: from window before to window after; places are those in the pieces
    beside = hits.join(near(bench.select(F.col("t").alias("b_t"), F.col("piece").alias("b_piece"), "n_b", "b_at", "b")), (F.col("t") == F.col("b_t")) & (F.col("piece") == F.col("b_piece")))
    lo = F.greatest(F.col("item_at") - window, F.lit(0))
    hi = F.least(F.col("item_at") + SPAN + window, F.col("n_b") - F.col("b_at"))
    shift = F.col("i") - F.col("item_at")
    equal = F.transform(F.sequence(F.col("lo"), F.col("hi") - 1), lambda j: F.when(
        (j + F.col("shift") >= 0) & F.coalesce(F.get(F.col("h"), j + F.col("shift")) == F.get(F.col("b"), j), F.lit(False)), 1).otherwise(0))
    seen = (beside.withColumn("lo", lo).withColumn("hi", hi).withColumn("shift", shift)
            .withColumn("stretch", F.least(F.lit(window), F.col("n_b"))).withColumn("eq", equal)
            .select("doc_id", "t", "stretch", F.explode(F.transform(
                F.sequence(F.lit(0), F.size("eq") - F.col("stretch")),
                lambda k: F.struct(F.aggregate(F.slice(F.col("eq"), k + 1, F.col("stretch")), F.lit(0), lambda a, x: a + x).alias("matched"),
                                   (F.col("at") + F.col("lo") + F.col("shift") + k - _EDGE).alias("start")))).alias("w")))
    found = seen.where(F.col("w.matched") >= F.ceil(F.col("stretch") * F.lit(share))).select("doc_id", "t", "w.matched", "stretch", "w.start")
    if lengths:
        found = found.unionByName(_short_leaks(docs.select(F.col(id_col).alias("doc_id"), token_hashes(F.col("text")).alias("h")), texts.where(is_short), sorted(lengths), n_short, few))
    by_text = found.groupBy("doc_id", "t").agg(F.max("matched").alias("matched"), F.max("stretch").alias("stretch"), F.min(F.greatest(F.col("start"), F.lit(0))).alias("start"))
    owners = whole.select("item_id", F.col("t").alias("b_t")).distinct()
    return (by_text.join(F.broadcast(owners) if few else owners, F.col("t") == F.col("b_t")).groupBy("doc_id", "item_id")
            .agg(F.max("matched").cast("long").alias("matched"), F.max("stretch").cast("long").alias("stretch"), F.min("start").cast("long").alias("doc_start")))


def items_left_out(items: DataFrame, min_item_tokens: int = MIN_ITEM) -> DataFrame:
    """``(item_id, n_tokens)`` of the items that are too short to be looked for, blank ones among them."""
    return items.select("item_id", F.size(token_hashes(F.col("text"))).cast("long").alias("n_tokens")).where(F.col("n_tokens") < max(min_item_tokens, 1))


def without_leaks(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """``docs`` without the documents that hold a stretch of a benchmark item; all columns stay.

    A document with a null id is judged like any other.
    """
    if short := items_left_out(items, params.get("min_item_tokens", MIN_ITEM)).count():
        _log.warning("%d benchmark items are too short to be looked for", short)
    bad = leaks(docs, items, **params).select(F.col("doc_id").alias("leak_id")).distinct()
    return wrapped(docs, "doc_id").join(bad, F.col("doc_id").eqNullSafe(F.col("leak_id")), "left_anti").select("row.*")
