"""Text search by a trigram block index stored with the catalogue.

``write_indexed_catalog`` stores the catalogue in its order (K2), each row with the number
of its block of ``BLOCK_ROWS`` rows, in small row groups; beside it, for every
sequence of one, two and three characters of the folded texts, the list of blocks in whose texts it
stands.  A search looks up the sequences of its (folded) needle,
intersects the lists of the rarest of them and reads those blocks only: their
numbers become a range predicate that Parquet checks against the statistics of
row groups and pages.  What is read is then tested as in any search, so a needle's
rows are those of a full scan, whatever the index says too much.

A folded text contains a folded needle wherever the plain text contains the
plain one (folding goes character by character), so one index serves both.

Sizes: a list row covers the blocks of ``PARTS_PER_ROW`` data partitions, so a
sequence that every block has is many bounded rows, range partitioned apart. The
driver sees one count per sequence of the needle and at most ``MAX_BLOCKS`` block numbers; a needle that
even its rarest sequence cannot narrow that far is met by a join with its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina import schemas as SC
from vitrina.functions.fold import fold, fold_py
from vitrina.operators.search import catalog_order, haystack, search
from vitrina.session import ship_package

BLOCK_ROWS = 1024  # a power of two
PARTS_PER_ROW = 64
#: Row group and page bytes of the stored texts: what one block's read brings along at most.
ROW_GROUP_BYTES, PAGE_BYTES = 4 << 20, 64 << 10
RAREST = 4
MAX_BLOCKS = 100_000
MAX_RANGES = 400
_LOCAL_BITS = 33  # of monotonically_increasing_id
_POSTED = "gram long, chunk long, blocks array<long>"


def _points(text: str) -> np.ndarray:
    """Code points of a text, from 1 on."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1


def gram_codes(text: str) -> np.ndarray:
    """The sequences of one to three characters of a text, 21 bits a character, each once."""
    p = _points(text)
    pairs = p[:-1] << 21 | p[1:]
    return np.unique(np.concatenate([p, pairs, pairs[:-1] << 21 | p[2:]])) if len(p) else p


def needle_codes(needle: str) -> list[int]:
    """The longest indexed sequences of a needle."""
    p = _points(needle)
    if len(p) >= 3:
        return np.unique((p[:-2] << 42) | (p[1:-1] << 21) | p[2:]).tolist()
    return [int(p[0] << 21 | p[1])] if len(p) == 2 else p.tolist()


def _postings(shift: int):
    """Rows (gram, chunk, blocks) of a piece of ``(block, text)`` rows."""

    def rows(texts: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        own = {b: np.unique(np.concatenate(codes)) for b, codes in texts.items()}
        gram = np.concatenate(list(own.values())) if own else np.zeros(0, np.int64)
        block = np.repeat(np.array(list(own), np.int64), [len(c) for c in own.values()])
        chunk = (block >> shift) // PARTS_PER_ROW
        order = np.lexsort((block, chunk, gram))
        gram, block, chunk = gram[order], block[order], chunk[order]
        first = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (chunk[1:] != chunk[:-1])]) if len(gram) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(gram)].astype(np.int32)), pa.array(block))
        return pa.RecordBatch.from_arrays([pa.array(gram[first]), pa.array(chunk[first]), lists], ["gram", "chunk", "blocks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for b, t in zip(batch.column(0).to_numpy(zero_copy_only=False).tolist(), batch.column(1), strict=True):
                codes = gram_codes(t.as_py() or "")
                held.setdefault(b, []).append(codes)
                size += len(codes)
                if size > 1 << 22:
                    yield rows(held)
                    held, size = {}, 0
        yield rows(held)
    return run


def write_indexed_catalog(df: DataFrame, path: str, block_rows: int = BLOCK_ROWS, partitions: int | None = None) -> None:
    """Store a catalogue under ``path/items`` and the index of its texts under ``path/grams``."""
    if block_rows < 1 or block_rows & (block_rows - 1):
        raise ValueError("a block has a power of two of rows")
    spark, bits = df.sparkSession, block_rows.bit_length() - 1
    ship_package(spark)
    order = catalog_order(df)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    # partition ids above the row's place in its partition: dividing leaves each partition its own blocks
    block = F.shiftright(F.monotonically_increasing_id(), bits)
    items = ranged.sortWithinPartitions(*order).withColumn("block", block).withColumn("text_folded", fold(haystack()))
    # a page ends with its block, so page statistics tell blocks apart
    small = lambda w: w.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    small(items.write).option("parquet.page.row.count.limit", block_rows).parquet(f"{path}/items")
    stored = spark.read.parquet(f"{path}/items").select("block", "text_folded")
    posted = stored.mapInArrow(_postings(_LOCAL_BITS - bits), _POSTED)
    # a block that two tasks have read is listed once
    lists = posted.groupBy("gram", "chunk").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("blocks")))).alias("blocks"))
    rows = lists.withColumn("n", F.size("blocks").cast("long")).repartitionByRange("gram", "chunk").sortWithinPartitions("gram", "chunk")
    small(rows.write).option("parquet.page.row.count.limit", 256).parquet(f"{path}/grams")


def _either(tests: list[Column]) -> Column:
    """Whether one of several tests holds, as a tree as low as can be: a chain of hundreds overflows the planner's stack."""
    half = len(tests) // 2
    return _either(tests[:half]) | _either(tests[half:]) if half else tests[0]


def _any_of(column: str, values: list[int]) -> Column:
    # equalities are pushed to the scan whatever their number; a long IN is not
    return _either([F.col(column) == v for v in values])


def candidate_blocks(spark: SparkSession, path: str, needle: str) -> tuple[DataFrame | None, int | None]:
    """The blocks (as rows) that may hold a folded needle, and a bound on their number; None for all blocks."""
    codes = needle_codes(needle)
    if not codes:
        return None, None
    posted = spark.read.parquet(f"{path}/grams")
    counts = {r["gram"]: r["n"] for r in posted.where(_any_of("gram", codes)).groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # one row a sequence of the needle
    if len(counts) < len(codes):
        return posted.where("false").select(F.lit(0).cast("long").alias("block")), 0
    rare = sorted(codes, key=lambda c: (counts[c], c))[:RAREST]
    listed = posted.where(_any_of("gram", rare)).select("gram", F.explode("blocks").alias("block"))
    both = listed.groupBy("block").agg(F.count("*").alias("c")).where(F.col("c") == len(rare)).select("block")
    return both, counts[rare[0]]


def block_ranges(blocks: list[int], most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Block numbers as at most ``most`` ranges; where there would be more, the smallest gaps are read too."""
    blocks = np.unique(np.array(blocks, np.int64))
    if not len(blocks):
        return []
    gap = np.diff(blocks)
    wide = gap > 1
    if wide.sum() >= most:
        kept = np.argsort(-gap, kind="stable")[: most - 1]
        wide = np.zeros(len(gap), bool)
        wide[kept] = True
    cut = np.flatnonzero(wide)
    return list(zip(blocks[np.r_[0, cut + 1]].tolist(), blocks[np.r_[cut, len(blocks) - 1]].tolist(), strict=True))


def narrowed(spark: SparkSession, path: str, texto: str | None, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows of the stored catalogue that may contain ``texto``, read by blocks."""
    items = spark.read.schema(T.StructType([*SC.CATALOG_STORED.fields, T.StructField("block", T.LongType())])).parquet(f"{path}/items")
    blocks, bound = candidate_blocks(spark, path, fold_py((texto or "").lower()))
    if blocks is None:
        return items
    if bound > max_blocks:
        return items.join(blocks, "block", "left_semi")
    ranges = block_ranges([r["block"] for r in blocks.collect()])  # at most max_blocks numbers
    if not ranges:
        return items.where("false")
    return items.where(_either([F.col("block").between(lo, hi) for lo, hi in ranges]))


def search_indexed(spark: SparkSession, path: str, texto: str, limit: int | None = 20, **criteria) -> DataFrame:
    """``search`` over a catalogue stored by ``write_indexed_catalog``: same rows, of the texts only candidate blocks are read."""
    found = narrowed(spark, path, texto)
    return search(found.drop("block"), limit=limit, texto=texto, **criteria)
