"""The stored catalogue with its counts, and a layout that skips on date, source and type.

``write_stored`` adds one batch of items under ``path/items`` and, under ``path/counts``,
how many of them there are by source, type and tag, with their range of dates.  Counts of
batches add up, so the summary of the whole catalogue (A1) and the counts of the run log (K9) are
read from them: one row for each name and batch, whatever the number of items.

The same counts are a dictionary of the sources and types that occur.  ``search_stored`` resolves the
loose criteria on it (F2: either text contains the other; F3: any case) and hands the scan
plain equalities, which Parquet checks against statistics and dictionaries of row
groups.  With ``cluster`` rows are laid out along a curve over date, source and
type instead of by date alone, so each of the three narrows the row groups read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina import schemas as SC
from vitrina.functions.fold import fold
from vitrina.operators import search as S
from vitrina.operators import summary as A

#: Cells of a dimension of the curve, as bits.
BITS = 8
#: Distinct months up to which dates are cut into cells of equally many items; beyond, dates are no dimension.
MAX_MONTHS = 20_000
#: Names that are pushed to the scan at most; more are compared after it.
MAX_NAMES = 200
ROW_GROUP_BYTES = 8 << 20


def catalog_counts(df: DataFrame) -> DataFrame:
    """Mergeable counts ``(piece, name, n, lo, hi)``: the total with its range of dates, and every source, type and tag."""
    pair = lambda piece, name: F.struct(F.lit(piece).alias("piece"), name.cast("string").alias("name"))
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: pair("tag", t))
    day = F.nullif("date_iso", F.lit(""))
    each = df.select(F.explode(F.concat(F.array(pair("total", F.lit(None)), pair("source", F.col("source")), pair("type", F.col("type"))), tags)).alias("k"), day.alias("d"))
    return each.groupBy("k.piece", "k.name").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))


def _cell_of_date(df: DataFrame) -> DataFrame:
    """``df`` with ``_d``: the cell of its month, cells holding about equally many items in order of time."""
    month = F.substring(F.coalesce("date_iso", F.lit("")), 1, 7)
    found = df.groupBy(month.alias("m")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_MONTHS + 1).collect()  # bounded
    if len(found) > MAX_MONTHS:
        return df.withColumn("_d", F.lit(0))
    total, before, rows = sum(r["n"] for r in found), 0, []
    for r in sorted(found, key=lambda r: r["m"]):
        rows.append((r["m"], (before << BITS) // total))
        before += r["n"]
    cells = df.sparkSession.createDataFrame(rows, "_m string, _d int")
    return df.join(F.broadcast(cells), month == F.col("_m")).drop("_m")


def clustered(df: DataFrame) -> DataFrame:
    """Items in the order of a curve over date, source and type: bits of the three cells in turn."""
    cell = lambda c: F.pmod(F.xxhash64(F.lower(F.coalesce(c, F.lit("")))), F.lit(1 << BITS)).cast("int")
    placed = _cell_of_date(df).withColumns({"_s": cell("source"), "_t": cell("type")})
    bits = [F.shiftleft(F.shiftright(F.col(c), b).bitwiseAND(F.lit(1)), 3 * b + i) for b in range(BITS) for i, c in enumerate(("_t", "_s", "_d"))]
    curve = placed.withColumn("_z", reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("_d", "_s", "_t")
    return curve.repartitionByRange("_z").sortWithinPartitions("_z", *S.catalog_order(df)).drop("_z")


def write_stored(df: DataFrame, path: str, mode: str = "append", cluster: bool = False, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Add a batch of items and its counts; ``mode="overwrite"`` replaces the catalogue.

    The counts of a batch are taken from what was stored of it, after it was stored.
    """
    spark, batch = df.sparkSession, uuid.uuid4().hex
    order = S.catalog_order(df)
    laid = clustered(df) if cluster else df.repartitionByRange(*order).sortWithinPartitions(*order)
    items = laid.withColumn("text_folded", fold(S.haystack())).withColumn("batch", F.lit(batch))
    items.write.mode(mode).option("parquet.block.size", row_group_bytes).partitionBy("batch").parquet(f"{path}/items")
    stored = load_stored(spark, path).where(F.col("batch") == batch)
    catalog_counts(stored).withColumn("batch", F.lit(batch)).coalesce(1).write.mode(mode).parquet(f"{path}/counts")


def load_stored(spark: SparkSession, path: str) -> DataFrame:
    """The items, with the batch of each."""
    return spark.read.schema(T.StructType([*SC.CATALOG_STORED.fields, T.StructField("batch", T.StringType())])).parquet(f"{path}/items")


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all batches, added up.

    A batch whose write stopped before its counts were there makes the total differ from the
    number of rows in the files' footers; then everything is counted anew.
    """
    parts = spark.read.schema("piece string, name string, n long, lo string, hi string, batch string").parquet(f"{path}/counts")
    items = load_stored(spark, path)
    counted = parts.where("piece = 'total'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if counted != items.count():  # from the footers: no column is read
        return catalog_counts(items)
    return parts.groupBy("piece", "name").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def stored_summary(spark: SparkSession, path: str) -> DataFrame:
    """``summary_table`` of a stored catalogue (A1) from its counts."""
    c = stored_counts(spark, path)
    total = c.where("piece = 'total'")
    by_source = c.where("piece = 'source'").groupBy(F.coalesce("name", F.lit(A.UNKNOWN_SOURCE)).alias("source")).agg(F.sum("n").alias("n"))
    tags = c.where("piece = 'tag'").select(F.col("name").alias("tag"), "n").orderBy(F.col("n").desc(), "tag").limit(10)
    return A.summary_rows({
        "total": total.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_items")), "by_source": by_source,
        "types": c.where("piece = 'type' AND name <> ''").select(F.col("name").alias("type")),
        "date_range": total.agg(F.coalesce(F.min("lo"), F.lit(A.UNKNOWN_DATE)).alias("desde"), F.coalesce(F.max("hi"), F.lit(A.UNKNOWN_DATE)).alias("hasta")),
        "top_tags": tags})


def _pushed(names: DataFrame, column: str, matches) -> Column | None:
    """Equalities of ``column`` with the names that match a criterion; None where they are too many to push."""
    found = [r["name"] for r in names.where(matches(F.col("name"))).select("name").limit(MAX_NAMES + 1).collect()]  # bounded
    if len(found) > MAX_NAMES:
        return None
    return reduce(lambda a, b: a | b, [F.col(column).isNull() if n is None else F.col(column) == n for n in found], F.lit(False))


def narrowed(spark: SparkSession, path: str, source: str | None = None, type: str | None = None) -> DataFrame:
    """The stored items whose source and type match, by equalities that the scan can skip on."""
    items, counts = load_stored(spark, path), stored_counts(spark, path)
    for piece, wanted, matches in (("source", source, S.source_matches), ("type", type, S.type_is)):
        if wanted:
            pushed = _pushed(counts.where(F.col("piece") == piece), piece, lambda c, m=matches, w=wanted: m(c, w))
            items = items if pushed is None else items.where(pushed)
    return items.drop("batch")


def search_stored(spark: SparkSession, path: str, limit: int | None = 20, source: str | None = None, tipo: str | None = None,
                  type: str | None = None, **criteria) -> DataFrame:
    """``search`` over a stored catalogue: the same rows, with source and type resolved before the scan."""
    return S.search(narrowed(spark, path, source, tipo or type), limit=limit, source=source, type=tipo or type, **criteria)
