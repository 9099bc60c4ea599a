"""First-wins dedupe, positions and ordered picks.

"First wins" rules are written as ``min_by`` aggregates over an explicit
order column, not as a window: the aggregate runs partially in every map
task, so a key holding a third of all rows is reduced before the shuffle.
Positions within a group (W2) are computed by range partitioning, which
splits a hot group across tasks, plus a small per-partition offset table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.text import strip_ws


def orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be compared; maps cannot."""
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_order(df: DataFrame) -> list[Column]:
    """Columns that put the rows of any schema in one order: what can be compared, then a hash of the rest."""
    rest = [f.name for f in df.schema.fields if not orderable(f.dataType)]
    return [F.col(f.name) for f in df.schema.fields if orderable(f.dataType)] + (
        [F.xxhash64(F.to_json(F.struct(*rest)))] if rest else [])


def first_by(df: DataFrame, key: list[Column | str], order: list[Column | str]) -> DataFrame:
    """One row per ``key``: the row with the least ``order`` (ties: ``row_order``)."""
    cols = df.columns
    key_cols = [F.col(k) if isinstance(k, str) else k for k in key]
    ord_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = [c.alias(f"_o{i}") for i, c in enumerate([*ord_cols, *row_order(df)])]
    tagged = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(key_cols)],
                       F.struct(*rank).alias("_rank"), F.struct(*[F.col(c) for c in cols]).alias("_row"))
    g = tagged.groupBy(*[f"_k{i}" for i in range(len(key_cols))]).agg(F.min_by("_row", "_rank").alias("_row"))
    return g.select(*[F.col("_row")[c].alias(c) for c in cols])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, on).drop(*[f"_r_{k}" for k in keys])


def dedupe_by_title(df: DataFrame, order_col: str, title_col: str = "title") -> DataFrame:
    """Keep the first item per trimmed lower-case title; blank titles dropped."""
    key = F.lower(strip_ws(F.coalesce(F.col(title_col), F.lit(""))))
    return first_by(df.filter(key != ""), [key], [order_col])


def ordinal_within(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   out: str = "position", n_parts: int | None = None) -> DataFrame:
    """0-based position of each row within its group by ``order_cols``.

    ``order_cols`` must be a total order inside a group.  Rows are range
    partitioned on (group, order), so a hot group spans many partitions;
    each row's position is its index inside its partition plus the number of
    rows of its group in earlier partitions (a table of one row per
    partition and group).  The tagged rows are checkpointed to the shared
    checkpoint folder, so both branches (and any recomputation after a lost
    executor) read the same partition ids and indices.
    """
    from vitrina.session import checkpoint_dir
    spark = df.sparkSession
    keys = [*group_cols, *order_cols]
    checkpoint_dir(spark)
    # The partition id and in-partition index are materialised once (a
    # reliable checkpoint in the shared folder): AQE may coalesce a shuffle
    # differently for each reader, so both branches must read stored values.
    ranged = df.repartitionByRange(n_parts, *keys) if n_parts else df.repartitionByRange(*keys)
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
              .checkpoint(eager=True))
    counts = tagged.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_n"),
                                                     F.min("_local").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    j = null_safe_join(tagged, offsets.select("_pid", *group_cols, "_before", "_first"), ["_pid", *group_cols])
    pos = (F.col("_before") + F.col("_local") - F.col("_first")).cast("bigint")
    return j.withColumn(out, pos).drop("_pid", "_local", "_before", "_first")


def first_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                      k: int) -> DataFrame:
    """The first ``k`` rows of each group.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` in
    each map task, so at most ``k`` rows per group and task are shuffled.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k) \
        .withColumn("rank", F.col("_rn").cast("bigint")).drop("_rn")


def order_obs(obs: Column | str, idx_field: str = "idx") -> Column:
    """Sort an array of structs by its leading integer index."""
    c = F.col(obs) if isinstance(obs, str) else obs
    return F.array_sort(c)


def concat_listings(listings: dict[str, DataFrame], url_col: str = "source_url") -> DataFrame:
    """Union of listings, each row tagged with the url of its listing."""
    tagged = [df.withColumn(url_col, F.lit(url)).withColumn("_listing", F.lit(i))
              for i, (url, df) in enumerate(listings.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def prefer_first(dfs: list[DataFrame], key: list[str]) -> DataFrame:
    """Per key, rows from the first frame that has the key.

    Union with a priority column, the least priority per key (a partial
    aggregate), then a join keeps the rows of that frame; AQE splits a hot
    key of the join.
    """
    tagged = [df.withColumn("_prio", F.lit(i)) for i, df in enumerate(dfs)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    best = u.groupBy(*key).agg(F.min("_prio").alias("_best"))
    return null_safe_join(u, best, key).filter(F.col("_prio") == F.col("_best")).drop("_best")
