"""Catalogue summaries.

Every aggregate here is a plain ``groupBy`` / global ``agg``: Spark runs the
partial aggregate map-side, so a source or tag holding a third of all rows is
pre-combined in every task before the shuffle and never lands whole in one
task.  ``top_tags`` orders a small aggregated frame (one row per tag).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions.text import year_of

UNKNOWN_SOURCE = "desconocido"   # fixed value: label of a missing source
UNKNOWN_DATE = "desconocida"     # fixed value: bound of an empty date range
UNDATED_YEAR = "sin_fecha"       # fixed value: year group of undated items


def count_by_source(df: DataFrame) -> DataFrame:
    """Items per source; a missing source counts as ``desconocido`` (A2)."""
    return (df.groupBy(F.coalesce(F.col("source"), F.lit(UNKNOWN_SOURCE)).alias("source"))
            .agg(F.count(F.lit(1)).alias("n")))


def count_by_type(df: DataFrame) -> DataFrame:
    """Items per type."""
    return df.groupBy(F.col("type")).agg(F.count(F.lit(1)).alias("n"))


def types(df: DataFrame) -> DataFrame:
    """Distinct non-empty types, one row each, sorted (A3)."""
    return (df.select("type").where(F.col("type").isNotNull() & (F.col("type") != ""))
            .distinct().orderBy("type"))


def date_range(df: DataFrame) -> DataFrame:
    """Min and max of the non-empty date texts, else ``desconocida`` (A4)."""
    d = F.nullif(F.col("date_iso"), F.lit(""))
    return df.agg(F.coalesce(F.min(d), F.lit(UNKNOWN_DATE)).alias("desde"),
                  F.coalesce(F.max(d), F.lit(UNKNOWN_DATE)).alias("hasta"))


def tag_counts(df: DataFrame) -> DataFrame:
    """Occurrences of every tag (the partial step of A5)."""
    return (df.select(F.explode(F.col("tags")).alias("tag"))
            .groupBy("tag").agg(F.count(F.lit(1)).alias("n")))


def top_tags(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent tags (A5).

    Ties are broken by tag text ascending: first-seen order has no meaning on
    a distributed input.
    """
    return tag_counts(df).orderBy(F.col("n").desc(), F.col("tag").asc()).limit(k)


def tables_per_op(tables: DataFrame, op_col: str = "op_id") -> DataFrame:
    """Tables per operation."""
    return tables.groupBy(op_col).agg(F.count(F.lit(1)).alias("tables_count"))


def last_modified(tables: DataFrame, op_col: str, mod_col: Column | str,
                  mode: str = "max", order_col: str | None = None) -> DataFrame:
    """Modification date per operation.

    ``max`` takes the latest value, ``both`` gives both in one pass; ``first`` takes the value of the lowest
    ``order_col`` (the file order the reference used), which must be given.
    """
    mod = F.col(mod_col) if isinstance(mod_col, str) else mod_col
    if mode == "max":
        aggs = [F.max(mod).alias("last_modified")]
    elif mode in ("first", "both"):
        if not order_col:
            raise ValueError(f"mode={mode!r} needs an explicit order column")
        first = F.min_by(mod, F.col(order_col))
        aggs = [first.alias("last_modified")] if mode == "first" else [F.max(mod).alias("last_modified"), first.alias("first_modified")]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return tables.where(mod.isNotNull()).groupBy(op_col).agg(*aggs)


def series_totals(series: DataFrame, op_col: str, values: Column | str = "Data") -> DataFrame:
    """Series and values per operation plus a grand total row.

    One input row per series; ``values`` is its nested value array (counted
    with ``size``) or a column holding its value count.  ``rollup`` adds the
    total with a null operation key; ``is_total`` marks it.
    """
    v = F.col(values) if isinstance(values, str) else values
    if isinstance(values, str) and dict(series.dtypes).get(values, "").startswith("array"):
        v = F.size(v)
    return (series.rollup(op_col)
            .agg(F.count(F.lit(1)).alias("n_series"),
                 F.sum(F.coalesce(v, F.lit(0))).cast("bigint").alias("n_values"),
                 F.grouping(op_col).cast("boolean").alias("is_total")))


def items_by_year(df: DataFrame, date_col: str = "date_iso") -> DataFrame:
    """Items per four-digit year of the date text, ``sin_fecha`` when none (A10)."""
    return (df.groupBy(F.coalesce(year_of(date_col), F.lit(UNDATED_YEAR)).alias("year"))
            .agg(F.count(F.lit(1)).alias("n")))


def series_stats(obs: DataFrame, key: list[str], order_col: str, value_col: str) -> DataFrame:
    """Observation count and the value at the greatest ``order_col`` per series."""
    return obs.groupBy(*key).agg(F.count(F.lit(1)).alias("count"),
                                 F.max_by(F.col(value_col), F.col(order_col)).alias("last_value"))


def mean_fanout(reports: DataFrame) -> DataFrame:
    """One row over the reviews of several crossings (A13): how many, how many have a ratio, the mean and the greatest ratio."""
    return reports.agg(F.count(F.lit(1)).alias("crossings"), F.count("fanout_ratio").alias("rated"), F.round(F.avg("fanout_ratio"), 6).alias("fanout_ratio_average"),
                       F.max("fanout_ratio").alias("fanout_ratio_max"), F.count_if(~F.col("passed")).alias("failed"))


def fanout_ratio(n_result: Column, n_a: Column, n_b: Column) -> Column:
    """``result / max(a, b)`` (A13; the reference names the metric but gives no formula)."""
    denom = F.greatest(n_a, n_b)
    return F.when(denom > 0, n_result / denom)


# The fields that a summary names.
SUMMARY_FIELDS = ["id", "source", "title", "date_iso", "description", "tags", "url", "type", "normalized_at", "authors", "date_raw", "pdf_url",
                  "geography", "technique", "date_raw", "operation_id", "operation_code", "tables_count"]


def summary_table(df: DataFrame) -> DataFrame:
    """The whole summary (A1) as one table ``(piece, position, name, n)``.

    Pieces: ``total_items``, ``por_fuente`` and ``tipos_disponibles`` (by
    name), ``rango_temporal`` (``desde``, ``hasta``), ``tags_mas_frecuentes``
    (most frequent first) and ``campos_disponibles``.  ``position`` orders the
    pieces that have an order of their own.
    """
    return summary_rows(summary(df))


def summary_rows(s: dict[str, DataFrame]) -> DataFrame:
    """The pieces of a summary as the rows of ``summary_table``."""
    row = lambda piece, position, name, n: [F.lit(piece).alias("piece"), position.cast("int").alias("position"), name.alias("name"), n.cast("bigint").alias("n")]
    none, text = F.lit(None), F.lit(None).cast("string")
    top = s["top_tags"].withColumn("_p", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("tag"))))  # ten rows
    bounds = F.explode(F.array(F.concat(F.lit("desde "), "desde"), F.concat(F.lit("hasta "), "hasta"))).alias("name")
    fields = s["total"].select(F.posexplode(F.array(*[F.lit(x) for x in SUMMARY_FIELDS])).alias("p", "f"))
    parts = [s["total"].select(*row("total_items", none, text, F.col("total_items"))), s["by_source"].select(*row("por_fuente", none, F.col("source"), F.col("n"))),
             s["types"].select(*row("tipos_disponibles", none, F.col("type"), none)), s["date_range"].select(bounds).select(*row("rango_temporal", none, F.col("name"), none)),
             top.select(*row("tags_mas_frecuentes", F.col("_p"), F.col("tag"), F.col("n"))), fields.select(*row("campos_disponibles", F.col("p") + 1, F.col("f"), none))]
    return reduce(DataFrame.unionByName, parts)


def summary(df: DataFrame) -> dict[str, DataFrame]:
    """All pieces of the catalogue summary (A1) over one projection.

    The projection keeps only the five columns the pieces read; callers that
    act on several pieces should ``persist`` it first.
    """
    proj = df.select("source", "type", "date_iso", "tags")
    return {
        "total": proj.agg(F.count(F.lit(1)).alias("total_items")),
        "by_source": count_by_source(proj),
        "types": types(proj),
        "date_range": date_range(proj),
        "top_tags": top_tags(proj),
    }
