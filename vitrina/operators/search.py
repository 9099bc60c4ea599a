"""Catalogue search.

``search`` only builds Column predicates and one ordered limit, so Catalyst
pushes ``date_iso`` bounds into the Parquet scan (``source`` and ``type`` are compared loosely, after it;
``operators.stored`` resolves them before) and plans the limit as ``TakeOrderedAndProject`` (a per-partition top-k, then a
merge of k rows per task): no full sort and no shuffle of the matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.fold import fold
from vitrina.functions.text import _c, strip_ws

SEARCH_FIELDS = ["id", "source", "title", "date_iso", "description", "url", "tags", "type"]


def source_matches(c: Column | str, s: str) -> Column:
    """Lower-case equality, or either text contains the other (F2).

    A null source counts as ``''``, which every query source contains.
    """
    item = F.lower(F.coalesce(_c(c), F.lit("")))
    q = s.lower()
    return (item == q) | item.contains(q) | F.lit(q).contains(item)


def type_is(c: Column | str, t: str) -> Column:
    """Case-insensitive type equality."""
    return F.lower(F.coalesce(_c(c), F.lit(""))) == t.lower()


def date_between(c: Column | str, desde: str | None = None, hasta: str | None = None) -> Column:
    """Text range on mixed-precision dates (F4, D7: bounds are independent).

    ``''`` (undated) fails any lower bound and passes any upper bound; ``2024``
    fails ``desde='2024-01-01'``: comparison is on text, as the reference does.
    """
    # Written so Parquet can take both bounds (no coalesce around the column):
    # a missing date counts as '', which is below any non-empty bound, so it
    # fails ``desde`` (null >= x is not true) and passes ``hasta`` (IS NULL).
    d = _c(c)
    conds = []
    if desde:
        conds.append(d >= desde)
    if hasta:
        conds.append(d.isNull() | (d <= hasta))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def haystack(title: Column | str = "title", description: Column | str = "description") -> Column:
    """``lower(title + ' ' + description)``, the text that F5 searches."""
    return F.lower(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "),
                            F.coalesce(_c(description), F.lit(""))))


def text_matches(t: str, title: Column | str = "title", description: Column | str = "description",
                 folded: Column | str | None = None) -> Column:
    """Plain or accent-folded substring match over title and description.

    ``folded`` may name a stored folded haystack column (written once by the
    catalogue sink) so the query does not fold every row again.
    """
    t_lower = t.lower()
    from vitrina.functions.fold import fold_py
    t_plain = fold_py(t_lower)
    h = haystack(title, description)
    if folded is not None:
        return h.contains(t_lower) | _c(folded).contains(t_plain)
    # bind the (long) haystack once per row: the fold refers to it several
    # times inside conditional branches, which are not de-duplicated
    return F.exists(F.array(h), lambda x: x.contains(t_lower) | fold(x).contains(t_plain))


def has_all_tags(c: Column | str, tags: list[str]) -> Column:
    """Every requested tag is present, case-insensitive."""
    wanted = F.array(*[F.lit(t.lower()) for t in tags])
    have = F.transform(F.coalesce(_c(c), F.array().cast("array<string>")), F.lower)
    return F.size(F.array_except(wanted, have)) == 0


def geography_is(c: Column | str, g: str) -> Column:
    """Case-insensitive geography equality; missing geography is ``''``."""
    return F.lower(F.coalesce(_c(c), F.lit(""))) == g.lower()


def search_predicate(df: DataFrame, source: str | None = None, tipo: str | None = None,
                     desde: str | None = None, hasta: str | None = None,
                     texto: str | None = None, tags: list[str] | None = None,
                     geography: str | None = None, type: str | None = None) -> Column:
    """AND of the given criteria; absent criteria add nothing (F1)."""
    conds: list[Column] = []
    if source:
        conds.append(source_matches("source", source))
    t = tipo or type
    if t:
        conds.append(type_is("type", t))
    if desde or hasta:
        conds.append(date_between("date_iso", desde, hasta))
    if texto:
        folded = "text_folded" if "text_folded" in df.columns else None
        conds.append(text_matches(texto, folded=folded))
    if tags:
        conds.append(has_all_tags("tags", tags))
    if geography:
        geo = F.col("geography") if "geography" in df.columns else F.lit("")
        conds.append(geography_is(geo, geography))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def search_view(df: DataFrame, width: int = 200) -> DataFrame:
    """The 8 result fields, description cut to ``width`` characters."""
    return df.select(
        "id", "source", "title", "date_iso",
        F.substring(F.coalesce(F.col("description"), F.lit("")), 1, width).alias("description"),
        "url", F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"), "type",
    )


def catalog_order(df: DataFrame) -> list[Column]:
    """Newest first on the date text, then id: a total, stable order."""
    return [F.coalesce(F.col("date_iso"), F.lit("")).desc(), F.col("id").asc()]


def search(df: DataFrame, limit: int | None = 20, **criteria) -> DataFrame:
    """Filter the catalogue and return the first ``limit`` items in catalogue order."""
    hits = search_view(df.filter(search_predicate(df, **criteria)))
    ordered = hits.orderBy(*catalog_order(hits))
    return ordered.limit(limit) if limit else ordered


def search_counts(df: DataFrame, limit: int = 20, **criteria) -> DataFrame:
    """One row: total matches and how many a ``limit`` would show."""
    return (df.filter(search_predicate(df, **criteria))
            .agg(F.count(F.lit(1)).alias("total_found"))
            .select("total_found", F.least(F.col("total_found"), F.lit(limit)).cast("bigint")
                    .alias("shown")))


def drop_system_pages(df: DataFrame, system_ids: DataFrame | list[str], key: str = "id") -> DataFrame:
    """Remove ids listed as system pages (F8).

    A literal id list is broadcast (its size is known); a DataFrame of ids is
    joined without a hint, so AQE broadcasts it only if its runtime size is small.
    """
    if isinstance(system_ids, list):
        ids = df.sparkSession.createDataFrame([(i,) for i in system_ids], f"{key} string")
        return df.join(F.broadcast(ids), on=key, how="left_anti")
    return df.join(system_ids.select(F.col(system_ids.columns[0]).alias(key)), on=key, how="left_anti")


def nonblank_title(c: Column | str = "title") -> Column:
    """Title that is not blank once trimmed."""
    return strip_ws(F.coalesce(_c(c), F.lit(""))) != ""


def recent(df: DataFrame, years: list[str], lastmod: str = "lastmod", date: str = "date") -> DataFrame:
    """Items whose year (of lastmod, else of date) is in ``years``."""
    from vitrina.functions.text import blank_to_null
    y = F.substring(F.coalesce(blank_to_null(lastmod), F.coalesce(F.col(date), F.lit(""))), 1, 4)
    return df.filter(y.isin(*years))
