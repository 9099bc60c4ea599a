"""Quality, privacy and provenance.

The fan-out review needs four numbers (|a|, |b|, |result|, duplicate keys in
the result).  They are computed as distributed aggregates and stacked into a
single row by a grouped aggregate (no cross join); only that one-row verdict
ever reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.text import _c

DEFAULT_TOLERANCE = 1.05  # fixed value: 1:N growth allowed (5%)
SIZE_S_MAX_ROWS = 100_000  # fixed value: routing limit for size S
# Sources allowed in the catalogue contract.
ALLOWED_SOURCES = ["Funcas", "BBVA Research", "INE", "ECB", "funcas", "bbva", "ine"]


class FanoutError(AssertionError):
    """A crossing blew up, lost its rows or broke its declared cardinality."""


def _metric(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(value.cast("bigint").alias("v")).select(F.lit(name).alias("m"), "v")


def fanout_report(a: DataFrame, b: DataFrame, result: DataFrame, keys: list[str],
                  how: str = "inner", expected: str = "1:1",
                  tol: float = DEFAULT_TOLERANCE) -> DataFrame:
    """One-row review of a crossing (Q1): counts, duplicate keys, ratio, verdict.

    Rules, first failure wins: explicit keys are required and must be in the
    result; ``1:1`` allows no duplicate key in the result, an inner result no
    larger than the smaller input and a left result of exactly |a| rows;
    ``1:N`` allows at most ``int(max(|a|,|b|) * tol)`` rows; any cardinality
    fails an empty result of two non-empty inputs (leakage).
    """
    spark = result.sparkSession
    if not keys:
        return _verdict_only(spark, "no explicit join keys: cartesian product blocked")
    missing = [k for k in keys if k not in result.columns]
    if missing:
        return _verdict_only(spark, f"key {missing[0]!r} not found in the result")
    parts = [_metric(a, "n_a", F.count(F.lit(1))), _metric(b, "n_b", F.count(F.lit(1)))]
    if expected == "1:1":
        # one pass over the result: rows per key give both the size and the duplicates
        per_key = result.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
        stats = per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.max("c"), F.lit(0)).alias("mx"))
        parts.append(stats.select(F.explode(F.array(
            F.struct(F.lit("n_result").alias("m"), F.col("n").cast("bigint").alias("v")),
            F.struct(F.lit("dup").alias("m"), (F.col("mx") > 1).cast("bigint").alias("v")))).alias("x")).select("x.m", "x.v"))
    else:
        parts.append(_metric(result, "n_result", F.count(F.lit(1))))
    stacked = reduce(DataFrame.unionByName, parts)
    row = stacked.agg(*[F.max(F.when(F.col("m") == m, F.col("v"))).alias(m)
                        for m in ["n_a", "n_b", "n_result", "dup"]])
    return _judged(row, how, expected, tol)


def crossing_report(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner", expected: str = "1:1",
                    tol: float = DEFAULT_TOLERANCE) -> DataFrame:
    """The review of ``fanout_report`` for a crossing that has not been run (Q1).

    The result's size and duplicates follow from how often each key occurs on
    either side: one aggregate over the keys of both inputs, each read once.  A
    key with a null part matches nothing.
    """
    if not keys:
        return _verdict_only(a.sparkSession, "no explicit join keys: cartesian product blocked")
    for side in (a, b):
        missing = [k for k in keys if k not in side.columns]
        if missing:
            return _verdict_only(a.sparkSession, f"key {missing[0]!r} not found in the result")
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join {how!r}")
    side = lambda df, x, y: df.select(*keys, F.lit(x).alias("x"), F.lit(y).alias("y"))
    counts = side(a, 1, 0).unionByName(side(b, 0, 1)).groupBy(*keys).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    whole = reduce(lambda p, q: p & q, [F.col(k).isNotNull() for k in keys])
    x, y = F.col("x").cast("decimal(18,0)"), F.col("y").cast("decimal(18,0)")
    met = F.when(whole & (F.col("x") > 0) & (F.col("y") > 0), x * y)
    alone = {"inner": F.lit(0), "left": x, "right": y, "full": x + y}[how]
    rows = F.coalesce(met, alone.cast("decimal(37,0)"))
    row = counts.agg(F.coalesce(F.sum("x"), F.lit(0)).cast("bigint").alias("n_a"), F.coalesce(F.sum("y"), F.lit(0)).cast("bigint").alias("n_b"),
                     F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("n_result"),
                     F.coalesce(F.max(rows) > 1, F.lit(False)).cast("bigint").alias("dup"))
    return _judged(row if expected == "1:1" else row.withColumn("dup", F.lit(None).cast("bigint")), how, expected, tol)


def _judged(row: DataFrame, how: str, expected: str, tol: float) -> DataFrame:
    """Verdict on the four numbers of a crossing."""
    na, nb, nr = F.col("n_a"), F.col("n_b"), F.col("n_result")
    dup = F.coalesce(F.col("dup"), F.lit(0)) > 0
    limit_1n = F.floor(F.greatest(na, nb) * F.lit(tol)).cast("bigint")
    rules = []
    if expected == "1:1":
        rules.append((dup, "duplicate keys in a 1:1 crossing: underlying N:M"))
        if how == "inner":
            rules.append((nr > F.least(na, nb), "inner join explosion: result larger than the smaller input"))
        if how == "left":
            rules.append((nr != na, "left join leak: result size differs from the left input"))
    elif expected == "1:N":
        rules.append((nr > limit_1n, "1:N explosion: result over max(|a|,|b|) * tolerance"))
    rules.append(((nr == 0) & (na > 0) & (nb > 0), "leakage: empty result from non-empty inputs"))
    reason = F.lit(None).cast("string")
    for cond, msg in reversed(rules):
        reason = F.when(cond, F.lit(msg)).otherwise(reason)
    from vitrina.operators.summary import fanout_ratio
    return row.select(na.alias("n_a"), nb.alias("n_b"), nr.alias("n_result"), dup.alias("dup_keys"),
                      F.round(fanout_ratio(nr, na, nb), 6).alias("fanout_ratio"),
                      reason.isNull().alias("passed"), reason.alias("reason"))


def _verdict_only(spark: SparkSession, reason: str) -> DataFrame:
    schema = "n_a bigint, n_b bigint, n_result bigint, dup_keys boolean, fanout_ratio double, " \
             "passed boolean, reason string"
    return spark.createDataFrame([(None, None, None, None, None, False, reason)], schema)


def check_crossing(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner",
                   expected: str = "1:1", tol: float = DEFAULT_TOLERANCE) -> None:
    """Raise ``FanoutError`` if a crossing would fail its review (J7); the crossing itself is not run."""
    if not keys:
        raise ValueError("no explicit join keys: cartesian product blocked")
    verdict = crossing_report(a, b, keys, how, expected, tol).first()
    if not verdict["passed"]:
        raise FanoutError(verdict["reason"])


def checked_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner",
                 expected: str = "1:1", tol: float = DEFAULT_TOLERANCE) -> DataFrame:
    """Join on explicit keys after its review passed (J7): an exploding join is refused before it runs."""
    check_crossing(a, b, keys, how, expected, tol)
    return a.join(b, on=keys, how=how)


def year_key(c: Column | str) -> Column:
    """Year of a mixed-precision date text, the key of J8."""
    return F.substring(_c(c), 1, 4)


# ---------------------------------------------------------------------------
# Q2 / Q3 hashing
# ---------------------------------------------------------------------------
def hmac_pads(secret: str, pepper: str) -> tuple[str, str]:
    """Inner and outer HMAC-SHA256 pads (hex) of the key ``secret_pepper``."""
    key = f"{secret}_{pepper}".encode("utf-8")
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\x00")
    return bytes(k ^ 0x36 for k in key).hex(), bytes(k ^ 0x5C for k in key).hex()


def hmac_sha256(c: Column | str, secret: str, pepper: str) -> Column:
    """Keyed pseudonym: hex HMAC-SHA256 of the value's text (Q2), all native.

    ``sha2(opad || unhex(sha2(ipad || value, 256)), 256)``; the pads are
    derived once on the driver from the key.
    """
    ipad, opad = hmac_pads(secret, pepper)
    data = F.encode(_c(c).cast("string"), "UTF-8")
    inner = F.unhex(F.sha2(F.concat(F.unhex(F.lit(ipad)), data), 256))
    return F.sha2(F.concat(F.unhex(F.lit(opad)), inner), 256)


#: Files up to this size are hashed as one value; larger ones are read in blocks.
WHOLE_FILE = 64 << 20


def _hashed_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from vitrina.sources.files import blocks_of
    for batch in batches:
        digests = []
        for path in batch.column(0).to_pylist():
            digest = hashlib.sha256()
            for block in blocks_of(path):
                digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string())], ["path", "size", "sha256"])


def file_hashes(spark: SparkSession, path_glob: str, whole_file: int = WHOLE_FILE) -> DataFrame:
    """Path, size and SHA-256 of every file matched (Q3).

    Small files are read by Spark as one value each.  Larger ones, of any size, are
    only listed by it; they are dealt out one by one and read in blocks, with the digest
    carried on, so a task holds one block.  Spark lists no empty files, so they give no row.
    """
    from vitrina.session import ship_package
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path_glob)  # the content is read only where it is selected
    small = files.filter(F.col("length") <= whole_file).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    listed = files.filter(F.col("length") > whole_file).select("path", F.col("length").alias("size"))
    large = listed.repartition("path").mapInArrow(_hashed_in_blocks, "path string, size long, sha256 string")
    return small.unionByName(large)


# ---------------------------------------------------------------------------
# Q4-Q8
# ---------------------------------------------------------------------------
def id_collisions(df: DataFrame, id_col: str = "id", order_col: str | None = None,
                  first_name: str | None = None) -> DataFrame:
    """Ids shared by more than one item (Q4, D2/D14), with the count and,
    given an order column, its least value (as ``first_name``)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if order_col:
        aggs.append(F.min(order_col).alias(first_name or f"first_{order_col}"))
    return df.groupBy(id_col).agg(*aggs).filter(F.col("n") > 1)


def validate_catalog(df: DataFrame, allowed: list[str] | None = None, min_items: int = 0,
                     max_items: int | None = None, required_sources: list[str] | None = None
                     ) -> DataFrame:
    """Contract violations as rows ``(rule, id, detail)`` (Q5): every rule that a row breaks, then those of the whole."""
    spark = df.sparkSession
    allowed = allowed or ALLOWED_SOURCES
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    rule = lambda cond, name: F.when(cond, F.lit(name))
    broken = F.array_compact(F.array(
        rule(blank("id"), "missing_id"), rule(blank("title"), "missing_title"), rule(blank("source"), "missing_source"),
        rule(~blank("source") & ~F.col("source").isin(*allowed), "source_not_allowed")))
    per_row = df.select(F.explode(broken).alias("rule"), F.col("id"),
                        F.coalesce(F.col("source"), F.lit("")).alias("detail"))
    n = df.agg(F.count(F.lit(1)).alias("n"))
    upper = F.lit(max_items) if max_items is not None else F.lit(None).cast("bigint")
    count_rule = n.select(
        F.when(F.col("n") < min_items, F.lit("too_few_items"))
        .when(F.col("n") > upper, F.lit("too_many_items")).alias("rule"),
        F.lit(None).cast("string").alias("id"), F.col("n").cast("string").alias("detail")
    ).filter(F.col("rule").isNotNull())
    out = per_row.unionByName(count_rule)
    if required_sources:
        req = spark.createDataFrame([(s,) for s in required_sources], "detail string")
        present = df.select(F.col("source").alias("detail")).distinct()
        missing = req.join(present, "detail", "left_anti").select(
            F.lit("missing_source_family").alias("rule"), F.lit(None).cast("string").alias("id"),
            "detail")
        out = out.unionByName(missing)
    return out


def _flat_fields(schema: T.StructType, prefix: str = "") -> dict[str, str]:
    out = {}
    for f in schema.fields:
        name = prefix + f.name
        out[name] = f.dataType.simpleString()
        if isinstance(f.dataType, T.StructType):
            out.update(_flat_fields(f.dataType, name + "."))
    return out


def schema_drift(spark: SparkSession, actual: T.StructType, expected: T.StructType) -> DataFrame:
    """Missing, extra and changed columns (nested fields included) as rows (Q6)."""
    a, e = _flat_fields(actual), _flat_fields(expected)
    rows = [(c, "missing", e[c], None) for c in e if c not in a]
    rows += [(c, "extra", None, a[c]) for c in a if c not in e]
    rows += [(c, "type_changed", e[c], a[c]) for c in e if c in a and a[c] != e[c]]
    return spark.createDataFrame(rows, "column string, kind string, expected string, actual string")


def record_drift(records: DataFrame, json_col: str, expected: dict[str, str]) -> DataFrame:
    """Fields of JSON records against expected types (Q6), from the records themselves.

    ``expected`` maps a field to its type in SQL (``BIGINT``, ``STRING``, ...).
    Returns ``column, kind, expected, actual, n``: ``extra`` and ``type_changed``
    per observed type with the number of records, ``missing`` with the number of
    records that lack the field (a record that is no object lacks all).
    """
    spark = records.sparkSession
    parsed = records.select(F.from_json(json_col, "map<string,variant>").alias("m"))
    want = spark.createDataFrame(list(expected.items()), "column string, expected string")  # a schema: as many rows as fields
    seen = (parsed.select(F.explode("m").alias("column", "v")).groupBy("column", F.schema_of_variant("v").alias("actual"))
            .agg(F.count(F.lit(1)).alias("n")))
    j = seen.join(want, "column", "left")
    changed = j.filter(F.col("expected").isNull() | (F.col("expected") != F.col("actual"))).select(
        "column", F.when(F.col("expected").isNull(), "extra").otherwise("type_changed").alias("kind"), "expected", "actual", "n")
    lacking = parsed.agg(*[F.count_if(~F.coalesce(F.map_contains_key("m", F.lit(c)), F.lit(False))).alias(c) for c in expected])
    rows = lacking.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit("missing").alias("kind"), F.lit(t).alias("expected"),
                                                       F.lit(None).cast("string").alias("actual"), F.col(f"`{c}`").alias("n"))
                                              for c, t in expected.items()])).alias("x")).select("x.*")
    return changed.unionByName(rows.filter("n > 0"))


def size_class(descr: Column | str, n_rows: Column | str, has_pii: Column | str) -> Column:
    """Crossing size S / M / L (Q7)."""
    d = F.coalesce(_c(descr), F.lit(""))
    low = F.lower(d)
    small = (_c(n_rows) < SIZE_S_MAX_ROWS) & ~F.coalesce(_c(has_pii), F.lit(False)) & d.contains("id=")
    large = low.contains("semantic") | low.contains("fuzzy")
    return F.when(small, F.lit("S")).when(large, F.lit("L")).otherwise(F.lit("M"))


def with_provenance(df: DataFrame, source: str | None = None, url_col: str | None = None,
                    scraped_at: Column | None = None) -> DataFrame:
    """Row provenance: source, url, scraped_at, normalized_at (Q8).

    ``normalized_at`` is ``current_timestamp()``: one value per query.
    """
    out = df
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    if url_col is not None and url_col != "url":
        out = out.withColumn("url", F.col(url_col))
    if scraped_at is not None:
        out = out.withColumn("scraped_at", scraped_at)
    return out.withColumn("normalized_at", F.current_timestamp())
