"""Sinks (K1, K2, K8, K9, K10, index lines).

All writers are Spark writers except ``write_bundles``, whose layout (one
file per item, named by id) has no built-in sink: it runs on the executors
with ``pyarrow.fs`` so the target can be any shared filesystem URI.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.operators.search import catalog_order


def write_clean(df: DataFrame, path: str, fmt: str = "json", partition_col: str = "source",
                mode: str = "overwrite") -> None:
    """Per-source clean records (K1): one folder per source value.

    The ``rebalance`` hint lets AQE size the write tasks (a hot source is
    split, small ones merged) instead of every task writing every source.
    """
    w = df.hint("rebalance", partition_col).write.mode(mode).partitionBy(partition_col)
    if fmt == "json":
        w.option("ignoreNullFields", False).json(path)
    else:
        w.parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str, fmt: str = "json",
                      rows_per_file: int = 1_000_000, mode: str = "overwrite") -> None:
    """One folder per ``key`` value with few, full files (S2 layout, K1).

    A plain ``partitionBy`` makes up to (tasks x keys) small files.  The
    ``rebalance`` hint shuffles rows by key so a key's rows meet in one task,
    and lets AQE split a skewed key over several tasks and merge small ones
    (advisory partition size); ``maxRecordsPerFile`` caps any single file.
    """
    out = df.hint("rebalance", key)
    w = out.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(key)
    (w.option("ignoreNullFields", False).json(path) if fmt == "json" else w.parquet(path))


def write_catalog(df: DataFrame, path: str, fmt: str = "parquet", partitions: int | None = None,
                  mode: str = "overwrite") -> None:
    """Unified catalogue, newest first (K2).

    Range partitioning on the catalogue order plus a sort inside each
    partition gives globally ordered part files without a single-task sort.
    A folded search column is stored so F5 does not fold at query time.
    """
    from vitrina.functions.fold import fold
    from vitrina.operators.search import haystack
    order = catalog_order(df)
    # without an explicit count AQE sizes the range partitions from the data; texts are folded
    # after the exchange, whose sampling would fold them once more
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    out = ranged.sortWithinPartitions(*order).withColumn("text_folded", fold(haystack()))
    (out.write.mode(mode).parquet(path) if fmt == "parquet"
     else out.write.mode(mode).option("ignoreNullFields", False).json(path))


def write_vectors(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Vector index as one Parquet table (K8): no positional coupling of files."""
    df.select("id", "title", "model", "vector", "ok").write.mode(mode).parquet(path)


def append_run_log(df: DataFrame, path: str, action: str) -> None:
    """Append one change-log row ``(at, action, detail)`` with counts (K9).

    ``df`` is the run's output; the detail is ``{n} items`` plus a count per
    source when a ``source`` column exists (one aggregate, one row).
    """
    if "source" in df.columns:
        per = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        detail = per.agg(F.concat(F.sum("n").cast("string"), F.lit(" items ("),
                                  F.array_join(F.array_sort(F.collect_list(
                                      F.concat(F.col("source"), F.lit(": "), F.col("n").cast("string")))), ", "),
                                  F.lit(")")).alias("detail"))
    else:
        detail = df.agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(" items")).alias("detail"))
    row = detail.select(F.current_timestamp().alias("at"), F.lit(action).alias("action"), "detail")
    row.coalesce(1).write.mode("append").parquet(path)


def write_lines(lines: DataFrame, path: str, order: list | None = None, partitions: int | None = None) -> None:
    """Write an index line table (K6/K7) as text in key order.

    Range partitioning by the sort keys keeps the order across part files;
    read the parts in name order to get the document.
    """
    order = order or [F.col(k) for k in ("k1", "k2", "k3", "k4") if k in lines.columns]
    ranged = lines.repartitionByRange(partitions, *order) if partitions else lines.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def bundle_name(ident: str | None) -> str:
    """File name of an id: one name in one folder, from which ``read_bundles`` gets the id back.

    Percent signs, slashes, backslashes and control characters are written as ``%XX``, and so is a
    leading dot or underscore, which would hide the file.  An id that is null or empty has no file.
    """
    if not ident:
        raise ValueError("a bundle needs an id")
    plain = "".join(f"%{ord(c):02X}" if c in "%/\\" or ord(c) < 32 or ord(c) == 127 else c for c in ident)
    return f"%{ord(plain[0]):02X}{plain[1:]}" if plain[0] in "._" else plain


def write_bundles(df: DataFrame, root: str, id_col: str = "id", content_col: str = "content",
                  suffix: str = ".md") -> DataFrame:
    """One file per item, named by its id (``bundle_name``) and ``suffix`` under ``root``.

    No id leads out of ``root`` or into a folder of its own; a null or empty id is an error.
    Runs on the executors (``mapInPandas``); returns ``(id, path, bytes)`` for
    every file written, so the caller can check or log the output.  Files are
    written whole and overwritten, so a retried task rewrites the same files.
    """
    # a path without a scheme is on the default filesystem, as for Spark's own readers
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))  # noqa: SLF001
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()  # noqa: SLF001
    base = full if "://" in full else full.replace("file:", "file://", 1)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs
        filesystem, prefix = pafs.FileSystem.from_uri(base)
        filesystem.create_dir(prefix, recursive=True)
        for pdf in it:
            paths, sizes = [], []
            for ident, content in zip(pdf[id_col], pdf[content_col]):
                data = (content or "").encode("utf-8")
                p = f"{prefix}/{bundle_name(ident)}{suffix}"
                with filesystem.open_output_stream(p) as out:
                    out.write(data)
                paths.append(p)
                sizes.append(len(data))
            yield pd.DataFrame({"id": pdf[id_col].to_numpy(), "path": paths, "bytes": sizes})

    from vitrina.session import ship_package
    ship_package(df.sparkSession)
    return df.select(id_col, content_col).mapInPandas(run, "id string, path string, bytes long")
