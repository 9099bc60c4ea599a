"""Readers for the publishers' raw layouts.

Every reader takes an explicit schema (nothing is inferred), keeps the file
a row came from where the layout encodes data in the file name, and sends
unreadable records to a quarantine column instead of failing the job.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina import schemas as SC
from vitrina.session import scratch_path, ship_package
from vitrina.sources.files import entries_in, opened
from vitrina.sources.large_json import cut_files

CORRUPT = "_corrupt_record"

# Reference code tables.
KEY_OPERATIONS = [25, 18, 293, 237, 247, 26, 32, 15, 432, 27, 132, 48, 14, 42, 4, 44, 334, 410, 436,
                  61, 62, 63, 137, 464, 465]
HIGH_VALUE_DATASETS = [
    (11078, "Producción industrial", "IPI"),
    (11079, "IPRI desgloses por actividad", "IPRI"),
    (11080, "Volumen de ventas por actividad", "ICN"),
    (11081, "Flujos turísticos en Europa", "Turismo"),
    (11082, "IPCA", "IPCA"),
    (11083, "PIB principales agregados", "CNTR"),
    (11084, "Indicadores sobre empresas", "CNE"),
    (11085, "Indicadores sobre hogares", "CNE"),
    (11086, "Gastos e ingresos públicos", "Gastos"),
    (11092, "Estadísticas medioambientales", "Medioambiente"),
    (11093, "Población", "Población"),
    (11094, "Fecundidad", "Fecundidad"),
    (11095, "Mortalidad", "Mortalidad"),
    (11096, "Pobreza", "Pobreza"),
    (11097, "Desigualdad", "Desigualdad"),
    (11098, "Dataset HVD 16", "HVD16"),
    (11099, "Dataset HVD 17", "HVD17"),
]


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, quarantine: bool = False) -> DataFrame:
    """JSON lines with a fixed schema.

    Blank lines are skipped by the JSON source and malformed lines are dropped
    (``DROPMALFORMED``); ``quarantined`` lists them.  ``quarantine=True``
    instead returns every line with a ``_corrupt_record`` column (PERMISSIVE).
    """
    if not quarantine:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return (spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def quarantined(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Only the malformed lines of a JSON-lines input, with their file.

    The first schema field is kept beside the raw line: Spark refuses a scan
    that references nothing but the corrupt-record column.
    """
    df = read_jsonl(spark, path, schema, quarantine=True)
    first = schema.fieldNames()[0]
    return df.filter(F.col(CORRUPT).isNotNull()).select(F.col("_metadata.file_path").alias("file"), first, CORRUPT)


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """Table metadata whose operation id is in the file name.

    Accepts ``tables_op{N}.jsonl`` files and ``op_id={N}`` partition folders.
    """
    df = read_jsonl(spark, path, SC.TABLE_META_RAW)
    fp = F.col("_metadata.file_path")
    from_name = F.regexp_extract(fp, r"tables_op(\d+)", 1)
    from_dir = F.regexp_extract(fp, r"op_id=(\d+)", 1)
    op = F.coalesce(F.nullif(from_name, F.lit("")), F.nullif(from_dir, F.lit(""))).cast("bigint")
    keep = [c for c in SC.TABLE_META_RAW.fieldNames()]
    return df.select(*keep, op.alias("op_id"))


#: Tasks for each core, at most, that read bundles; the files of a task, if there are fewer tasks; files and bytes of a batch.
BUNDLE_TASKS = 16
BUNDLES_A_TASK = 500
_BATCH_FILES, _BATCH_BYTES = 1000, 4 << 20


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``name``: the files of a folder that match a pattern, listed now, in a task, into a table: the driver sees none of them.

    Folders named ``key=value`` are listed too, with a slash behind."""
    ship_package(spark)
    regex = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()  # noqa: SLF001

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in it:
            pass
        # as Spark's readers: hidden files are none
        wanted = (f if is_file else f"{f}/" for f, is_file in entries_in(folder)
                  if (re.fullmatch(regex, f, re.DOTALL) if is_file else "=" in f) and not (f[0] == "." or f[0] == "_" and "=" not in f))
        while some := list(islice(wanted, 10_000)):
            yield pa.RecordBatch.from_pydict({"name": pa.array(some, pa.string())})

    path = scratch_path(spark, f"listing-{uuid.uuid4().hex}")
    spark.range(0, 1, 1, 1).mapInArrow(run, "name string").write.parquet(path)
    return spark.read.schema("name string").parquet(path)


def _read_listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    """``name, value``: files of a folder, read as a table of their names says; empty files are left out, as by Spark's readers.  None if the folder is partitioned."""
    names = _listed(spark, folder, pattern)
    n, parts = names.agg(F.count("name"), F.max(F.col("name").endswith("/"))).first()
    if parts:
        return None
    tasks = min(max(-(-n // BUNDLES_A_TASK), 1), BUNDLE_TASKS * spark.sparkContext.defaultParallelism)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = opened(folder)
        batch = lambda: pa.RecordBatch.from_pydict({"name": pa.array(found, pa.string()), "value": pa.array(data, pa.binary())})
        found, data, size = [], [], 0
        for name in (n for b in it for n in b.column(0).to_pylist()):
            with filesystem.open_input_stream(f"{base.rstrip('/')}/{name}", compression=None) as stream:
                value = stream.read()
            if value:
                found.append(name)
                data.append(value)
                size += len(value)
            if len(found) >= _BATCH_FILES or size >= _BATCH_BYTES:
                yield batch()
                found, data, size = [], [], 0
        if found:
            yield batch()

    return names.repartition(tasks, "name").mapInArrow(run, "name string, value binary").select("name", F.col("value").cast("string").alias("value"))


def _folder(spark: SparkSession, folder: str) -> str | None:
    """The whole name of a folder that tasks can list and open by themselves, or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    full = fs.makeQualified(path).toString()
    try:
        opened(full)
    except (OSError, ValueError):  # a store that only Spark reads
        return None
    return full if fs.exists(path) and fs.getFileStatus(path).isDirectory() else None


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Markdown bundles, one row per file: ``(id = file stem, content)`` (S3); ``%XX`` in a stem stands for a character.

    ``folder/pattern``, the pattern ending in ``.md``, is listed once and now, by a task that writes the names
    to a table; tasks that read this table open the files.  Neither names nor files come to the driver,
    however many there are.  Other paths, partitioned folders (``key=value``) and stores that only Spark reads are listed by Spark, on the driver.
    """
    folder, _, pattern = path.rpartition("/")
    plain = lambda name: F.when(name.contains("%"), F.url_decode(F.regexp_replace(name, r"\+", "%2B"))).otherwise(name)  # noqa: E731  a plus is a plus
    stem = F.regexp_replace(F.col("name"), r"\.md$", "")
    one = bool(re.search(r"[*?\[{]", pattern) and folder and not re.search(r"[*?\[{\\]", folder))
    if one and pattern.endswith(".md") and (full := _folder(spark, folder)) and (read := _read_listed(spark, full, pattern)) is not None:
        return read.select(plain(stem).alias("id"), F.col("value").alias("content"))
    df = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True) if one else spark.read.text(path, wholetext=True)
    df = df.select(F.col("_metadata.file_name").alias("name"), "value").coalesce(BUNDLE_TASKS * spark.sparkContext.defaultParallelism)
    return df.select(plain(plain(stem)).alias("id"), F.col("value").alias("content"))  # the name comes as part of a URI


#: Documents up to this size are read as one record; larger ones are cut into small documents while they are read.
WHOLE_DOCUMENT = 16 << 20
_STEM = r"([^/]+)\.json$"


def _documents(spark: SparkSession, path: str, schema: T.StructType, layout: str, whole: int) -> DataFrame:
    """``(file, flow_file, first, doc, error)``: JSON documents, large ones as several, each with the number of its first series; ``doc`` is null for a bad file."""
    text = spark.read.text(path, wholetext=True).where(F.col("_metadata.file_size") <= whole)  # larger files are not opened
    parsed = F.from_json("value", _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    small = text.select(F.col("_metadata.file_path").alias("file"), parsed.alias("d"))
    ok = F.col("d").isNotNull() & F.col(f"d.{CORRUPT}").isNull()
    one = small.select("file", F.lit(0).cast("long").alias("first"), F.when(ok, F.struct(*[F.col(f"d.{f}").alias(f) for f in schema.fieldNames()])).alias("doc"),
                       F.when(~ok, F.lit("no such JSON document")).alias("error"))
    cut = cut_files(spark, path, layout, whole)
    many = cut.select(F.col("path").alias("file"), "first", F.from_json("text", schema).alias("doc"), "error")
    both = one.unionByName(many)
    return both.withColumn("flow_file", F.regexp_extract("file", _STEM, 1))


def read_series(spark: SparkSession, path: str, whole: int = WHOLE_DOCUMENT) -> DataFrame:
    """Decoded series files, one JSON document per flow.

    The flow is the file stem; a file that cannot be parsed is skipped and
    reported by ``bad_series_files``.  One row per series with its 0-based
    ``position`` in the file.  A file of more than ``whole`` bytes leaves its task in
    pieces, while it is read.
    """
    ok = _documents(spark, path, SC.SERIES_FILE, "series", whole).where("doc IS NOT NULL")
    e = ok.select("flow_file", "doc.label", "doc.has_es", "first", F.posexplode("doc.series").alias("at", "s"))
    return e.select(F.col("flow_file").alias("flow"), "label", "has_es", (F.col("first") + F.col("at")).cast("int").alias("position"),
                    *[F.col("s")[f].alias(f) for f in SC.DECODED_SERIES.fieldNames() if f != "flow"])


def bad_series_files(spark: SparkSession, path: str, whole: int = WHOLE_DOCUMENT) -> DataFrame:
    """``(file, flow)`` of the files that are no JSON documents."""
    return _documents(spark, path, SC.SERIES_FILE, "series", whole).where("doc IS NULL").select("file", F.lit(None).cast("string").alias("flow"))


def read_stat_series(spark: SparkSession, path: str) -> DataFrame:
    """Statistics series with nested values; non-object lines dropped."""
    df = read_jsonl(spark, path, SC.STAT_SERIES_RAW, quarantine=True)
    return df.filter(F.col(CORRUPT).isNull() & F.col("COD").isNotNull()).drop(CORRUPT)


def read_sdmx(spark: SparkSession, path: str, whole: int = WHOLE_DOCUMENT) -> DataFrame:
    """SDMX-JSON messages with the file stem as flow.

    One row for a file of up to ``whole`` bytes.  A larger message is many rows, each with the
    code lists and a part of the series, which leave its task while it is read; they decode as one message would.
    Files that cannot be parsed are skipped and reported by ``bad_sdmx_files``.
    """
    return _documents(spark, path, SC.SDMX_MESSAGE, "sdmx", whole).where("doc IS NOT NULL").select(F.col("flow_file").alias("flow"), F.col("doc").alias("msg"))


def bad_sdmx_files(spark: SparkSession, path: str, whole: int = WHOLE_DOCUMENT) -> DataFrame:
    """``(file, error)`` of the files that are no SDMX-JSON messages."""
    return _documents(spark, path, SC.SDMX_MESSAGE, "sdmx", whole).where("doc IS NULL").select("file", "error")


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap ``<url>`` entries: ``(url, lastmod)``, lastmod ``''`` when absent."""
    df = spark.read.format("xml").option("rowTag", "url").schema(SC.SITEMAP_ENTRY).load(path)
    return df.select(F.col("loc").alias("url"), F.coalesce(F.col("lastmod"), F.lit("")).alias("lastmod"))


def load_catalog(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The unified catalogue; a missing path fails with a clear message."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"catalogue not found at {path}: build it first (build_catalog + write_catalog)")
    reader = spark.read.schema(SC.CATALOG_STORED)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Vector index ``(id, title, model, vector, ok)``."""
    return spark.read.schema(SC.VECTORS).parquet(path)


def ref_table(spark: SparkSession, name: str) -> DataFrame:
    """Small fixed code tables of the reference (S10); safe to broadcast."""
    from vitrina.operators.normalize import FLOW_LABELS, SYSTEM_PAGES
    if name == "key_operations":
        return spark.createDataFrame([(i,) for i in KEY_OPERATIONS], "op_id bigint")
    if name == "high_value_datasets":
        return spark.createDataFrame(HIGH_VALUE_DATASETS, "cap bigint, name string, code string")
    if name == "flow_labels":
        return spark.createDataFrame(list(FLOW_LABELS.items()), "flow string, label string")
    if name == "system_pages":
        return spark.createDataFrame([(s,) for s in SYSTEM_PAGES], "id string")
    raise ValueError(f"unknown reference table {name!r}")
