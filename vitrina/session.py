"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vitrina", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster the master and the shuffle width come from spark-submit; the
    defaults here are for local runs and tests.  AQE stays on so shuffle
    partitions are coalesced and skewed join partitions are split at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # only effective before the JVM starts (local mode)
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is read from the session.  When
    it is unset, a local master (tests) gets one scratch folder per
    application, and any other master is an error: a folder of one machine
    would be out of the others' reach.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if sc.applicationId not in _SCRATCH:
            _SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="vitrina-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        path = _SCRATCH[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vitrina`` importable in Python workers (``addPyFile`` of a zip).

    Called by the operators that run Python on executors; on a cluster the
    package is usually shipped with ``--py-files`` already, and this adds it
    once per SparkContext when it is not.
    """
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="vitrina-pkg-"), "vitrina.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))
