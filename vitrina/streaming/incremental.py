"""Incremental refresh.

Batch diffs are joins: ``left_anti`` for new ids, a left join with a
timestamp predicate for changed ones.  "Latest version wins" is a
``max_by`` aggregate per id (partial, skew-safe).  The streaming forms read
new files with the file source and write each micro-batch idempotently; which keys
are stored already is keyed state, so late rows are never lost and a batch costs what it brings.  Their
checkpoints live in the shared folder named by ``spark.checkpoint.dir``, so a
restarted or retried run resumes where it stopped.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.dedupe import row_order


def new_items(df: DataFrame, seen: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Rows whose key is not among the processed ones."""
    keys = [key] if isinstance(key, str) else key
    return df.join(seen.select(*keys).distinct(), on=keys, how="left_anti")


def changed_items(df: DataFrame, state: DataFrame, key: str = "id", ts: str = "lastmod") -> DataFrame:
    """New rows, plus rows whose ``ts`` is later than the stored one.

    ``ts`` is compared as text (ISO stamps sort as text).  The state side is
    reduced to one row per key first, so a key stored many times cannot
    multiply the output.
    """
    st = state.groupBy(key).agg(F.max(ts).alias("_stored"))
    j = df.join(st, key, "left")
    return j.filter(F.col("_stored").isNull() | (F.col(ts) > F.col("_stored"))).drop("_stored")


def update_state(df: DataFrame, by: str = "source", ts: str = "lastmod",
                 state: DataFrame | None = None) -> DataFrame:
    """Progress per source: the greatest ``ts`` seen, merged with the old state (T4).

    Both are aggregated together, so a null source is one source like any other.
    """
    cur = df.groupBy(by).agg(F.max(ts).alias("last"), F.count(F.lit(1)).alias("n"))
    if state is None:
        return cur
    return cur.unionByName(state.select(by, "last", "n")).groupBy(by).agg(F.max("last").alias("last"), F.sum("n").alias("n"))


def upsert_latest(current: DataFrame, incoming: DataFrame, key: str = "id", ts: str = "lastmod") -> DataFrame:
    """Union of the stored table and new rows, latest version per key (T5).

    Ties on ``ts`` go to the incoming row, then to the greatest.  One ``max_by`` per key.
    """
    cols = current.columns
    tag = lambda d, p: d.select(*cols, F.lit(p).alias("_prio"))
    u = tag(current, 0).unionByName(tag(incoming.select(*cols), 1))
    return _latest(u, cols, key, [F.col(ts), F.col("_prio")])


def _drained(stream: DataFrame, add, checkpoint: str, mode: str = "append") -> int:
    """Run a stream over what is there, one ``add(batch, number)`` a micro-batch; how many ran."""
    run: list[int] = []

    def counted(batch: DataFrame, epoch_id: int) -> None:
        add(batch, epoch_id)
        run.append(epoch_id)

    q = (stream.writeStream.outputMode(mode).foreachBatch(counted).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(run)


@contextmanager
def _setting(spark: SparkSession, **values: str):
    """Session settings (``_`` for ``.``) that hold while a stream starts."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


#: The state store that keeps its entries on disk and uploads changes only.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_refresh(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                   checkpoint: str, key: str, event_time: str, fmt: str = "parquet") -> int:
    """Process the files that arrived since the last run, once.

    ``readStream`` over ``source_dir`` sees new files only (its checkpoint
    tracks them).  Which keys were stored before is keyed state of the stream: a
    streaming aggregate holds each key's first arrival, so a batch looks up and
    changes the entries of its own keys and never reads the sink, however large that
    has become.  Of a new key's rows in a batch the earliest stays (ties: the least row); a
    key that arrived in an earlier batch adds nothing, late or not.  Rows without a key all
    stay and take no state.  A micro-batch is written to a folder of its own,
    ``sink_dir/batch=<n>``, which a retry overwrites with the same rows.
    ``trigger(availableNow=True)`` drains what is there and stops, which suits a
    scheduled refresh.  Returns the number of micro-batches run.
    """
    root, names = sink_dir.rstrip("/"), schema.fieldNames()
    rows = spark.readStream.schema(schema).format(fmt).load(source_dir).select(*names)
    keyed = rows.filter(F.col(key).isNotNull())
    first = keyed.withColumn("_arrived", F.current_timestamp()).groupBy(F.col(key).alias("_key")).agg(
        F.min_by(F.struct(*names), F.struct(F.col(event_time).alias("_at"), *[c.alias(f"_{i}") for i, c in enumerate(row_order(keyed))])).alias("_r"),
        F.min("_arrived").alias("_arrived"))
    new = first.filter(F.col("_arrived") == F.current_timestamp())  # constant within a batch
    out = new.select(*[F.col("_r")[c].alias(c) for c in names]).unionByName(rows.filter(F.col(key).isNull()))

    def add(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={epoch_id}")

    with _setting(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB,
                  spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true"):
        return _drained(out, add, checkpoint, "update")


def read_upserted(spark: SparkSession, table_dir: str, schema: T.StructType, key: str, ts: str) -> DataFrame:
    """The table maintained by ``stream_upsert``: the latest version per key, ties to the later batch."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(table_dir)
    return _latest(stored, schema.fieldNames(), key, [F.col(ts), F.col("batch")])


def _latest(df: DataFrame, cols: list[str], key: str, order: list) -> DataFrame:
    """One row per key, the greatest by ``order`` (ties: the greatest row), so reruns agree."""
    rank = [c.alias(f"_o{i}") for i, c in enumerate([*order, *row_order(df.select(*cols))])]
    best = df.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*cols), F.struct(*rank)).alias("_r"))
    return best.select(*[F.col("_r")[c].alias(c) for c in cols])


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, table_dir: str,
                  checkpoint: str, key: str, ts: str, fmt: str = "parquet") -> int:
    """Streaming T5: each micro-batch of new files adds its latest version per key to the table.

    A batch is one folder, ``table_dir/batch=<n>``, written by Spark's own committer and
    overwritten whole by a retry; which batches count is the stream's checkpoint.  Nothing stored is
    read or rewritten: ``read_upserted`` takes the latest version of each key
    with one partial aggregate.  Returns the number of micro-batches run.
    """
    root = table_dir.rstrip("/")

    def add(batch: DataFrame, epoch_id: int) -> None:
        _latest(batch, schema.fieldNames(), key, [F.col(ts)]).write.mode("overwrite").parquet(f"{root}/batch={epoch_id}")

    return _drained(spark.readStream.schema(schema).format(fmt).load(source_dir).select(*schema.fieldNames()), add, checkpoint)
