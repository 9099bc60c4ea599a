"""Batch diffs, state, upsert and the streaming refresh."""

import uuid

import pytest
from pyspark.sql import functions as F

from vitrina.session import scratch_path
from vitrina.streaming import incremental as I


def test_new_and_changed(spark):
    state = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("b", "2023-01-01")],
                                  "id string, lastmod string")
    cur = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01"), ("c", "2024-01-05")],
                                "id string, lastmod string")
    assert [r["id"] for r in I.new_items(cur, state).collect()] == ["c"]
    assert sorted(r["id"] for r in I.changed_items(cur, state).collect()) == ["b", "c"]


def test_update_state_and_upsert(spark):
    old = I.update_state(spark.createDataFrame([("P", "2024-01-01")], "source string, lastmod string"))
    cur = spark.createDataFrame([("P", "2023-12-01"), ("Q", "2024-03-01")], "source string, lastmod string")
    st = {r["source"]: (r["last"], r["n"]) for r in I.update_state(cur, state=old).collect()}
    assert st == {"P": ("2024-01-01", 2), "Q": ("2024-03-01", 1)}
    stored = spark.createDataFrame([("a", "2024-01-01", "old"), ("b", "2024-01-01", "old")],
                                   "id string, lastmod string, v string")
    inc = spark.createDataFrame([("a", "2024-01-01", "new"), ("c", "2024-02-01", "new"), ("b", "2023-01-01", "new")],
                                "id string, lastmod string, v string")
    got = {r["id"]: r["v"] for r in I.upsert_latest(stored, inc).collect()}
    assert got == {"a": "new", "b": "old", "c": "new"}  # ties go to the incoming row


def test_stream_refresh_processes_only_new_files(spark):
    base = scratch_path(spark, f"t-stream-{uuid.uuid4().hex}")
    schema = "id bigint, ts timestamp_ntz, v string"
    first = spark.createDataFrame([(1, None, "a"), (2, None, "b")], schema) \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    first.write.parquet(f"{base}/in")
    sch = first.schema
    I.stream_refresh(spark, f"{base}/in", sch, f"{base}/out", f"{base}/ckpt", "id", "ts")
    assert spark.read.parquet(f"{base}/out").count() == 2
    second = spark.createDataFrame([(3, None, "c"), (1, None, "a-again")], schema) \
        .withColumn("ts", F.lit("2024-01-01 06:00:00").cast("timestamp_ntz"))
    second.write.mode("append").parquet(f"{base}/in")
    I.stream_refresh(spark, f"{base}/in", sch, f"{base}/out", f"{base}/ckpt", "id", "ts")
    out = sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect())
    assert out == [1, 2, 3]  # old files not re-read; id 1 is stored already


def test_null_source_is_one_source(spark):
    df = spark.createDataFrame([(None, "2024-01-01"), ("P", "2024-01-02")], "source string, lastmod string")
    once = I.update_state(df)
    twice = I.update_state(spark.createDataFrame([(None, "2023-01-01")], df.schema), state=I.update_state(df, state=once))
    assert sorted(map(str, twice.collect())) == sorted(map(str, spark.createDataFrame(
        [(None, "2024-01-01", 3), ("P", "2024-01-02", 2)], "source string, last string, n long").collect()))


def test_stream_upsert_latest_wins(spark):
    base = scratch_path(spark, f"t-upsert-{uuid.uuid4().hex}")
    schema = "id string, lastmod string, v int"
    drops = [[("a", "2024-01-01", 1), ("b", "2024-01-01", 1)], [("a", "2024-02-01", 2), ("b", "2023-01-01", 2), ("c", "2024-01-03", 2)],
             [("a", "2024-02-01", 3), ("c", "2024-01-03", 1), ("c", "2024-01-03", 0)]]
    for rows in drops:
        df = spark.createDataFrame(rows, schema)
        df.write.mode("append").parquet(f"{base}/in")
        assert I.stream_upsert(spark, f"{base}/in", df.schema, f"{base}/t", f"{base}/ck", "id", "lastmod") == 1
    assert I.stream_upsert(spark, f"{base}/in", df.schema, f"{base}/t", f"{base}/ck", "id", "lastmod") == 0
    got = {r["id"]: (r["lastmod"], r["v"]) for r in I.read_upserted(spark, f"{base}/t", df.schema, "id", "lastmod").collect()}
    assert got == {"a": ("2024-02-01", 3), "b": ("2024-01-01", 1), "c": ("2024-01-03", 1)}  # ties: the later batch, then the greater row


def test_stream_refresh_keeps_late_and_keyless_rows(spark):
    base = scratch_path(spark, f"t-late-{uuid.uuid4().hex}")
    schema = "id string, ts timestamp_ntz"
    rows = lambda day, *ids: spark.createDataFrame([(i,) for i in ids], "id string").withColumn("ts", F.lit(f"2024-{day} 00:00:00").cast("timestamp_ntz"))
    sch = rows("02-01", "x").schema
    assert sch.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"
    for day, ids in (("02-01", ("a", None)), ("01-01", ("b", "a", None, "b")), ("01-15", ("c", "b"))):
        rows(day, *ids).write.mode("append").parquet(f"{base}/in")
        I.stream_refresh(spark, f"{base}/in", sch, f"{base}/out", f"{base}/ckpt", "id", "ts")
    got = sorted((r["id"] or "", str(r["ts"])[:10]) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("", "2024-01-01"), ("", "2024-02-01"), ("a", "2024-02-01"), ("b", "2024-01-01"), ("c", "2024-01-15")]


def test_stream_upsert_survives_a_stop(spark, monkeypatch):
    base = scratch_path(spark, f"t-stop-{uuid.uuid4().hex}")
    schema = "id string, lastmod string"
    run = lambda: I.stream_upsert(spark, f"{base}/in", sch, f"{base}/t", f"{base}/ck", "id", "lastmod")
    stored = lambda: {r["id"]: r["lastmod"] for r in I.read_upserted(spark, f"{base}/t", sch, "id", "lastmod").collect()}
    spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01")], schema).write.parquet(f"{base}/in")
    sch = spark.read.parquet(f"{base}/in").schema
    run()
    spark.createDataFrame([("c", "2024-01-03"), ("a", "2024-03-01")], schema).write.mode("append").parquet(f"{base}/in")
    latest = I._latest
    with monkeypatch.context() as m:
        m.setattr(I, "_latest", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(Exception, match="stopped"):
            run()
    assert I._latest is latest and stored() == {"a": "2024-01-01", "b": "2024-01-01"}
    run()
    assert stored() == {"a": "2024-03-01", "b": "2024-01-01", "c": "2024-01-03"}


def test_stream_refresh_retry_writes_the_same_rows(spark):
    """A batch whose folder was written but not committed is run again from the state before it."""
    base = scratch_path(spark, f"t-retry-{uuid.uuid4().hex}")
    make = lambda *rows: spark.createDataFrame(rows, "id string, ts string, v int")
    sch = make(("a", "1", 1)).schema
    run = lambda: I.stream_refresh(spark, f"{base}/in", sch, f"{base}/out", f"{base}/ckpt", "id", "ts")
    make(("a", "1", 1), ("b", "2", 2)).write.parquet(f"{base}/in")
    assert run() == 1
    make(("b", "0", 3), ("c", "5", 5), ("c", "4", 9), ("c", "4", 4)).coalesce(1).write.mode("append").parquet(f"{base}/in")
    assert run() == 1
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/ckpt/commits/1")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.delete(path, False)
    assert run() == 1
    got = sorted((r["id"], r["ts"], r["v"], r["batch"]) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("a", "1", 1, 0), ("b", "2", 2, 0), ("c", "4", 4, 1)]


def test_stream_refresh_never_reads_the_sink(spark):
    base = scratch_path(spark, f"t-sink-{uuid.uuid4().hex}")
    df = spark.createDataFrame([("a", 1)], "id string, ts int")
    run = lambda: I.stream_refresh(spark, f"{base}/in", df.schema, f"{base}/out", f"{base}/ckpt", "id", "ts")
    df.write.parquet(f"{base}/in")
    run()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/out/batch=0")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    df.unionByName(spark.createDataFrame([("b", 1)], df.schema)).write.mode("append").parquet(f"{base}/in")
    run()
    assert [r["id"] for r in spark.read.parquet(f"{base}/out").collect()] == ["b"]
