"""Sources and sinks on small files in a temporary folder."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vitrina import schemas as SC
from vitrina.sources import readers as RD
from vitrina.sources import sinks as SK


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_jsonl_quarantine(spark, tmp_dir):
    write(f"{tmp_dir}/ops/operaciones.jsonl",
          '{"Id": 25, "Cod_IOE": "30138", "Nombre": "IPC", "Codigo": "IPC"}\n\n{not json\n'
          '{"Id": 7, "Nombre": "Otra", "Codigo": ""}\n')
    ok = RD.read_jsonl(spark, f"{tmp_dir}/ops", SC.OPERATION_RAW)
    assert sorted(r["Id"] for r in ok.collect()) == [7, 25]
    bad = RD.quarantined(spark, f"{tmp_dir}/ops", SC.OPERATION_RAW).collect()
    assert len(bad) == 1 and bad[0]["_corrupt_record"] == "{not json"


def test_tables_op_id_from_file_name(spark, tmp_dir):
    write(f"{tmp_dir}/raw/tables_op25.jsonl", '{"Id": 1, "Nombre": "a", "Ultima_Modificacion": 1}\n')
    write(f"{tmp_dir}/raw/tables_op7.jsonl", '{"Id": 2, "Nombre": "b"}\n{"Id": 3, "Nombre": "c"}\n')
    t = RD.read_tables(spark, f"{tmp_dir}/raw/tables_op*.jsonl")
    assert sorted((r["op_id"], r["Id"]) for r in t.collect()) == [(7, 2), (7, 3), (25, 1)]


def test_bundles_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a-1", "---\ntitle: \"x\"\n---\n"), ("b", "línea 1\nlínea 2\n")],
                               "id string, content string")
    rep = SK.write_bundles(df, f"{tmp_dir}/bundles").collect()
    assert sorted(r["id"] for r in rep) == ["a-1", "b"]
    back = {r["id"]: r["content"] for r in RD.read_bundles(spark, f"{tmp_dir}/bundles/*.md").collect()}
    assert back == {r["id"]: r["content"] for r in df.collect()}


def test_bundles_of_any_id_stay_in_their_folder(spark, tmp_dir):
    ids = ["a/b", "../up", "..", ".", ".hidden", "_x", "50%", "a%2Fb", "a\\b", "a+b c", "tab\there", "ñandú"]
    df = spark.createDataFrame([(i, f"of {i}") for i in ids], "id string, content string")
    SK.write_bundles(df, f"{tmp_dir}/b/bundles").collect()
    assert os.listdir(f"{tmp_dir}/b") == ["bundles"]
    assert len([f for f in os.listdir(f"{tmp_dir}/b/bundles") if f.endswith(".md")]) == len(ids)
    assert {r["id"]: r["content"] for r in RD.read_bundles(spark, f"{tmp_dir}/b/bundles/*.md").collect()} == {i: f"of {i}" for i in ids}
    for bad in (None, ""):
        with pytest.raises(Exception, match="a bundle needs an id"):
            SK.write_bundles(spark.createDataFrame([(bad, "x")], "id string, content string"), f"{tmp_dir}/c").collect()


def test_series_files_and_bad_file(spark, tmp_dir):
    doc = {"flow": "STS", "label": "x", "has_es": True, "fetched_at": "", "total_series": 2,
           "series": [{"flow": "STS", "dim_codes": ["M", "ES"], "dimensions": {"REF_AREA": "ES"},
                       "dimension_names": ["FREQ=M"], "name": "b", "observations": [{"period": "2024-01", "value": 1}],
                       "last_value": 1, "count": 1, "fetched_at": ""},
                      {"flow": "STS", "name": "a", "observations": [], "count": 0}]}
    write(f"{tmp_dir}/ecb/STS.json", json.dumps(doc, indent=2))
    write(f"{tmp_dir}/ecb/BAD.json", "{ this is not json")
    s = RD.read_series(spark, f"{tmp_dir}/ecb/*.json")
    assert sorted((r["flow"], r["position"], r["name"]) for r in s.collect()) == [("STS", 0, "b"), ("STS", 1, "a")]
    assert [r["file"].rsplit("/", 1)[-1] for r in RD.bad_series_files(spark, f"{tmp_dir}/ecb/*.json").collect()] \
        == ["BAD.json"]


def test_stat_series(spark, tmp_dir):
    write(f"{tmp_dir}/ine/t.jsonl", '{"COD": "IPC1", "Nombre": "n", "Data": [{"Fecha": 1704067200000, "Valor": 1.5}]}'
                                    '\n[1, 2]\n')
    s = RD.read_stat_series(spark, f"{tmp_dir}/ine")
    assert [(r["COD"], r["Data"][0]["Valor"]) for r in s.collect()] == [("IPC1", 1.5)]


def test_sitemap_namespaced(spark, tmp_dir):
    write(f"{tmp_dir}/sm/sitemap.xml",
          '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'
          '<url><loc>https://p.example/a/</loc><lastmod>2024-01-02T00:00:00+00:00</lastmod></url>\n'
          '<url><loc>https://p.example/b/</loc></url>\n</urlset>\n')
    got = sorted((r["url"], r["lastmod"]) for r in RD.read_sitemap(spark, f"{tmp_dir}/sm").collect())
    assert got == [("https://p.example/a/", "2024-01-02T00:00:00+00:00"), ("https://p.example/b/", "")]


def test_catalog_missing_and_round_trip(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="catalogue not found"):
        RD.load_catalog(spark, f"{tmp_dir}/nope")
    cat = spark.createDataFrame([("a", "S", "Título", "2024", "Inflación", ["t"], "", "report"),
                                 ("b", "S", "Otro", "2025-01", "", [], "", "dataset")],
                                "id string, source string, title string, date_iso string, description string, "
                                "tags array<string>, url string, type string")
    SK.write_catalog(cat, f"{tmp_dir}/cat", partitions=2)
    back = RD.load_catalog(spark, f"{tmp_dir}/cat")
    parts = sorted(p for p in os.listdir(f"{tmp_dir}/cat") if p.endswith(".parquet"))
    ids = [r["id"] for p in parts for r in RD.load_catalog(spark, f"{tmp_dir}/cat/{p}").collect()]
    assert ids == ["b", "a"]  # newest first, in part-file order
    assert back.filter(F.col("id") == "a").first()["text_folded"] == "titulo inflacion"


def test_run_log_and_lines(spark, tmp_dir):
    cat = spark.createDataFrame([("a", "S1"), ("b", "S2"), ("c", "S1")], "id string, source string")
    SK.append_run_log(cat, f"{tmp_dir}/log", "refresh")
    SK.append_run_log(cat, f"{tmp_dir}/log", "refresh")
    rows = spark.read.schema(SC.RUN_LOG).parquet(f"{tmp_dir}/log").collect()
    assert [r["detail"] for r in rows] == ["3 items (S1: 2, S2: 1)"] * 2
    lines = spark.createDataFrame([("b", 1, "2", "y"), ("a", 0, "", "x"), ("b", 0, "", "h")],
                                  "k1 string, k2 bigint, k3 string, line string")
    SK.write_lines(lines, f"{tmp_dir}/idx", partitions=2)
    parts = sorted(p for p in os.listdir(f"{tmp_dir}/idx") if p.startswith("part-"))
    text = "".join(open(f"{tmp_dir}/idx/{p}", encoding="utf-8").read() for p in parts)
    assert text == "x\nh\ny\n"


def test_ref_tables(spark):
    assert RD.ref_table(spark, "key_operations").count() == 25
    assert RD.ref_table(spark, "high_value_datasets").count() == 17
    assert RD.ref_table(spark, "flow_labels").count() == 7
    assert RD.ref_table(spark, "system_pages").count() == 6


def test_write_partitioned_splits_hot_key(spark, tmp_dir):
    rows = [(1, i) for i in range(2500)] + [(2, 1), (3, 2)]
    df = spark.createDataFrame(rows, "op_id bigint, Id bigint").repartition(4)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "4k")  # tiny advisory size so the hot key counts as skewed here
    try:
        SK.write_partitioned(df, f"{tmp_dir}/t", "op_id", "json", rows_per_file=100_000)
    finally:
        spark.conf.set(key, old)
    files = {k: [f for f in os.listdir(f"{tmp_dir}/t/op_id={k}") if f.startswith("part-")] for k in (1, 2, 3)}
    assert len(files[2]) == 1 and len(files[3]) == 1
    assert len(files[1]) > 1  # the hot key is split over several tasks
    back = RD.read_tables(spark, f"{tmp_dir}/t")
    assert back.count() == len(rows) and back.filter("op_id = 1").count() == 2500


def test_many_bundles_in_one_listing_and_few_tasks(spark, tmp_dir):
    n = 16 * RD.BUNDLE_TASKS
    SK.write_bundles(spark.range(n).selectExpr("concat('b', id) AS id", "concat('of ', id) AS content"), f"{tmp_dir}/many").collect()
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "512m")  # every file a partition of its own, as thousands of them have
    try:
        df = RD.read_bundles(spark, f"{tmp_dir}/many/*.md")
        assert df.rdd.getNumPartitions() <= RD.BUNDLE_TASKS * spark.sparkContext.defaultParallelism
        assert df._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location().rootPaths().size() == 1
        assert {r["id"]: r["content"] for r in df.collect()} == {f"b{i}": f"of {i}" for i in range(n)}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_bundles_are_listed_and_read_without_the_driver(spark, tmp_dir):
    root = f"{tmp_dir}/a folder"
    os.makedirs(f"{root}/sub.md")
    bytes_of = {"a.md": b"\xef\xbb\xbfa\r\n", "b+c%2Fd e.md": b"\xff\xfe\n", "\u00e9.md": b"x" * 5_000_000, "empty.md": b"", ".h.md": b"x", "_h.md": b"x", "_k=v.md": b"x", "c.txt": b"x", "sub.md/d.md": b"x"}
    for name, data in bytes_of.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    df = RD.read_bundles(spark, f"{root}/*.md")
    whole = spark.read.option("pathGlobFilter", "*.md").text(root, wholetext=True)  # Spark's own reader of the same folder
    got = df.selectExpr("id", "hex(cast(content AS binary)) AS h").collect()
    assert sorted(r["h"] for r in got) == sorted(r["h"] for r in whole.selectExpr("hex(cast(value AS binary)) AS h").collect())
    assert {r["id"]: r["h"] for r in got} == {"a": bytes_of["a.md"].hex().upper(), "b+c/d e": "FFFE0A", "_k=v": "78", "\u00e9": "78" * 5_000_000}
    listed = df._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location()
    assert listed.inputFiles().__len__() <= 2  # the table of names; the files themselves are not among the driver's
    assert {r["id"] for r in RD.read_bundles(spark, f"{root}/[!b].md").collect()} == {"a", "\u00e9"}
    assert RD.read_bundles(spark, f"{root}/no*.md").count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        RD.read_bundles(spark, f"{tmp_dir}/none/*.md")
    os.makedirs(f"{tmp_dir}/parts/k=1")
    with open(f"{tmp_dir}/parts/k=1/c.md", "w") as f:
        f.write("x")
    assert [tuple(r) for r in RD.read_bundles(spark, f"{tmp_dir}/parts/*.md").collect()] == [("c", "x")]
