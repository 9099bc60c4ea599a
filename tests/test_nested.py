"""SDMX decoding (M1-M3, F10, F11), array/long-form last-n."""

import json

from pyspark.sql import functions as F

from vitrina.operators import nested as M

MSG = {
    "structure": {"dimensions": {
        "series": [{"id": "FREQ", "values": [{"id": "M", "name": "Monthly"}]},
                   {"id": "REF_AREA", "values": [{"id": "ES", "name": "Spain"}, {"id": "DE", "name": "Germany"}]}],
        "observation": [{"id": "TIME_PERIOD", "values": [{"id": f"2024-{m:02d}", "name": f"2024-{m:02d}"}
                                                         for m in range(1, 12)]}]}},
    "dataSets": [{"series": {
        "0:0": {"observations": {"10": [5.0], "2": [1.5], "1": [2.0, 9.0]}},
        "0:1": {"observations": {"0": [3.0]}},
        "0:7": {"observations": {"0": []}},
        "0:0:4": {"observations": {"0": [1.0]}},
        "0:1:0": {"observations": {}},
    }}],
}


def decoded(spark):
    df = spark.createDataFrame([("STS", True, json.dumps(MSG))], "flow string, has_es boolean, text string")
    msg = df.select("flow", "has_es", M.parse_sdmx("text").alias("msg"))
    return M.decode_series(msg, keep=["flow", "has_es"])


def test_decode_series(spark):
    rows = {r["series_key"]: r for r in decoded(spark).collect()}
    assert "0:1:0" not in rows  # no observations
    a = rows["0:0"]
    assert a["dim_codes"] == ["M", "ES"]
    assert a["dimensions"] == {"FREQ": "M", "REF_AREA": "ES"}
    assert a["name"] == "FREQ=Monthly | REF_AREA=Spain"
    # numeric index order: 1, 2, 10 (not text order)
    assert [(o["period"], o["value"]) for o in a["observations"]] == [("2024-02", 2.0), ("2024-03", 1.5),
                                                                      ("2024-11", 5.0)]
    assert a["last_value"] == 5.0 and a["count"] == 3
    assert rows["0:7"]["dim_codes"] == ["M", "idx7"]  # index beyond the labels
    assert rows["0:7"]["observations"][0]["value"] is None  # empty value list
    extra = rows["0:0:4"]
    assert extra["dim_codes"] == ["M", "ES", "idx4"]
    assert extra["dimensions"]["dim2"] == "idx4"  # more parts than dimensions
    assert extra["dimension_names"] == ["FREQ=Monthly", "REF_AREA=Spain"]  # zip stops at the dimensions


def test_area_filter(spark):
    d = decoded(spark)
    kept = sorted(r["series_key"] for r in M.area_filter(d, "has_es").collect())
    assert kept == ["0:0", "0:0:4"]
    all_ = M.area_filter(d.withColumn("has_es", F.lit(False)), "has_es").count()
    assert all_ == 4


def test_last_n_array(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([],), ([9],)], "a array<int>")
    got = [r["v"] for r in df.select(M.last_n_array("a", 2).alias("v")).collect()]
    assert got == [[3, 4], [], [9]]
    assert [r["v"] for r in df.select(M.last_n_array("a", 0).alias("v")).collect()][0] == [1, 2, 3, 4]


def test_series_long_and_values(spark):
    rows = [("S1", "a", [(1704067200000, 1, 2024, 1.0), (1706745600000, 2, 2024, 2.0), (1709251200000, 3, 2024, 3.0)]),
            ("S2", "b", [(1704067200000, 1, 2024, 7.0)])]
    df = spark.createDataFrame(rows, "COD string, Nombre string, "
                               "Data array<struct<Fecha:bigint,FK_Periodo:int,Anyo:int,Valor:double>>")
    long = M.series_long(df, ["COD"])
    assert [r["fecha"] for r in long.filter("COD = 'S1'").orderBy("pos").collect()] == \
        ["2024-01-01", "2024-02-01", "2024-03-01"]
    long = long.withColumn("t", F.lit("T"))
    out = M.series_values(long, "t", "T", "COD", "fecha", "pos", desde="2024-01-15", max_series=1, max_values=1)
    assert [(r["COD"], r["valor"]) for r in out.collect()] == [("S1", 3.0)]
    # hasta alone is applied
    out2 = M.series_values(long, "t", "T", "COD", "fecha", "pos", hasta="20240101", max_series=5, max_values=0)
    assert sorted(r["valor"] for r in out2.collect()) == [1.0, 7.0]
