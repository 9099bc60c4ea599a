"""Driver contract: entry() runs, every oracle key is a query, columns line up."""

import re

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "n", "first_id"]
    assert df.count() > 0


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80
    from vitrina.plans import registry
    for name in registry.QUERIES:
        assert not re.match(r"op\d+_", name) and "pipeline" not in name


def test_sample_query_columns_match_oracle(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    from vitrina.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ["search_multi", "count_by_source", "sdmx_decode", "fanout_report"]:
        s = E.queries()[name](spark, sf)
        d = con.execute(E.oracle_sql()[name])
        assert sorted(s.columns) == sorted(c[0] for c in d.description), name
