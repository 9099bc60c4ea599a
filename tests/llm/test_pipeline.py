"""The pipeline's stages on a small folder, and the registration of all queries."""

import re

import pytest

import __spark_entry__
import corpus_pipeline
from test_jaccard import brute as brute_groups
from test_lines import brute as brute_lines
from test_native import brute_leaks
from vitrina.llm import quality


@pytest.fixture(scope="module")
def folder(docs, spark, corpus, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{d}/documents.parquet")
    # from documents long enough to be kept, without near copies
    long = [t.split() for i, t, *_ in corpus if 12 <= i < 60 and i != 3 and len(t.split()) >= 60][:6]
    items = [(n, " ".join(w[30:50])) for n, w in enumerate(long, 10)]
    spark.createDataFrame([*items, (2, "nothing of this stands anywhere in any of the documents at all")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder, docs):
    d, columns = spark.read.parquet(f"{folder}/documents.parquet"), docs.columns
    kept = {r["doc_id"] for r in quality.quality_rules(d).where("kept").collect()}
    stages = dict(corpus_pipeline.STAGES)
    one = stages["quality_rules"](spark, d, folder)
    rows = [tuple(r) for r in one.collect()]
    assert one.columns == columns and {r[0] for r in rows} == kept
    two = stages["line_dedup"](spark, one, folder)
    gone = {(i, n) for i, n, _ in brute_lines(rows)}
    want = {(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, t, *_ in rows}
    rows = [tuple(r) for r in two.collect()]
    assert two.columns == columns and {(r[0], r[1]) for r in rows} == {x for x in want if x[1].strip()}
    three = stages["near_duplicates"](spark, two, folder)
    want = {i for i, _, c in brute_groups(rows, 5, 80, 100) if i == c}
    rows = [tuple(r) for r in three.collect()]
    assert three.columns == columns and {r[0] for r in rows} == want
    four = stages["benchmark_decontamination"](spark, three, folder)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {i for i, _ in brute_leaks(rows, items)}
    left = {r["doc_id"] for r in four.collect()}
    assert four.columns == columns and bad and left == {r[0] for r in rows} - bad
    five = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in five.collect()} <= left and five.columns == [*columns, "mix_repeats"]


def test_empty_documents(spark, folder, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = [k for k in __spark_entry__.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "benchmark_decontamination", "source_mix"]
