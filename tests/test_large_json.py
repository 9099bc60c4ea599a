"""Large JSON documents cut while they are read."""

import json
import random
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.test_text_index import rows_of
from vitrina.operators import nested as N
from vitrina.sources import large_json as LJ
from vitrina.sources import readers as RD

VALUES = st.recursive(st.none() | st.booleans() | st.floats(allow_nan=False, allow_infinity=False) | st.integers(-10**9, 10**9) | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=8)


def blocks(text, size):
    data = text.encode()
    return lambda: (data[i : i + size] for i in range(0, len(data), size))


def message(n, rng, areas=("ES", "FR")):
    """An SDMX message of ``n`` series, its structure after its data as publishers send it."""
    lists = [{"id": "FREQ", "values": [{"id": "M", "name": "Monthly, \"adjusted\" \\ {[é"}]}, {"id": "REF_AREA", "values": [{"id": a, "name": a} for a in areas]},
             {"id": "ITEM", "values": [{"id": f"I{i}", "name": f"item {i}"} for i in range(max(1, n))]}]
    series = {f"0:{rng.randrange(len(areas))}:{i}": {"attributes": [None, {"a": "]}"}], "observations": {str(k): [round(rng.random(), 3), None] for k in range(3)}} for i in range(n)}
    times = [{"id": f"2024-0{k + 1}", "name": f"2024-0{k + 1}"} for k in range(3)]
    return {"header": {"id": "x"}, "dataSets": [{"action": "Replace", "series": series}, {"series": {}}], "structure": {"name": "s", "dimensions": {"series": lists, "observation": [{"id": "TIME_PERIOD", "values": times}]}}}


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(max_size=5), VALUES, max_size=4), st.lists(VALUES, max_size=6), st.integers(1, 9), st.sampled_from([None, 1]), st.integers(1, 40))
def test_groups_put_together_are_the_document(common, series, size, indent, group):
    common = {k: v for k, v in common.items() if k != "series"}
    text = json.dumps({**common, "flow": "f", "series": series}, indent=indent, ensure_ascii=False).encode("utf-8", "surrogatepass").decode("utf-8", "replace")
    want = json.loads(text)
    got, at = [], 0
    for first, doc in LJ.cut_document(blocks(text, size), "series", group):
        doc = json.loads(doc)
        assert first == at and doc["flow"] == "f"
        got += doc["series"]
        at += len(doc["series"])
    assert got == want["series"]


@pytest.mark.parametrize("text", ["", "{", "[1]", '{"a": 1', '{"series": [1, 2}', '{"series": [1 2]}', '{"a" 1}', '{"series": []} x', '{"series": [{"a": }]}', "not json", '{"a": "open', "[" * 5000, '{"a": ' + "[" * 100_000])
def test_bad_documents(text):
    with pytest.raises(ValueError):
        list(LJ.cut_document(blocks(text, 7), "series"))


def test_memory_does_not_grow_with_the_series():
    def many(n):
        yield b'{"dataSets": [{"series": {'
        for i in range(n):
            yield (b"," if i else b"") + b'"0:0:%d": {"observations": {"0": [%d]}}' % (i, i)
        yield b'}}], "structure": {"dimensions": {"series": []}}}'

    def peak(n):
        tracemalloc.start()
        count = sum(doc.count("observations") for _, doc in LJ.cut_document(lambda: many(n), "sdmx", 50_000))
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert count == n
        return top

    peak(1000)
    assert peak(300_000) < 1.5 * peak(60_000)


def test_large_messages_decode_as_small_ones(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    for name, n in (("BIG", 400), ("SMALL", 2), ("NONE", 0)):
        (tmp_path / f"{name}.json").write_text(json.dumps(message(n, rng), indent=1 if n else None, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "CUT.json").write_text(json.dumps(message(200, rng))[:-400], encoding="utf-8")
    (tmp_path / "BAD.json").write_text("{ no", encoding="utf-8")
    monkeypatch.setattr(LJ.cut_files, "__defaults__", (5_000,))
    flows = lambda df: rows_of(N.decode_series(df, keep=["flow"]).drop("dimensions"))
    whole, cut = (RD.read_sdmx(spark, str(tmp_path), whole=w) for w in (1 << 30, 2_000))
    assert flows(cut) == flows(whole) and len(flows(cut)) == 402
    assert cut.where("flow = 'BIG'").count() > 5 and whole.count() == 3
    names = lambda df: sorted(r["file"].rsplit("/", 1)[1] for r in df.collect())
    assert names(RD.bad_sdmx_files(spark, str(tmp_path), whole=2_000)) == names(RD.bad_sdmx_files(spark, str(tmp_path), whole=1 << 30)) == ["BAD.json", "CUT.json"]


def test_large_series_files(spark, tmp_path, monkeypatch):
    for name, n in (("A", 300), ("B", 3)):
        doc = {"flow": name, "label": f"l {name}", "has_es": True, "series": [{"name": f"s{i}", "dim_codes": ["M"], "observations": [{"period": "2024", "value": i}], "last_value": i, "count": 1} for i in range(n)], "total_series": n}
        (tmp_path / f"{name}.json").write_text(json.dumps(doc), encoding="utf-8")
    monkeypatch.setattr(LJ.cut_files, "__defaults__", (2_000,))
    cut, whole = (RD.read_series(spark, str(tmp_path), whole=w) for w in (1_000, 1 << 30))
    assert rows_of(cut.drop("dimensions")) == rows_of(whole.drop("dimensions"))
    assert [r["position"] for r in cut.where("flow = 'A'").orderBy("position").collect()] == list(range(300))
