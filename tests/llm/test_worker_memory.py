"""What Python workers hold beside the executor's heap."""

import pytest

from quipu.llm import common, group_join, packing, secret_scan
from quipu.llm.queries import tokenizer_path


def test_scan_starts_no_python(spark, monkeypatch):
    """An empty ledger by createDataFrame([]) ran Python on every executor, in workers of another kind beside those of the steps."""
    docs = spark.createDataFrame([(1, "password=abcdefgh1234"), (2, None), (3, "plain")], "doc_id long, text string").localCheckpoint()
    expected = spark.createDataFrame([], "a binary, b array<struct<x:int,y:string>>").schema

    def refuse(*_, **__):
        raise AssertionError("rows from Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    empty = common.no_rows(spark, "a binary, b array<struct<x:int,y:string>>")
    assert empty.schema == expected and empty.collect() == []
    found = {r["doc_id"]: [f["kind"] for f in r["findings"]] for r in secret_scan.scan(docs).collect()}
    assert found == {1: ["assign"], 2: [], 3: []}


@pytest.fixture
def held(spark):
    """What each task's worker has kept of hashes and encoders: (most hashes, most encoders)."""

    def count(batches):
        for batch in batches:
            yield batch.assign(hashes=len(group_join._HASHES), encoders=len(packing._ENCODERS))[["hashes", "encoders"]]

    def look():
        rows = common.with_package(spark.range(64).repartition(32)).mapInPandas(count, "hashes long, encoders long").collect()
        return max(r["hashes"] for r in rows), max(r["encoders"] for r in rows)

    return look


def test_workers_hold_no_caches_of_steps_that_are_over(spark, held):
    """Hashes of 200,000 words and the tokenizer's words stayed in every worker while later steps filled the heap."""
    texts = [" ".join(f"w{i}x{k}" for k in range(9)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:3])), "doc_id long, text string")
    assert packing.pieces(docs, tokenizer_path()).count() == 43
    assert {r["component_id"] for r in group_join.near_copies(docs).collect()} == set(range(40))
    assert held()[0] == 0


def test_a_step_leaves_only_what_it_keeps(monkeypatch):
    kept = {"hashes": {b"a": 1}, "encoders": {"path": 1}}
    monkeypatch.setattr(common, "KEPT", kept)

    def step(batches):
        assert kept["hashes"] == {}
        for batch in batches:
            kept["hashes"][batch] = 1
            yield batch

    assert list(common.lean(step, "encoders")(iter([1, 2]))) == [1, 2]
    assert kept == {"hashes": {}, "encoders": {"path": 1}}
    assert list(common.lean(step)(iter([3]))) == [3]
    assert kept == {"hashes": {}, "encoders": {}}

    def fails(batches):
        kept["hashes"][0] = 1
        yield from batches
        raise ValueError("x")

    with pytest.raises(ValueError, match="x"):
        list(common.lean(fails)(iter([1])))
    assert kept["hashes"] == {}


def test_operators_register_what_they_keep():
    assert common.KEPT["hashes"] is group_join._HASHES
    assert common.KEPT["encoders"] is packing._ENCODERS
