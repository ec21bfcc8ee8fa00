"""Folders written once, the refreshed index, and the chained run that is stopped at every step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import balances
from quipu import default_config
from quipu.operators import index_store, ingest
from quipu.operators.search import embed_by_hashing
from quipu.plans import calendar
from quipu.sources.files import read_documents, read_report_csv
from quipu.sources.folders import exists, mark_once, names, put_once
from quipu.sources.snapshots import read_ledger, write_ledger

CONFIG = default_config()
TEXT = "id string, texto string, dominio string, corte string, categoria_bloque string, tipo_registro string, es_futuro boolean, seccion string, concepto string, valor decimal(28,2)"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, d, "2026-04", None, None, False, None, None, None) for i, t, d in rows], TEXT)


def test_folders_are_put_once(spark, tmp_path):
    path = str(tmp_path / "x")
    assert names(spark, path) == [] and not exists(spark, path)
    assert put_once(spark.range(3), path, "a=1") and not put_once(spark.range(5), path, "a=1")
    assert spark.read.parquet(f"{path}/a=1").count() == 3
    # A writer that is beaten to the name leaves nothing.
    from quipu.sources import folders

    spark.range(7).write.parquet(f"{path}/_draft")
    assert not folders.move_once(spark, f"{path}/_draft", f"{path}/a=1") and not exists(spark, f"{path}/_draft")
    assert spark.read.parquet(path).count() == 3
    assert mark_once(spark, f"{path}/done") and not mark_once(spark, f"{path}/done")


def test_index_embeds_only_what_changed(spark, tmp_path):
    path, seen = str(tmp_path / "index"), []

    def embed(rows):
        seen.append(sorted(r["key"] for r in rows.collect()))
        return embed_by_hashing(rows, dimension=8)

    assert index_store.read_index(spark, path) is None
    first = [(f"d{i}", f"text {i}", "CASA") for i in range(120)] + [("none", None, "CASA"), ("same", "text 5", "CASA")]
    assert index_store.refresh(docs(spark, *first).repartition(1), path, embed)
    second = [("d0", "other", "CASA"), ("d1", "text 1", "AHORRO"), *first[3:], ("new", "text 5", "CASA")]  # d2 is gone
    index_store.refresh(docs(spark, *second), path, embed)
    assert seen[1] == ["d0", "new"]
    rows = {r["key"]: r for r in index_store.read_index(spark, path).collect()}
    assert len(rows) == 122 and "d2" not in rows
    assert [(rows[k]["vector_de"], rows[k]["lote"], rows[k]["metadata"]["dominio"]) for k in ("d0", "d1", "d3", "new")] == [
        (1, 1, "CASA"), (0, 1, "AHORRO"), (0, 0, "CASA"), (1, 1, "CASA")]
    assert rows["d5"]["embedding"] == rows["new"]["embedding"] == rows["same"]["embedding"]
    told = {c["key"]: c for r in index_store.loads(spark, path, 1).collect() for c in r["cambios"]}
    assert sorted(told) == ["d0", "d1", "d2", "new"] and told["d2"]["borrado"] and told["d2"]["embedding"] is None and told["d1"]["embedding"]
    sizes = sorted(len(r["cambios"]) for r in index_store.loads(spark, path, 0).collect())
    assert sum(sizes) == 122 and max(sizes) <= 50 and len(sizes) == 3
    # Again the same, then all back: a tombstone is not the end of a key.
    index_store.refresh(docs(spark, *second), path, embed)
    assert seen[2] == [] and spark.read.parquet(f"{path}/lote=2").count() == 0
    index_store.refresh(docs(spark, *first), path, embed)
    assert seen[3] == ["d0", "d2"] and index_store.read_index(spark, path).count() == 122
    assert not index_store.refresh(docs(spark, *second), path, embed, number=3)
    index_store.refresh(docs(spark), path, embed)
    assert index_store.read_index(spark, path).count() == 0


def test_a_repeated_append_changes_nothing(spark, tmp_path):
    ddl = "trx_id string, dominio string, corte string, valor long"
    rows = spark.createDataFrame([("a", "CASA", "2026-04", 1), ("b", "CASA", "2026-05", 2), ("a", "CASA", "2026-04", 1)], ddl)
    path = str(tmp_path / "t")
    assert ingest.read_appended(spark, path, rows.schema).count() == 0
    assert [ingest.append_once(rows, path, w) for w in ("lote-1", "lote-1", "lote-2")] == [True, False, True]
    found = ingest.read_appended(spark, path, rows.schema)
    assert found.count() == 4 and {r["corte"] for r in found.collect()} == {"2026-04", "2026-05"}
    raw = spark.createDataFrame([('{"id":"x","detail":{}}',), ('{"id":""}',), ('{"detail":1}',), ('{"detail":1}',)], "raw string")
    ids = [r[0] for r in raw.select(ingest.event_identity(F.col("raw"), "cuenta")).collect()]
    assert ids[0] == "cuenta-x" and ids[2] == ids[3] != ids[1] and len(ids[1]) == 64 + 7


class Stopped(Exception):
    pass


ROWS = [
    ("CASA", "2026-04", "CUENTA#SERVICIOS#BDO", 500), ("CASA", "2026-04", "GASTO#SERVICIOS", 900), ("CASA", "2026-05", "GASTO#SALUD", 100),
    ("PERSONAL", "2026-04", "CUENTA#SALUD#NEQUI", -70), ("PERSONAL", "2026-04", "GASTO#DEUDA A CASA", 40),
]


def outcome(spark, root):
    ledger = balances(read_ledger(spark, f"{root}/ledger"))
    report = sorted(map(str, read_report_csv(spark, f"{root}/reports").collect()))
    texts = sorted(map(str, read_documents(spark, f"{root}/rag").collect()))
    index = sorted((r["key"], r["huella"]) for r in index_store.read_index(spark, f"{root}/index").collect())
    return ledger, report, texts, index


def test_a_stopped_run_goes_on(spark, ledger, tmp_path):
    def job(root, as_of=dt.date(2026, 5, 1)):
        return calendar.Run(spark, CONFIG, str(root), as_of, 1, lambda rows: embed_by_hashing(rows, dimension=16))

    with pytest.raises(ValueError, match="no ledger"):
        calendar.run_calendar(job(tmp_path / "none"))
    whole = tmp_path / "whole"
    write_ledger(ledger(*ROWS), f"{whole}/ledger")
    every = [name for name, _, _ in calendar.STEPS]
    assert calendar.run_calendar(job(whole)) == every and calendar.run_calendar(job(whole)) == []
    expected = outcome(spark, whole)
    assert ("CASA", "2026-05", "CUENTA#SALDO_INICIAL#BDO") in expected[0] and not any(m == "2026-04" for _, m, _ in expected[0])
    # Stopped after the work of every step, before its marker.
    root = tmp_path / "stopped"
    write_ledger(ledger(*ROWS), f"{root}/ledger")
    for k in range(len(every)):

        def stop(run, work=calendar.STEPS[k][2]):
            work(run)
            raise Stopped

        steps = [s if n != k else (*s[:2], stop) for n, s in enumerate(calendar.STEPS)]
        with pytest.raises(Stopped):
            calendar.run_calendar(job(root), steps)
        assert sorted(p.name for p in root.glob("corridas/*/*.hecho")) == sorted(f"{n}.hecho" for n in every[:k])
    assert calendar.run_calendar(job(root)) == every[-1:]
    assert outcome(spark, root) == expected
    # The next day only the day's part is due.
    assert calendar.run_calendar(job(root, dt.date(2026, 5, 2))) == every[3:]
    assert outcome(spark, root)[0] == expected[0]


def test_new_files_are_indexed(spark, tmp_path):
    import json
    from urllib.parse import quote

    from quipu.plans.jobs import index_new_files, refresh_index

    path, base = str(tmp_path / "index"), tmp_path / "files"
    embed = lambda rows: embed_by_hashing(rows, dimension=8)
    refresh_index(docs(spark, ("a", "one", "CASA"), ("b", "two", "CASA")), path, embed)
    for name, rows in (("rag/año 1.json", [("b", "other"), ("c", "three")]), ("rag/2.json", [("d", "four")])):
        file = base / "cubo" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("\n".join(json.dumps({"id": i, "texto": t, "dominio": "CASA", "es_futuro": False}) for i, t in rows))
    told = [
        {"Records": [{"s3": {"bucket": {"name": "cubo"}, "object": {"key": quote("rag/año 1.json")}}}]}, {"bucket": "cubo", "key": "rag/2.json"},
        {"bucket": "cubo", "key": "rag/2.json"}, {"bucket": "cubo"}, {},
    ]
    raw = spark.createDataFrame([(json.dumps(t),) for t in told], "raw string")
    assert index_new_files(raw, str(base), path, embed) == ["cubo/rag/2.json", "cubo/rag/año 1.json"]
    rows = {r["key"]: r["vector_de"] for r in index_store.read_index(spark, path).collect()}
    assert rows == {"a": 0, "b": 1, "c": 1, "d": 1}
    assert index_new_files(raw.limit(0), str(base), path, embed) == []


def test_a_refresh_shuffles_no_unchanged_text(spark, tmp_path):
    """Only prints meet the stored index; what differs is counted, and a few rows are broadcast to the texts."""
    fields = "id string, texto string, dominio string, corte string, categoria_bloque string, tipo_registro string, es_futuro boolean, seccion string, concepto string, valor long"
    rows = lambda *pairs: spark.createDataFrame([(k, text, domain, *[None] * 7) for k, text, domain in pairs], fields)
    path, embed = str(tmp_path / "index"), lambda found: embed_by_hashing(found, dimension=8)
    first = [("a", "uno", "CASA"), ("b", "dos", "CASA"), ("c", "tres", "CASA"), (None, "nada", "CASA")]
    index_store.refresh(rows(*first), path, embed)
    later = rows(("a", "uno", "CASA"), ("b", "otro", "CASA"), ("c", "tres", "AHORRO"), (None, "nada", "CASA"))
    differ = index_store.differing(later, path)
    assert "texto" not in differ.columns and {(r["key"], r["_nuevo"]) for r in differ.collect()} == {("b", True), ("c", False), (None, True)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        added = index_store.changes(later, path, 1, embed, whole=False, differ=differ, few=True)
        plan = added._jdf.queryExecution().explainString(added.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        joins = [line for line in plan.splitlines() if "LeftSemi" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
        assert {(r["key"], r["vector_de"]) for r in added.collect()} == {("b", 1), ("c", 0), (None, 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
