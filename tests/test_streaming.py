import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from conftest import balances
from quipu import default_config
from quipu.operators import ingest
from quipu.operators.ledger import consolidate
from quipu.plans import stream_queries
from quipu.schema import CHANGE, KEY
from quipu.sources.changes import decode_changes, read_changes, stream_changes, undecodable
from quipu.sources.orders import change_records
from quipu.sources.snapshots import last_batch, read_ledger
from quipu.streaming.jobs import apply_batch, ingest_stream, ledger_stream, message_stream, outbox_stream
from test_ledger import as_book, frame, random_rows
from walk import walk

CONFIG = default_config()


def arn(table):
    return f"arn:aws:dynamodb:r:1:table/{table}/stream/x"


ACCOUNTS, CARDS = arn("HistoriaCuentasAltoRendimiento_modules_IAC"), arn("HistorialTarjetas_modules_IAC")


def image(**fields):
    return {k: {"N": str(v)} if isinstance(v, int) else v if isinstance(v, dict) else {"S": v} for k, v in fields.items()}


def change(event, source, new, old=None, event_id=None):
    body = {"NewImage": new} if new is not None else {}
    if old is not None:
        body["OldImage"] = old
    return {"eventID": event_id, "eventName": event, "eventSourceARN": source, "dynamodb": body}


def write(path, records):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir())):04d}.json").write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


BASE = dict(trx_id="t", created_at="2026-04-01T00:00:00", dominioFinanciero="CASA", corte="2026-04", descripcion="salud", cuenta="bdo", valor=100)


def test_decode(spark, tmp_path):
    path = write(
        tmp_path / "c",
        [
            change("INSERT", ACCOUNTS, image(**BASE, cuentaDestino="kubo", nota={"NULL": True}), event_id="1"),
            change("REMOVE", ACCOUNTS, None, event_id="2"),
            change("INSERT", arn("Otra"), image(**BASE), event_id="3"),
            change("INSERT", ACCOUNTS, None, event_id="4"),
            change("INSERT", CARDS, image(**{**BASE, "franquicia": "visa"}), event_id="5"),
            change("INSERT", ACCOUNTS, image(**{**BASE, "valor": "abc"}), event_id="6"),
            change("INSERT", ACCOUNTS, image(**{**BASE, "valor": {"BOOL": True}}), event_id="7"),
            change("INSERT", arn("ConceptosFijosPersonal_modules_IAC"), image(**{**BASE, "concepto": "aporte"}), event_id="8"),
        ],
    )
    rows = {r["event_id"]: r for r in decode_changes(read_changes(spark, path)).collect()}
    assert sorted(rows) == ["1", "5", "8"]
    assert (rows["1"]["origen"], rows["1"]["cuenta_destino"], rows["1"]["concepto"], rows["1"]["tipo"]) == ("BDO", "KUBO", "SALUD", "CUENTA")
    assert (rows["5"]["origen"], rows["5"]["tipo"]) == ("VISA", "TARJETA")
    assert (rows["8"]["origen"], rows["8"]["concepto"], rows["8"]["bloque"]) == (None, "APORTE", "PROYECCION")
    assert sorted(r["event_id"] for r in undecodable(read_changes(spark, path)).collect()) == ["6", "7"]


def test_modifications(spark, tmp_path):
    path = write(tmp_path / "c", [change("MODIFY", ACCOUNTS, image(**{**BASE, "valor": 150}), image(**BASE))])
    changes = read_changes(spark, path)
    assert int(decode_changes(changes).first()["valor"]) == 150
    assert int(decode_changes(changes, "delta").first()["valor"]) == 50
    with pytest.raises(ValueError):
        decode_changes(changes, "other")


def test_micro_batches_equal_one_batch(spark, tmp_path):
    rows = random_rows(11, 300)
    root, state, checkpoint = tmp_path / "changes", str(tmp_path / "state"), str(tmp_path / "checkpoint")
    for part in (rows[:70], rows[70:200], rows[200:]):
        change_records(frame(spark, part)).coalesce(1).write.mode("append").json(str(root))
        ledger_stream(stream_changes(spark, str(root)), CONFIG, state, checkpoint, cents=True).awaitTermination()
    assert last_batch(spark, f"{state}/ledger") == 2
    assert as_book(read_ledger(spark, f"{state}/ledger")) == walk(rows, CONFIG)


def test_repeated_batches_and_events(spark, movement, tmp_path):
    state = str(tmp_path)
    rows = movement({"valor": 10}, {"valor": 5}).withColumn("event_id", F.col("trx_id").cast("string"))
    apply_batch(rows, 0, CONFIG, state)
    apply_batch(rows, 0, CONFIG, state)
    key = ("CASA", "2026-04", "CUENTA#SERVICIOS#BDO")
    assert balances(read_ledger(spark, f"{state}/ledger")) == {key: 15}
    # The same events again in a later batch, twice, with a new one.
    later = rows.unionByName(rows).unionByName(rows.filter("valor = 5").withColumn("event_id", F.lit("new")))
    apply_batch(later, 1, CONFIG, state)
    assert balances(read_ledger(spark, f"{state}/ledger")) == {key: 20}
    apply_batch(rows, 2, CONFIG, state, deduplicate=False)
    assert balances(read_ledger(spark, f"{state}/ledger")) == {key: 35}


def test_a_batch_that_failed_before_its_commit_is_applied_once(spark, movement, tmp_path):
    state = str(tmp_path)
    rows = movement({"valor": 10}).withColumn("event_id", F.lit("a"))
    apply_batch(rows, 0, CONFIG, state)
    more = movement({"valor": 7}).withColumn("event_id", F.lit("b"))
    # The ids of batch 1 were written, its ledger version was not.
    more.select("event_id", "corte").write.partitionBy("corte").parquet(f"{state}/event_ids/lote=1")
    apply_batch(more, 1, CONFIG, state)
    assert balances(read_ledger(spark, f"{state}/ledger")) == {("CASA", "2026-04", "CUENTA#SERVICIOS#BDO"): 17}


def test_ingest_and_outbox_streams(spark, tmp_path):
    good = {"Cuenta": "BDO", "Descripcion": "SALUD", "Valor": 5, "FechaMovimiento": "2026-03-15", "Corte": "2026-03", "DominioFinanciero": "CASA"}
    def message(payload, kind="movimiento.general.registrado"):
        return {"detail_type": kind, "raw": json.dumps({"detail": {"payload": payload, "metadata": {"user_id": "u", "channel_id": "c"}}})}
    root, out = tmp_path / "messages", str(tmp_path / "out")
    write(root, [message(good), message(good), message({**good, "Cuenta": "X"}), message(good, "proyeccion.registrado")])
    for _ in range(2):
        ingest_stream(message_stream(spark, str(root)), ingest.ACCOUNT, CONFIG, out, str(tmp_path / "cp")).awaitTermination()
    taken = spark.read.parquet(f"{out}/cuenta").collect()
    assert len(taken) == 2 and len({r["trx_id"] for r in taken}) == 2
    assert [r["reject_reason"] for r in spark.read.parquet(f"{out}/quarantine_cuenta").collect()] == [ingest.BAD_ACCOUNT]
    outbox = spark.read.parquet(f"{out}/outbox_cuenta")
    assert {json.loads(r["detail"])["trx_id"] for r in outbox.collect()} == {r["trx_id"] for r in taken}
    events = spark.readStream.schema("detail_type string, detail string, lote int").parquet(f"{out}/outbox_cuenta")
    outbox_stream(events, str(tmp_path / "sent"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sent")).count() == 2


def test_decoded_changes_fold_like_movements(spark):
    movements = frame(spark, random_rows(12, 200))
    decoded = decode_changes(change_records(movements)).withColumn("valor", F.col("valor").cast("bigint"))
    assert sorted(map(str, consolidate(decoded, CONFIG).select(*KEY, "valor").collect())) == sorted(
        map(str, consolidate(movements, CONFIG).select(*KEY, "valor").collect())
    )


def test_no_record_is_lost(spark, tmp_path):
    odd = dict(BASE, trx_id="o", descripcion="odd")
    amounts = {"a": "1.005", "b": "12345678901234567.25", "c": "0.0000001", "d": "1e30", "e": "abc", "f": "NaN"}
    root = tmp_path / "c"
    write(root, [change("INSERT", ACCOUNTS, image(**{**BASE, "trx_id": k, "valor": v}), event_id=k) for k, v in amounts.items()])
    write(root, [change("INSERT", ACCOUNTS, image(**{k: v for k, v in odd.items() if k != "descripcion"}), event_id="g")])
    write(root, [change("INSERT", ACCOUNTS, image(**BASE), event_id="a"), change("REMOVE", ACCOUNTS, None, event_id="x")])
    state = str(tmp_path / "s")
    ledger_stream(stream_changes(spark, str(root)), CONFIG, state, str(tmp_path / "k")).awaitTermination()
    held = {r["event_id"]: r["motivo"] for r in spark.read.parquet(f"{state}/quarantine").collect()}
    assert held == {"c": "VALOR_FUERA_DE_RANGO", "d": "VALOR_FUERA_DE_RANGO", "e": "VALOR_NO_NUMERICO", "f": "VALOR_FUERA_DE_RANGO", "g": "FALTA_CONCEPTO"}
    assert spark.read.parquet(f"{state}/conteos").drop("lote").first() == (8, 1, 5, 2)
    total = sum(r["valor"] for r in read_ledger(spark, f"{state}/ledger").collect() if r["tipo"] == "CUENTA")
    assert str(total) in ("12345678901234568.255000", "12345678901234667.250000")
    more = change("INSERT", ACCOUNTS, image(**{**BASE, "trx_id": "z", "valor": "0.5"}), event_id="z")
    write(root, [more])
    ledger_stream(stream_changes(spark, str(root)), CONFIG, state, str(tmp_path / "k")).awaitTermination()
    again = sum(r["valor"] for r in read_ledger(spark, f"{state}/ledger").collect() if r["tipo"] == "CUENTA")
    assert str(again - total) == "0.500000"


def test_unknown_operations_are_held(spark, movement, tmp_path):
    rules = [{**r, "acciones": [{**a, "operacion": "NUEVA"} for a in r["acciones"]]} for r in CONFIG.rules]
    odd = dataclasses.replace(CONFIG, rules=rules)
    rows = movement({"valor": -5}, {"tipo": "GASTO", "valor": 3}).withColumn("event_id", F.col("trx_id").cast("string"))
    apply_batch(rows, 0, odd, str(tmp_path))
    held = spark.read.parquet(f"{tmp_path}/quarantine").collect()
    assert [r["motivo"] for r in held] == ["OPERACION_NO_SOPORTADA"]
    assert spark.read.parquet(f"{tmp_path}/conteos").drop("lote").first() == (2, 0, 1, 1)


@pytest.mark.parametrize("modify", ["readd", "delta"])
def test_insert_and_modify_of_one_movement_keep_their_order(spark, tmp_path, modify):
    """A projection that a negative account movement lowers and its modification raises: the sequence decides, not chance."""
    first = change("INSERT", ACCOUNTS, image(**{**BASE, "valor": -8}), event_id="b")
    second = change("MODIFY", ACCOUNTS, image(**{**BASE, "valor": -3}), image(**{**BASE, "valor": -8}), event_id="a")
    for n, record in ((1, first), (2, second)):
        record["dynamodb"]["SequenceNumber"] = str(n)
    found = set()
    for k, order in enumerate(([first, second], [second, first])):
        path = write(tmp_path / f"c{k}", order)
        rows = decode_changes(read_changes(spark, path), modify)
        assert [r["event_id"] for r in rows.orderBy("seq").collect()] == ["b", "a"]
        book = consolidate(rows.drop("event_id"), CONFIG).select(*KEY, "valor")
        found.add(tuple(sorted(map(str, book.collect()))))
    assert len(found) == 1


def write_orders(spark, path, n=120):
    """A small table of orders over four years in one file."""
    k = F.col("id")
    priority = F.element_at(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))), (k % 5 + 1).cast("int"))
    day = F.timestamp_seconds(F.lit(788_918_400) + k * 86_400 * 11)
    rows = spark.range(n).select(k.alias("o_orderkey"), (k * 7 % 13).alias("o_custkey"), (k * 3.5 + 1).alias("o_totalprice"), day.alias("o_orderdate"), priority.alias("o_orderpriority"))
    rows.coalesce(1).write.parquet(f"{path}/orders.parquet")
    return str(path)


@pytest.mark.parametrize("query, name, batches", [("change_modify", "change-modify", 4), ("stream_horizon", "stream-horizon", 3)])
def test_no_task_writes_a_whole_batch(spark, tmp_path, monkeypatch, query, name, batches):
    monkeypatch.setattr(stream_queries, "run_folder", lambda *_: f"{tmp_path}/{name}")
    folder = write_orders(spark, tmp_path / "in")
    found = getattr(stream_queries, query)(spark, folder).collect()
    assert found and len(list((tmp_path / name / "changes").glob("*.json"))) > 2 * batches


def test_messages_and_changes_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "run_folder", lambda _, name: f"{tmp_path}/{name}")
    folder = write_orders(spark, tmp_path / "in")
    for query, written, files in ((stream_queries.stream_ingest, "stream-ingest/messages", 3), (stream_queries.stream_ledger, "stream-ledger/changes", 4)):
        assert query(spark, folder).count() > 0
        assert len(list((tmp_path / written).glob("*.json"))) > 2 * files


def test_a_batch_of_changes_goes_once_both_streams_have_it(spark, tmp_path, monkeypatch):
    root, plain, held = f"{tmp_path}/change-modify", stream_queries.balance_stream, []
    monkeypatch.setattr(stream_queries, "run_folder", lambda *_: root)

    def watched(changes, config, path, *args, modify, **options):
        assert options["unload"]
        held.append((modify, read_changes(spark, f"{root}/changes").collect()))
        return plain(changes, config, path, *args, modify=modify, **options)

    monkeypatch.setattr(stream_queries, "balance_stream", watched)
    found = stream_queries.change_modify(spark, write_orders(spark, tmp_path / "in")).collect()
    for modify in ("readd", "delta"):
        batches = [rows for of, rows in held if of == modify]
        ids = [r["eventID"] for rows in batches for r in rows]
        assert len(batches) == 4 and all(batches) and len(ids) == len(set(ids))
        every = spark.createDataFrame([r for rows in batches for r in rows], CHANGE)
        book = consolidate(decode_changes(every, modify).drop("event_id"), CONFIG).select(*KEY, "valor").collect()
        assert sorted(map(str, [(*r[:-1], int(r[-1])) for r in book])) == sorted(str((*[r[c] for c in KEY], r["valor"])) for r in found if r["modo"] == modify)


def test_messages_are_not_cached(spark, tmp_path, monkeypatch):
    root, plain, cached = f"{tmp_path}/stream-postings", stream_queries.ingest_stream, []
    monkeypatch.setattr(stream_queries, "run_folder", lambda *_: root)
    ours = set(spark.sparkContext._jsc.getPersistentRDDs())

    def watched(*args, **options):
        cached.append(set(spark.sparkContext._jsc.getPersistentRDDs()) - ours)
        return plain(*args, **options)

    monkeypatch.setattr(stream_queries, "ingest_stream", watched)
    assert stream_queries.stream_postings(spark, write_orders(spark, tmp_path / "in")).count() > 0
    assert cached[0] == set()
    sent = spark.read.json(f"{root}/messages").groupBy("detail_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("raw").alias("each"))
    assert sorted((r["n"], r["each"]) for r in sent.collect()) == [(120, 120), (120, 120), (240, 120)]
