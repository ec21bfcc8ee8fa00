"""Balances in the state store, chunks of steps, and ledger versions by month."""

import dataclasses
import datetime as dt
import json
import pickle
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import balances
from quipu import default_config
from quipu.operators import chunks
from quipu.operators.ledger import consolidate
from quipu.plans.jobs import drop_months, monthly_close
from quipu.sources import snapshots
from quipu.sources.changes import stream_changes
from quipu.sources.orders import change_records
from quipu.sources.snapshots import latest, read_ledger, write_ledger
from quipu.streaming import balances as stream
from quipu.streaming.balances import Steps, balance_stream, packed_steps, partial_sums, read_balances, read_state, refused_stream
from quipu.streaming.jobs import apply_batch
from test_ledger import as_book, frame, random_rows
from test_streaming import ACCOUNTS, BASE, change, image, write
from walk import walk

CONFIG = default_config()


def literal(steps, start):
    """Balances after each step and the place of the last one that writes."""
    now, out, last = start, [], None
    for k, (x, limited, by_rule) in enumerate(steps):
        then = max(now + x, 0) if limited else now + x
        if not by_rule or then != now:
            last = k
        now = then
        out.append(now)
    return out, last


steps_of = st.lists(st.tuples(st.integers(-50, 50), st.booleans(), st.booleans()), min_size=1, max_size=30)


@settings(max_examples=150, deadline=None)
@given(steps_of, st.integers(-30, 60), st.integers(1, 29))
def test_chunks_compose_like_a_walk(steps, start, cut):
    # Only decrements are limited, and only by a rule.
    steps = [(-abs(x) if limited else x, limited, limited or by_rule) for x, limited, by_rule in steps]
    deltas, limited, by_rule = (np.asarray(c) for c in zip(*steps, strict=True))
    for scale in (1, 10**18):
        x = chunks.as_array([int(d) * scale for d in deltas])
        out, last = literal([(int(d) * scale, a, b) for d, (_, a, b) in zip(deltas, steps, strict=True)], start * scale)
        assert chunks.balances(x, limited, start * scale).tolist() == out
        assert chunks.last_write(x, limited, by_rule, start * scale) == last
        now = start * scale
        for part in (slice(0, cut), slice(cut, None)):
            if len(x[part]):
                now = chunks.after(now, *chunks.summary(x[part], limited[part]))
        assert now == out[-1]


def run(spark, root, state, config=CONFIG, **options):
    balance_stream(stream_changes(spark, str(root)), config, f"{state}/saldos", f"{state}/cp", **options).awaitTermination()
    return as_book(read_balances(spark, f"{state}/saldos"))


@pytest.mark.parametrize("order, cents", [("arrival", True), ("arrival", False), ("replay", True)])
def test_state_equals_the_walk_over_restarts(spark, tmp_path, order, cents):
    rows, root = random_rows(11, 300), tmp_path / "changes"
    for part in (rows[:70], rows[70:200], rows[200:]):
        change_records(frame(spark, part)).coalesce(1).write.mode("append").json(str(root))
        got = run(spark, root, tmp_path, cents=cents, order=order, chunk_steps=5)
    assert got == walk(rows, CONFIG)
    assert as_book(read_state(spark, f"{tmp_path}/cp")) == got
    assert run(spark, root, tmp_path, cents=cents, order=order) == got  # nothing new


def test_late_records_give_the_replay(spark, tmp_path):
    rows, root = random_rows(12, 240), tmp_path / "changes"
    mixed = random.Random(1).sample(rows, len(rows))
    for k in range(0, 240, 80):
        change_records(frame(spark, mixed[k : k + 80])).coalesce(1).write.mode("append").json(str(root))
        got = run(spark, root, tmp_path, cents=True, order="replay", chunk_steps=4)
    assert got == walk(rows, CONFIG)


@pytest.mark.parametrize("order", ["arrival", "replay"])
def test_balances_start_from_a_ledger(spark, tmp_path, order):
    rows, root = random_rows(13, 200), tmp_path / "changes"
    stored = consolidate(frame(spark, rows[:100]), CONFIG)
    change_records(frame(spark, rows[100:])).coalesce(1).write.json(str(root))
    got = run(spark, root, tmp_path, cents=True, order=order, initial=stored, chunk_steps=3)
    whole = walk(rows, CONFIG)
    assert got == {k: whole[k] for k in got} and len(got) > 20
    assert as_book(read_state(spark, f"{tmp_path}/cp")) == whole


def test_partial_sums_shrink_hot_keys(spark):
    fields = "dominio string, corte string, tipo string, concepto string, origen_clave string, created_at timestamp, trx_id string, seq string, regla_pos int, accion_pos int"
    schema = f"{fields}, bloque string, origen string, delta {{}}, por_regla boolean, limitado boolean"
    now = dt.datetime(2026, 4, 1)
    hot = [("CASA", "2026-04", "CUENTA", "A", None, now, str(i), "s", 1, 0, "CAJA_ACTUAL", None, i, True, False) for i in range(1000)]
    kept = [("CASA", "2026-04", "GASTO", "A", None, now, str(i), "s", 1, 0, "PROYECCION", "o", -i, True, True) for i in range(3)]
    odd = [("CASA", None, None, "A", None, now, "x", "s", 1, 0, "CAJA_ACTUAL", None, 5, False, False)]
    out = partial_sums(spark.createDataFrame(hot + kept + odd, schema.format("long")).coalesce(1), ["CUENTA", "TARJETA"]).collect()
    assert sorted((r["tipo"] or "", r["delta"], r["trx_id"]) for r in out) == [("", 5, "x"), ("CUENTA", 499500, None), ("GASTO", -2, "2"), ("GASTO", -1, "1"), ("GASTO", 0, "0")]
    big = [(*hot[0][:12], 5 * 10**18, True, False)] * 2
    with pytest.raises(Exception, match="exceed 64 bits"):
        partial_sums(spark.createDataFrame(big, schema.format("long")).coalesce(1), ["CUENTA"]).collect()


def test_ids_expire_and_nothing_is_lost(spark, tmp_path):
    root, day = tmp_path / "changes", 86_400
    start = dt.datetime(2026, 4, 1, tzinfo=dt.UTC).timestamp()

    def sent(name, created, arrived, value=1, concept="salud"):
        fields = image(**{**BASE, "trx_id": name, "valor": value, "descripcion": concept, "created_at": str(dt.datetime.fromtimestamp(start + created * day, dt.UTC))[:19]})
        record = change("INSERT", ACCOUNTS, fields, event_id=name)
        record["dynamodb"]["ApproximateCreationDateTime"] = start + arrived * day
        return record

    batches = [
        [sent("a", 0, 0), sent("b", 0, 0, 10), sent("old", -90, 1, 10_000), sent("bad", 0, 0, "x")],
        [sent("a", 0, 9), sent("c", 20, 20, 100)],
        [sent("b", 0, 45), sent("c", 20, 46), sent("d", 44, 46, 1000)],
        [sent("e", 99, 100, 5)],
    ]
    options = {"cents": True, "horizon": "30 days", "arrived": F.col("dynamodb.ApproximateCreationDateTime")}
    for batch in batches:
        write(root, batch)
        got = run(spark, root, tmp_path, **options)
        query = refused_stream(stream_changes(spark, str(root)), CONFIG, f"{tmp_path}/refused", f"{tmp_path}/cp2", **options)
        query.awaitTermination()
    key = ("CASA", "2026-04", "CUENTA", "SALUD", "BDO")
    assert got[key][0] == 1 + 10 + 100 + 1000 + 5
    held = sorted((r["event_id"], r["motivo"]) for r in spark.read.parquet(f"{tmp_path}/refused").collect())
    assert held == [("b", "FUERA_DE_HORIZONTE"), ("bad", "VALOR_NO_NUMERICO"), ("old", "FUERA_DE_HORIZONTE")]
    operator = spark.read.format("state-metadata").load(f"{tmp_path}/cp").filter("operatorName LIKE 'dedupe%'").first()["operatorId"]
    ids = spark.read.format("statestore").option("operatorId", operator).load(f"{tmp_path}/cp").count()
    assert ids <= 2  # of five


def test_unknown_operations_are_refused(spark, tmp_path):
    rules = [{**r, "acciones": [{**a, "operacion": "NUEVA"} for a in r["acciones"]]} for r in CONFIG.rules]
    odd = dataclasses.replace(CONFIG, rules=rules)
    root = tmp_path / "changes"
    write(root, [change("INSERT", ACCOUNTS, image(**{**BASE, "trx_id": t, "valor": v}), event_id=t) for t, v in (("p", 5), ("n", -5))])
    assert [v[0] for v in run(spark, root, tmp_path, odd, cents=True).values()] == [5]
    refused_stream(stream_changes(spark, str(root)), odd, f"{tmp_path}/refused", f"{tmp_path}/cp2").awaitTermination()
    held = spark.read.parquet(f"{tmp_path}/refused").collect()
    assert [(r["event_id"], r["motivo"], json.loads(r["registro"])["trx_id"]) for r in held] == [("n", "OPERACION_NO_SOPORTADA", "n")]


MONTHS = [("CASA", "2026-03", "GASTO#A", 1), ("CASA", "2026-04", "GASTO#A", 2), ("AHORRO", "2026-04", "GASTO#A", 3), ("CASA", "2026-05", "GASTO#A", 4)]


def folders(path, version):
    return dict(f.split("/")[::-1] for f in (path / f"v{version}.version").read_text().split("\n")[2:])


def test_only_touched_months_are_written(spark, ledger, movement, tmp_path):
    path = tmp_path / "ledger"
    write_ledger(ledger(*MONTHS), str(path))
    batch = movement({"tipo": "GASTO", "concepto": "A", "corte": "2026-05", "valor": 7}, {"tipo": "GASTO", "concepto": "A", "corte": "2026/06 ", "valor": 9})
    apply_batch(batch.withColumn("event_id", F.col("trx_id").cast("string")), 0, CONFIG, str(tmp_path))
    before, after = folders(path, 1), folders(path, 2)
    assert {m for m in after if before.get(m) != after[m]} == {"corte=2026-05", "corte=2026%2F06 "}
    assert after["corte=2026-04"] == before["corte=2026-04"]
    written = [f.parent.name for f in path.rglob("*.parquet") if f.parents[1].name == after["corte=2026-05"]]
    assert set(written) == {"corte=2026-05", "corte=2026%2F06 "}
    found = balances(read_ledger(spark, str(path)))
    assert found["CASA", "2026-05", "GASTO#A"] == 11 and found["CASA", "2026/06 ", "GASTO#A"] == 9 and len(found) == 5
    assert balances(read_ledger(spark, str(path), months=["2026-05"])) == {("CASA", "2026-05", "GASTO#A"): 11}
    assert balances(read_ledger(spark, str(path), 1)) == balances(ledger(*MONTHS))


def test_months_are_deleted_and_closed_alone(spark, ledger, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "KEPT_VERSIONS", 2)
    path, gone = tmp_path / "ledger", lambda *rows: spark.createDataFrame(rows, "dominio string, corte string")
    assert drop_months(spark, str(path), gone(("CASA", "2026-04"))) is None
    write_ledger(ledger(*MONTHS), str(path))
    first = folders(path, 1)
    assert drop_months(spark, str(path), gone(("CASA", "2026-04"), ("CASA", "2026-03"), ("CASA", "1999-01"), (None, None))) == 2
    assert sorted(balances(read_ledger(spark, str(path)))) == [("AHORRO", "2026-04", "GASTO#A"), ("CASA", "2026-05", "GASTO#A")]
    assert folders(path, 2)["corte=2026-05"] == first["corte=2026-05"] and "corte=2026-03" not in folders(path, 2)
    monthly_close(spark, CONFIG, str(path), dt.date(2026, 5, 10))
    assert "corte=2026-04" not in folders(path, 3) and latest(spark, str(path)) == 3
    drop_months(spark, str(path), gone(("CASA", "2026-05")))
    assert read_ledger(spark, str(path)).count() == 0 and read_ledger(spark, str(path)).columns == read_ledger(spark, str(path), 3).columns
    # Folders that no kept version names are gone.
    named = {f"{v}/{k}" for n in (3, 4) for k, v in folders(path, n).items()}
    assert {f"{p.parent.name}/{p.name}" for p in path.glob("version=*/corte=*")} == named
    write_ledger(ledger(*MONTHS[:1]), str(path))
    assert balances(read_ledger(spark, str(path))) == {("CASA", "2026-03", "GASTO#A"): 1}


def test_batches_forget_ids_behind_the_horizon(spark, movement, tmp_path):
    def batch(n, *rows):
        made = movement(*[{"tipo": "GASTO", "concepto": "A", "corte": c, "valor": v} for _, c, v in rows])
        ids = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "trx_id long, event_id string")
        apply_batch(made.join(ids, "trx_id"), n, CONFIG, str(tmp_path), horizon_months=2)

    batch(0, ("a", "2026-01", 1), ("b", "2026-04", 2))
    batch(1, ("c", "2026-05", 3), ("b", "2026-04", 2), ("late", "2026-01", 50))
    batch(2, ("a", "2026-01", 1), ("c", "2026-05", 3), ("d", "2026-03", 4), ("odd", "x", 5))
    got = {m: v for (_, m, _), v in balances(read_ledger(spark, f"{tmp_path}/ledger")).items()}
    assert got == {"2026-01": 1, "2026-04": 2, "2026-05": 3, "2026-03": 4, "x": 5}
    held = spark.read.parquet(f"{tmp_path}/quarantine").collect()
    assert sorted((r["lote"], r["event_id"], r["motivo"]) for r in held) == [(1, "late", "FUERA_DE_HORIZONTE"), (2, "a", "FUERA_DE_HORIZONTE")]
    counts = spark.read.parquet(f"{tmp_path}/conteos").orderBy("lote").drop("lote").collect()
    assert [tuple(r) for r in counts] == [(2, 0, 0, 2), (3, 1, 1, 1), (4, 1, 1, 2)]
    assert {p.name for p in tmp_path.glob("event_ids/*/corte=*")} == {"corte=2026-03", "corte=2026-04", "corte=2026-05", "corte=x"}


def test_steps_of_a_key_travel_packed(spark):
    """Steps of a task meet the state as one row for each key, in replay order, nulls first."""
    fields = "dominio string, corte string, tipo string, concepto string, origen_clave string, created_at timestamp, trx_id string, seq string, regla_pos int, accion_pos int"
    schema = f"{fields}, bloque string, origen string, delta long, por_regla boolean, limitado boolean"
    days = [None, *[dt.datetime(2026, 4, 1, tzinfo=dt.UTC) + dt.timedelta(days=k) for k in range(40)]]
    rows = [("CASA", "2026-04", "GASTO", name, None, day, None if k % 3 else "t", "s", -1 if k % 2 else 1, 0, "PROYECCION", "o", k, True, False) for name in "AB" for k, day in enumerate(days)]
    mixed = random.Random(3).sample(rows, len(rows))
    packs = packed_steps(spark.createDataFrame(mixed, schema).coalesce(1), ["CUENTA"]).collect()
    assert sorted(r["concepto"] for r in packs) == ["A", "B"]
    for pack in packs:
        found = Steps.of(iter([pack])).columns
        assert found[1] == list(range(41)) and found[0] == sorted(found[0])
        assert found[0][0] == "\x01\x02t\x01\x02s\x01\x0204611686018427387905\x01\x0204611686018427387904"
        assert found[0][1].startswith("\x022026-04-01 00:00:00.000000\x01\x01")


def test_packed_steps_are_compressed_and_plain_ones_still_read():
    orders = [f"1998-07-01 00:00:00\x02\x01{k:020d}\x02\x01{k:040d}#INSERT-{k}-HistoriaCuentasAltoRendimiento_modules_IAC\x02" for k in range(1000)]
    columns = (orders, list(range(1000)), [True] * 1000, [False] * 1000, [None] * 1000, ["BDO"] * 1000)
    plain = pickle.dumps(columns)
    assert 4 * len(stream._dumped(columns)) < len(plain)
    assert stream._loaded(stream._dumped(columns)) == stream._loaded(plain) == columns
