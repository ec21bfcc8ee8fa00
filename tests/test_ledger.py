import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import LEDGER_DDL, MOVEMENT_DDL, balances
from quipu import default_config
from quipu.operators import ledger as books
from quipu.operators import rules
from quipu.operators.balances import running_balance
from quipu.schema import KEY
from walk import walk

CONFIG = default_config()
BUDGET = ("CASA", "2026-04", "GASTO#SERVICIOS")


@pytest.mark.parametrize(
    "stored, spent, effective",
    [
        (160000, 100000, -100000),
        (160000, 160000, -160000),
        (160000, 170000, -160000),
        (160000, 500000, -160000),
        (0, 50000, 0),
        (100000, 120000, -100000),
        (None, 170000, 0),
        (2492820, 2000000, -2000000),
        (2492820, 2600000, -2492820),
        (-50, 10, 50),
    ],
)
def test_limited_decrement(spark, movement, ledger, stored, spent, effective):
    before = ledger((*BUDGET, stored)) if stored is not None else spark.createDataFrame([], LEDGER_DDL)
    after = balances(books.consolidate(movement({"valor": -spent}), CONFIG, before))
    assert after.get(BUDGET, 0) - (stored or 0) == effective
    assert (BUDGET in after) == (stored is not None)
    assert after[("CASA", "2026-04", "CUENTA#SERVICIOS#BDO")] == -spent


def test_income_lowers_the_projected_income(movement, ledger):
    before = ledger(("CASA", "2026-04", "GASTO#INGRESO HOGAR", 1000))
    after = balances(books.consolidate(movement({"concepto": "INGRESO HOGAR", "valor": 300}), CONFIG, before))
    assert after == {("CASA", "2026-04", "GASTO#INGRESO HOGAR"): 700, ("CASA", "2026-04", "CUENTA#INGRESO HOGAR#BDO"): 300}


def test_card_purchase(movement, ledger):
    before = ledger(("CASA", "2026-04", "GASTO#ALIMENTACION", 500))
    rows = movement({"tipo": "TARJETA", "concepto": "ALIMENTACION", "origen": "TARJETA VISA BDO", "valor": 200})
    after = balances(books.consolidate(rows, CONFIG, before))
    assert after == {("CASA", "2026-04", "GASTO#ALIMENTACION"): 300, ("CASA", "2026-04", "TARJETA#ALIMENTACION#TARJETA VISA BDO"): 200}


def test_transfer_and_replica(movement):
    rows = movement({"concepto": "TRANSFERENCIA", "origen": "BDO", "cuenta_destino": "KUBO", "valor": 70})
    assert balances(books.consolidate(rows, CONFIG)) == {
        ("CASA", "2026-04", "CUENTA#TRANSFERENCIA#BDO"): -70,
        ("CASA", "2026-04", "CUENTA#TRANSFERENCIA#KUBO"): 70,
        ("AHORRO", "2026-04", "CUENTA#SALDO APTO#KUBO"): 70,
    }


def test_transfer_to_a_card_lowers_its_debt(movement):
    rows = movement({"concepto": "TRANSFERENCIA", "cuenta_destino": "TARJETA VISA BDO", "valor": 70})
    after = balances(books.consolidate(rows, CONFIG))
    assert after[("CASA", "2026-04", "CUENTA#TRANSFERENCIA#TARJETA VISA BDO")] == -70


def test_transfer_without_target_posts_only_the_origin(movement):
    rows = movement({"concepto": "TRANSFERENCIA", "valor": 70})
    assert balances(books.consolidate(rows, CONFIG)) == {("CASA", "2026-04", "CUENTA#TRANSFERENCIA#BDO"): -70}


def test_negative_transfer_matches_two_normal_rules(movement):
    rows = movement({"concepto": "TRANSFERENCIA", "cuenta_destino": "NEQUI", "valor": -70})
    twice = balances(books.consolidate(rows, CONFIG))
    assert twice[("CASA", "2026-04", "CUENTA#TRANSFERENCIA#BDO")] == -140
    once = balances(books.consolidate(rows, CONFIG, first_normal_rule_only=True))
    assert once[("CASA", "2026-04", "CUENTA#TRANSFERENCIA#BDO")] == -70


def test_zero_amounts_only_count_on_the_default_path(movement):
    rows = movement({"valor": 0}, {"concepto": "TRANSFERENCIA", "cuenta_destino": "NEQUI", "valor": 0})
    assert balances(books.consolidate(rows, CONFIG)) == {("CASA", "2026-04", "CUENTA#SERVICIOS#BDO"): 0}


def test_unknown_operation_is_held_back(movement):
    rule = {**CONFIG.rules[0], "acciones": [{**CONFIG.rules[0]["acciones"][0], "operacion": "MULTIPLICAR"}]}
    config = dataclasses.replace(CONFIG, rules=[rule])
    rows = movement({"valor": -5}, {"valor": 5})
    assert [r["trx_id"] for r in rules.unsupported_movements(rows, config).collect()] == [0]
    assert {r["trx_id"] for r in rules.postings(rows, config).collect()} == {1}


def test_empty_include_list_rejects_and_unknown_sign_passes(movement):
    base = {"activo": True, "tipos_origen": ["CUENTA"], "bloque_origen": "CAJA_ACTUAL", "acciones": []}
    config = dataclasses.replace(
        CONFIG,
        rules=[
            {**base, "id": "A", "condicion_valor": "CUALQUIERA", "incluir_dominio": []},
            {**base, "id": "B", "condicion_valor": "OTRA"},
            {**base, "id": "C", "condicion_valor": "CUALQUIERA", "requiere_origen": True},
            {**base, "id": "D", "condicion_valor": "CUALQUIERA", "activo": False},
        ],
    )
    rows = movement({"valor": 5}, {"valor": 5, "origen": None})
    found = sorted((r["trx_id"], r["regla_id"]) for r in rules.rule_matches(rows, config).collect())
    assert found == [(0, "B"), (0, "C"), (1, "B")]


def test_quotes_in_configured_names(movement):
    rule = {**CONFIG.rules[0], "excluir_conceptos": ["D'ANGELO\\S"]}
    config = dataclasses.replace(CONFIG, rules=[rule])
    rows = movement({"valor": -5, "concepto": "D'ANGELO\\S"}, {"valor": -5, "concepto": "OTRO"})
    assert [r["trx_id"] for r in rules.rule_matches(rows, config).collect()] == [1]


def random_rows(seed, n=400):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        kind = pick.choice(["CUENTA", "CUENTA", "TARJETA", "GASTO"])
        origin = {"CUENTA": ["BDO", "KUBO", "NEQUI", None], "TARJETA": ["TARJETA VISA BDO"], "GASTO": [None]}[kind]
        rows.append(
            dict(
                trx_id=i,
                # Many equal stamps, so that the id has to break ties.
                created_at=dt.datetime(2026, 4, 1) + dt.timedelta(days=i // 40),
                dominio=pick.choice(["CASA", "PERSONAL", "AHORRO", "INVERSIONES"]),
                corte=pick.choice(["2026-04", "2026-05"]),
                tipo=kind,
                bloque="PROYECCION" if kind == "GASTO" else "CAJA_ACTUAL",
                concepto=pick.choice(["SALUD", "INGRESO HOGAR", "TRANSFERENCIA", "SALDO_INICIAL"]),
                origen=pick.choice(origin),
                cuenta_destino=pick.choice(["KUBO", "BDO", "TARJETA VISA BDO", None]),
                valor=pick.choice([0, 1, 1]) * pick.choice([-1, 1]) * pick.randint(1, 100),
            )
        )
    return rows


def frame(spark, rows):
    names = [c.split()[0] for c in MOVEMENT_DDL.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], MOVEMENT_DDL)


def as_book(result):
    return {tuple(r[c] for c in KEY): [int(r["valor"]), r["bloque"], r["origen"]] for r in result.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_the_literal_walk(spark, seed):
    rows = random_rows(seed)
    assert as_book(books.consolidate(frame(spark, rows), CONFIG)) == walk(rows, CONFIG)


def test_hot_keys_give_the_same_ledger(spark):
    # One key holds most of the rows; chunks cut through it.
    rows = random_rows(3, 600)
    for r in rows[::2]:
        r.update(dominio="CASA", corte="2026-04", concepto="SALUD")
    result = books.consolidate(frame(spark, rows), CONFIG, hot_key_steps=20)
    assert as_book(result) == walk(rows, CONFIG)


def test_chunked_running_balance_equals_the_plain_one(spark):
    steps = rules.postings(frame(spark, random_rows(4, 500)), CONFIG, only=["GASTO"])
    plain, chunked = running_balance(steps, None), running_balance(steps, 5, chunks=7)
    columns = [*KEY, "trx_id", "regla_pos", "accion_pos", "saldo", "efectivo"]
    assert sorted(map(str, plain.select(*columns).collect())) == sorted(map(str, chunked.select(*columns).collect()))


@pytest.mark.parametrize("cut", [0, 1, 137, 400])
def test_two_batches_equal_one(spark, cut):
    rows = random_rows(5)
    first = books.consolidate(frame(spark, rows[:cut]), CONFIG)
    both = books.consolidate(frame(spark, rows[cut:]), CONFIG, first)
    assert as_book(both) == walk(rows, CONFIG)


def test_additive_upsert_and_replace(spark, ledger):
    stored = ledger(("CASA", "2026-04", "CUENTA#A#BDO", 10), ("CASA", "2026-04", "CUENTA#B#BDO", 5))
    more = ledger(("CASA", "2026-04", "CUENTA#A#BDO", 7), ("CASA", "2026-05", "CUENTA#A#BDO", 1))
    added = balances(books.add_amounts(stored, more.withColumn("seq", F.lit(1))))
    assert added == {("CASA", "2026-04", "CUENTA#A#BDO"): 17, ("CASA", "2026-04", "CUENTA#B#BDO"): 5, ("CASA", "2026-05", "CUENTA#A#BDO"): 1}
    assert balances(books.replace_rows(stored, more))[("CASA", "2026-04", "CUENTA#A#BDO")] == 7


def test_key_scan_and_month_delete(spark, ledger):
    stored = ledger(("CASA", "2026-04", "CUENTA#A#BDO", 10), ("CASA", "2026-04", "GASTO#A", 5), ("CASA", "2026-05", "CUENTA#A#BDO", 1))
    assert list(balances(books.key_scan(stored, "CASA", "2026-04", "CUENTA#"))) == [("CASA", "2026-04", "CUENTA#A#BDO")]
    assert list(balances(books.key_scan(stored, "CASA", "2026-04", "GASTO#A"))) == [("CASA", "2026-04", "GASTO#A")]
    months = spark.createDataFrame([("CASA", "2026-04")], "dominio string, corte string")
    assert list(balances(books.delete_months(stored, months))) == [("CASA", "2026-05", "CUENTA#A#BDO")]
