import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import balances
from quipu import default_config
from quipu.functions.months import close_months
from quipu.functions.text import ledger_key
from quipu.operators import close

CONFIG = dataclasses.replace(default_config(), persistent={"PERSONAL": ["DEUDA A CASA"]})
AS_OF = dt.date(2026, 5, 1)
APRIL = [
    ("PERSONAL", "2026-04", "CUENTA#INGRESO SALARIO#KUBO", 6934140),
    ("PERSONAL", "2026-04", "CUENTA#APORTE HOGAR#KUBO", -2492820),
    ("PERSONAL", "2026-04", "CUENTA#SALDO_INICIAL#KUBO", 500000),
    ("PERSONAL", "2026-04", "GASTO#INGRESO SALARIO", -6934140),
    ("PERSONAL", "2026-04", "GASTO#DEUDA A CASA", -800000),
    ("PERSONAL", "2026-04", "GASTO#APORTE HOGAR", -2492820),
    ("PERSONAL", "2026-04", "GASTO#AHORRO PROYECTO FINCA", -3323760),
    ("CASA", "2026-04", "CUENTA#INGRESO HOGAR#BDO", 2492820),
    ("CASA", "2026-04", "CUENTA#SERVICIOS#BDO", -210000),
    ("CASA", "2026-04", "TARJETA#ALIMENTACION#TARJETA VISA BDO", 940000),
    ("CASA", "2026-04", "GASTO#SERVICIOS", -210000),
    ("CASA", "2026-04", "GASTO#ALIMENTACION", -940000),
]
MAY = {
    ("PERSONAL", "2026-05", "CUENTA#SALDO_INICIAL#KUBO"): 4941320,
    ("PERSONAL", "2026-05", "GASTO#DEUDA A CASA"): -800000,
    ("CASA", "2026-05", "CUENTA#SALDO_INICIAL#BDO"): 2282820,
    ("CASA", "2026-05", "TARJETA#SALDO_INICIAL#TARJETA VISA BDO"): 940000,
}


@pytest.mark.parametrize(
    "as_of, months",
    [(AS_OF, ("2026-04", "2026-05")), (dt.date(2027, 1, 1), ("2026-12", "2027-01")), (dt.date(2026, 3, 31), ("2026-02", "2026-03"))],
)
def test_months(spark, as_of, months):
    assert tuple(spark.range(1).select(*close_months(as_of)).first()) == months


def test_key_text(spark):
    rows = spark.createDataFrame(
        [("CUENTA", "SALDO_INICIAL", "KUBO"), ("GASTO", "DEUDA A CASA", None), ("GASTO", "X", "BDO"), ("TARJETA", "X", "")],
        "t string, c string, o string",
    )
    keys = [r[0] for r in rows.select(ledger_key(F.col("t"), F.col("c"), F.col("o"))).collect()]
    assert keys == ["CUENTA#SALDO_INICIAL#KUBO", "GASTO#DEUDA A CASA", "GASTO#X", "TARJETA#X"]


def test_close_gives_exactly_the_opening_rows(ledger):
    assert balances(close.close_month(ledger(*APRIL), CONFIG, AS_OF)) == MAY


def test_zero_balance_opens_nothing(ledger):
    rows = ledger(("PERSONAL", "2026-04", "CUENTA#INGRESO#NEQUI", 5), ("PERSONAL", "2026-04", "CUENTA#OTRO#NEQUI", -5))
    assert balances(close.close_month(rows, CONFIG, AS_OF)) == {}


def test_zero_persistent_projection_is_not_carried(ledger):
    assert balances(close.close_month(ledger(("PERSONAL", "2026-04", "GASTO#DEUDA A CASA", 0)), CONFIG, AS_OF)) == {}


def test_opening_replaces_and_carry_adds(ledger):
    present = [
        ("PERSONAL", "2026-05", "CUENTA#SALDO_INICIAL#KUBO", 1),
        ("PERSONAL", "2026-05", "GASTO#DEUDA A CASA", -100),
        ("PERSONAL", "2026-05", "CUENTA#OTRO#KUBO", 9),
    ]
    after = balances(close.close_month(ledger(*APRIL, *present), CONFIG, AS_OF))
    assert after == {**MAY, ("PERSONAL", "2026-05", "GASTO#DEUDA A CASA"): -800100, ("PERSONAL", "2026-05", "CUENTA#OTRO#KUBO"): 9}


def test_other_months_and_unknown_domains_stay(ledger):
    others = [("CASA", "2026-03", "CUENTA#X#BDO", 4), ("OTRO", "2026-04", "CUENTA#X#BDO", 6)]
    after = balances(close.close_month(ledger(*others), CONFIG, AS_OF))
    assert after == {("CASA", "2026-03", "CUENTA#X#BDO"): 4, ("OTRO", "2026-04", "CUENTA#X#BDO"): 6}


def test_second_close_finds_nothing_to_move(ledger):
    once = close.close_month(ledger(*APRIL), CONFIG, AS_OF)
    assert balances(close.close_month(once, CONFIG, AS_OF)) == MAY


def test_card_paid_by_transfer_is_carried_only_by_origin(ledger):
    rows = ledger(
        ("CASA", "2026-04", "TARJETA#X#TARJETA VISA BDO", 100), ("CASA", "2026-04", "CUENTA#TRANSFERENCIA#TARJETA VISA BDO", -40)
    )
    key = ("CASA", "2026-05", "TARJETA#SALDO_INICIAL#TARJETA VISA BDO")
    assert balances(close.close_month(rows, CONFIG, AS_OF)) == {key: 100}
    assert balances(close.close_month(rows, CONFIG, AS_OF, carry_by_origin=True)) == {key: 60}


def test_investments_are_carried_only_on_request(ledger):
    rows = ledger(("INVERSIONES", "2026-04", "CUENTA#CDT_BDO#CDT_BDO", 100))
    assert balances(close.close_month(rows, CONFIG, AS_OF)) == {}
    after = balances(close.close_month(rows, CONFIG, AS_OF, carry_all_types=True))
    assert after == {("INVERSIONES", "2026-05", "CUENTA#SALDO_INICIAL#CDT_BDO"): 100}
