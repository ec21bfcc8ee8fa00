import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MOVEMENT_DDL = (
    "trx_id long, created_at timestamp, dominio string, corte string, tipo string, bloque string, concepto string, "
    "origen string, cuenta_destino string, valor long"
)
LEDGER_DDL = (
    "dominio string, corte string, tipo string, concepto string, origen_clave string, bloque string, origen string, valor long"
)


@pytest.fixture
def movement(spark):
    """Builds a movements frame from short dicts."""

    def build(*rows):
        base = dict(dominio="CASA", corte="2026-04", tipo="CUENTA", bloque=None, concepto="SERVICIOS", origen="BDO", cuenta_destino=None, valor=0)
        full = []
        for i, row in enumerate(rows):
            r = {**base, **row}
            if r["bloque"] is None:
                r["bloque"] = "PROYECCION" if r["tipo"] == "GASTO" else "CAJA_ACTUAL"
            if r["tipo"] == "GASTO":
                r["origen"] = None
            stamp = dt.datetime(2026, 4, 1) + dt.timedelta(minutes=i)
            full.append(
                (i, stamp, r["dominio"], r["corte"], r["tipo"], r["bloque"], r["concepto"], r["origen"], r["cuenta_destino"], r["valor"])
            )
        return spark.createDataFrame(full, MOVEMENT_DDL)

    return build


@pytest.fixture
def ledger(spark):
    """Builds a ledger frame from (dominio, corte, key text, valor) tuples."""

    def build(*rows):
        full = []
        for domain, corte, key, value in rows:
            kind, concept, *origin = key.split("#")
            origin = origin[0] if origin else None
            block = "PROYECCION" if kind == "GASTO" else "CAJA_ACTUAL"
            full.append((domain, corte, kind, concept, origin, block, origin, value))
        return spark.createDataFrame(full, LEDGER_DDL)

    return build


def balances(frame):
    """{(dominio, corte, key text): valor}"""
    out = {}
    for r in frame.collect():
        key = "#".join(x for x in (r["tipo"], r["concepto"], r["origen_clave"]) if x is not None)
        out[(r["dominio"], r["corte"], key)] = int(r["valor"])
    return out
