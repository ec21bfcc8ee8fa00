import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quipu import default_config
from quipu.operators import projections

CONFIG = dataclasses.replace(
    default_config(),
    projections={
        "CASA": {"SERVICIOS": 41, "SALUD": 7, "ALIMENTACION": 300},
        "PERSONAL": {"APORTE HOGAR": 88, "AHORRO PROYECTO FINCA": 12},
    },
)
DDL = "dominio string, corte string, origen_registro string"


@pytest.fixture
def existing(spark):
    """Both domains already projected for June and July; August only has a manual row."""
    rows = [(d, c, "PROYECCION_AUTOMATICA") for d in ("CASA", "PERSONAL") for c in ("2026-06", "2026-07")]
    return spark.createDataFrame([*rows, ("CASA", "2026-08", "PROYECCION_MANUAL")], DDL)


@pytest.mark.parametrize(
    "base, months",
    [
        ("2026-05", ["2026-06", "2026-07", "2026-08"]),
        ("2026-10", ["2026-11", "2026-12", "2027-01"]),
        ("2026-11", ["2026-12", "2027-01", "2027-02"]),
        ("2026-12", ["2027-01", "2027-02", "2027-03"]),
    ],
)
def test_months(spark, base, months):
    assert sorted({r["corte"] for r in projections.expand(spark, CONFIG, base).collect()}) == months


def test_months_from_a_run_date(spark):
    rows = projections.expand(spark, CONFIG, as_of=dt.date(2026, 1, 31))
    assert sorted({r["corte"] for r in rows.collect()}) == ["2026-02", "2026-03", "2026-04"]


def test_only_the_open_month_is_inserted(existing):
    rows = projections.new_projections(existing, CONFIG, "2026-05").collect()
    assert sorted((r["dominio"], r["concepto"], r["valor"]) for r in rows) == [
        ("CASA", "ALIMENTACION", 300), ("CASA", "SALUD", 7), ("CASA", "SERVICIOS", 41), ("PERSONAL", "AHORRO PROYECTO FINCA", 12), ("PERSONAL", "APORTE HOGAR", 88),
    ]
    assert {r["corte"] for r in rows} == {"2026-08"}
    assert {r["origen_registro"] for r in rows} == {"PROYECCION_AUTOMATICA"}
    assert {(r["dominio"], r["tabla"]) for r in rows} == {("CASA", "conceptos_fijos"), ("PERSONAL", "conceptos_fijos_persona")}
    assert len({r["trx_id"] for r in rows}) == 5


def test_second_run_inserts_nothing(existing):
    first = projections.new_projections(existing, CONFIG, "2026-05").select("dominio", "corte", "origen_registro")
    assert projections.new_projections(existing.unionByName(first), CONFIG, "2026-05").count() == 0


def test_nothing_exists_yet(spark):
    assert projections.new_projections(spark.createDataFrame([], DDL), CONFIG, "2026-05").count() == 15


def test_summary(existing):
    rows = {r["corte"]: r for r in projections.run_summary(existing, CONFIG, "2026-05").collect()}
    assert sorted(rows) == ["2026-06", "2026-07", "2026-08"]
    assert rows["2026-06"]["omitidos_por_duplicado"] == ["CASA", "PERSONAL"] and rows["2026-06"]["insertados"] == []
    assert rows["2026-08"]["omitidos_por_duplicado"] == [] and len(rows["2026-08"]["insertados"]) == 5


def test_unknown_concepts_and_domains_without_projections(existing):
    odd = dataclasses.replace(CONFIG, projections={" casa ": {" salud ": 1, "NO EXISTE": 2}, "INVERSIONES": {"KUBO": 3}})
    rows = projections.new_projections(existing, odd, "2026-05").collect()
    assert [(r["dominio"], r["concepto"]) for r in rows] == [("CASA", "SALUD")]


def test_unknown_domain_aborts(existing):
    with pytest.raises(ValueError):
        projections.new_projections(existing, dataclasses.replace(CONFIG, projections={"NADIE": {"X": 1}}), "2026-05")


def test_all_domains_unprojectable(spark):
    none = dataclasses.replace(CONFIG, projections={"INVERSIONES": {"KUBO": 3}})
    assert projections.expand(spark, none, "2026-05").count() == 0
    rows = projections.run_summary(spark.createDataFrame([], DDL), none, "2026-05").collect()
    assert sorted((r["corte"], r["insertados"]) for r in rows) == [("2026-06", []), ("2026-07", []), ("2026-08", [])]


def test_scheduled_run_appends_once(spark, existing, tmp_path):
    from quipu.plans.jobs import monthly_projections

    path = str(tmp_path / "table")
    monthly_projections(existing, CONFIG, path, "2026-05")
    stored = spark.read.parquet(path)
    assert stored.count() == 5 and {r["tabla"] for r in stored.collect()} == {"conceptos_fijos", "conceptos_fijos_persona"}
    both = existing.unionByName(stored.select("dominio", F.col("corte").cast("string").alias("corte"), "origen_registro"))
    monthly_projections(both, CONFIG, path, "2026-05")
    assert spark.read.parquet(path).count() == 5
