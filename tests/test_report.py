import datetime as dt

import pytest
from pyspark.sql import functions as F

from quipu import default_config
from quipu.functions.text import millions_text
from quipu.operators import dashboard, documents, report
from quipu.plans import jobs
from quipu.plans.jobs import daily_report, monthly_close, rebuild_ledger
from quipu.sources import files, snapshots
from quipu.sources.snapshots import VersionConflict, last_batch, latest, read_ledger, write_ledger
from quipu.streaming import jobs as streams
from quipu.streaming.jobs import apply_batch

CONFIG = default_config()
AS_OF = dt.date(2026, 4, 15)
ROWS = [
    ("CASA", "2026-04", "CUENTA#X#BDO", 100),
    ("CASA", "2026-09", "CUENTA#X#BDO", 11),
    ("CASA", "2026-04", "TARJETA#X#TARJETA VISA BDO", 30),
    ("CASA", "2026-04", "GASTO#SALUD", 20),
    ("CASA", "2026-05", "GASTO#INGRESO HOGAR", 50),
    ("CASA", "2026-03", "GASTO#SALUD", 999),
    ("PERSONAL", "2026-05", "GASTO#SALUD", 7),
]
EXPECTED = [
    ("CASA", "2026-04", "CAJA_ACTUAL", "BDO", 111),
    ("CASA", "2026-04", "CAJA_ACTUAL", "TARJETA VISA BDO", -30),
    ("CASA", "2026-04", "TOTAL_CAJA_ACTUAL", "", 81),
    ("CASA", "2026-04", "PROYECCION", "SALUD", -20),
    ("CASA", "2026-04", "CAJA_PROYECTADA_A_CORTE_2026-04", "", 61),
    ("CASA", "2026-05", "PROYECCION", "INGRESO HOGAR", 50),
    ("CASA", "2026-05", "CAJA_PROYECTADA_A_CORTE_2026-05", "", 111),
    ("PERSONAL", "2026-05", "PROYECCION", "SALUD", -7),
    ("PERSONAL", "2026-05", "CAJA_PROYECTADA_A_CORTE_2026-05", "", None),
]


@pytest.fixture
def rows(ledger):
    return report.report(ledger(*ROWS), AS_OF)


def test_sections_in_order(rows):
    assert [tuple(r) for r in report.ordered_report(rows).collect()] == EXPECTED


def test_missing_cash_as_zero(ledger):
    found = report.projected_cash(ledger(*ROWS), AS_OF, missing_cash_zero=True).filter("dominio = 'PERSONAL'").first()
    assert found["valor_ajustado"] == -7


def test_null_origin_or_concept_keeps_the_sign(spark, ledger):
    plain = ledger(("CASA", "2026-04", "CUENTA#X", 5)).withColumn("origen", F.lit(None).cast("string"))
    assert report.adjust(plain).first()["valor_ajustado"] == 5


def test_documents(rows):
    found = {r["id"]: r for r in documents.documents(rows, AS_OF).collect()}
    first = found["CASA_2026-04_CAJA_ACTUAL_BDO"]
    assert first["texto"] == (
        "Dominio financiero: CASA. Periodo: 2026-04. Sección: CAJA_ACTUAL. Concepto: BDO. Tipo registro: DETALLE. Valor calculado: 111"
    )
    assert (first["categoria_bloque"], first["tipo_registro"], first["es_futuro"]) == ("CAJA_ACTUAL", "DETALLE", True)
    projected = found["CASA_2026-05_CAJA_PROYECTADA_A_CORTE_2026-05_"]
    assert (projected["categoria_bloque"], projected["tipo_registro"]) == ("OTRO", "TOTAL")
    assert found["PERSONAL_2026-05_CAJA_PROYECTADA_A_CORTE_2026-05_"]["texto"] is None


@pytest.mark.parametrize("cents, shown", [(-250, "-2"), (-350, "-4"), (250, "2"), (123456789, "1,234,568")])
def test_sentence_rounds_half_to_even(spark, cents, shown):
    row = spark.createDataFrame([("A", "2026-04", "S", "", cents)], "dominio string, corte string, seccion string, concepto string, valor_ajustado long")
    assert row.select(documents.sentence(100).alias("t")).first()["t"].endswith(f"Valor calculado: {shown}")


def test_csv_round_trip(spark, rows, tmp_path):
    files.write_report_csv(rows, str(tmp_path / "csv"))
    back = sorted(tuple(r) for r in files.read_report_csv(spark, str(tmp_path / "csv")).collect())
    assert back == sorted((d, c, s, k, float(v or 0)) for d, c, s, k, v in EXPECTED)


def test_csv_quotes_bad_amounts_and_blank_domains(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'dominio,corte,seccion,concepto,valor_ajustado\nCASA,2026-04,"PROYECCION","uno, dos",12abc\n,2026-04,X,Y,1\n CASA ,2026-05,S,"",nada\n'
    )
    back = [tuple(r) for r in files.read_report_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert back == [("CASA", "2026-04", "PROYECCION", "uno, dos", 12.0), ("CASA", "2026-05", "S", "", 0.0)]


def test_document_files_skip_blank_lines(spark, rows, tmp_path):
    path = tmp_path / "docs"
    files.write_documents(documents.documents(rows, AS_OF), str(path))
    (path / "more.json").write_text('\n{"id": "z", "texto": "t"}\n\n')
    assert files.read_documents(spark, str(path)).count() == len(EXPECTED) + 1


def test_dashboard(rows):
    row = dashboard.metrics(rows).first()
    assert tuple(row) == ("2026-05", 111, 111 + 50, -30 - 20 - 7, 0, 9)
    assert tuple(dashboard.metrics(dashboard.select_rows(rows, corte="2026-04"), "2026-04").first())[:2] == ("2026-04", 61)
    assert tuple(dashboard.metrics(dashboard.select_rows(rows, domain="NADIE")).first()) == (None, 0, 0, 0, 0, 0)
    assert [r[0] for r in dashboard.choices(rows, "corte").collect()] == ["2026-04", "2026-05"]
    assert [tuple(r) for r in dashboard.top_concepts(rows, 1).collect()] == [("INGRESO HOGAR", 50)]
    assert dashboard.projected_amount(rows, "CASA", "2026-05").first()[0] == 111
    assert dashboard.projected_amount(rows, "CASA", "2030-01").first()[0] is None


def test_matrices(spark):
    million = 1_000_000
    rows = spark.createDataFrame(
        [
            ("CASA", "2026-04", "CAJA_PROYECTADA_A_CORTE_2026-04", "", 3 * million // 2),
            ("PERSONAL", "2026-04", "TOTAL_CAJA_ACTUAL", "", 1),
            ("PERSONAL", "2026-05", "PROYECCION", "X", 1),
        ],
        "dominio string, corte string, seccion string, concepto string, valor_ajustado long",
    )
    matrix = {r["corte"]: r for r in dashboard.evolution(rows, CONFIG.domains).collect()}
    assert float(matrix["2026-04"]["CASA"]) == 1.5 and matrix["2026-05"]["CASA"] is None and "INVERSIONES" not in matrix["2026-04"]
    compared = dashboard.comparison(rows.filter("dominio = 'PERSONAL'"), rows, CONFIG.domains)
    assert sorted((r["corte"], float(r["CASA"])) for r in compared.collect()) == [("2026-04", 1.5), ("2026-05", 0.0)]


@pytest.mark.parametrize("value, text", [(-1250000, "-$1.25M"), (0, "$0.00M"), (999999, "$1.00M"), (-1, "-$0.00M")])
def test_millions_text(spark, value, text):
    assert spark.range(1).select(millions_text(F.lit(value))).first()[0] == text


def test_snapshots_and_scheduled_jobs(spark, ledger, movement, tmp_path):
    path, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    assert read_ledger(spark, path) is None and monthly_close(spark, CONFIG, path, AS_OF) is None
    assert rebuild_ledger(movement({"valor": -5}, {"valor": 7}), CONFIG, path) == 1
    write_ledger(ledger(*ROWS), path, batch=3)
    assert last_batch(spark, path) == 3 and read_ledger(spark, path).count() == len(ROWS)
    daily_report(spark, path, out, AS_OF)
    assert files.read_report_csv(spark, f"{out}/reports").count() == len(EXPECTED)
    assert files.read_documents(spark, f"{out}/rag").count() == len(EXPECTED)
    assert monthly_close(spark, CONFIG, path, dt.date(2026, 5, 1)) == 3
    assert "2026-04" not in {r["corte"] for r in read_ledger(spark, path).collect()}
    # A version that was never committed is not read.
    (tmp_path / "ledger" / "v9-abc").mkdir()
    assert last_batch(spark, path) == 3 and latest(spark, path) == 3


def test_writers_do_not_lose_each_other(spark, ledger, movement, tmp_path, monkeypatch):
    """A close and a micro-batch that start from the same version, each committing first in turn."""
    for first in ("batch", "close"):
        path = str(tmp_path / first)
        write_ledger(ledger(("CASA", "2026-04", "GASTO#SALUD", 10)), f"{path}/ledger")
        batch = movement({"tipo": "GASTO", "concepto": "SALUD", "corte": "2026-06", "valor": 7}).withColumn("event_id", F.lit("e"))
        other = {
            "batch": lambda p=path: apply_batch(batch, 0, CONFIG, p),
            "close": lambda p=path: monthly_close(spark, CONFIG, f"{p}/ledger", dt.date(2026, 5, 1)),
        }
        late, module = ("close", jobs) if first == "batch" else ("batch", streams)
        plain, calls = module.write_ledger, []

        def slow(*args, run=other[first], write=plain, seen=calls, **options):
            if not seen:
                seen.append(1)
                run()
            return write(*args, **options)

        monkeypatch.setattr(module, "write_ledger", slow)
        other[late]()
        monkeypatch.setattr(module, "write_ledger", plain)
        found = {(r["corte"], r["concepto"]): r["valor"] for r in read_ledger(spark, f"{path}/ledger").collect() if r["valor"]}
        assert ("2026-04", "SALUD") not in found and found["2026-06", "SALUD"] == 7
        assert latest(spark, f"{path}/ledger") == 3 and last_batch(spark, f"{path}/ledger") == 0


def test_old_versions_go(spark, ledger, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "KEPT_VERSIONS", 2)
    for i in range(4):
        write_ledger(ledger(("CASA", "2026-04", "GASTO#SALUD", i)), str(tmp_path), batch=i)
    assert sorted(p.name for p in tmp_path.glob("*.version")) == ["v3.version", "v4.version"]
    assert read_ledger(spark, str(tmp_path)).first()["valor"] == 3 and read_ledger(spark, str(tmp_path), 3).first()["valor"] == 2
    with pytest.raises(VersionConflict):
        write_ledger(ledger(("CASA", "2026-04", "GASTO#SALUD", 9)), str(tmp_path), parent=3)
