import datetime as dt
import json
import urllib.parse

import pytest
from pyspark.sql import functions as F

from quipu import default_config, load_config
from quipu.operators import catalogue, envelope, ingest, outbox
from quipu.operators.search import valid_questions

CONFIG = default_config()
ACCOUNT = {
    "Cuenta": " efectivo", "Descripcion": "salud ", "Valor": 100000, "FechaMovimiento": "2026-03-15", "Corte": "2026-03",
    "DominioFinanciero": "casa", "Subconcepto": "x",
}
CARD = {
    "Franquicia": "TARJETA MASTERCARD BDO", "Corte": "2026-03", "Valor": 823889, "FechaMovimiento": "2026-03-15",
    "DominioFinanciero": "CASA", "Descripcion": "SERVICIOS",
}
PROJECTION = {"Corte": "2026-03", "Valor": 185000, "DominioFinanciero": "CASA", "Concepto": "ADMINISTRACION"}


def raw(spark, *events):
    return spark.createDataFrame([(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)], "n int, raw string")


def check(spark, kind, *payloads):
    rows = ingest.validate(envelope.normalise(raw(spark, *payloads)), kind, CONFIG).orderBy("n").collect()
    return [(r["reject_code"], r["reject_reason"]) for r in rows]


def test_envelopes(spark):
    claims = {"requestContext": {"authorizer": {"claims": {"sub": "s1"}}}}
    named = {"requestContext": {"authorizer": {"claims": {"sub": "s1", "cognito:username": "u1"}}}}
    rows = envelope.normalise(
        raw(
            spark,
            {"detail": {"payload": {"Valor": 1}, "metadata": {"user_id": "u", "channel_id": "c"}}, "body": "x"},
            {"body": json.dumps({"Valor": 2}), **claims},
            {"body": {"Valor": 3}, **named},
            {"body": "{broken", **claims},
            {"Valor": 4},
            "not json",
            {"detail": None},
            {"body": '[{"Valor": 5}]'},
        )
    ).orderBy("n")
    got = [(r["source"], r["user_id"], r["channel_id"], r["a"]) for r in rows.withColumn("a", F.try_variant_get("payload.Valor", "$", "int")).collect()]
    assert got == [
        ("eventbridge", "u", "c", 1), ("apigateway", "s1", None, 2), ("apigateway", "u1", None, 3), ("apigateway", "s1", None, None),
        ("unknown", None, None, 4), ("unknown", None, None, None), ("eventbridge", None, None, None), ("apigateway", None, None, None),
    ]


def test_account_checks(spark):
    transfer = {**ACCOUNT, "Descripcion": "TRANSFERENCIA"}
    got = check(
        spark, ingest.ACCOUNT,
        ACCOUNT,
        {**ACCOUNT, "Valor": 0},
        {**ACCOUNT, "Valor": "0"},
        {**ACCOUNT, "Valor": "NaN"},
        {**ACCOUNT, "Valor": "1e3"},
        {**ACCOUNT, "Cuenta": 5},
        {**ACCOUNT, "DominioFinanciero": "otro"},
        {**ACCOUNT, "Cuenta": "NADA"},
        {**ACCOUNT, "Cuenta": "TARJETA VISA BDO"},
        {**ACCOUNT, "Descripcion": "APORTE HOGAR"},
        {**ACCOUNT, "DominioFinanciero": "INVERSIONES", "Cuenta": "NU", "Descripcion": "CDT_BDO"},
        transfer,
        {**transfer, "CuentaDestino": "NU"},
        {**transfer, "CuentaDestino": "efectivo "},
        {**transfer, "CuentaDestino": "kubo"},
        {**transfer, "DominioFinanciero": "INVERSIONES", "Cuenta": "NU", "CuentaDestino": "RAPPI"},
    )
    assert got == [
        (None, None), (400, ingest.MISSING), (None, None), (400, ingest.NOT_NUMERIC), (None, None), (500, ingest.INTERNAL),
        (400, "Dominio inválido: OTRO"), (400, ingest.BAD_ACCOUNT), (None, None), (400, ingest.BAD_CONCEPT), (None, None),
        (400, ingest.NO_TARGET), (400, ingest.BAD_TARGET), (400, ingest.SAME_TARGET), (None, None), (400, ingest.BAD_CONCEPT),
    ]


def test_missing_fields_are_all_named(spark):
    rows = ingest.validate(envelope.normalise(raw(spark, {"Cuenta": "", "Valor": False, "Corte": "2026-01", "Descripcion": []})), ingest.ACCOUNT, CONFIG)
    assert rows.first()["missing_fields"] == ["Cuenta", "Descripcion", "Valor", "FechaMovimiento", "DominioFinanciero"]


def test_card_checks(spark):
    got = check(
        spark, ingest.CARD,
        CARD, {**CARD, "Franquicia": "BDO"}, {**CARD, "DominioFinanciero": "AHORRO"}, {**CARD, "Descripcion": "DEUDA A CASA"}, {**CARD, "Valor": "x"},
    )
    assert got == [
        (None, None), (400, ingest.BAD_CARD), (500, "Tipo 'TARJETA' no configurado en 'CAJA_ACTUAL' para dominio 'AHORRO'"),
        (400, ingest.BAD_CONCEPT), (400, ingest.NOT_NUMERIC),
    ]


def test_projection_checks(spark):
    got = check(
        spark, ingest.PROJECTION,
        PROJECTION, {**PROJECTION, "DominioFinanciero": "INVERSIONES"}, {**PROJECTION, "Concepto": "NO"}, {**PROJECTION, "DominioFinanciero": "X"},
    )
    assert got == [
        (None, None), (500, "Bloque 'PROYECCION' no configurado para dominio 'INVERSIONES'"), (400, ingest.BAD_CONCEPT), (400, "Dominio inválido: X"),
    ]


def test_accepted_rows(spark):
    bus = {"detail": {"payload": ACCOUNT, "metadata": {"user_id": "u", "channel_id": "c"}}}
    rows = ingest.validate(envelope.normalise(raw(spark, bus, {**ACCOUNT, "Valor": 0})), ingest.ACCOUNT, CONFIG)
    row = ingest.accepted(rows, ingest.ACCOUNT).collect()
    assert len(row) == 1 and len(row[0]["trx_id"]) == 36
    assert (row[0]["cuenta"], row[0]["descripcion"], row[0]["subconcepto"], row[0]["dominio"], float(row[0]["valor"]), row[0]["user_id"]) == (
        "EFECTIVO", "SALUD", "X", "CASA", 100000.0, "u",
    )
    assert ingest.rejected(rows).count() == 1


def test_tables_are_appended(spark, tmp_path):
    rows = ingest.accepted(ingest.validate(envelope.normalise(raw(spark, PROJECTION)), ingest.PROJECTION, CONFIG), ingest.PROJECTION)
    for _ in range(2):
        ingest.append_table(rows, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 2 and stored.first()["origen_registro"] == "PROYECCION_MANUAL" and stored.first()["tabla"] == "conceptos_fijos"


def test_requests(spark):
    question = {
        "type": "view_submission", "user": {"id": "U1"},
        "view": {
            "callback_id": "consulta_financiera", "private_metadata": json.dumps({"channel_id": "C1"}),
            "state": {"values": {"question": {"question_input": {"value": "¿Cuánto tengo & debo?"}}}},
        },
    }
    bodies = [
        "payload=" + urllib.parse.quote_plus(json.dumps(question)),
        "token=a&command=%2Fregistrar&trigger_id=1.2&channel_id=C9&text=",
        json.dumps({"type": "block_actions"}),
        json.dumps({"x": 1}),
        "{broken",
    ]
    decoded = envelope.decode_requests(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "n int, body string"))
    got = [(r["request_class"], r["command"], r["channel_id"], r["question"], r["user_id"]) for r in decoded.orderBy("n").collect()]
    assert got == [
        ("submission", None, "C1", "¿Cuánto tengo & debo?", "U1"), ("command", "/registrar", "C9", None, None),
        ("block_action", None, None, None, None), ("other", None, None, None, None), ("other", None, None, None, None),
    ]
    assert [r["n"] for r in valid_questions(decoded).collect()] == [0]


def state(spark, **fields):
    values = {
        block: {action: {"selected_option": {"value": fields.get(name)}} if action.endswith("select") else {"value": fields.get(name)}}
        for name, (block, action) in envelope.FORM_FIELDS.items()
        if name in fields
    }
    body = json.dumps({"type": "view_submission", "view": {"state": {"values": values}}})
    return envelope.form_state(envelope.decode_requests(spark.createDataFrame([(body,)], "body string")))


@pytest.mark.parametrize(
    "fields, event, expected",
    [
        (dict(tipo_registro="MOVIMIENTO_GENERAL", dominio="INVERSIONES", cuenta="NU", concepto="C", valor="5"), "movimiento.general.registrado", {"Cuenta": "NU", "Descripcion": "NU", "Valor": 5}),
        (dict(tipo_registro="MOVIMIENTO_TARJETA", dominio="CASA", cuenta="T", concepto="C", valor="-5", descripcion="d"), "movimiento.tarjeta.registrado", {"Franquicia": "T", "Cuenta": None, "Subconcepto": "d", "Valor": -5}),
        (dict(tipo_registro="PROYECCION", dominio="CASA", concepto="C", valor=" 7 "), "proyeccion.registrado", {"Concepto": "C", "Descripcion": None, "Valor": 7}),
        (dict(tipo_registro="TRANSFERENCIA", dominio="CASA", cuenta="A", cuenta_destino="B", valor="7"), "movimiento.general.registrado", {"CuentaDestino": "B", "Descripcion": "TRANSFERENCIA"}),
    ],
)
def test_routes(spark, fields, event, expected):
    row = envelope.route(state(spark, **fields), dt.date(2026, 3, 15)).first()
    assert row["event_type"] == event and row["route_error"] is None
    assert {k: row["payload"][k] for k in expected} == expected and row["payload"]["FechaMovimiento"] == "2026-03-15"


def test_form_values_that_are_not_plain_options(spark):
    def entry(block, action, value):
        return json.dumps({"type": "view_submission", "view": {"state": {"values": {block: {action: value}}}}})

    bodies = [
        entry("dominio", "dominio_select", {"selected_option": {}, "value": "v"}),
        entry("dominio", "dominio_select", {"selected_option": "x", "value": "v"}),
        entry("dominio", "dominio_select", {"selected_option": {"text": {"a": 1}}, "value": "v"}),
        entry("dominio", "dominio_select", {"selected_option": None, "value": 5}),
        entry("dominio", "dominio_select", {"selected_option": {"value": "s", "text": {"a": 1}}}),
    ]
    rows = envelope.form_state(envelope.decode_requests(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "n int, body string")))
    assert [r[0] for r in rows.orderBy("n").select("state.dominio").collect()] == ["v", "v", None, "5", "s"]


@pytest.mark.parametrize("fields", [dict(tipo_registro="OTRO", valor="1"), dict(valor="1"), dict(tipo_registro="PROYECCION", valor="1.5"), dict(tipo_registro="PROYECCION")])
def test_route_errors(spark, fields):
    row = envelope.route(state(spark, **fields)).first()
    assert row["event_type"] is None and row["payload"] is None and row["route_error"]


def test_routed_form_is_accepted_downstream(spark):
    rows = state(spark, tipo_registro="TRANSFERENCIA", dominio="CASA", corte="2026-03", cuenta="BDO", cuenta_destino="NEQUI", valor="9")
    messages = envelope.bus_message(envelope.route(rows).withColumn("user_id", F.lit("u")).withColumn("channel_id", F.lit("c")))
    taken = ingest.accepted(ingest.validate(envelope.normalise(messages), ingest.ACCOUNT, CONFIG), ingest.ACCOUNT).first()
    assert (taken["cuenta"], taken["cuenta_destino"], taken["user_id"], taken["source"]) == ("BDO", "NEQUI", "u", "eventbridge")


@pytest.mark.parametrize(
    "fields, errors",
    [
        (dict(), {"tipo_registro", "dominio"}),
        (dict(tipo_registro="X", dominio="CASA"), {"tipo_registro"}),
        (dict(tipo_registro="PROYECCION", dominio="NADIE"), {"dominio"}),
        (dict(tipo_registro="PROYECCION", dominio="CASA", cuenta="BDO"), {"cuenta", "concepto"}),
        (dict(tipo_registro="MOVIMIENTO_GENERAL", dominio="CASA"), {"cuenta", "concepto"}),
        (dict(tipo_registro="MOVIMIENTO_GENERAL", dominio="INVERSIONES", cuenta="NU"), set()),
        (dict(tipo_registro="TRANSFERENCIA", dominio="CASA", cuenta="BDO", cuenta_destino="BDO"), {"cuenta_destino"}),
        (dict(tipo_registro="TRANSFERENCIA", dominio="CASA", cuenta="BDO", cuenta_destino="KUBO"), set()),
        (dict(tipo_registro="MOVIMIENTO_TARJETA", dominio="CASA", cuenta="bdo", concepto="SALUD"), {"cuenta"}),
    ],
)
def test_form_errors(spark, fields, errors):
    assert set(ingest.form_errors(state(spark, **fields), CONFIG).first()["errores"]) == errors


def test_outbox(spark):
    rows = spark.createDataFrame(
        [("t1", "CASA", "SALUD", 5, "2026-03", None, "eventbridge", "c"), ("t2", "CASA", "SALUD", 5, "2026-03", "u", "apigateway", "c"), ("t3", "CASA", "SALUD", 5, "2026-03", "u", "eventbridge", None)],
        "trx_id string, dominio string, descripcion string, valor long, corte string, user_id string, source string, channel_id string",
    )
    events = outbox.confirmations(rows, "movimiento.cuenta.confirmado")
    assert events.count() == 2
    sent = outbox.notifications(events).collect()
    assert len(sent) == 1 and sent[0]["titulo"].startswith("📬") and sent[0]["lineas"][-1] == "*Usuario:*\nNone"
    odd = spark.createDataFrame([("movimiento.cuenta.registrado", '{"channel_id": "c", "descripcion": "D"}')], "detail_type string, detail string")
    message = outbox.notifications(odd).first()
    assert message["titulo"].startswith("🏦") and message["lineas"][1:3] == ["*Dominio:*\nN/A", "*Concepto:*\nD"]


def test_file_locations(spark):
    notice = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "rag/a+b%20c.json"}}}]}
    rows = envelope.file_location(raw(spark, notice, {"bucket": "b", "key": "k"}, {"key": "k"})).orderBy("n").collect()
    assert [(r["bucket"], r["file_key"], r["location_error"] is None) for r in rows] == [("b", "rag/a b c.json", True), ("b", "k", True), (None, None, False)]


def test_catalogue(spark):
    names = [r["nombre"] for r in catalogue.names(spark, CONFIG, "CASA", "CAJA_ACTUAL").collect()]
    assert names == ["BDO", "KUBO", "NEQUI", "EFECTIVO", "TARJETA VISA BDO", "TARJETA MASTERCARD BDO"]
    assert catalogue.names(spark, CONFIG, "CASA", "CAJA_ACTUAL", "TARJETA").count() == 2
    for bad in (("NADIE", "CAJA_ACTUAL"), ("INVERSIONES", "PROYECCION"), ("AHORRO", "CAJA_ACTUAL", "TARJETA")):
        with pytest.raises(ValueError):
            catalogue.names(spark, CONFIG, *bad)
    assert [r[0] for r in catalogue.form_months(spark, dt.date(2026, 9, 30)).collect()] == ["2026-09", "2026-10", "2026-11", "2026-12", "2027-01", "2027-02"]
    kinds = {(r["tipo_registro"], r["clase"]) for r in catalogue.selectable(spark, CONFIG).collect()}
    assert ("PROYECCION", "cuenta") not in kinds and ("TRANSFERENCIA", "cuenta_destino") in kinds


def test_first_listed_type_wins(spark):
    import dataclasses

    double = dataclasses.replace(CONFIG, catalogue={"D": {"CAJA_ACTUAL": {"CUENTA": ["A"], "TARJETA": ["A", "B"]}}})
    rows = spark.createDataFrame([("D", "A"), ("D", "B"), ("D", "C")], "dominio string, cuenta string")
    got = {r["cuenta"]: r["tipo_nombre"] for r in catalogue.with_account_type(rows, double, "cuenta").collect()}
    assert got == {"A": "CUENTA", "B": "TARJETA", "C": None}


def test_config_files(spark, tmp_path):
    for name, value in (("c", CONFIG.catalogue), ("r", {"reglas": CONFIG.rules}), ("p", CONFIG.projections)):
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=2))
    loaded = load_config(spark, str(tmp_path / "c.json"), str(tmp_path / "r.json"), str(tmp_path / "p.json"))
    assert (loaded.catalogue, loaded.rules, loaded.projections, loaded.persistent) == (CONFIG.catalogue, CONFIG.rules, CONFIG.projections, {})


def test_all_kinds_in_one_pass(spark):
    requests = [
        (ingest.ACCOUNT, ACCOUNT), (ingest.CARD, CARD), (ingest.PROJECTION, PROJECTION), (ingest.ACCOUNT, {**ACCOUNT, "Cuenta": 5}),
        (ingest.ACCOUNT, {**ACCOUNT, "Franquicia": 7, "Concepto": 8}), (ingest.CARD, {**CARD, "Cuenta": 5, "Franquicia": "BDO"}),
        (ingest.PROJECTION, {**PROJECTION, "DominioFinanciero": "INVERSIONES"}), (ingest.PROJECTION, {"Concepto": "X"}), ("otra", ACCOUNT), (None, ACCOUNT),
        (ingest.CARD, {**CARD, "Valor": "1e40"}), (ingest.ACCOUNT, {**ACCOUNT, "DominioFinanciero": "AHORRO", "Descripcion": "X"}),
    ]
    rows = spark.createDataFrame([(k, c, json.dumps(p)) for k, (c, p) in enumerate(requests)], "k int, clase string, raw string")
    found = ingest.validate_each(envelope.normalise(rows), CONFIG)
    each = {r["k"]: r for r in found.collect()}
    for kind in (ingest.ACCOUNT, ingest.CARD, ingest.PROJECTION):
        alone = ingest.validate(envelope.normalise(rows.filter(F.col("clase") == kind)), kind, CONFIG)
        columns = [c for c in alone.columns if c not in ("raw", "payload")]
        assert {c for c in found.columns if c not in columns} >= {"raw"}
        for row in alone.select(*columns).collect():
            assert {c: each[row["k"]][c] for c in columns} == row.asDict()
    assert [(each[k]["reject_code"], each[k]["reject_reason"]) for k in (8, 9, 10)] == [(500, ingest.INTERNAL), (500, ingest.INTERNAL), (400, ingest.OUT_OF_RANGE)]
    assert each[1]["cuenta"] is None and each[1]["franquicia"] == "TARJETA MASTERCARD BDO" and each[0]["tabla"] is None
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_large_catalogues_are_joined(spark, monkeypatch):
    from quipu.operators import catalogue

    expected = check(spark, ingest.ACCOUNT, ACCOUNT, {**ACCOUNT, "Cuenta": "NADA"}, {**ACCOUNT, "DominioFinanciero": "otro"})
    monkeypatch.setattr(catalogue, "LITERAL_NAMES", 0)
    assert check(spark, ingest.ACCOUNT, ACCOUNT, {**ACCOUNT, "Cuenta": "NADA"}, {**ACCOUNT, "DominioFinanciero": "otro"}) == expected


@pytest.mark.parametrize(
    "text, value, shown",
    [
        ("1.005", "1.005000", "1.005"), (" 12345678901234567890.25 ", "12345678901234567890.250000", "12345678901234567890.25"), ("1e3", "1000.000000", "1000"),
        ("100", "100.000000", "100"), ("-0.50", "-0.500000", "-0.5"), ("1.0000000", "1.000000", "1"), ("1.0000005", None, None),
        ("1.0000000000001", None, None), ("1e40", None, None), ("123456789012345678901234567890", None, None), ("x", None, None), ("NaN", None, None), (None, None, None),
    ],
)
def test_amounts_are_exact_or_refused(spark, text, value, shown):
    from quipu.functions.text import exact_amount, is_number, plain_number

    row = spark.createDataFrame([(text,)], "t string").select(exact_amount(F.col("t")).alias("v"), is_number(F.col("t")).alias("n"))
    got = row.select(F.col("v").cast("string"), plain_number(F.col("v")), "n").first()
    assert (got[0], got[1]) == (value, shown)
    assert got[2] == (text not in ("x", "NaN", None))


def test_configured_fractions_are_kept(spark):
    import dataclasses

    from quipu.operators import projections

    config = dataclasses.replace(CONFIG, projections={"CASA": {"SALUD": 7.25, "SERVICIOS": 3}})
    rows = projections.expand(spark, config, "2026-05").filter("corte = '2026-06'")
    assert sorted((r["concepto"], str(r["valor"])) for r in rows.collect()) == [("SALUD", "7.250000"), ("SERVICIOS", "3.000000")]
    assert sorted(str(r["valor"]) for r in config.projection_dim(spark).collect()) == ["3.000000", "7.250000"]
    assert dict(projections.expand(spark, CONFIG, "2026-05").dtypes)["valor"] == "bigint"
    with pytest.raises(ValueError, match="6 digits"):
        projections.expand(spark, dataclasses.replace(CONFIG, projections={"CASA": {"SALUD": 0.1234567}}), "2026-05")
