"""Inputs of the contract queries: requests, forms and tables written from the given tables.

Each function turns whole tables into the raw shape an operator reads.
"""

import dataclasses
import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.config import LedgerConfig, default_config, load_config
from quipu.operators.ledger import consolidate
from quipu.sources.orders import movements

AS_OF = dt.date(1998, 7, 15)
CENTS = 100

# Concepts that the derived movements really use, so that the close carries some.
CONTRACT_PERSISTENT = {"PERSONAL": ["DEUDA A CASA", "SALUD"], "CASA": ["SERVICIOS"]}


def config() -> LedgerConfig:
    return default_config()


def close_config() -> LedgerConfig:
    return dataclasses.replace(default_config(), persistent=CONTRACT_PERSISTENT)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    return consolidate(movements(spark, folder), config())


def _null() -> Column:
    return F.lit(None).cast("string")


def account_payload() -> Column:
    """Every movement as an account request; a few movement shapes make requests that must fail."""
    origin = F.coalesce(F.col("origen"), F.col("concepto"))
    target = (
        F.when((F.col("dominio") == "PERSONAL") & (F.col("origen") == "EFECTIVO"), F.col("origen"))
        .when((F.col("dominio") == "CASA") & (F.col("origen") == "EFECTIVO"), _null())
        .otherwise(F.col("cuenta_destino"))
    )
    return F.struct(
        F.concat(F.lit("  "), F.lower(origin)).alias("Cuenta"),
        F.lower("concepto").alias("Descripcion"),
        F.lit("nota ").alias("Subconcepto"),
        F.col("valor").alias("Valor"),
        F.date_format("created_at", "yyyy-MM-dd").alias("FechaMovimiento"),
        F.col("corte").alias("Corte"),
        F.lower("dominio").alias("DominioFinanciero"),
        target.alias("CuentaDestino"),
    )


def card_payload() -> Column:
    """Every movement as a card request."""
    return F.struct(
        F.coalesce(F.col("origen"), F.lit("TARJETA MASTERCARD NU")).alias("Franquicia"),
        F.col("corte").alias("Corte"),
        F.when(F.col("tipo") == "GASTO", F.lit("sin valor")).otherwise(F.col("valor").cast("string")).alias("Valor"),
        F.date_format("created_at", "yyyy-MM-dd").alias("FechaMovimiento"),
        F.col("dominio").alias("DominioFinanciero"),
        F.col("concepto").alias("Descripcion"),
    )


def projection_payload() -> Column:
    """Every movement as a projection request."""
    return F.struct(
        F.when(F.col("tipo") == "TARJETA", F.lit("OTRO")).otherwise(F.col("dominio")).alias("DominioFinanciero"),
        F.col("concepto").alias("Concepto"),
        F.col("valor").alias("Valor"),
        F.col("corte").alias("Corte"),
    )


def falsy_payload() -> Column:
    """Account requests with the number 0, the text 0, an empty account and a null concept among them."""
    number = F.when(F.col("concepto") == "SALUD", F.lit(0)).otherwise(F.col("valor"))
    as_text = F.col("concepto") == "SERVICIOS"
    return F.concat(
        F.lit('{"Valor":'),
        F.when(as_text, F.lit('"0"')).otherwise(number.cast("string")),
        F.lit(',"Cuenta":"'),
        F.when(F.col("origen") == "NEQUI", F.lit("")).otherwise(F.coalesce("origen", F.lit("x"))),
        F.lit('","Descripcion":'),
        F.when(F.col("concepto") == "AUTOMOVIL", F.lit("null")).otherwise(F.concat(F.lit('"'), "concepto", F.lit('"'))),
        F.when(F.col("tipo") == "GASTO", F.lit("")).otherwise(F.concat(F.lit(',"FechaMovimiento":"'), "corte", F.lit('-01"'))),
        F.lit(',"Corte":"'), F.col("corte"), F.lit('","DominioFinanciero":"'), F.col("dominio"), F.lit('"}'),
    )


def bus_events(rows: DataFrame, payload: Column) -> DataFrame:
    """(trx_id, raw): payloads in bus envelopes."""
    return rows.select("trx_id", _bus_text(payload).alias("raw"))


def _bus_text(payload: Column) -> Column:
    detail = F.struct(
        payload.alias("payload"),
        F.struct(
            F.concat(F.lit("U"), F.col("trx_id").cast("string")).alias("user_id"),
            F.concat(F.lit("C"), F.col("dominio")).alias("channel_id"),
        ).alias("metadata"),
    )
    return F.to_json(F.struct(detail.alias("detail")))


def requests_of_each_kind(rows: DataFrame, payloads: dict) -> DataFrame:
    """(trx_id, clase, raw): every row as a bus event of each kind, from one scan."""
    events = [F.struct(F.lit(kind).alias("clase"), _bus_text(payload).alias("raw")) for kind, payload in payloads.items()]
    return rows.select("trx_id", F.inline(F.array(*events)))


def mixed_events(spark: SparkSession, folder: str) -> DataFrame:
    """(origin, id, raw): movements in the three envelope shapes, and ``events`` with broken and object bodies."""
    rows = movements(spark, folder)
    payload = F.struct(F.col("origen").alias("Cuenta"), F.col("dominio").alias("DominioFinanciero"), F.col("valor").alias("Valor"))
    claims = F.struct(F.concat(F.lit("S"), F.col("trx_id").cast("string")).alias("sub"), F.col("dominio").alias("cognito:username"))
    context = F.struct(F.struct(claims.alias("claims")).alias("authorizer"))
    detail = F.struct(payload.alias("payload"), F.struct(F.col("corte").alias("user_id"), F.col("dominio").alias("channel_id")).alias("metadata"))
    raw = (
        F.when(F.col("tipo") == "CUENTA", F.to_json(F.struct(detail.alias("detail"))))
        .when(F.col("tipo") == "TARJETA", F.to_json(F.struct(F.to_json(payload).alias("body"), context.alias("requestContext"))))
        .otherwise(F.to_json(payload))
    )
    moved = rows.select(F.lit("movimiento").alias("origin"), F.col("trx_id").alias("id"), raw.alias("raw"))
    sub = F.struct(F.struct(F.struct(F.col("user_id").cast("string").alias("sub")).alias("claims")).alias("authorizer"))
    broken = F.to_json(F.struct(F.concat(F.lit("{"), "props").alias("body"), sub.alias("requestContext")))
    whole = F.to_json(F.struct(F.struct(F.col("event_type").alias("Cuenta")).alias("body"), sub.alias("requestContext")))
    shaped = F.when(F.col("event_type") == "error", broken).when(F.col("event_type") == "signup", F.col("props")).otherwise(whole)
    other = table(spark, folder, "events").select(F.lit("evento").alias("origin"), F.col("event_id").alias("id"), shaped.alias("raw"))
    return moved.unionByName(other)


def interaction_requests(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, body): user turns as submitted questions, assistant turns as commands, the rest as JSON."""
    rows = table(spark, folder, "conversations")
    channel = F.to_json(F.struct(F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("channel_id")))
    view = F.struct(
        F.lit("consulta_financiera").alias("callback_id"),
        channel.alias("private_metadata"),
        F.struct(F.struct(F.struct(F.struct(F.col("text").alias("value")).alias("question_input")).alias("question")).alias("values")).alias("state"),
    )
    submitted = F.to_json(
        F.struct(F.lit("view_submission").alias("type"), view.alias("view"), F.struct(F.col("conv_id").cast("string").alias("id")).alias("user"))
    )
    command = F.concat(
        F.lit("command="), F.url_encode(F.lit("/consulta")), F.lit("&channel_id=C"), F.col("conv_id").cast("string"),
        F.lit("&trigger_id=T"), F.col("turn").cast("string"), F.lit("&text="), F.url_encode("text"),
    )
    body = (
        F.when(F.col("role") == "user", F.concat(F.lit("payload="), F.url_encode(submitted)))
        .when(F.col("role") == "assistant", command)
        .otherwise(F.to_json(F.struct(F.lit("block_actions").alias("type"))))
    )
    return rows.select("conv_id", "turn", body.alias("body"))


def record_type() -> Column:
    return (
        F.when(F.col("tipo") == "TARJETA", "MOVIMIENTO_TARJETA")
        .when((F.col("tipo") == "GASTO") & (F.col("dominio") == "AHORRO"), "OTRO")
        .when(F.col("tipo") == "GASTO", "PROYECCION")
        .when(F.col("concepto") == "TRANSFERENCIA", "TRANSFERENCIA")
        .otherwise("MOVIMIENTO_GENERAL")
    )


def form_requests(spark: SparkSession, folder: str, domain: Column | None = None) -> DataFrame:
    """(trx_id, body): every movement as a submitted form, of its own domain or another."""

    def chosen(value: Column, action: str) -> Column:
        return F.struct(F.struct(F.struct(value.alias("value")).alias("selected_option")).alias(action))

    def typed(value: Column, action: str) -> Column:
        return F.struct(F.struct(value.alias("value")).alias(action))

    amount = F.when(F.col("concepto") == "AUTOMOVIL", F.concat(F.col("valor").cast("string"), F.lit(".5"))).otherwise(F.col("valor").cast("string"))
    values = F.struct(
        chosen(record_type(), "tipo_registro_select").alias("tipo_registro"),
        chosen(F.col("dominio") if domain is None else domain, "dominio_select").alias("dominio"),
        chosen(F.col("corte"), "corte_select").alias("corte"),
        chosen(F.col("origen"), "cuenta_select").alias("cuenta"),
        chosen(F.col("cuenta_destino"), "cuenta_destino_select").alias("cuenta_destino"),
        chosen(F.col("concepto"), "concepto_select").alias("concepto"),
        typed(F.concat(F.lit("trx "), F.col("trx_id").cast("string")), "descripcion_input").alias("descripcion"),
        typed(amount, "valor_input").alias("valor"),
    )
    view = F.struct(F.lit("registro_financiero").alias("callback_id"), F.struct(values.alias("values")).alias("state"))
    return movements(spark, folder).select(
        "trx_id", F.to_json(F.struct(F.lit("view_submission").alias("type"), view.alias("view"))).alias("body")
    )


def configuration_files(spark: SparkSession, path: str) -> LedgerConfig:
    """The configuration written as JSON files and read again, with two more rules: one that requires an origin, and one with an
    operation that nobody knows."""
    plain = config()
    wanted = {"tipos_origen": ["TARJETA", "GASTO"], "condicion_valor": "POSITIVO"}
    action = {"tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "ADD"}
    more = [
        {"id": "CON_ORIGEN", "activo": True, **wanted, "bloque_origen": "PROYECCION", "requiere_origen": True, "acciones": [action]},
        {"id": "SIN_ORIGEN", "activo": True, **wanted, "bloque_origen": "PROYECCION", "incluir_conceptos": ["SALUD"], "acciones": [action]},
        {"id": "TARJETA_CON_ORIGEN", "activo": True, **wanted, "bloque_origen": "CAJA_ACTUAL", "requiere_origen": True, "incluir_conceptos": ["SERVICIOS"], "acciones": [action]},
        {"id": "OTRA", "activo": True, **wanted, "bloque_origen": "CAJA_ACTUAL", "incluir_conceptos": ["SALUD"], "acciones": [{**action, "operacion": "MULTIPLICAR"}]},
    ]
    files = {"catalogo": plain.catalogue, "reglas": {"reglas": [*plain.rules, *more]}, "proyecciones": plain.projections, "persistentes": plain.persistent}
    rows = spark.createDataFrame([(name, json.dumps(content, ensure_ascii=False)) for name, content in files.items()], "nombre string, value string")
    rows.repartition("nombre").write.partitionBy("nombre").text(path)
    return load_config(spark, *[f"{path}/nombre={name}" for name in files])


def file_notifications(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, raw): storage notifications, direct pairs and broken events about files named after the pages' urls."""
    k, key = F.col("page_id") % 4, F.concat(F.lit("rag/año "), F.col("page_id").cast("string"), F.lit("/"), F.coalesce("url", F.lit("x")))
    stored = F.struct(F.struct(F.lit("cubo").alias("name")).alias("bucket"), F.struct(F.url_encode(key).alias("key")).alias("object"))
    notified = F.to_json(F.struct(F.array(F.struct(stored.alias("s3"))).alias("Records")))
    direct = F.to_json(F.struct(F.lit("otro").alias("bucket"), key.alias("key")))
    raw = F.when(k == 0, notified).when(k == 1, direct).when(k == 2, F.to_json(F.struct(F.lit("otro").alias("bucket")))).otherwise(F.lit("{broken"))
    return table(spark, folder, "pages").select("page_id", raw.alias("raw"))


def confirmed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Movements as accepted rows: projections came over the API, savings name no channel."""
    return movements(spark, folder).select(
        "trx_id", "dominio", F.col("concepto").alias("descripcion"), "valor", "corte",
        F.when(F.col("tipo") == "TARJETA", F.col("origen")).alias("user_id"),
        F.when(F.col("tipo") == "GASTO", "apigateway").otherwise("eventbridge").alias("source"),
        F.when(F.col("dominio") != "AHORRO", F.concat(F.lit("C"), F.col("dominio"))).alias("channel_id"),
    )


# Projections from this amount on (in cents) count as automatic in the existing table.
AUTOMATIC_FROM = 45_000_000


def existing_projections(spark: SparkSession, folder: str) -> DataFrame:
    """Projection movements as the existing projection table."""
    marked = F.when(F.col("valor") >= AUTOMATIC_FROM, "PROYECCION_AUTOMATICA").otherwise("PROYECCION_MANUAL")
    return movements(spark, folder).filter(F.col("tipo") == "GASTO").withColumn("origen_registro", marked)


def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings as a vector index with report-like metadata."""
    rows = table(spark, folder, "embeddings")
    domain = F.when(F.col("label") < 3, "CASA").when(F.col("label") < 6, "PERSONAL").otherwise("AHORRO")
    metadata = F.struct(
        domain.alias("dominio"),
        F.lit("1998-07").alias("corte"),
        F.lit("PROYECCION").alias("seccion"),
        F.when(F.col("label") != 0, F.concat(F.lit("ETIQUETA "), F.col("label").cast("string"))).alias("concepto"),
        F.col("vec_id").alias("valor"),
    )
    return rows.select(F.col("vec_id").alias("key"), "embedding", "label", metadata.alias("metadata"))


def label_questions(index: DataFrame) -> DataFrame:
    """One question per label: the mean vector of the label's embeddings."""
    parts = index.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("embedding")
    ).withColumnRenamed("label", "question_id")
