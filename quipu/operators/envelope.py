"""Envelopes, interaction requests, form states and routing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.defaults import EVENT_ACCOUNT, EVENT_CARD, EVENT_PROJECTION
from quipu.functions.months import as_date
from quipu.functions.once import with_columns_once
from quipu.functions.text import blank_to_null
from quipu.functions.variants import part, text

# Form field -> (block, action) that holds it.
FORM_FIELDS = {
    "tipo_registro": ("tipo_registro", "tipo_registro_select"),
    "dominio": ("dominio", "dominio_select"),
    "corte": ("corte", "corte_select"),
    "cuenta": ("cuenta", "cuenta_select"),
    "cuenta_destino": ("cuenta_destino", "cuenta_destino_select"),
    "concepto": ("concepto", "concepto_select"),
    "descripcion": ("descripcion", "descripcion_input"),
    "valor": ("valor", "valor_input"),
}


# The fields a request payload can carry.
PAYLOAD_FIELDS = [
    "Cuenta", "CuentaDestino", "Franquicia", "Descripcion", "Concepto", "Subconcepto", "Valor", "FechaMovimiento", "Corte",
    "DominioFinanciero",
]
_PAYLOAD = ", ".join(f"{f} variant" for f in PAYLOAD_FIELDS)
_EVENT = (
    f"detail struct<payload: struct<{_PAYLOAD.replace(' variant', ': variant')}>, metadata: struct<user_id: string, channel_id: string>>, "
    f"body string, requestContext struct<authorizer: struct<claims: map<string, string>>>, {_PAYLOAD}"
)


def _object(json_text: Column, schema: str) -> Column:
    """A JSON object as a struct; null for any other text."""
    return F.when(F.startswith(F.ltrim(json_text), F.lit("{")), F.from_json(json_text, schema))


def _has_key(raw: Column, value: Column, key: str) -> Column:
    """Whether a key is present, be it with a null or an unexpected value (looked at only when the text names it)."""
    odd = F.when(value.isNull() & F.contains(raw, F.lit(f'"{key}"')), part(F.try_parse_json(raw), f"$.{key}").isNotNull())
    return value.isNotNull() | F.coalesce(odd, F.lit(False))


def normalise(events: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds payload (a struct of variants, one per payload field), user_id, channel_id and source.

    Bus events carry ``detail``, API calls carry ``body`` (text or object), and
    anything else is taken as the payload itself. Bad JSON gives an empty
    payload. One parse reads an event; a body is parsed in turn. The fields stay
    variants because the number 0 and the text "0" mean different things.
    """
    text_, event = F.col(raw), F.col("_evento")
    claims = event["requestContext"]["authorizer"]["claims"]
    user = F.coalesce(blank_to_null(F.try_element_at(claims, F.lit("cognito:username"))), F.try_element_at(claims, F.lit("sub")))
    parsed = events.withColumn("_evento", _object(text_, _EVENT))
    marked = parsed.withColumns(
        {"_bus": _has_key(text_, event["detail"], "detail"), "_api": _has_key(text_, event["body"], "body")}
    )
    on_bus, by_api = F.col("_bus"), F.col("_api")
    bare = F.struct(*[event[f].alias(f) for f in PAYLOAD_FIELDS])
    return with_columns_once(
        marked,
        {
            "source": F.when(on_bus, "eventbridge").when(by_api, "apigateway").otherwise("unknown"),
            "payload": F.when(on_bus, event["detail"]["payload"]).when(by_api, _object(event["body"], _PAYLOAD)).otherwise(bare),
            "user_id": F.when(on_bus, event["detail"]["metadata"]["user_id"]).when(by_api, user),
            "channel_id": F.when(on_bus, event["detail"]["metadata"]["channel_id"]),
        },
    ).drop("_evento", "_bus", "_api")


def _form_value(body: Column, name: str) -> Column:
    """First value of a URL-encoded form field; blank values count as absent."""
    encoded = F.regexp_extract(body, f"(?:^|&){name}=([^&]*)", 1)
    return F.nullif(F.try_url_decode(encoded), F.lit(""))


_FORM = ", ".join(
    f"{block}: struct<{action}: struct<selected_option: map<string, string>, value: string>>"
    for block, action in FORM_FIELDS.values()
)
_REQUEST = (
    "type string, command string, channel_id string, user struct<id: string>, "
    "view struct<callback_id: string, private_metadata: string, state: struct<values: "
    f"struct<question: struct<question_input: struct<value: string>>, {_FORM}>>>"
)


def decode_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """Adds the request class and what the class carries.

    Bodies are ``payload=<encoded JSON>``, a URL-encoded command (recognised by
    its trigger_id) or plain JSON. JSON is parsed once, into the fields in use.
    """
    raw, request = F.col(body), F.col("request")
    wrapped, command_form = F.startswith(raw, F.lit("payload=")), F.contains(raw, F.lit("trigger_id"))
    json_text = F.when(wrapped, _form_value(raw, "payload")).when(~command_form, raw)
    opened = with_columns_once(
        requests,
        {
            "_json": json_text,
            "_comando": F.when(~wrapped & command_form, _form_value(raw, "command")),
            "_canal": F.when(~wrapped & command_form, _form_value(raw, "channel_id")),
        },
    )
    parsed = with_columns_once(opened, {"request": _object(F.col("_json"), _REQUEST)})
    command = F.coalesce(F.col("_comando"), request["command"])
    return with_columns_once(
        parsed,
        {
            "command": command,
            "request_class": F.when(command.isNotNull(), "command")
            .when(request["type"] == "block_actions", "block_action")
            .when(request["type"] == "view_submission", "submission")
            .otherwise("other"),
            "channel_id": F.when(command.isNotNull(), F.coalesce(F.col("_canal"), request["channel_id"])).otherwise(
                F.get_json_object(request["view"]["private_metadata"], "$.channel_id")
            ),
            "callback_id": request["view"]["callback_id"],
            "user_id": request["user"]["id"],
            "question": request["view"]["state"]["values"]["question"]["question_input"]["value"],
        },
    ).drop("_json", "_comando", "_canal")


def form_state(requests: DataFrame, request: str = "request") -> DataFrame:
    """Adds ``state``: the selected option's value, else the text value, of the eight form fields."""
    values = F.col(f"{request}.view.state.values")

    def field(block: str, action: str) -> Column:
        entry = values[block][action]
        chosen = entry["selected_option"]
        return F.when(F.size(chosen) > 0, F.try_element_at(chosen, F.lit("value"))).otherwise(entry["value"])

    return with_columns_once(requests, {"state": F.struct(*[field(*at).alias(name) for name, at in FORM_FIELDS.items()])})


def integer(value: Column) -> Column:
    """Whole number from text, null otherwise (12.5 is not a whole number)."""
    stripped = F.trim(value)
    return F.when(stripped.rlike(r"^[+-]?\d+$"), stripped.try_cast("bigint"))


def route(states: DataFrame, as_of=None) -> DataFrame:
    """Adds event_type, payload and route_error by record type.

    The movement date is the run date. Investments name the account as concept.
    """
    s = F.col("state")
    kind, value = s["tipo_registro"], integer(s["valor"])
    general, card = kind == "MOVIMIENTO_GENERAL", kind == "MOVIMIENTO_TARJETA"
    projection, transfer = kind == "PROYECCION", kind == "TRANSFERENCIA"
    concept = F.when(s["dominio"] == "INVERSIONES", s["cuenta"]).otherwise(s["concepto"])
    known = F.coalesce(general | card | projection | transfer, F.lit(False))
    payload = F.struct(
        F.when(general | transfer, s["cuenta"]).alias("Cuenta"),
        F.when(transfer, s["cuenta_destino"]).alias("CuentaDestino"),
        F.when(card, s["cuenta"]).alias("Franquicia"),
        F.when(general, concept).when(transfer, "TRANSFERENCIA").when(card, s["concepto"]).alias("Descripcion"),
        F.when(projection, s["concepto"]).alias("Concepto"),
        s["descripcion"].alias("Subconcepto"),
        value.alias("Valor"),
        F.date_format(as_date(as_of), "yyyy-MM-dd").alias("FechaMovimiento"),
        s["corte"].alias("Corte"),
        s["dominio"].alias("DominioFinanciero"),
    )
    error = F.when(~known, F.concat(F.lit("Tipo de registro no soportado: "), F.coalesce(kind, F.lit("None")))).when(
        value.isNull(), "Valor no es un entero"
    )
    event = F.when(general | transfer, EVENT_ACCOUNT).when(card, EVENT_CARD).when(projection, EVENT_PROJECTION)
    return (
        states.withColumn("route_error", error)
        .withColumn("event_type", F.when(error.isNull(), event))
        .withColumn("payload", F.when(error.isNull(), payload))
    )


def bus_message(routed: DataFrame, stamp=None) -> DataFrame:
    """(detail_type, raw): routed rows as bus envelopes; rows with an error are left out."""
    moment = F.current_timestamp() if stamp is None else F.lit(stamp)
    metadata = F.struct(
        F.col("user_id"), F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("channel_id")
    )
    detail = F.struct(F.struct(F.col("payload"), metadata.alias("metadata")).alias("detail"))
    return routed.filter(F.col("event_type").isNotNull()).select(
        F.col("event_type").alias("detail_type"), F.to_json(detail).alias("raw")
    )


def route_to(messages: DataFrame, *detail_types: str) -> DataFrame:
    """The messages one consumer receives."""
    return messages.filter(F.col("detail_type").isin(*detail_types))


def file_location(records: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds bucket, file_key and location_error from a storage notification or a direct pair."""
    event = F.try_parse_json(raw)
    first = "$.Records[0].s3"
    notified = part(event, "$.Records").isNotNull()
    bucket = F.when(notified, text(event, first + ".bucket.name")).otherwise(text(event, "$.bucket"))
    key = F.when(notified, F.try_url_decode(text(event, first + ".object.key"))).otherwise(text(event, "$.key"))
    complete = bucket.isNotNull() & key.isNotNull()
    return (
        records.withColumn("bucket", F.when(complete, bucket))
        .withColumn("file_key", F.when(complete, key))
        .withColumn("location_error", F.when(~complete, "Evento inválido"))
    )

