"""Contract queries: every operator over whole tables.

Amounts are integer cents, the run date is fixed, and every column is named.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions.months import month_start, months_from
from quipu.functions.variants import scalar_text
from quipu.operators import catalogue, close, dashboard, documents, index_store, ingest, outbox, projections, report, rules, search
from quipu.operators import ledger as books
from quipu.operators.balances import running_balance
from quipu.operators.envelope import decode_requests, file_location, form_state, normalise, route
from quipu.plans import calendar, inputs
from quipu.plans.inputs import AS_OF, CENTS
from quipu.plans.jobs import drop_months
from quipu.schema import KEY, LEDGER
from quipu.scratch import run_folder
from quipu.sources import files
from quipu.sources.changes import decode_changes, source_rows
from quipu.sources.orders import change_records, movements
from quipu.sources.snapshots import read_ledger, write_ledger


# --- sources -----------------------------------------------------------------

def ledger_scan(spark: SparkSession, folder: str) -> DataFrame:
    stored = books.with_key_text(inputs.ledger(spark, folder)).select("Dominio-Corte", "Tipo-Concepto", "bloque", "valor")
    return files.read_key_text_ledger(stored).select("Dominio_Corte", "Tipo_Concepto", "dominio", "corte", "bloque", "valor")


def change_decode(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_changes(change_records(movements(spark, folder)))
    return rows.select(
        F.col("trx_id").cast("bigint").alias("trx_id"), "dominio", "corte", "tipo", "bloque", "concepto", "origen",
        "cuenta_destino", F.col("valor").cast("bigint").alias("valor"),
    )


def source_context(spark: SparkSession, folder: str) -> DataFrame:
    records = change_records(movements(spark, folder))
    # Removals and unmapped tables keep null context.
    return (
        source_rows(records)
        .groupBy("tabla", "tipo", "bloque")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("valor").cast("bigint").alias("total"))
    )


def catalogue_dim(spark: SparkSession, folder: str) -> DataFrame:
    rows = movements(spark, folder)
    used = (
        rows.select("dominio", F.inline(F.array(
            F.struct(F.lit("CAJA_ACTUAL").alias("bloque"), F.col("origen").alias("nombre")),
            F.struct(F.lit("PROYECCION").alias("bloque"), F.col("concepto").alias("nombre")),
        )), "valor")
        .groupBy("dominio", "bloque", "nombre")
        .agg(F.count(F.lit(1)).alias("usos"), F.sum("valor").alias("total"))
    )
    dim = inputs.config().catalogue_dim(spark)
    return dim.join(used, ["dominio", "bloque", "nombre"], "left").select(
        "dominio", "bloque", "tipo", "nombre", "pos", F.coalesce("usos", F.lit(0)).alias("usos"), F.coalesce("total", F.lit(0)).alias("total")
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "report-csv")
    files.write_report_csv(report.report(inputs.ledger(spark, folder), AS_OF), path)
    return files.read_report_csv(spark, path).withColumn("valor_ajustado", F.col("valor_ajustado").cast("bigint"))


def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "documents")
    rows = report.report(inputs.ledger(spark, folder), AS_OF)
    files.write_documents(documents.documents(rows, AS_OF, CENTS), path)
    return files.read_documents(spark, path).withColumn("valor", F.col("valor").cast("double"))


# --- envelopes and routing ---------------------------------------------------

def envelope_normalise(spark: SparkSession, folder: str) -> DataFrame:
    rows = normalise(inputs.mixed_events(spark, folder))
    return rows.select(
        "origin", "id", "source", "user_id", "channel_id", scalar_text(F.col("payload.Cuenta")).alias("cuenta"),
        scalar_text(F.col("payload.DominioFinanciero")).alias("dominio"), scalar_text(F.col("payload.Valor")).alias("valor"),
    )


def request_decode(spark: SparkSession, folder: str) -> DataFrame:
    return decode_requests(inputs.interaction_requests(spark, folder)).select(
        "conv_id", "turn", "request_class", "command", "channel_id", "callback_id", "user_id", "question"
    )


def _states(spark: SparkSession, folder: str) -> DataFrame:
    return form_state(decode_requests(inputs.form_requests(spark, folder))).select("trx_id", "state")


def form_states(spark: SparkSession, folder: str) -> DataFrame:
    return _states(spark, folder).select("trx_id", "state.*")


def route_events(spark: SparkSession, folder: str) -> DataFrame:
    return route(_states(spark, folder), AS_OF).select("trx_id", "event_type", "route_error", "payload.*")


def outbox_messages(spark: SparkSession, folder: str) -> DataFrame:
    events = outbox.confirmations(inputs.confirmed_rows(spark, folder), "movimiento.cuenta.confirmado")
    return outbox.notifications(events).select(
        "channel_id", "detail_type", "titulo", F.array_join("lineas", "|").alias("lineas"), "pie"
    )


# --- validation --------------------------------------------------------------

def _validated(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    payload = {
        ingest.ACCOUNT: inputs.account_payload, ingest.CARD: inputs.card_payload, ingest.PROJECTION: inputs.projection_payload,
    }[kind]()
    events = inputs.bus_events(movements(spark, folder), payload)
    return ingest.validate(normalise(events), kind, inputs.config())


def validate_required(spark: SparkSession, folder: str) -> DataFrame:
    events = movements(spark, folder).select("trx_id", inputs.falsy_payload().alias("raw"))
    checked = ingest.validate(normalise(events), ingest.ACCOUNT, inputs.config())
    return checked.select("trx_id", F.array_join("missing_fields", ",").alias("faltantes"))


def validate_account(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder, ingest.ACCOUNT).select("trx_id", "cuenta", "descripcion", "subconcepto", "dominio", "reject_code", "reject_reason")


def validate_card(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder, ingest.CARD).select("trx_id", "franquicia", "dominio", "reject_code", "reject_reason")


def validate_concept(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder, ingest.PROJECTION).select("trx_id", "dominio", "concepto", "tabla", "reject_code", "reject_reason")


def validate_transfer(spark: SparkSession, folder: str) -> DataFrame:
    rows = _validated(spark, folder, ingest.ACCOUNT).filter(F.col("descripcion") == "TRANSFERENCIA")
    return rows.select("trx_id", "dominio", "cuenta", "cuenta_destino", "reject_reason")


def validate_form(spark: SparkSession, folder: str) -> DataFrame:
    checked = ingest.form_errors(_states(spark, folder), inputs.config())
    fields = ["tipo_registro", "dominio", "cuenta", "cuenta_destino", "concepto"]
    return checked.select("trx_id", *[F.try_element_at("errores", F.lit(f)).alias(f"error_{f}") for f in fields])


def form_domains(spark: SparkSession, folder: str) -> DataFrame:
    """Forms of which some name a domain that isn't listed, and some none."""
    k = F.col("trx_id") % 10
    domain = F.when(k == 0, "OTRO").when(k == 1, "").when(k == 2, F.lit(None)).otherwise(F.col("dominio"))
    states = form_state(decode_requests(inputs.form_requests(spark, folder, domain))).select("trx_id", "state")
    checked = ingest.form_errors(states, inputs.config())
    fields = ["tipo_registro", "dominio", "cuenta", "cuenta_destino", "concepto"]
    return checked.select("trx_id", *[F.try_element_at("errores", F.lit(f)).alias(f"error_{f}") for f in fields])


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Where the files are that storage notifications and direct events tell of."""
    found = file_location(inputs.file_notifications(spark, folder))
    return found.select("page_id", "bucket", "file_key", "location_error")


def ingest_split(spark: SparkSession, folder: str) -> DataFrame:
    """Every movement as a request of each kind, in one pass: accepted and refused ones by code, with exact amounts. Some account
    requests have fractions, 20 digits, or more than an amount can hold."""
    payloads = {ingest.ACCOUNT: inputs.account_payload(), ingest.CARD: inputs.card_payload(), ingest.PROJECTION: inputs.projection_payload()}
    # The narrow rows are dealt out before they become requests: their table may be a single row group.
    rows = movements(spark, folder).repartition(spark.sparkContext.defaultParallelism, "trx_id")
    events = inputs.requests_of_each_kind(rows, payloads)
    odd = F.col("trx_id") % 40
    number = F.when(odd == 1, "1.005").when(odd == 2, "12345678901234567890.25").when(odd == 3, "1e40")
    changed = F.regexp_replace("raw", F.lit('"Valor":-?[0-9]+'), F.concat(F.lit('"Valor":'), number))
    events = events.withColumn("raw", F.when((F.col("clase") == ingest.ACCOUNT) & number.isNotNull(), changed).otherwise(F.col("raw")))
    rows = ingest.validate_each(normalise(events), inputs.config())
    refused = F.col("reject_code").isNotNull()
    rows = rows.select("clase", "dominio", F.when(refused, "cuarentena").otherwise("aceptado").alias("salida"), F.coalesce("reject_code", F.lit(200)).alias("codigo"), "valor")
    total = F.coalesce(F.sum("valor"), F.lit(0)).cast("decimal(38,6)").cast("string")
    return rows.groupBy("clase", "dominio", "salida", "codigo").agg(F.count(F.lit(1)).alias("n"), total.alias("total"))


def append_once(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted account requests appended by two writers, one of them twice and with its events sent twice."""
    raw = F.concat(F.lit('{"id":"e'), F.col("trx_id").cast("string"), F.lit('",'), F.substr("raw", F.lit(2)))
    events = inputs.bus_events(movements(spark, folder), inputs.account_payload()).withColumn("raw", raw)
    rows = ingest.validate(normalise(events), ingest.ACCOUNT, inputs.config())
    rows = ingest.accepted(rows, ingest.ACCOUNT, ingest.event_identity(F.col("raw"), ingest.ACCOUNT), AS_OF)
    path = f"{run_folder(spark, 'append-once')}/cuenta"
    even = F.substring_index("trx_id", "e", -1).cast("bigint") % 2 == 0
    for part, writer in ((rows.filter(even), "lote-0"), (rows.filter(~even).unionByName(rows.filter(~even)), "lote-1"), (rows, "lote-1")):
        ingest.append_once(part, path, writer)
    found = ingest.read_appended(spark, path, rows.schema)
    return found.select("trx_id", "dominio", "corte", "cuenta", F.col("valor").cast("bigint").alias("valor"))


# --- catalogue ---------------------------------------------------------------

def catalogue_names(spark: SparkSession, folder: str) -> DataFrame:
    config = inputs.config()
    listed = None
    for domain in config.domains:
        for block in config.catalogue[domain]:
            part = catalogue.names(spark, config, domain, block).select(F.lit(domain).alias("dominio"), F.lit(block).alias("bloque"), "nombre", "pos")
            listed = part if listed is None else listed.unionByName(part)
    counts = movements(spark, folder).groupBy("dominio").agg(F.count(F.lit(1)).alias("movimientos"))
    return listed.join(counts, "dominio", "left").fillna(0, ["movimientos"])


def catalogue_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts by domain, block and type, with the movements that name them."""
    config, listed = inputs.config(), None
    for domain, blocks in config.catalogue.items():
        for kind in blocks.get("CAJA_ACTUAL", {}):
            part = catalogue.names(spark, config, domain, "CAJA_ACTUAL", kind).select(F.lit(domain).alias("dominio"), F.lit(kind).alias("tipo"), "nombre")
            listed = part if listed is None else listed.unionByName(part)
    counts = movements(spark, folder).groupBy("dominio", F.col("origen").alias("nombre")).agg(F.count(F.lit(1)).alias("movimientos"))
    return listed.join(counts, ["dominio", "nombre"], "left").fillna(0, ["movimientos"])


def catalogue_type(spark: SparkSession, folder: str) -> DataFrame:
    typed = catalogue.with_account_type(movements(spark, folder), inputs.config(), "cuenta_destino")
    return typed.select("trx_id", "dominio", "cuenta_destino", F.col("tipo_nombre").alias("tipo_destino"))


def selectable_values(spark: SparkSession, folder: str) -> DataFrame:
    offered = catalogue.selectable(spark, inputs.config())
    rows = movements(spark, folder).select("dominio", F.inline(F.array(
        F.struct(F.lit("cuenta").alias("clase"), F.col("origen").alias("nombre")),
        F.struct(F.lit("concepto").alias("clase"), F.col("concepto").alias("nombre")),
        F.struct(F.lit("cuenta_destino").alias("clase"), F.col("cuenta_destino").alias("nombre")),
    )))
    used = rows.groupBy("dominio", "clase", "nombre").agg(F.count(F.lit(1)).alias("usos"))
    return offered.join(used, ["dominio", "clase", "nombre"], "left").select(
        "tipo_registro", "dominio", "clase", "nombre", "pos", F.coalesce("usos", F.lit(0)).alias("usos")
    )


def month_sequence(spark: SparkSession, folder: str) -> DataFrame:
    months = movements(spark, folder).select(
        "corte", F.explode(months_from(F.col("created_at").cast("date"), catalogue.FORM_MONTHS)).alias("mes")
    )
    return months.groupBy("corte", "mes").agg(F.count(F.lit(1)).alias("n"))


# --- rules -------------------------------------------------------------------

_POSTED = ["trx_id", "regla_pos", "accion_pos", "regla_id", "dominio", "corte", "tipo", "concepto", "origen_clave", "bloque", "origen", "delta", "limitado"]


def rule_matches(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_matches(movements(spark, folder), inputs.config()).select("trx_id", "regla_pos", "regla_id", "complementaria")


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    return rules.postings(movements(spark, folder), inputs.config())


def rules_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rules read from JSON files, among them one that requires an origin and one with an unknown operation: the rules of every
    movement, and whether it is held back."""
    config, rows = inputs.configuration_files(spark, run_folder(spark, "config")), movements(spark, folder)
    held = rules.unsupported_movements(rows, config).select("trx_id", F.lit("RETENIDO").alias("regla_id"))
    return rules.rule_matches(rows, config).select("trx_id", "regla_id").unionByName(held)


def rule_deltas(spark: SparkSession, folder: str) -> DataFrame:
    return _postings(spark, folder).filter("por_regla").select(*_POSTED)


def transfer_postings(spark: SparkSession, folder: str) -> DataFrame:
    return _postings(spark, folder).filter(F.col("regla_id") == "TRANSFERENCIA_ENTRE_CUENTAS").select(*_POSTED)


def replicated_postings(spark: SparkSession, folder: str) -> DataFrame:
    return _postings(spark, folder).filter("complementaria").select(*_POSTED)


def default_postings(spark: SparkSession, folder: str) -> DataFrame:
    return _postings(spark, folder).filter(~F.col("por_regla")).select(*[c for c in _POSTED if c != "regla_id"])


# --- ledger ------------------------------------------------------------------

def clamped_balance(spark: SparkSession, folder: str) -> DataFrame:
    steps = rules.postings(movements(spark, folder), inputs.config(), only=rules.limited_kinds(inputs.config()))
    return running_balance(steps).select("trx_id", "regla_pos", "accion_pos", "dominio", "corte", "concepto", "delta", "saldo", "efectivo")


def ledger_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.ledger(spark, folder).select(*KEY, "valor")


def ledger_last_writer(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.ledger(spark, folder).select(*KEY, "bloque", "origen")


def ledger_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Movements before the run date folded first, the later ones merged into that ledger."""
    rows = movements(spark, folder)
    stored = books.consolidate(rows.filter(F.col("created_at") < F.lit(AS_OF)), inputs.config())
    return books.consolidate(rows.filter(F.col("created_at") >= F.lit(AS_OF)), inputs.config(), stored).select(*LEDGER)


def ledger_add(spark: SparkSession, folder: str) -> DataFrame:
    """Every movement added onto the ledger at its own key."""
    rows = movements(spark, folder)
    deltas = rows.select(
        "dominio", "corte", "tipo", "concepto", F.when(F.col("tipo") != "GASTO", F.col("origen")).alias("origen_clave"),
        "bloque", "origen", "valor", F.struct("created_at", "trx_id").alias("seq"),
    )
    return books.add_amounts(inputs.ledger(spark, folder), deltas).select(*KEY, "valor")


def ledger_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Account balances replaced by their absolute values under the opening concept."""
    stored = inputs.ledger(spark, folder)
    new = stored.filter(F.col("tipo") == "CUENTA").withColumn("valor", F.abs("valor"))
    return books.replace_rows(stored, new).select(*KEY, "valor")


def ledger_key_scan(spark: SparkSession, folder: str) -> DataFrame:
    return books.key_scan(inputs.ledger(spark, folder), "CASA", "1998-06", "CUENTA#").select(*KEY, "valor")


def ledger_delete(spark: SparkSession, folder: str) -> DataFrame:
    """A stored ledger after a job deleted two domains' early months and then a month of every domain."""
    path = f"{run_folder(spark, 'ledger-delete')}/ledger"
    write_ledger(inputs.ledger(spark, folder), path)
    stored = read_ledger(spark, path).select("dominio", "corte")
    drop_months(spark, path, stored.filter("corte < '1994-01' AND dominio IN ('CASA', 'AHORRO')").distinct())
    drop_months(spark, path, stored.filter("corte = '1995-06'").distinct())
    return read_ledger(spark, path).select(*KEY, "bloque", "origen", F.col("valor").cast("bigint").alias("valor"))


# --- close -------------------------------------------------------------------

def close_balances(spark: SparkSession, folder: str) -> DataFrame:
    return close.closing_balances(inputs.ledger(spark, folder), inputs.close_config(), AS_OF).select("dominio", "tipo", "origen", "valor")


def close_opening(spark: SparkSession, folder: str) -> DataFrame:
    balances = close.closing_balances(inputs.ledger(spark, folder), inputs.close_config(), AS_OF)
    return close.opening_rows(balances, AS_OF).select(*LEDGER)


def close_carry(spark: SparkSession, folder: str) -> DataFrame:
    return close.carried_rows(inputs.ledger(spark, folder), inputs.close_config(), AS_OF).select(*KEY, "bloque", "valor")


def close_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return close.close_month(inputs.ledger(spark, folder), inputs.close_config(), AS_OF).select(*KEY, "bloque", "valor")


# --- projections -------------------------------------------------------------

def _bases(spark: SparkSession, folder: str) -> DataFrame:
    return movements(spark, folder).select(month_start(F.col("corte")).alias("base")).distinct()


def projection_months(spark: SparkSession, folder: str) -> DataFrame:
    rows = movements(spark, folder)
    months = rows.select("corte", F.explode(projections.projection_months(month_start(F.col("corte")))).alias("mes"))
    return months.groupBy("corte", "mes").agg(F.count(F.lit(1)).alias("n"))


def projection_expand(spark: SparkSession, folder: str) -> DataFrame:
    rows = projections.known_concepts(projections.expand_over(_bases(spark, folder), inputs.config()), inputs.config())
    return rows.select(F.date_format("base", "yyyy-MM").alias("base"), "dominio", "concepto", "corte", "valor")


def projection_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    wanted = projections.expand_over(_bases(spark, folder), inputs.config()).drop("base").distinct()
    return projections.pending(wanted, inputs.existing_projections(spark, folder)).select("dominio", "concepto", "corte", "valor")


def projection_run(spark: SparkSession, folder: str) -> DataFrame:
    rows = projections.new_projections(inputs.existing_projections(spark, folder), inputs.config(), as_of=AS_OF, stamp=AS_OF)
    return rows.select("dominio", "concepto", "corte", "valor", "origen_registro", "tabla")


def projection_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = projections.run_summary(inputs.existing_projections(spark, folder), inputs.config(), as_of=AS_OF)
    return rows.select(
        "corte",
        F.array_join(F.transform("insertados", lambda r: F.concat_ws(":", r["dominio"], r["concepto"], r["valor"].cast("string"))), "|").alias("insertados"),
        F.array_join("omitidos_por_duplicado", "|").alias("omitidos"),
    )


# --- report ------------------------------------------------------------------

def report_sign_adjust(spark: SparkSession, folder: str) -> DataFrame:
    return report.adjust(inputs.ledger(spark, folder)).select(*KEY, "valor", "valor_ajustado")


def report_cash_detail(spark: SparkSession, folder: str) -> DataFrame:
    return report.cash_detail(inputs.ledger(spark, folder), AS_OF)


def report_cash_total(spark: SparkSession, folder: str) -> DataFrame:
    return report.cash_total(inputs.ledger(spark, folder), AS_OF)


def report_projection_detail(spark: SparkSession, folder: str) -> DataFrame:
    return report.projection_detail(inputs.ledger(spark, folder), AS_OF)


def report_projection_total(spark: SparkSession, folder: str) -> DataFrame:
    return report.projection_total(inputs.ledger(spark, folder), AS_OF)


def report_running_projection(spark: SparkSession, folder: str) -> DataFrame:
    return report.running_projection(inputs.ledger(spark, folder), AS_OF)


def report_projected_cash(spark: SparkSession, folder: str) -> DataFrame:
    return report.projected_cash(inputs.ledger(spark, folder), AS_OF)


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return report.report(inputs.ledger(spark, folder), AS_OF)


def report_full(spark: SparkSession, folder: str) -> DataFrame:
    ranked = report.ordered_report(_report(spark, folder))
    return ranked.select("dominio", "corte", "seccion", "concepto", "valor_ajustado", report.section_rank().cast("int").alias("rango"))


# --- documents and search ----------------------------------------------------

def doc_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = _report(spark, folder)
    return rows.groupBy(
        "seccion", documents.record_class().alias("tipo_registro"), documents.block_class().alias("categoria_bloque"),
        documents.is_future(AS_OF).alias("es_futuro"),
    ).agg(F.count(F.lit(1)).alias("n"))


def doc_text(spark: SparkSession, folder: str) -> DataFrame:
    return documents.documents(_report(spark, folder), AS_OF, CENTS).select("id", "texto")


def document_rows(spark: SparkSession, folder: str) -> DataFrame:
    return documents.documents(_report(spark, folder), AS_OF, CENTS).withColumn("valor", F.col("valor").cast("double"))


def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    index = inputs.vector_index(spark, folder)
    return search.nearest_for_all(index, inputs.label_questions(index)).select("question_id", "key", "rank", "score")


def vector_pivots(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whose id is divisible by 50 as a question to the index in blocks around pivots."""
    index = inputs.vector_index(spark, folder)
    asked = index.filter(F.col("key") % 50 == 0).select(F.col("key").alias("question_id"), "embedding")
    blocks, pivots = search.pivot_index(index)
    return search.nearest_by_pivots(blocks, pivots, asked).select("question_id", "key", "rank", "score")


def context_text(spark: SparkSession, folder: str) -> DataFrame:
    index = inputs.vector_index(spark, folder)
    return search.answer_context(index, inputs.label_questions(index))


def index_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as an index, refreshed after some got another text, some another domain, and some are gone."""
    path, rows = f"{run_folder(spark, 'index-refresh')}/index", inputs.table(spark, folder, "documents")
    none, k = F.lit(None).cast("string"), F.col("doc_id")

    def shaped(text, domain) -> DataFrame:
        fields = {c: none for c in index_store.METADATA} | {"dominio": domain, "es_futuro": F.lit(False), "valor": F.lit(0)}
        return rows.select(k.cast("string").alias("id"), text.alias("texto"), *[fields[c].alias(c) for c in index_store.METADATA])

    def embed(changed: DataFrame) -> DataFrame:
        return search.embed_by_hashing(changed, dimension=64)

    before = shaped(F.col("text"), F.col("lang"))
    after = shaped(F.when(k % 5 == 0, F.concat("text", F.lit(" nuevo"))).otherwise(F.col("text")), F.when(k % 11 == 0, "OTRO").otherwise(F.col("lang")))
    index_store.refresh(before.filter("CAST(id AS BIGINT) % 13 <> 0"), path, embed)
    index_store.refresh(after.filter("CAST(id AS BIGINT) % 7 <> 0"), path, embed)
    index_store.refresh(after.filter("CAST(id AS BIGINT) % 7 <> 0"), path, embed)
    found = index_store.read_index(spark, path)
    norm = F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x), 3)
    return found.select(F.col("key").cast("bigint").alias("key"), F.col("metadata.dominio").alias("dominio"), "huella", "vector_de", "lote", norm.alias("norma"))


def question_intake(spark: SparkSession, folder: str) -> DataFrame:
    asked = decode_requests(inputs.interaction_requests(spark, folder))
    return search.valid_questions(asked).select("conv_id", "turn", "channel_id", "user_id", "question")


def embed_hash(spark: SparkSession, folder: str) -> DataFrame:
    embedded = search.embed_by_hashing(inputs.table(spark, folder, "documents"), "text", dimension=256)
    places = embedded.select("doc_id", F.posexplode("embedding").alias("posicion", "peso")).filter("peso <> 0")
    return places.withColumn("peso", F.round(F.col("peso").cast("double"), 6))


# --- calendar ----------------------------------------------------------------

def calendar_run(spark: SparkSession, folder: str) -> DataFrame:
    """The month's and the day's jobs over a stored ledger, run twice: the ledger with its projections, and rows of report, documents
    and index."""
    root = run_folder(spark, "calendar")
    write_ledger(inputs.ledger(spark, folder), f"{root}/ledger")
    job = calendar.Run(spark, inputs.close_config(), root, AS_OF, CENTS, lambda rows: search.embed_by_hashing(rows, dimension=32))
    for _ in range(2):
        calendar.run_calendar(job)
    ledger = read_ledger(spark, job.ledger).select(F.lit("saldo").alias("parte"), *KEY, F.col("valor").cast("bigint").alias("valor"))
    counted = {
        "reporte": files.read_report_csv(spark, f"{root}/reports"), "documentos": files.read_documents(spark, f"{root}/rag"),
        "indice": index_store.read_index(spark, f"{root}/index"),
    }
    for name, rows in counted.items():
        none = [F.lit(None).cast("string").alias(c) for c in KEY]
        ledger = ledger.unionByName(rows.agg(F.count(F.lit(1)).alias("valor")).select(F.lit(name).alias("parte"), *none, "valor"))
    return ledger


# --- dashboard ---------------------------------------------------------------

def dash_filter(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.select_rows(_report(spark, folder), domain="CASA", section="PROYECCION")


def dash_distinct(spark: SparkSession, folder: str) -> DataFrame:
    rows = _report(spark, folder)
    parts = [dashboard.choices(rows, c).select(F.lit(c).alias("columna"), F.col(c).alias("valor")) for c in ("dominio", "corte", "seccion")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dash_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.metrics(_report(spark, folder))


def _as_double(matrix: DataFrame) -> DataFrame:
    return matrix.select("corte", *[F.col(c).cast("double").alias(c.lower()) for c in matrix.columns if c != "corte"])


def dash_month(spark: SparkSession, folder: str) -> DataFrame:
    """The numbers of three months, each chosen as the active one."""
    rows, found = _report(spark, folder), None
    for corte in ("1998-07", "1998-08", "1999-01"):
        part = dashboard.metrics(rows, corte)
        found = part if found is None else found.unionByName(part)
    return found


def dash_evolution(spark: SparkSession, folder: str) -> DataFrame:
    return _as_double(dashboard.evolution(_report(spark, folder), scale=CENTS))


def dash_comparison(spark: SparkSession, folder: str) -> DataFrame:
    rows = _report(spark, folder)
    chosen = dashboard.select_rows(rows, domain="PERSONAL")
    return _as_double(dashboard.comparison(chosen, rows, scale=CENTS))


def dash_top_concepts(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_concepts(_report(spark, folder))


def dash_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.projected_amount(_report(spark, folder), "CASA", "1998-07")


def dash_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _report(spark, folder)
    shown = [dashboard.table_view(rows, CENTS, d).withColumn("decimales", F.lit(d)) for d in (2, 3)]
    return shown[0].unionByName(shown[1])
