"""SQL twins of the contract queries, written against the plain tables.

They share the movement mapping and the configuration values with the queries;
everything the operators do is stated again in SQL.
"""

from quipu.plans.inputs import AS_OF, AUTOMATIC_FROM, CONTRACT_PERSISTENT, config
from quipu.sources.orders import MOVEMENTS_SQL

AS_OF_SQL = f"DATE '{AS_OF}'"
MONTH, CLOSING = "'1998-07'", "'1998-06'"
KEY = "dominio, corte, tipo, concepto, origen_clave"


def _values(rows: list) -> str:
    def show(v):
        return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(show(v) for v in row) + ")" for row in rows)


def _catalogue() -> str:
    return f"cat(dominio, bloque, tipo, nombre, pos) AS (VALUES {_values(config().catalogue_rows())})"


MOV = f"m AS ({MOVEMENTS_SQL.replace('{orders}', 'orders')})"

_R0 = "(tipo = 'CUENTA' AND valor < 0 AND concepto <> 'SALDO_INICIAL' AND dominio NOT IN ('AHORRO', 'INVERSIONES'))"
_R1 = "(tipo = 'TARJETA' AND valor > 0 AND concepto <> 'SALDO_INICIAL')"
_R2 = "(tipo = 'CUENTA' AND valor > 0 AND concepto IN ('INGRESO HOGAR', 'INGRESO SALARIO') AND dominio <> 'INVERSIONES')"
_R3 = "(tipo = 'CUENTA' AND concepto = 'TRANSFERENCIA')"
_KUBO = "(origen = 'KUBO' OR coalesce(cuenta_destino, '') = 'KUBO')"
_R4 = f"(tipo = 'CUENTA' AND dominio = 'CASA' AND {_KUBO})"
_R5 = f"(tipo = 'CUENTA' AND dominio = 'PERSONAL' AND {_KUBO})"
_CONDITIONS = [_R0, _R1, _R2, _R3, _R4, _R5]


def _post(pos, step, condition, domain, kind, concept, block, origin, delta, by_rule=True, complementary=False) -> str:
    rule = f"'{config().rules[pos]['id']}'" if by_rule else "CAST(NULL AS VARCHAR)"
    keyed = "NULL" if kind == "'GASTO'" else f"CASE WHEN {kind} IN ('CUENTA', 'TARJETA') THEN {origin} END"
    limited = f"({block} = 'PROYECCION' AND {delta} < 0)" if by_rule else "false"
    zero = "AND valor <> 0" if by_rule else ""
    return (
        f"SELECT trx_id, created_at, {pos} AS regla_pos, {step} AS accion_pos, {rule} AS regla_id, {domain} AS dominio, corte, "
        f"{kind} AS tipo, {concept} AS concepto, CAST({keyed} AS VARCHAR) AS origen_clave, {block} AS bloque, {origin} AS origen, "
        f"{delta} AS delta, {limited} AS limitado, {str(by_rule).lower()} AS por_regla, {str(complementary).lower()} AS complementaria "
        f"FROM m WHERE {condition} {zero}"
    )


_CARD_TARGET = "((dominio = 'CASA' AND cuenta_destino IN ('TARJETA VISA BDO', 'TARJETA MASTERCARD BDO')) OR (dominio = 'PERSONAL' AND cuenta_destino IN ('TARJETA VISA BDO', 'TARJETA MASTERCARD BDO', 'TARJETA MASTERCARD NU')))"
_DOWN, _UP = "-abs(valor)", "abs(valor)"
_POSTS = " UNION ALL ".join(
    [
        _post(0, 0, _R0, "dominio", "'GASTO'", "concepto", "'PROYECCION'", "origen", _DOWN),
        _post(0, 1, _R0, "dominio", "'CUENTA'", "concepto", "'CAJA_ACTUAL'", "origen", _DOWN),
        _post(1, 0, _R1, "dominio", "'GASTO'", "concepto", "'PROYECCION'", "origen", _DOWN),
        _post(1, 1, _R1, "dominio", "'TARJETA'", "concepto", "'CAJA_ACTUAL'", "origen", _UP),
        _post(2, 0, _R2, "dominio", "'GASTO'", "concepto", "'PROYECCION'", "origen", _DOWN),
        _post(2, 1, _R2, "dominio", "'CUENTA'", "concepto", "'CAJA_ACTUAL'", "origen", _UP),
        _post(3, 0, _R3, "dominio", "'CUENTA'", "concepto", "'CAJA_ACTUAL'", "origen", _DOWN),
        _post(3, 1, f"{_R3} AND cuenta_destino IS NOT NULL", "dominio", "'CUENTA'", "concepto", "'CAJA_ACTUAL'", "cuenta_destino",
              f"CASE WHEN {_CARD_TARGET} THEN {_DOWN} ELSE {_UP} END"),
        _post(4, 0, _R4, "'AHORRO'", "'CUENTA'", "'SALDO APTO'", "'CAJA_ACTUAL'", "'KUBO'", "valor", True, True),
        _post(5, 0, _R5, "'AHORRO'", "'CUENTA'", "'AHORRO JOHAO'", "'CAJA_ACTUAL'", "'KUBO'", "valor", True, True),
        _post(6, 0, f"NOT ({_R0} OR {_R1} OR {_R2} OR {_R3})", "dominio", "tipo", "concepto", "bloque",
              "CASE WHEN tipo IN ('CUENTA', 'TARJETA') THEN origen END", "valor", False),
    ]
)
POST = f"{MOV}, p AS ({_POSTS})"

_ORDER = "created_at, trx_id, regla_pos, accion_pos"
_RUN = f"""r1 AS (SELECT *, sum(delta) OVER (PARTITION BY {KEY} ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) AS s FROM p),
r2 AS (SELECT *, min(CASE WHEN limitado THEN s END) OVER (PARTITION BY {KEY} ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) AS lo FROM r1),
r3 AS (SELECT *, s - least(0, coalesce(lo, 0)) AS saldo FROM r2),
r4 AS (SELECT *, saldo - coalesce(lag(saldo) OVER (PARTITION BY {KEY} ORDER BY {_ORDER}), 0) AS efectivo FROM r3)"""
LED = f"""{POST}, {_RUN},
w AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY created_at DESC, trx_id DESC, regla_pos DESC, accion_pos DESC) AS rn,
      sum(efectivo) OVER (PARTITION BY {KEY}) AS total FROM r4 WHERE NOT por_regla OR efectivo <> 0),
led AS (SELECT {KEY}, bloque, origen, CAST(total AS BIGINT) AS valor FROM w WHERE rn = 1)"""

_ADJUST = """CASE WHEN bloque = 'CAJA_ACTUAL' AND contains(upper(origen), 'TARJETA') THEN -valor
 WHEN tipo = 'GASTO' AND NOT contains(upper(concepto), 'INGRESO') THEN -valor ELSE valor END"""
REP = f"""{LED}, adj AS (SELECT *, {_ADJUST} AS va FROM led),
cd AS (SELECT dominio, {MONTH} AS corte, 'CAJA_ACTUAL' AS seccion, origen AS concepto, CAST(sum(va) AS BIGINT) AS valor_ajustado
       FROM adj WHERE bloque = 'CAJA_ACTUAL' GROUP BY dominio, origen),
ct AS (SELECT dominio, {MONTH} AS corte, 'TOTAL_CAJA_ACTUAL' AS seccion, '' AS concepto, CAST(sum(valor_ajustado) AS BIGINT) AS valor_ajustado
       FROM cd GROUP BY dominio),
pd AS (SELECT dominio, corte, 'PROYECCION' AS seccion, concepto, CAST(va AS BIGINT) AS valor_ajustado
       FROM adj WHERE bloque = 'PROYECCION' AND corte >= {MONTH}),
pt AS (SELECT dominio, corte, CAST(sum(valor_ajustado) AS BIGINT) AS total_proyeccion FROM pd GROUP BY dominio, corte),
pr AS (SELECT *, CAST(sum(total_proyeccion) OVER (PARTITION BY dominio ORDER BY corte ROWS UNBOUNDED PRECEDING) AS BIGINT) AS acumulado FROM pt),
pc AS (SELECT pr.dominio, pr.corte, 'CAJA_PROYECTADA_A_CORTE_' || pr.corte AS seccion, '' AS concepto,
       CAST(ct.valor_ajustado + pr.acumulado AS BIGINT) AS valor_ajustado FROM pr LEFT JOIN ct ON pr.dominio = ct.dominio),
rep AS (SELECT * FROM cd UNION ALL SELECT * FROM ct UNION ALL SELECT * FROM pd UNION ALL SELECT * FROM pc)"""

_TYPE = "CASE WHEN concepto = '' THEN 'TOTAL' ELSE 'DETALLE' END"
_BLOCK = "CASE WHEN seccion LIKE '%CAJA_ACTUAL%' THEN 'CAJA_ACTUAL' WHEN seccion LIKE '%PROYECCION%' THEN 'PROYECCION' ELSE 'OTRO' END"
_UNITS = "CAST(round_even(valor_ajustado / 100.0, 0) AS BIGINT)"
_NUMBER = f"CASE WHEN valor_ajustado < 0 AND {_UNITS} = 0 THEN '-0' ELSE format('{{:,}}', {_UNITS}) END"
DOC = f"""{REP}, doc AS (SELECT concat_ws('_', dominio, corte, seccion, concepto) AS id, dominio, corte, {_BLOCK} AS categoria_bloque,
 {_TYPE} AS tipo_registro, corte >= {MONTH} AS es_futuro, seccion, concepto, CAST(valor_ajustado / 100.0 AS DOUBLE) AS valor,
 'Dominio financiero: ' || dominio || '. Periodo: ' || corte || '. Sección: ' || seccion || '. ' ||
 CASE WHEN concepto <> '' THEN 'Concepto: ' || concepto || '. ' ELSE '' END || 'Tipo registro: ' || {_TYPE} ||
 '. Valor calculado: ' || {_NUMBER} AS texto FROM rep)"""

# Thousandths of a million, rounded half away from zero, from cents.
_MILLI = "(CASE WHEN valor_ajustado < 0 THEN -1 ELSE 1 END * ((abs(valor_ajustado) + 50000) // 100000))"
_PROJECTED = "seccion = 'CAJA_PROYECTADA_A_CORTE_' || corte"
_CHARTED = [d for d in config().domains if d != "INVERSIONES"]
_CELLS = ", ".join(
    f"max(CASE WHEN {_PROJECTED} AND dominio = '{d}' THEN {_MILLI} / 1000.0 END) AS {d.lower()}" for d in _CHARTED
)

_TRIM = "' ' || chr(9) || chr(10) || chr(13)"


def _listed(domain: str, name: str, block: str) -> str:
    return f"EXISTS (SELECT 1 FROM cat WHERE cat.dominio = {domain} AND cat.bloque = {block} AND cat.nombre = {name})"


_ORIGIN = "coalesce(origen, concepto)"
_TARGET = "CASE WHEN dominio = 'PERSONAL' AND origen = 'EFECTIVO' THEN origen WHEN dominio = 'CASA' AND origen = 'EFECTIVO' THEN NULL ELSE cuenta_destino END"
ACCOUNT = f"""{MOV}, {_catalogue()}, q AS (SELECT trx_id, {_ORIGIN} AS cuenta, concepto AS descripcion, dominio, {_TARGET} AS destino, valor FROM m),
a AS (SELECT *, CASE
 WHEN valor = 0 THEN 'Campos obligatorios faltantes'
 WHEN NOT {_listed('q.dominio', 'q.cuenta', "'CAJA_ACTUAL'")} THEN 'Cuenta no permitida para el dominio'
 WHEN NOT {_listed('q.dominio', 'q.descripcion', "CASE WHEN q.dominio = 'INVERSIONES' THEN 'CAJA_ACTUAL' ELSE 'PROYECCION' END")} THEN 'Concepto no permitido según el catálogo'
 WHEN descripcion = 'TRANSFERENCIA' AND destino IS NULL THEN 'CuentaDestino es obligatorio para transferencias'
 WHEN descripcion = 'TRANSFERENCIA' AND NOT {_listed('q.dominio', 'q.destino', "'CAJA_ACTUAL'")} THEN 'CuentaDestino no permitida para el dominio'
 WHEN descripcion = 'TRANSFERENCIA' AND destino = cuenta THEN 'CuentaDestino no puede ser igual a la cuenta origen'
 END AS razon FROM q)"""
CARD = f"""{MOV}, {_catalogue()}, q AS (SELECT trx_id, coalesce(origen, 'TARJETA MASTERCARD NU') AS franquicia, dominio, concepto, tipo, valor FROM m),
c AS (SELECT *, CASE
 WHEN tipo = 'GASTO' THEN 'Valor debe ser numérico'
 WHEN dominio NOT IN ('CASA', 'PERSONAL') THEN 'Tipo ''TARJETA'' no configurado en ''CAJA_ACTUAL'' para dominio ''' || dominio || ''''
 WHEN NOT EXISTS (SELECT 1 FROM cat WHERE cat.dominio = q.dominio AND cat.tipo = 'TARJETA' AND cat.nombre = q.franquicia) THEN 'Franquicia no permitida para el dominio'
 WHEN NOT {_listed('q.dominio', 'q.concepto', "'PROYECCION'")} THEN 'Concepto no permitido según el catálogo'
 END AS razon FROM q)"""
PROJECTION = f"""{MOV}, {_catalogue()}, q AS (SELECT trx_id, CASE WHEN tipo = 'TARJETA' THEN 'OTRO' ELSE dominio END AS dominio, concepto, valor FROM m),
j AS (SELECT *, CASE
 WHEN valor = 0 THEN 'Campos obligatorios faltantes'
 WHEN dominio = 'OTRO' THEN 'Dominio inválido: OTRO'
 WHEN dominio = 'INVERSIONES' THEN 'Bloque ''PROYECCION'' no configurado para dominio ''INVERSIONES'''
 WHEN NOT {_listed('q.dominio', 'q.concepto', "'PROYECCION'")} THEN 'Concepto no permitido según el catálogo'
 END AS razon FROM q)"""


def _code(reason: str = "razon") -> str:
    return f"CASE WHEN {reason} IS NULL THEN NULL WHEN {reason} LIKE '%no configurado%' THEN 500 ELSE 400 END"


_RECORD = """CASE WHEN tipo = 'TARJETA' THEN 'MOVIMIENTO_TARJETA' WHEN tipo = 'GASTO' AND dominio = 'AHORRO' THEN 'OTRO'
 WHEN tipo = 'GASTO' THEN 'PROYECCION' WHEN concepto = 'TRANSFERENCIA' THEN 'TRANSFERENCIA' ELSE 'MOVIMIENTO_GENERAL' END"""
_AMOUNT_TEXT = "CASE WHEN concepto = 'AUTOMOVIL' THEN CAST(valor AS VARCHAR) || '.5' ELSE CAST(valor AS VARCHAR) END"
FORM = f"""{MOV}, f AS (SELECT trx_id, {_RECORD} AS tipo_registro, dominio, corte, origen AS cuenta, cuenta_destino, concepto,
 'trx ' || CAST(trx_id AS VARCHAR) AS descripcion, {_AMOUNT_TEXT} AS valor FROM m)"""

_CLOSE_CARRY = " OR ".join(
    f"(dominio = '{d}' AND concepto IN ({', '.join(chr(39) + c + chr(39) for c in names)}))" for d, names in CONTRACT_PERSISTENT.items()
)
CLOSE = f"""{LED}, {_catalogue()}, bal AS (SELECT led.dominio, cat.tipo, led.origen, CAST(sum(led.valor) AS BIGINT) AS valor
 FROM led JOIN cat ON cat.dominio = led.dominio AND cat.bloque = 'CAJA_ACTUAL' AND cat.tipo IN ('CUENTA', 'TARJETA') AND cat.nombre = led.origen
 WHERE led.corte = {CLOSING} AND led.tipo = cat.tipo GROUP BY led.dominio, cat.tipo, led.origen HAVING sum(led.valor) <> 0),
opening AS (SELECT dominio, {MONTH} AS corte, tipo, 'SALDO_INICIAL' AS concepto, origen AS origen_clave, 'CAJA_ACTUAL' AS bloque, origen, valor FROM bal),
carry AS (SELECT dominio, {MONTH} AS corte, tipo, concepto, origen_clave, 'PROYECCION' AS bloque, valor
 FROM led WHERE corte = {CLOSING} AND tipo = 'GASTO' AND valor <> 0 AND ({_CLOSE_CARRY}))"""

_PROJECTION_ROWS = _values([(d, c, v) for d, cs in config().projections.items() for c, v in cs.items()])
_ADD = "strftime(CAST(CAST({0} || '-01' AS DATE) + to_months({1}) AS DATE), '%Y-%m')"
PROJ = f"""{MOV}, {_catalogue()}, fp(dominio, concepto, valor) AS (VALUES {_PROJECTION_ROWS}), n(i) AS (VALUES (1), (2), (3)),
bases AS (SELECT DISTINCT corte AS base FROM m),
ex AS (SELECT base, fp.dominio, fp.concepto, {_ADD.format('base', 'i')} AS corte, CAST(fp.valor AS BIGINT) AS valor FROM bases, fp, n),
existing AS (SELECT dominio, corte FROM m WHERE tipo = 'GASTO' AND valor >= {AUTOMATIC_FROM})"""

_SCORE = "round(list_dot_product(CAST(v.embedding AS DOUBLE[]), c.embedding) / (sqrt(list_dot_product(CAST(v.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[]))) * sqrt(list_dot_product(c.embedding, c.embedding))), 12)"
HITS = f"""e AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM e GROUP BY label, i),
c AS (SELECT label AS question_id, list(x ORDER BY i) AS embedding FROM means GROUP BY label),
sc AS (SELECT c.question_id, v.vec_id AS key, v.label, {_SCORE} AS score FROM embeddings v, c),
rk AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, key) AS rank FROM sc),
hits AS (SELECT * FROM rk WHERE rank <= 5)"""

_REQ = """req AS (SELECT *, 'C' || CAST(conv_id AS VARCHAR) AS canal, CAST(conv_id AS VARCHAR) AS usuario FROM conversations)"""
_CHANNEL = "CASE WHEN dominio <> 'AHORRO' THEN 'C' || dominio END"


def oracle_sql() -> dict:
    q = {}

    q["ledger_scan"] = f"""WITH {LED} SELECT dominio || '#' || corte AS Dominio_Corte, concat_ws('#', tipo, concepto, origen_clave) AS Tipo_Concepto,
 dominio, corte, bloque, valor FROM led"""
    q["change_decode"] = f"WITH {MOV} SELECT trx_id, dominio, corte, tipo, bloque, concepto, origen, cuenta_destino, valor FROM m"
    q["source_context"] = f"""WITH {MOV}, t AS (SELECT *, CASE WHEN tipo = 'TARJETA' THEN 'HistorialTarjetas_modules_IAC'
 WHEN tipo = 'CUENTA' THEN 'HistoriaCuentasAltoRendimiento_modules_IAC' WHEN dominio = 'CASA' THEN 'ConceptosFijosObligaciones_modules_IAC'
 ELSE 'ConceptosFijosPersonal_modules_IAC' END AS tabla FROM m),
 u AS (SELECT tabla, tipo, bloque, valor FROM t UNION ALL SELECT tabla, NULL, NULL, NULL FROM t WHERE tipo = 'GASTO'
 UNION ALL SELECT 'OtraTabla', NULL, NULL, NULL FROM t WHERE tipo = 'GASTO')
 SELECT tabla, tipo, bloque, count(*) AS n, CAST(sum(valor) AS BIGINT) AS total FROM u GROUP BY tabla, tipo, bloque"""
    q["catalogue_dim"] = f"""WITH {MOV}, {_catalogue()}, u AS (SELECT dominio, 'CAJA_ACTUAL' AS bloque, origen AS nombre, valor FROM m
 UNION ALL SELECT dominio, 'PROYECCION', concepto, valor FROM m),
 g AS (SELECT dominio, bloque, nombre, count(*) AS usos, CAST(sum(valor) AS BIGINT) AS total FROM u GROUP BY dominio, bloque, nombre)
 SELECT cat.dominio, cat.bloque, cat.tipo, cat.nombre, CAST(cat.pos AS INTEGER) AS pos, coalesce(usos, 0) AS usos, coalesce(total, 0) AS total
 FROM cat LEFT JOIN g ON cat.dominio = g.dominio AND cat.bloque = g.bloque AND cat.nombre = g.nombre"""
    q["csv_roundtrip"] = f"WITH {REP} SELECT dominio, corte, seccion, coalesce(concepto, '') AS concepto, valor_ajustado FROM rep"
    q["jsonl_roundtrip"] = f"WITH {DOC} SELECT * FROM doc"

    q["envelope_normalise"] = f"""WITH {MOV} SELECT 'movimiento' AS origin, trx_id AS id,
 CASE tipo WHEN 'CUENTA' THEN 'eventbridge' WHEN 'TARJETA' THEN 'apigateway' ELSE 'unknown' END AS source,
 CASE tipo WHEN 'CUENTA' THEN corte WHEN 'TARJETA' THEN dominio END AS user_id, CASE tipo WHEN 'CUENTA' THEN dominio END AS channel_id,
 origen AS cuenta, dominio, CAST(valor AS VARCHAR) AS valor FROM m
 UNION ALL SELECT 'evento', event_id, CASE WHEN event_type = 'signup' THEN 'unknown' ELSE 'apigateway' END,
 CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END, NULL,
 CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END, NULL, NULL FROM events"""
    q["request_decode"] = f"""WITH {_REQ} SELECT conv_id, turn,
 CASE role WHEN 'user' THEN 'submission' WHEN 'assistant' THEN 'command' ELSE 'block_action' END AS request_class,
 CASE role WHEN 'assistant' THEN '/consulta' END AS command, CASE WHEN role IN ('user', 'assistant') THEN canal END AS channel_id,
 CASE role WHEN 'user' THEN 'consulta_financiera' END AS callback_id, CASE role WHEN 'user' THEN usuario END AS user_id,
 CASE role WHEN 'user' THEN text END AS question FROM req"""
    q["form_states"] = f"WITH {FORM} SELECT * FROM f"
    q["route_events"] = f"""WITH {FORM}, g AS (SELECT *, CASE WHEN tipo_registro = 'OTRO' THEN 'Tipo de registro no soportado: OTRO'
 WHEN concepto = 'AUTOMOVIL' THEN 'Valor no es un entero' END AS err, tipo_registro AS t FROM f)
 SELECT trx_id, CASE WHEN err IS NULL THEN CASE t WHEN 'MOVIMIENTO_TARJETA' THEN 'movimiento.tarjeta.registrado'
 WHEN 'PROYECCION' THEN 'proyeccion.registrado' ELSE 'movimiento.general.registrado' END END AS event_type, err AS route_error,
 CASE WHEN err IS NULL AND t IN ('MOVIMIENTO_GENERAL', 'TRANSFERENCIA') THEN cuenta END AS Cuenta,
 CASE WHEN err IS NULL AND t = 'TRANSFERENCIA' THEN cuenta_destino END AS CuentaDestino,
 CASE WHEN err IS NULL AND t = 'MOVIMIENTO_TARJETA' THEN cuenta END AS Franquicia,
 CASE WHEN err IS NULL THEN CASE t WHEN 'MOVIMIENTO_GENERAL' THEN CASE WHEN dominio = 'INVERSIONES' THEN cuenta ELSE concepto END
  WHEN 'TRANSFERENCIA' THEN 'TRANSFERENCIA' WHEN 'MOVIMIENTO_TARJETA' THEN concepto END END AS Descripcion,
 CASE WHEN err IS NULL AND t = 'PROYECCION' THEN concepto END AS Concepto,
 CASE WHEN err IS NULL THEN descripcion END AS Subconcepto, CASE WHEN err IS NULL THEN TRY_CAST(valor AS BIGINT) END AS Valor,
 CASE WHEN err IS NULL THEN '{AS_OF}' END AS FechaMovimiento, CASE WHEN err IS NULL THEN corte END AS Corte,
 CASE WHEN err IS NULL THEN dominio END AS DominioFinanciero FROM g"""
    q["outbox_messages"] = f"""WITH {MOV} SELECT 'C' || dominio AS channel_id, 'movimiento.cuenta.confirmado' AS detail_type,
 '📬 Nuevo registro — Controlador Financiero' AS titulo,
 '*Tipo:*' || chr(10) || 'movimiento.cuenta.confirmado|*Dominio:*' || chr(10) || dominio || '|*Concepto:*' || chr(10) || concepto ||
 '|*Valor:*' || chr(10) || '$' || CAST(valor AS VARCHAR) || '|*Corte:*' || chr(10) || corte || '|*Usuario:*' || chr(10) ||
 CASE WHEN tipo = 'TARJETA' THEN origen ELSE 'None' END AS lineas,
 '🔎 Source: `eventbridge` | 🆔 `' || CAST(trx_id AS VARCHAR) || '`' AS pie FROM m WHERE tipo <> 'GASTO' AND dominio <> 'AHORRO'"""

    q["validate_required"] = f"""WITH {MOV} SELECT trx_id, concat_ws(',', CASE WHEN origen = 'NEQUI' THEN 'Cuenta' END,
 CASE WHEN concepto = 'AUTOMOVIL' THEN 'Descripcion' END, CASE WHEN concepto = 'SALUD' OR (concepto <> 'SERVICIOS' AND valor = 0) THEN 'Valor' END,
 CASE WHEN tipo = 'GASTO' THEN 'FechaMovimiento' END) AS faltantes FROM m"""
    q["validate_account"] = f"""WITH {ACCOUNT} SELECT trx_id, cuenta, descripcion, 'NOTA' AS subconcepto, dominio, {_code()} AS reject_code, razon AS reject_reason FROM a"""
    q["validate_card"] = f"WITH {CARD} SELECT trx_id, franquicia, dominio, {_code()} AS reject_code, razon AS reject_reason FROM c"
    q["validate_concept"] = f"""WITH {PROJECTION} SELECT trx_id, dominio, concepto, CASE WHEN dominio = 'CASA' THEN 'conceptos_fijos'
 WHEN dominio <> 'OTRO' THEN 'conceptos_fijos_persona' END AS tabla, {_code()} AS reject_code, razon AS reject_reason FROM j"""
    q["validate_transfer"] = f"""WITH {ACCOUNT} SELECT trx_id, dominio, cuenta, destino AS cuenta_destino, razon AS reject_reason FROM a WHERE descripcion = 'TRANSFERENCIA'"""
    q["validate_form"] = f"""WITH {FORM}, {_catalogue()} SELECT trx_id,
 CASE WHEN tipo_registro = 'OTRO' THEN 'Tipo de registro inválido' END AS error_tipo_registro, CAST(NULL AS VARCHAR) AS error_dominio,
 CASE WHEN tipo_registro IN ('MOVIMIENTO_GENERAL', 'MOVIMIENTO_TARJETA', 'TRANSFERENCIA') THEN CASE WHEN cuenta IS NULL THEN 'La cuenta es obligatoria'
  WHEN NOT {_listed('f.dominio', 'f.cuenta', "'CAJA_ACTUAL'")} THEN 'Cuenta no válida para este dominio' END
  WHEN tipo_registro = 'PROYECCION' AND cuenta IS NOT NULL THEN 'Este tipo de registro no permite cuenta' END AS error_cuenta,
 CASE WHEN tipo_registro = 'TRANSFERENCIA' THEN CASE WHEN cuenta_destino IS NULL THEN 'La cuenta destino es obligatoria para transferencias'
  WHEN NOT {_listed('f.dominio', 'f.cuenta_destino', "'CAJA_ACTUAL'")} THEN 'Cuenta destino no válida para este dominio'
  WHEN cuenta_destino = cuenta THEN 'La cuenta destino no puede ser igual a la cuenta origen' END END AS error_cuenta_destino,
 CASE WHEN tipo_registro IN ('MOVIMIENTO_GENERAL', 'MOVIMIENTO_TARJETA', 'PROYECCION') AND dominio <> 'INVERSIONES'
  AND NOT {_listed('f.dominio', 'f.concepto', "'PROYECCION'")} THEN 'Concepto no válido para este dominio' END AS error_concepto FROM f"""
    other = "CASE trx_id % 10 WHEN 0 THEN 'OTRO' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE dominio END"
    shown = q["validate_form"].replace(FORM, f"{FORM.replace('f AS (', 'f0 AS (')}, f AS (SELECT * REPLACE ({other} AS dominio) FROM f0)")
    go = "coalesce(dominio, '') <> '' AND dominio <> 'OTRO'"
    fields = ", ".join(f"CASE WHEN {go} THEN error_{c} END AS error_{c}" for c in ("cuenta", "cuenta_destino", "concepto"))
    q["form_domains"] = f"""SELECT c.trx_id, CASE WHEN coalesce(f.dominio, '') <> '' THEN error_tipo_registro END AS error_tipo_registro,
 CASE WHEN coalesce(f.dominio, '') = '' THEN 'Debes seleccionar un dominio'
 WHEN f.dominio = 'OTRO' AND error_tipo_registro IS NULL THEN 'Dominio ''OTRO'' no existe en el catálogo' END AS error_dominio,
 {fields} FROM ({shown}) c JOIN (SELECT o_orderkey AS trx_id, {other.replace('trx_id', 'o_orderkey').replace('dominio', chr(39) + 'x' + chr(39))} AS dominio FROM orders) f USING (trx_id)"""
    q["new_files"] = """WITH p AS (SELECT page_id, page_id % 4 AS k, 'rag/año ' || CAST(page_id AS VARCHAR) || '/' || coalesce(url, 'x') AS key FROM pages)
 SELECT page_id, CASE k WHEN 0 THEN 'cubo' WHEN 1 THEN 'otro' END AS bucket, CASE WHEN k < 2 THEN key END AS file_key,
 CASE WHEN k >= 2 THEN 'Evento inválido' END AS location_error FROM p"""
    split = " UNION ALL ".join(
        f"""SELECT '{kind}' AS clase, dominio, CASE WHEN razon IS NULL THEN 'aceptado' ELSE 'cuarentena' END AS salida,
 coalesce({_code()}, 200) AS codigo, {value} AS valor FROM {name}"""
        for kind, name, value in (("cuenta", "a", "valor"), ("tarjeta", "c", "CASE WHEN tipo <> 'GASTO' THEN valor END"), ("proyeccion", "j", "valor"))
    )
    cards = CARD.replace(f"{MOV}, {_catalogue()}, q AS", "q2 AS").replace("q.", "q2.").replace("FROM q)", "FROM q2)")
    projections = PROJECTION.replace(f"{MOV}, {_catalogue()}, q AS", "q3 AS").replace("q.", "q3.").replace("FROM q)", "FROM q3)")
    number = "CASE trx_id % 40 WHEN 1 THEN 1.005 WHEN 2 THEN 12345678901234567890.25 WHEN 3 THEN NULL ELSE valor END"
    odd = ACCOUNT.replace("a AS (SELECT *, CASE\n", f"a AS (SELECT * REPLACE (CAST({number} AS DECIMAL(38,6)) AS valor), CASE WHEN trx_id % 40 = 3 THEN 'Valor fuera de rango'\n")
    q["ingest_split"] = f"""WITH {odd}, {cards}, {projections}, s AS ({split})
 SELECT clase, dominio, salida, codigo, count(*) AS n, CAST(CAST(coalesce(sum(valor), 0) AS DECIMAL(38,6)) AS VARCHAR) AS total
 FROM s GROUP BY clase, dominio, salida, codigo"""

    q["catalogue_names"] = f"""WITH {MOV}, {_catalogue()}, g AS (SELECT dominio, count(*) AS movimientos FROM m GROUP BY dominio)
 SELECT cat.dominio, cat.bloque, cat.nombre, CAST(cat.pos AS INTEGER) AS pos, coalesce(g.movimientos, 0) AS movimientos FROM cat LEFT JOIN g ON cat.dominio = g.dominio"""
    q["catalogue_kind"] = f"""WITH {MOV}, {_catalogue()}, g AS (SELECT dominio, origen, count(*) AS n FROM m GROUP BY dominio, origen)
 SELECT cat.dominio, cat.tipo, cat.nombre, coalesce(g.n, 0) AS movimientos FROM cat LEFT JOIN g ON g.dominio = cat.dominio AND g.origen = cat.nombre
 WHERE cat.bloque = 'CAJA_ACTUAL'"""
    q["catalogue_type"] = f"""WITH {MOV}, {_catalogue()}, d AS (SELECT dominio, nombre, arg_min(tipo, pos) AS tipo FROM cat WHERE bloque = 'CAJA_ACTUAL' GROUP BY dominio, nombre)
 SELECT m.trx_id, m.dominio, m.cuenta_destino, d.tipo AS tipo_destino FROM m LEFT JOIN d ON m.dominio = d.dominio AND m.cuenta_destino = d.nombre"""
    q["selectable_values"] = f"""WITH {MOV}, {_catalogue()}, t(tipo_registro, clase, bloque) AS (VALUES
 ('MOVIMIENTO_GENERAL', 'cuenta', 'CAJA_ACTUAL'), ('MOVIMIENTO_TARJETA', 'cuenta', 'CAJA_ACTUAL'), ('TRANSFERENCIA', 'cuenta', 'CAJA_ACTUAL'),
 ('TRANSFERENCIA', 'cuenta_destino', 'CAJA_ACTUAL'), ('MOVIMIENTO_GENERAL', 'concepto', 'PROYECCION'), ('MOVIMIENTO_TARJETA', 'concepto', 'PROYECCION'),
 ('PROYECCION', 'concepto', 'PROYECCION'), ('TRANSFERENCIA', 'concepto', 'PROYECCION')),
 u AS (SELECT dominio, 'cuenta' AS clase, origen AS nombre FROM m UNION ALL SELECT dominio, 'concepto', concepto FROM m
 UNION ALL SELECT dominio, 'cuenta_destino', cuenta_destino FROM m), g AS (SELECT dominio, clase, nombre, count(*) AS usos FROM u GROUP BY dominio, clase, nombre)
 SELECT t.tipo_registro, cat.dominio, t.clase, cat.nombre, CAST(cat.pos AS INTEGER) AS pos, coalesce(g.usos, 0) AS usos FROM cat JOIN t ON cat.bloque = t.bloque
 LEFT JOIN g ON g.dominio = cat.dominio AND g.clase = t.clase AND g.nombre = cat.nombre"""
    q["month_sequence"] = f"""WITH {MOV}, n(i) AS (VALUES (0), (1), (2), (3), (4), (5))
 SELECT corte, {_ADD.format('corte', 'i')} AS mes, count(*) AS n FROM m, n GROUP BY corte, mes"""

    hits = " UNION ALL ".join(
        f"SELECT trx_id, {i} AS regla_pos, '{rule['id']}' AS regla_id, {str(rule.get('tipo') == 'COMPLEMENTARIA').lower()} AS complementaria FROM m WHERE {_CONDITIONS[i]}"
        for i, rule in enumerate(config().rules)
    )
    q["rule_matches"] = f"WITH {MOV} {hits}"
    plain = hits.replace(f" AS regla_pos", " AS pos")
    added = {
        "SIN_ORIGEN": "tipo = 'GASTO' AND valor > 0 AND concepto = 'SALUD'",
        "TARJETA_CON_ORIGEN": "tipo = 'TARJETA' AND valor > 0 AND concepto = 'SERVICIOS'",
        "OTRA": "tipo = 'TARJETA' AND valor > 0 AND concepto = 'SALUD'",
        "RETENIDO": "tipo = 'TARJETA' AND valor > 0 AND concepto = 'SALUD'",
    }
    q["rules_from_files"] = f"WITH {MOV} SELECT trx_id, regla_id FROM ({plain}) UNION ALL " + " UNION ALL ".join(
        f"SELECT trx_id, '{name}' FROM m WHERE {condition}" for name, condition in added.items()
    )
    posted = "trx_id, regla_pos, accion_pos, regla_id, dominio, corte, tipo, concepto, origen_clave, bloque, origen, delta, limitado"
    q["rule_deltas"] = f"WITH {POST} SELECT {posted} FROM p WHERE por_regla"
    q["transfer_postings"] = f"WITH {POST} SELECT {posted} FROM p WHERE regla_pos = 3"
    q["replicated_postings"] = f"WITH {POST} SELECT {posted} FROM p WHERE complementaria"
    q["default_postings"] = f"WITH {POST} SELECT {posted.replace('regla_id, ', '')} FROM p WHERE NOT por_regla"

    q["clamped_balance"] = f"""WITH {POST}, {_RUN} SELECT trx_id, regla_pos, accion_pos, dominio, corte, concepto, CAST(delta AS BIGINT) AS delta,
 CAST(saldo AS BIGINT) AS saldo, CAST(efectivo AS BIGINT) AS efectivo FROM r4 WHERE tipo = 'GASTO'"""
    q["ledger_snapshot"] = f"WITH {LED} SELECT {KEY}, valor FROM led"
    q["ledger_last_writer"] = f"WITH {LED} SELECT {KEY}, bloque, origen FROM led"
    q["ledger_merge"] = f"WITH {LED} SELECT {KEY}, bloque, origen, valor FROM led"
    q["ledger_add"] = f"""WITH {LED}, u AS (SELECT {KEY}, valor FROM led UNION ALL
 SELECT dominio, corte, tipo, concepto, CASE WHEN tipo <> 'GASTO' THEN origen END, valor FROM m)
 SELECT {KEY}, CAST(sum(valor) AS BIGINT) AS valor FROM u GROUP BY {KEY}"""
    q["ledger_replace"] = f"WITH {LED} SELECT {KEY}, CASE WHEN tipo = 'CUENTA' THEN abs(valor) ELSE valor END AS valor FROM led"
    q["ledger_key_scan"] = f"WITH {LED} SELECT {KEY}, valor FROM led WHERE dominio = 'CASA' AND corte = '1998-06' AND tipo = 'CUENTA'"

    q["close_balances"] = f"WITH {CLOSE} SELECT dominio, tipo, origen, valor FROM bal"
    q["close_opening"] = f"WITH {CLOSE} SELECT {KEY}, bloque, origen, valor FROM opening"
    q["close_carry"] = f"WITH {CLOSE} SELECT {KEY}, bloque, valor FROM carry"
    q["close_snapshot"] = f"""WITH {CLOSE}, kept AS (SELECT {KEY}, bloque, valor FROM led WHERE corte <> {CLOSING}
 AND NOT EXISTS (SELECT 1 FROM opening o WHERE o.dominio = led.dominio AND o.corte = led.corte AND o.tipo = led.tipo AND o.concepto = led.concepto
 AND o.origen_clave IS NOT DISTINCT FROM led.origen_clave)), merged AS (SELECT * FROM kept UNION ALL SELECT * FROM carry)
 SELECT {KEY}, bloque, valor FROM opening UNION ALL SELECT {KEY}, max(bloque), CAST(sum(valor) AS BIGINT) FROM merged GROUP BY {KEY}"""

    q["projection_months"] = f"""WITH {MOV}, n(i) AS (VALUES (1), (2), (3)) SELECT corte, {_ADD.format('corte', 'i')} AS mes, count(*) AS n FROM m, n GROUP BY corte, mes"""
    q["projection_expand"] = f"WITH {PROJ} SELECT base, dominio, concepto, corte, valor FROM ex"
    q["projection_idempotent"] = f"""WITH {PROJ} SELECT DISTINCT dominio, concepto, corte, valor FROM ex
 WHERE NOT EXISTS (SELECT 1 FROM existing x WHERE x.dominio = ex.dominio AND x.corte = ex.corte)"""
    q["projection_run"] = f"""WITH {PROJ} SELECT DISTINCT dominio, concepto, corte, valor, 'PROYECCION_AUTOMATICA' AS origen_registro,
 CASE WHEN dominio = 'CASA' THEN 'conceptos_fijos' ELSE 'conceptos_fijos_persona' END AS tabla FROM ex WHERE base = {MONTH}
 AND NOT EXISTS (SELECT 1 FROM existing x WHERE x.dominio = ex.dominio AND x.corte = ex.corte)"""
    q["projection_summary"] = f"""WITH {PROJ}, now AS (SELECT DISTINCT fp.dominio, fp.concepto, fp.valor, {_ADD.format(MONTH, 'i')} AS corte FROM fp, n),
 k AS (SELECT *, EXISTS (SELECT 1 FROM existing x WHERE x.dominio = now.dominio AND x.corte = now.corte) AS hecho FROM now)
 SELECT corte, coalesce(string_agg(CASE WHEN NOT hecho THEN concat_ws(':', dominio, concepto, CAST(valor AS VARCHAR)) END, '|' ORDER BY dominio, concepto), '') AS insertados,
 coalesce(string_agg(DISTINCT CASE WHEN hecho THEN dominio END, '|' ORDER BY CASE WHEN hecho THEN dominio END), '') AS omitidos FROM k GROUP BY corte"""

    section = "dominio, corte, seccion, concepto, valor_ajustado"
    q["report_sign_adjust"] = f"WITH {REP} SELECT {KEY}, valor, CAST(va AS BIGINT) AS valor_ajustado FROM adj"
    q["report_cash_detail"] = f"WITH {REP} SELECT {section} FROM cd"
    q["report_cash_total"] = f"WITH {REP} SELECT {section} FROM ct"
    q["report_projection_detail"] = f"WITH {REP} SELECT {section} FROM pd"
    q["report_projection_total"] = f"WITH {REP} SELECT dominio, corte, total_proyeccion FROM pt"
    q["report_running_projection"] = f"WITH {REP} SELECT dominio, corte, total_proyeccion, acumulado FROM pr"
    q["report_projected_cash"] = f"WITH {REP} SELECT {section} FROM pc"
    q["report_full"] = f"""WITH {REP} SELECT {section}, CASE seccion WHEN 'CAJA_ACTUAL' THEN 1 WHEN 'TOTAL_CAJA_ACTUAL' THEN 2 WHEN 'PROYECCION' THEN 3 ELSE 4 END AS rango
 FROM rep ORDER BY dominio, corte, rango, concepto"""

    q["doc_class"] = f"WITH {DOC} SELECT seccion, tipo_registro, categoria_bloque, es_futuro, count(*) AS n FROM doc GROUP BY seccion, tipo_registro, categoria_bloque, es_futuro"
    q["doc_text"] = f"WITH {DOC} SELECT id, texto FROM doc"
    q["documents"] = f"WITH {DOC} SELECT * FROM doc"

    q["vector_topk"] = f"WITH {HITS} SELECT question_id, key, CAST(rank AS INTEGER) AS rank, round(score, 6) + 0.0 AS score FROM hits"
    q["vector_pivots"] = f"""WITH {HITS.split('hits AS')[0].rstrip(', ' + chr(10)).replace(HITS[: HITS.index('sc AS')], "c AS (SELECT vec_id AS question_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings WHERE vec_id % 50 = 0)," + chr(10))}
 SELECT question_id, key, CAST(rank AS INTEGER) AS rank, round(score, 6) + 0.0 AS score FROM rk WHERE rank <= 5"""
    q["index_refresh"] = """WITH d AS (SELECT doc_id AS k, CASE WHEN doc_id % 5 = 0 THEN text || ' nuevo' ELSE text END AS t,
 CASE WHEN doc_id % 11 = 0 THEN 'OTRO' ELSE lang END AS dominio, doc_id % 5 = 0 AND text IS NOT NULL AS otro, doc_id % 13 = 0 AS nuevo, doc_id % 11 = 0 AS ficha
 FROM documents WHERE doc_id % 7 <> 0)
 SELECT k AS key, dominio, sha256(coalesce(t, '')) AS huella, CAST(CASE WHEN otro OR nuevo THEN 1 ELSE 0 END AS INTEGER) AS vector_de,
 CAST(CASE WHEN otro OR nuevo OR ficha THEN 1 ELSE 0 END AS INTEGER) AS lote,
 CASE WHEN len(regexp_extract_all(lower(coalesce(t, '')), '[\\p{L}\\p{M}\\p{N}_]+')) > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END AS norma FROM d"""
    q["append_once"] = f"WITH {ACCOUNT} SELECT 'cuenta-e' || CAST(trx_id AS VARCHAR) AS trx_id, dominio, corte, cuenta, CAST(valor AS BIGINT) AS valor FROM a JOIN (SELECT trx_id, corte FROM m) USING (trx_id) WHERE razon IS NULL"
    q["calendar_run"] = f"""WITH {CLOSE}, fp(dominio, concepto, importe) AS (VALUES {_PROJECTION_ROWS}), n(i) AS (VALUES (1), (2), (3)),
 kept AS (SELECT {KEY}, bloque, origen, valor FROM led WHERE corte <> {CLOSING}
 AND NOT EXISTS (SELECT 1 FROM opening o WHERE o.dominio = led.dominio AND o.corte = led.corte AND o.tipo = led.tipo AND o.concepto = led.concepto
 AND o.origen_clave IS NOT DISTINCT FROM led.origen_clave)),
 extra AS (SELECT fp.dominio, {_ADD.format(MONTH, 'i')} AS corte, 'GASTO' AS tipo, fp.concepto, CAST(NULL AS VARCHAR) AS origen_clave,
 'PROYECCION' AS bloque, CAST(NULL AS VARCHAR) AS origen, CAST(fp.importe AS BIGINT) * 100 AS valor FROM fp, n
 WHERE EXISTS (SELECT 1 FROM cat WHERE cat.dominio = fp.dominio AND cat.bloque = 'PROYECCION' AND cat.nombre = fp.concepto)),
 parts AS (SELECT * FROM kept UNION ALL SELECT {KEY}, bloque, NULL, valor FROM carry UNION ALL SELECT * FROM extra UNION ALL SELECT {KEY}, bloque, origen, valor FROM opening),
 booked AS (SELECT {KEY}, max(bloque) AS bloque, max(origen) AS origen, CAST(sum(valor) AS BIGINT) AS valor FROM parts GROUP BY {KEY}),
 shown AS (SELECT dominio, origen FROM booked WHERE bloque = 'CAJA_ACTUAL' GROUP BY dominio, origen),
 ahead AS (SELECT DISTINCT dominio, corte, concepto FROM booked WHERE bloque = 'PROYECCION' AND corte >= {MONTH}),
 total AS (SELECT (SELECT count(*) FROM shown) + (SELECT count(DISTINCT dominio) FROM shown) + (SELECT count(*) FROM ahead)
 + (SELECT count(*) FROM (SELECT DISTINCT dominio, corte FROM ahead)) AS n)
 SELECT 'saldo' AS parte, {KEY}, valor FROM booked UNION ALL
 SELECT parte, NULL, NULL, NULL, NULL, NULL, n FROM total, (VALUES ('reporte'), ('documentos'), ('indice')) t(parte)"""
    q["context_text"] = f"""WITH {HITS} SELECT question_id, string_agg(chr(10) || 'Dominio: ' || CASE WHEN label < 3 THEN 'CASA' WHEN label < 6 THEN 'PERSONAL' ELSE 'AHORRO' END ||
 chr(10) || 'Periodo: 1998-07' || chr(10) || 'Sección: PROYECCION' || chr(10) || 'Concepto: ' || CASE WHEN label <> 0 THEN 'ETIQUETA ' || CAST(label AS VARCHAR) ELSE 'None' END ||
 chr(10) || 'Valor: ' || CAST(key AS VARCHAR) || chr(10), chr(10) ORDER BY rank) AS contexto FROM hits GROUP BY question_id"""
    q["stream_quarantine"] = f"""WITH {MOV}, t AS (SELECT trx_id % 50 AS k FROM m)
 SELECT 'RECIBIDOS' AS destino, count(*) + count(*) FILTER (WHERE k = 4) AS n FROM t
 UNION ALL SELECT 'REPETIDOS', count(*) FROM t WHERE k = 4
 UNION ALL SELECT 'APLICADOS', count(*) FROM t WHERE k NOT IN (1, 2, 3)
 UNION ALL SELECT 'VALOR_NO_NUMERICO', count(*) FROM t WHERE k = 1
 UNION ALL SELECT 'FALTA_CONCEPTO', count(*) FROM t WHERE k = 2
 UNION ALL SELECT 'VALOR_FUERA_DE_RANGO', count(*) FROM t WHERE k = 3"""
    q["embed_hash"] = """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{M}\\p{N}_]+')) AS palabra FROM documents),
 p AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(palabra), 1, 8) AS BIGINT) % 256 AS INTEGER) AS posicion, count(*) AS n FROM w GROUP BY ALL),
 s AS (SELECT *, sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS largo FROM p)
 SELECT doc_id, posicion, round(CAST(CAST(n / largo AS FLOAT) AS DOUBLE), 6) AS peso FROM s"""
    q["question_intake"] = f"""WITH {_REQ} SELECT conv_id, turn, canal AS channel_id, usuario AS user_id, text AS question FROM req WHERE role = 'user' AND coalesce(text, '') <> ''"""

    q["dash_filter"] = f"WITH {REP} SELECT {section} FROM rep WHERE dominio = 'CASA' AND seccion = 'PROYECCION'"
    q["dash_distinct"] = f"""WITH {REP} SELECT DISTINCT 'dominio' AS columna, dominio AS valor FROM rep UNION ALL SELECT DISTINCT 'corte', corte FROM rep
 UNION ALL SELECT DISTINCT 'seccion', seccion FROM rep"""
    counted = "seccion NOT LIKE 'TOTAL%' AND seccion NOT LIKE 'CAJA_PROYECTADA%'"
    q["dash_metrics"] = f"""WITH {REP}, mx AS (SELECT max(corte) AS c FROM rep) SELECT (SELECT c FROM mx) AS corte_activo,
 CAST(coalesce(sum(CASE WHEN corte = (SELECT c FROM mx) AND {_PROJECTED} THEN valor_ajustado END), 0) AS BIGINT) AS caja_proyectada,
 CAST(coalesce(sum(CASE WHEN valor_ajustado > 0 AND {counted} THEN valor_ajustado END), 0) AS BIGINT) AS total_ingresos,
 CAST(coalesce(sum(CASE WHEN valor_ajustado < 0 AND {counted} THEN valor_ajustado END), 0) AS BIGINT) AS total_egresos,
 CAST(coalesce(sum(CASE WHEN dominio = 'INVERSIONES' AND seccion = 'TOTAL_CAJA_ACTUAL' THEN valor_ajustado END), 0) AS BIGINT) AS portafolio,
 count(*) AS registros FROM rep"""
    one = q["dash_metrics"].split("SELECT (SELECT c FROM mx)", 1)[1].replace("(SELECT c FROM mx)", "chosen.c")
    q["dash_month"] = f"""WITH {REP}, chosen(c) AS (VALUES ('1998-07'), ('1998-08'), ('1999-01')) SELECT chosen.c{one}, chosen GROUP BY chosen.c"""
    q["dash_evolution"] = f"WITH {REP} SELECT corte, {_CELLS} FROM rep GROUP BY corte"
    zeroed = ", ".join(f"coalesce(x.{d.lower()}, 0.0) AS {d.lower()}" for d in _CHARTED)
    q["dash_comparison"] = f"""WITH {REP}, x AS (SELECT corte, {_CELLS} FROM rep GROUP BY corte), mo AS (SELECT DISTINCT corte FROM rep WHERE dominio = 'PERSONAL')
 SELECT mo.corte, {zeroed} FROM mo LEFT JOIN x ON mo.corte = x.corte"""
    q["dash_top_concepts"] = f"""WITH {REP} SELECT concepto, CAST(sum(valor_ajustado) AS BIGINT) AS total FROM rep WHERE seccion = 'PROYECCION' AND concepto <> ''
 GROUP BY concepto ORDER BY abs(sum(valor_ajustado)) DESC, concepto LIMIT 9"""
    q["dash_lookup"] = f"""WITH {REP} SELECT max(valor_ajustado) AS caja_proyectada FROM rep WHERE dominio = 'CASA' AND corte = '1998-07' AND {_PROJECTED}"""
    sign = "CASE WHEN valor_ajustado < 0 THEN '-' ELSE '' END"
    centi = "((abs(valor_ajustado) + 500000) // 1000000)"
    shown = "CASE WHEN concepto = '' OR concepto IS NULL THEN '—' ELSE concepto END AS concepto"
    q["dash_format"] = f"""WITH {REP} SELECT dominio, corte, seccion, {shown}, 3 AS decimales,
 {sign} || '$' || CAST(abs({_MILLI}) // 1000 AS VARCHAR) || '.' || lpad(CAST(abs({_MILLI}) % 1000 AS VARCHAR), 3, '0') || 'M' AS valor FROM rep
 UNION ALL SELECT dominio, corte, seccion, {shown}, 2,
 {sign} || '$' || CAST({centi} // 100 AS VARCHAR) || '.' || lpad(CAST({centi} % 100 AS VARCHAR), 2, '0') || 'M' FROM rep"""

    q["stream_ledger"] = q["ledger_snapshot"]
    new = "valor - 100 * (trx_id % 1000)"
    modes = []
    for mode, amount in (("readd", new), ("delta", f"{new} - valor")):
        both = f"""m0 AS ({MOVEMENTS_SQL.replace('{orders}', 'orders')}), m AS (SELECT * REPLACE (2 * trx_id AS trx_id) FROM m0
 UNION ALL SELECT * REPLACE (2 * trx_id + 1 AS trx_id, {amount} AS valor) FROM m0 WHERE trx_id % 3 = 0)"""
        modes.append(f"(WITH {LED.replace(MOV, both)} SELECT '{mode}' AS modo, {KEY}, bloque, origen, valor FROM led)")
    q["change_modify"] = " UNION ALL ".join(modes)
    in_time = f"m AS (SELECT * FROM ({MOVEMENTS_SQL.replace('{orders}', 'orders')}) WHERE trx_id % 50 <> 7)"
    q["stream_horizon"] = f"""WITH {LED.replace(MOV, in_time)}, late AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 50 IN (7, 9))
 SELECT 'FUERA_DE_HORIZONTE' AS destino, count(*) AS n, CAST(0 AS BIGINT) AS total FROM late
 UNION ALL SELECT tipo, count(*), CAST(sum(valor) AS BIGINT) FROM led GROUP BY tipo"""
    q["ledger_delete"] = f"""WITH {LED} SELECT {KEY}, bloque, origen, valor FROM led
 WHERE NOT (corte < '1994-01' AND dominio IN ('CASA', 'AHORRO') OR corte = '1995-06')"""
    q["stream_ingest"] = f"""WITH {ACCOUNT}, {cards}, {projections}, s AS ({split}) SELECT clase, salida, count(*) AS n FROM s GROUP BY clase, salida"""
    number = "lpad(CAST(trx_id AS VARCHAR), 12, '0')"
    accepted = {
        "a": f"SELECT 'CUENTA#cuenta-' || {number} AS trx_id, dominio, 'CUENTA' AS tipo, 'CAJA_ACTUAL' AS bloque, descripcion AS concepto, cuenta AS origen, destino AS cuenta_destino, valor FROM a JOIN (SELECT trx_id AS k, corte FROM m0) ON k = trx_id WHERE razon IS NULL",
        "c": f"SELECT 'TARJETA#tarjeta-' || {number}, dominio, 'TARJETA', 'CAJA_ACTUAL', concepto, franquicia, NULL, valor FROM c WHERE razon IS NULL",
        "j": f"SELECT 'GASTO#proyeccion-' || {number}, dominio, 'GASTO', 'PROYECCION', concepto, NULL, NULL, valor FROM j WHERE razon IS NULL",
    }
    taken = " UNION ALL ".join(part.split(" JOIN ")[0] + " WHERE razon IS NULL" if " JOIN " in part else part for part in accepted.values())
    base = ACCOUNT.replace(MOV, MOV.replace("m AS (", "m0 AS (", 1)).replace(" FROM m)", " FROM m0)")
    others = f"{cards}, {projections}".replace(" FROM m)", " FROM m0)")
    posted_rows = f"""{base}, {others}, taken AS ({taken}),
 m AS (SELECT split_part(t.trx_id, '#', 2) AS trx_id, TIMESTAMP '1998-07-01' AS created_at, m0.corte, t.dominio, t.tipo, t.bloque, t.concepto, t.origen, t.cuenta_destino, t.valor
 FROM taken t JOIN m0 ON m0.trx_id = CAST(split_part(t.trx_id, '-', 2) AS BIGINT))"""
    q["stream_postings"] = f"WITH {LED.replace(MOV, posted_rows)} SELECT {KEY}, bloque, origen, valor FROM led"
    q["stream_outbox"] = f"""WITH {MOV} SELECT 'C' || dominio AS channel_id, 'movimiento.cuenta.confirmado' AS detail_type, count(*) AS n
 FROM m WHERE tipo <> 'GASTO' AND dominio <> 'AHORRO' GROUP BY dominio"""
    return q
