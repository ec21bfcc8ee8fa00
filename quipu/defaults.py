"""Default configuration.

Everything in this module is a fixed value: names, amounts, conditions and key
texts that results depend on. Catalogue, rules, projections and persistent
concepts can be replaced by the JSON documents that ``quipu.config.load_config``
reads; source and projection tables, record types and event names cannot.
"""

from typing import NamedTuple

# Catalogue, domain -> block -> type -> names in listed order.
CATALOGUE = {
    "CASA": {
        "CAJA_ACTUAL": {
            "CUENTA": ["BDO", "KUBO", "NEQUI", "EFECTIVO"],
            "TARJETA": ["TARJETA VISA BDO", "TARJETA MASTERCARD BDO"],
        },
        "PROYECCION": {
            "CONCEPTOS": [
                "INGRESO HOGAR", "SALUD", "SERVICIOS", "ALIMENTACION", "AUTOMOVIL", "HIPOTECARIO",
                "ADMINISTRACION", "ESTUDIO", "SALDO_INICIAL", "AHORRO CONTINGENCIA", "TRANSFERENCIA",
            ],
        },
    },
    "PERSONAL": {
        "CAJA_ACTUAL": {
            "CUENTA": ["BDO", "KUBO", "NEQUI", "EFECTIVO"],
            "TARJETA": ["TARJETA VISA BDO", "TARJETA MASTERCARD BDO", "TARJETA MASTERCARD NU"],
        },
        "PROYECCION": {
            "CONCEPTOS": [
                "AHORRO PROYECTO FINCA", "AHORRO CONTINGENCIA", "SALDO_INICIAL", "INGRESO SALARIO",
                "APORTE HOGAR", "DEUDA A CASA", "GASTOS HORMIGA", "TRANSFERENCIA", "AUTOMOVIL",
            ],
        },
    },
    "AHORRO": {
        "CAJA_ACTUAL": {"CUENTA": ["BDO", "KUBO", "NEQUI", "EFECTIVO"]},
        "PROYECCION": {
            "CONCEPTOS": [
                "AHORRO PROYECTO FINCA", "AHORRO CONTINGENCIA", "SALDO_INICIAL", "AUTOMOVIL",
                "AHORRO LEANDRO", "AHORRO JOHAO", "AHORRO JENNY", "SALDO APTO", "TRANSFERENCIA",
            ],
        },
    },
    "INVERSIONES": {
        "CAJA_ACTUAL": {
            "CDT": ["CDT_BDO", "CDT_TRII"],
            "ACCIONES": ["ACC_PFARGOS", "ACC_NU"],
            "MONEDAS": ["MON_BITCOIN", "MON_USD"],
            "CUENTAS": ["KUBO", "NU", "RAPPI"],
        },
    },
}

# Compensation rules in evaluation order.
RULES = [
    {
        "id": "CUENTA_DISMINUYE_GASTO",
        "activo": True,
        "tipos_origen": ["CUENTA"],
        "bloque_origen": "CAJA_ACTUAL",
        "condicion_valor": "NEGATIVO",
        "excluir_conceptos": ["SALDO_INICIAL"],
        "excluir_dominio": ["AHORRO", "INVERSIONES"],
        "acciones": [
            {"tipo_destino": "GASTO", "bloque_destino": "PROYECCION", "operacion": "DECREMENTAR"},
            {"tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "DECREMENTAR"},
        ],
    },
    {
        "id": "MOV_TARJETA_REDUCE_PROYECCION",
        "activo": True,
        "tipos_origen": ["TARJETA"],
        "bloque_origen": "CAJA_ACTUAL",
        "condicion_valor": "POSITIVO",
        "excluir_conceptos": ["SALDO_INICIAL"],
        "acciones": [
            {"tipo_destino": "GASTO", "bloque_destino": "PROYECCION", "operacion": "DECREMENTAR"},
            {"tipo_destino": "TARJETA", "bloque_destino": "CAJA_ACTUAL", "operacion": "INCREMENTAR"},
        ],
    },
    {
        "id": "INGRESO_HOGAR_DISMINUYE_PROYECCION",
        "activo": True,
        "tipos_origen": ["CUENTA"],
        "bloque_origen": "CAJA_ACTUAL",
        "condicion_valor": "POSITIVO",
        "incluir_conceptos": ["INGRESO HOGAR", "INGRESO SALARIO"],
        "excluir_dominio": ["INVERSIONES"],
        "acciones": [
            {"tipo_destino": "GASTO", "bloque_destino": "PROYECCION", "operacion": "DECREMENTAR"},
            {"tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "INCREMENTAR"},
        ],
    },
    {
        "id": "TRANSFERENCIA_ENTRE_CUENTAS",
        "activo": True,
        "tipos_origen": ["CUENTA"],
        "bloque_origen": "CAJA_ACTUAL",
        "condicion_valor": "CUALQUIERA",
        "incluir_conceptos": ["TRANSFERENCIA"],
        "acciones": [
            {
                "tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "DECREMENTAR",
                "origen_destino": "USAR_ORIGEN",
            },
            {
                "tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "INCREMENTAR",
                "origen_destino": "USAR_CUENTA_DESTINO",
            },
        ],
    },
    {
        "id": "KUBO_CASA_REPLICA_AHORRO_SALDO_APTO",
        "tipo": "COMPLEMENTARIA",
        "activo": True,
        "tipos_origen": ["CUENTA"],
        "bloque_origen": "CAJA_ACTUAL",
        "condicion_valor": "CUALQUIERA",
        "incluir_dominio": ["CASA"],
        "incluir_origen": ["KUBO"],
        "acciones": [
            {
                "tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "REPLICAR",
                "dominio_destino": "AHORRO", "concepto_destino": "SALDO APTO",
                "origen_destino": "USAR_CUENTA_AFECTADA",
            },
        ],
    },
    {
        "id": "KUBO_PERSONAL_REPLICA_AHORRO_JOHAO",
        "tipo": "COMPLEMENTARIA",
        "activo": True,
        "tipos_origen": ["CUENTA"],
        "bloque_origen": "CAJA_ACTUAL",
        "condicion_valor": "CUALQUIERA",
        "incluir_dominio": ["PERSONAL"],
        "incluir_origen": ["KUBO"],
        "acciones": [
            {
                "tipo_destino": "CUENTA", "bloque_destino": "CAJA_ACTUAL", "operacion": "REPLICAR",
                "dominio_destino": "AHORRO", "concepto_destino": "AHORRO JOHAO",
                "origen_destino": "USAR_CUENTA_AFECTADA",
            },
        ],
    },
]

# Monthly amounts projected per domain and concept.
FIXED_PROJECTIONS = {
    "CASA": {
        "SALUD": 75000,
        "ADMINISTRACION": 185000,
        "ALIMENTACION": 940000,
        "INGRESO HOGAR": 2535360,
        "AUTOMOVIL": 320000,
        "HIPOTECARIO": 350000,
        "SERVICIOS": 210000,
    },
    "PERSONAL": {
        "AHORRO PROYECTO FINCA": 3406890,
        "APORTE HOGAR": 2535360,
        "AHORRO CONTINGENCIA": 475380,
        "INGRESO SALARIO": 7269930,
        "AUTOMOVIL": 500000,
    },
}

# Concepts carried over at the monthly close.
PERSISTENT_CONCEPTS = {"PERSONAL": ["DEUDA A CASA"]}

# Source table -> (tipo, bloque, field that holds the origin).
SOURCE_TABLES = {
    "HistoriaCuentasAltoRendimiento_modules_IAC": ("CUENTA", "CAJA_ACTUAL", "cuenta"),
    "HistorialTarjetas_modules_IAC": ("TARJETA", "CAJA_ACTUAL", "franquicia"),
    "ConceptosFijosObligaciones_modules_IAC": ("GASTO", "PROYECCION", None),
    "ConceptosFijosPersonal_modules_IAC": ("GASTO", "PROYECCION", None),
}

# Which projection table a domain writes to.
PROJECTION_TABLES = {
    "CASA": "conceptos_fijos",
    "PERSONAL": "conceptos_fijos_persona",
    "AHORRO": "conceptos_fijos_persona",
    "INVERSIONES": "conceptos_fijos_persona",
}


class RecordType(NamedTuple):
    """What a form asks for."""

    account: bool
    concept: bool


# Record types.
RECORD_TYPES = {
    "MOVIMIENTO_GENERAL": RecordType(account=True, concept=True),
    "MOVIMIENTO_TARJETA": RecordType(account=True, concept=True),
    "PROYECCION": RecordType(account=False, concept=True),
    "TRANSFERENCIA": RecordType(account=True, concept=False),
}

# Event names.
EVENT_ACCOUNT = "movimiento.general.registrado"
EVENT_CARD = "movimiento.tarjeta.registrado"
EVENT_PROJECTION = "proyeccion.registrado"
CONFIRMED_ACCOUNT = "movimiento.cuenta.confirmado"
CONFIRMED_CARD = "movimiento.tarjeta.confirmado"
CONFIRMED_PROJECTION = "concepto.fijo.confirmado"

# Notification symbols; events without an entry get the default one.
SYMBOLS = {
    "movimiento.tarjeta.registrado": "💳",
    "movimiento.cuenta.registrado": "🏦",
    "concepto.fijo.registrado": "📌",
}
DEFAULT_SYMBOL = "📬"

# Record origin marks of projection rows.
MANUAL_PROJECTION = "PROYECCION_MANUAL"
AUTOMATIC_PROJECTION = "PROYECCION_AUTOMATICA"
