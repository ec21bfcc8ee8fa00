"""Column lists and schemas of the ledger's tables."""

from pyspark.sql import types as T

# Normalised movement: one accepted account, card or projection record.
MOVEMENT = [
    "trx_id", "created_at", "dominio", "corte", "tipo", "bloque", "concepto", "origen", "cuenta_destino", "valor",
]

# Key of a balance. origen_clave is set only where the key separates by origin.
KEY = ["dominio", "corte", "tipo", "concepto", "origen_clave"]

# Replay order of the postings of one run; seq tells apart the records of one movement.
ORDER = ["created_at", "trx_id", "seq", "regla_pos", "accion_pos"]

LEDGER = KEY + ["bloque", "origen", "valor"]

# Types whose balances are kept per origin.
KEYED_BY_ORIGIN = ["CUENTA", "TARJETA"]

# Why a decoded movement is held back.
TOO_OLD, UNSUPPORTED = "FUERA_DE_HORIZONTE", "OPERACION_NO_SOPORTADA"

SECTION = ["dominio", "corte", "seccion", "concepto", "valor_ajustado"]

ATTRIBUTE = T.StructType([T.StructField("S", T.StringType()), T.StructField("N", T.StringType())])
IMAGE = T.MapType(T.StringType(), ATTRIBUTE)

CHANGE = T.StructType(
    [
        T.StructField("eventID", T.StringType()),
        T.StructField("eventName", T.StringType()),
        T.StructField("eventSourceARN", T.StringType()),
        T.StructField("dynamodb", T.StructType([T.StructField("NewImage", IMAGE), T.StructField("OldImage", IMAGE), T.StructField("SequenceNumber", T.StringType()), T.StructField("ApproximateCreationDateTime", T.DoubleType())])),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("dominio", T.StringType()),
        T.StructField("corte", T.StringType()),
        T.StructField("categoria_bloque", T.StringType()),
        T.StructField("tipo_registro", T.StringType()),
        T.StructField("es_futuro", T.BooleanType()),
        T.StructField("seccion", T.StringType()),
        T.StructField("concepto", T.StringType()),
        T.StructField("valor", T.DecimalType(28, 2)),
        T.StructField("texto", T.StringType()),
    ]
)
