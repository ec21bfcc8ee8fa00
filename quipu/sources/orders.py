"""Movements derived from an ``orders`` table.

The mapping gives every order a domain, a type, a concept, an origin and a
signed amount in integer cents. It is the shared input of the contract queries,
the tests and the benchmark; its text runs unchanged in other SQL engines.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions.once import with_columns_once
from quipu.schema import IMAGE

#: Tasks over which rows are dealt, for each core.
TASKS_A_CORE = 4

MOVEMENTS_SQL = """
SELECT o_orderkey AS trx_id, o_orderdate AS created_at, substr(CAST(o_orderdate AS STRING),1,7) AS corte,
 CASE o_custkey % 4 WHEN 0 THEN 'CASA' WHEN 1 THEN 'PERSONAL' WHEN 2 THEN 'AHORRO' ELSE 'INVERSIONES' END AS dominio,
 CASE o_orderpriority WHEN '2-HIGH' THEN 'TARJETA' WHEN '5-LOW' THEN 'GASTO' ELSE 'CUENTA' END AS tipo,
 CASE WHEN o_orderpriority='5-LOW' THEN 'PROYECCION' ELSE 'CAJA_ACTUAL' END AS bloque,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN 'TRANSFERENCIA' WHEN o_orderpriority='3-MEDIUM' THEN 'INGRESO HOGAR'
      ELSE CASE o_orderkey % 5 WHEN 0 THEN 'SALUD' WHEN 1 THEN 'SERVICIOS' WHEN 2 THEN 'AUTOMOVIL'
           WHEN 3 THEN 'ALIMENTACION' ELSE 'INGRESO HOGAR' END END AS concepto,
 CASE WHEN o_orderpriority='2-HIGH' THEN CASE o_orderkey % 2 WHEN 0 THEN 'TARJETA VISA BDO' ELSE 'TARJETA MASTERCARD BDO' END
      WHEN o_orderpriority='5-LOW' THEN NULL
      ELSE CASE o_orderkey % 4 WHEN 0 THEN 'BDO' WHEN 1 THEN 'KUBO' WHEN 2 THEN 'NEQUI' ELSE 'EFECTIVO' END END AS origen,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN CASE o_orderkey % 4 WHEN 0 THEN 'KUBO' WHEN 1 THEN 'NEQUI'
      WHEN 2 THEN 'TARJETA VISA BDO' ELSE 'BDO' END END AS cuenta_destino,
 CAST(round(o_totalprice*100) AS BIGINT) * CASE WHEN o_orderpriority='1-URGENT' THEN -1
      WHEN o_orderpriority='4-NOT SPECIFIED' AND o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS valor
FROM {orders}
"""


def movements(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return spark.sql(MOVEMENTS_SQL.replace("{orders}", "{source}"), source=orders)


def spread(rows: DataFrame) -> DataFrame:
    """The same rows dealt evenly over several tasks a core: a few compact files give many long records."""
    return rows.repartition(TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def change_records(rows: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """Movements as change records of their source tables, with their columns in ``kept``.

    Every projection also brings a removal (without a new image) and an insert
    on a table that is not mapped; both must be ignored downstream.
    """

    def attributes(pairs: dict) -> Column:
        entries = []
        for name, (mark, value) in pairs.items():
            kind = F.struct(
                F.when(F.lit(mark == "S"), value.cast("string")).alias("S"),
                F.when(F.lit(mark == "N"), value.cast("string")).alias("N"),
            )
            entries.append(F.when(value.isNotNull(), F.struct(F.lit(name), kind)))
        return F.map_from_entries(F.array_compact(F.array(*entries)))

    card, budget = F.col("tipo") == "TARJETA", F.col("tipo") == "GASTO"
    image = attributes(
        {
            # Padded, so that ids sort as text the way they sort as numbers.
            "trx_id": ("S", F.lpad(F.col("trx_id").cast("string"), 20, "0")),
            "created_at": ("S", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss")),
            "dominioFinanciero": ("S", F.col("dominio")),
            "corte": ("S", F.col("corte")),
            "descripcion": ("S", F.when(~budget, F.lower("concepto"))),
            "concepto": ("S", F.when(budget, F.lower("concepto"))),
            "cuenta": ("S", F.when(~card, F.lower("origen"))),
            "franquicia": ("S", F.when(card, F.lower("origen"))),
            "cuentaDestino": ("S", F.lower("cuenta_destino")),
            "valor": ("N", F.col("valor")),
        }
    )
    table = (
        F.when(card, "HistorialTarjetas_modules_IAC")
        .when(~budget, "HistoriaCuentasAltoRendimiento_modules_IAC")
        .when(F.col("dominio") == "CASA", "ConceptosFijosObligaciones_modules_IAC")
        .otherwise("ConceptosFijosPersonal_modules_IAC")
    )

    def arn(name: Column) -> Column:
        return F.concat(F.lit("arn:aws:dynamodb:us-east-1:000000000000:table/"), name, F.lit("/stream/2026"))

    def record(event: str, name: Column, new_image: Column) -> Column:
        return F.struct(
            F.concat(F.lit(event), F.lit("-"), F.col("trx_id").cast("string"), F.lit("-"), name).alias("eventID"),
            F.lit(event).alias("eventName"),
            arn(name).alias("eventSourceARN"),
            F.struct(new_image.alias("NewImage"), F.lit(None).cast(IMAGE).alias("OldImage")).alias("dynamodb"),
        )

    shaped = with_columns_once(rows, {"_imagen": image, "_tabla": table})
    image, table = F.col("_imagen"), F.col("_tabla")
    ignored = F.array(record("REMOVE", table, F.lit(None).cast(IMAGE)), record("INSERT", F.lit("OtraTabla"), image))
    records = F.array(record("INSERT", table, image))
    return shaped.select(F.explode(F.when(budget, F.concat(records, ignored)).otherwise(records)).alias("r"), *kept).select("r.*", *kept)
