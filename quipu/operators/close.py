"""Monthly close: opening balances, carried projections, purge of the closed month."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.config import LedgerConfig
from quipu.functions.months import close_months
from quipu.functions.text import keyed_origin
from quipu.schema import KEY, KEYED_BY_ORIGIN, LEDGER

OPENING_CONCEPT = "SALDO_INICIAL"
CARRIED_TYPE = "GASTO"


def _accounts(ledger: DataFrame, config: LedgerConfig, all_types: bool) -> DataFrame:
    """(dominio, origen, tipo_cuenta): the catalogue's cash accounts that a close settles."""
    dim = config.accounts_dim(ledger.sparkSession, None if all_types else KEYED_BY_ORIGIN)
    return dim.select("dominio", F.col("nombre").alias("origen"), F.col("tipo").alias("tipo_cuenta"))


def closing_balances(
    ledger: DataFrame,
    config: LedgerConfig,
    as_of,
    carry_by_origin: bool = False,
    carry_all_types: bool = False,
) -> DataFrame:
    """Non-zero balance of the closing month per catalogue account: (dominio, tipo, origen, valor).

    By default an account sums the keys of its own type only, and only accounts
    and cards are settled. ``carry_by_origin`` sums an account's cash keys of
    any type; ``carry_all_types`` also settles the other catalogue types, whose
    movements sit on account keys.
    """
    closing, _ = close_months(as_of)
    rows = ledger.filter(F.col("corte") == closing).withColumnRenamed("tipo", "tipo_clave")
    settled = rows.join(_accounts(ledger, config, carry_all_types), ["dominio", "origen"])
    return (
        settled.filter(_settles(carry_by_origin, carry_all_types))
        .withColumn("tipo", _opening_type())
        .groupBy("dominio", "tipo", "origen")
        .agg(F.sum("valor").alias("valor"))
        .filter(F.col("valor") != 0)
    )


def _opening_type() -> Column:
    """Type of the opening key; accounts of other catalogue types keep account keys."""
    return F.when(F.col("tipo_cuenta").isin(KEYED_BY_ORIGIN), F.col("tipo_cuenta")).otherwise("CUENTA")


def _settles(carry_by_origin: bool, carry_all_types: bool) -> Column:
    if carry_by_origin:
        return F.col("bloque") == "CAJA_ACTUAL"
    return F.col("tipo_clave") == (_opening_type() if carry_all_types else F.col("tipo_cuenta"))


def opening_rows(balances: DataFrame, as_of) -> DataFrame:
    """Opening rows of the new month, in ledger columns."""
    _, opening = close_months(as_of)
    return balances.select(
        "dominio",
        opening.alias("corte"),
        "tipo",
        F.lit(OPENING_CONCEPT).alias("concepto"),
        keyed_origin(F.col("tipo"), F.col("origen")).alias("origen_clave"),
        F.lit("CAJA_ACTUAL").alias("bloque"),
        "origen",
        "valor",
    )


def carried_rows(ledger: DataFrame, config: LedgerConfig, as_of) -> DataFrame:
    """Non-zero persistent projections of the closing month, moved to the opening month."""
    closing, opening = close_months(as_of)
    kept = ledger.filter(
        (F.col("corte") == closing) & (F.col("tipo") == CARRIED_TYPE) & (F.col("valor") != 0)
    ).filter(F.col("dominio").isin(config.domains))
    return (
        kept.join(config.persistent_dim(ledger.sparkSession), ["dominio", "concepto"], "left_semi")
        .withColumn("corte", opening)
        .withColumn("bloque", F.lit("PROYECCION"))
        .withColumn("origen", F.lit(None).cast("string"))
        .select(*LEDGER)
    )


def close_month(
    ledger: DataFrame,
    config: LedgerConfig,
    as_of,
    carry_by_origin: bool = False,
    carry_all_types: bool = False,
) -> DataFrame:
    """The whole close as a new ledger.

    Opening rows replace stored ones, carried projections add to stored ones,
    and the closed month goes away for every catalogue domain. Every row is
    tagged with its part in the close, then one aggregation by key settles it.
    """
    closing, _ = close_months(as_of)
    purged = F.coalesce((F.col("corte") == closing) & F.col("dominio").isin(config.domains), F.lit(False))
    balances = closing_balances(ledger, config, as_of, carry_by_origin, carry_all_types)
    parts = (
        ledger.filter(~purged).select(*LEDGER, F.lit("queda").alias("_parte"))
        .unionByName(opening_rows(balances, as_of).withColumn("_parte", F.lit("apertura")))
        .unionByName(carried_rows(ledger, config, as_of).withColumn("_parte", F.lit("traslado")))
    )

    def amount(part: str) -> Column:
        return F.sum(F.when(F.col("_parte") == part, F.col("valor")))

    def text(column: str, part: str) -> Column:
        return F.max(F.when(F.col("_parte") == part, F.col(column)))

    return (
        parts.groupBy(*KEY)
        .agg(
            F.coalesce(
                amount("apertura"),
                F.coalesce(amount("queda"), F.lit(0)) + F.coalesce(amount("traslado"), F.lit(0)),
            ).alias("valor"),
            F.coalesce(text("bloque", "apertura"), text("bloque", "traslado"), text("bloque", "queda")).alias("bloque"),
            F.coalesce(text("origen", "apertura"), text("origen", "queda")).alias("origen"),
        )
        .select(*LEDGER)
    )
