"""Catalogue queries and membership joins."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.config import LedgerConfig
from quipu.defaults import RECORD_TYPES
from quipu.functions.months import as_date, months_from
from quipu.functions.text import in_list

FORM_MONTHS = 6
#: Listed names that are compared as literals; more of them are joined.
LITERAL_NAMES = 5000
_BETWEEN = "\x1f"


def names(spark: SparkSession, config: LedgerConfig, domain: str, block: str, kind: str | None = None) -> DataFrame:
    """(nombre, pos) of a domain's block in listed order, optionally of one type."""
    if domain not in config.catalogue:
        raise ValueError(f"Dominio '{domain}' no existe en el catálogo")
    if not config.has_block(domain, block):
        raise ValueError(f"Bloque '{block}' no configurado para dominio '{domain}'")
    if kind is not None and kind not in config.catalogue[domain][block]:
        raise ValueError(f"Tipo '{kind}' no configurado en '{block}' para dominio '{domain}'")
    rows = config.catalogue_dim(spark).filter((F.col("dominio") == domain) & (F.col("bloque") == block))
    if kind is not None:
        rows = rows.filter(F.col("tipo") == kind)
    return rows.select("nombre", "pos").orderBy("pos")


def with_account_type(rows: DataFrame, config: LedgerConfig, account: str, block: str = "CAJA_ACTUAL") -> DataFrame:
    """Adds tipo_nombre, the first listed type of the row's account in its domain, null when unlisted."""
    dim = config.account_type_dim(rows.sparkSession, block).withColumnRenamed("nombre", account)
    return rows.join(dim, ["dominio", account], "left")


def mark_listed(
    rows: DataFrame, config: LedgerConfig, column: str, flag: str, blocks: list, kind: str | None = None
) -> DataFrame:
    """Adds a boolean: is the row's name listed for its domain in the first of ``blocks`` the domain has.

    A catalogue of the usual size is a set of literals, so that no lookup needs a join.
    """
    pairs = config.listed_names(blocks, kind)
    if len(pairs) <= LITERAL_NAMES:
        wanted = [f"{domain}{_BETWEEN}{name}" for domain, name in pairs]
        return rows.withColumn(flag, in_list(F.concat(F.col("dominio"), F.lit(_BETWEEN), F.col(column)), wanted))
    listed = config.names_dim(rows.sparkSession, blocks, kind).select(
        F.col("dominio").alias("_listado_d"), F.col("nombre").alias("_listado_n"), F.lit(True).alias(flag)
    )
    same = (F.col("dominio") == F.col("_listado_d")) & (F.col(column) == F.col("_listado_n"))
    joined = rows.join(listed, same, "left").drop("_listado_d", "_listado_n")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def selectable(spark: SparkSession, config: LedgerConfig) -> DataFrame:
    """(tipo_registro, dominio, clase, nombre, pos): what a form offers per record type and domain.

    Projections offer no accounts; only transfers offer destination accounts.
    """
    accounts = [t for t, r in RECORD_TYPES.items() if r.account]
    offers = {"cuenta": ("CAJA_ACTUAL", accounts), "concepto": ("PROYECCION", list(RECORD_TYPES)), "cuenta_destino": ("CAJA_ACTUAL", ["TRANSFERENCIA"])}
    kinds = F.array(*[
        F.struct(F.lit(c).alias("clase"), F.lit(b).alias("_bloque"), F.lit(t).alias("tipo_registro"))
        for c, (b, types) in offers.items()
        for t in types
    ])
    offered = config.catalogue_dim(spark).select("*", F.inline(kinds)).filter(F.col("bloque") == F.col("_bloque"))
    return offered.select("tipo_registro", "dominio", "clase", "nombre", "pos")


def form_months(spark: SparkSession, start=None, n: int = FORM_MONTHS) -> DataFrame:
    """The current month and the following ones, as offered by forms."""
    return spark.range(1).select(F.explode(months_from(as_date(start), n)).alias("corte"))
