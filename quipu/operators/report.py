"""Cash-flow report: cash by origin, cash total, projections, projected cash.

One aggregation of the ledger gives all figures: ``cells`` holds a row per cash origin and per projected balance, ``months`` adds
them up by domain and month and runs the projection along. The sections are lines read off these two.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions.months import month_key
from quipu.schema import SECTION

CASH, CASH_TOTAL, PROJECTION, PROJECTED_CASH = "CAJA_ACTUAL", "TOTAL_CAJA_ACTUAL", "PROYECCION", "CAJA_PROYECTADA_A_CORTE_"
_RANKS = {CASH: 1, CASH_TOTAL: 2, PROJECTION: 3}


def _counts_against() -> Column:
    """Card balances held as cash and projected expenses. Rows without an origin or concept count in favour."""
    owed = (F.col("bloque") == CASH) & F.contains(F.upper("origen"), F.lit("TARJETA"))
    expense = (F.col("tipo") == "GASTO") & ~F.contains(F.upper("concepto"), F.lit("INGRESO"))
    return F.coalesce(owed, F.lit(False)) | F.coalesce(expense, F.lit(False))


def adjust(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("valor_ajustado", F.col("valor") * F.when(_counts_against(), -1).otherwise(1))


def cells(ledger: DataFrame, as_of=None) -> DataFrame:
    """dominio, corte, seccion, concepto, valor_ajustado: cash of all months under the current one, by origin; and projections of
    the current and later months, by balance."""
    now, cash = month_key(as_of), F.col("bloque") == CASH
    used = adjust(ledger.filter(cash | ((F.col("bloque") == PROJECTION) & (F.col("corte") >= now))))
    balance = F.when(~cash, F.struct("tipo", "origen_clave", "origen"))
    keys = [
        F.col("dominio"), F.when(cash, now).otherwise(F.col("corte")).alias("corte"), F.col("bloque").alias("seccion"),
        F.when(cash, F.col("origen")).otherwise(F.col("concepto")).alias("concepto"), balance.alias("saldo"),
    ]
    return used.groupBy(*keys).agg(F.sum("valor_ajustado").alias("valor_ajustado")).drop("saldo")


def months(found: DataFrame) -> DataFrame:
    """From cells: dominio, corte, caja (cash of the domain, null without any), es_caja, total_proyeccion (null in a month without
    projections), es_proyeccion and acumulado, its running sum. One row per domain and month, so windows stay small."""
    of = lambda section: F.col("seccion") == section
    sums = found.groupBy("dominio", "corte").agg(
        F.sum(F.when(of(CASH), F.col("valor_ajustado"))).alias("efectivo"), F.max(of(CASH)).alias("es_caja"),
        F.sum(F.when(of(PROJECTION), F.col("valor_ajustado"))).alias("total_proyeccion"), F.max(of(PROJECTION)).alias("es_proyeccion"),
    )
    domain = Window.partitionBy("dominio")
    so_far = domain.orderBy("corte").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sums.withColumns({"caja": F.sum("efectivo").over(domain), "acumulado": F.sum("total_proyeccion").over(so_far)}).drop("efectivo")


def _line(section: Column, value: Column) -> Column:
    return F.struct(section.alias("seccion"), F.lit("").alias("concepto"), value.alias("valor_ajustado"))


def _total_lines(found: DataFrame, missing_cash_zero: bool = False) -> DataFrame:
    """Cash total and projected cash, read off the months."""
    by_month = months(found)
    held = F.coalesce("caja", F.lit(0)) if missing_cash_zero else F.col("caja")
    total = F.when(F.col("es_caja"), _line(F.lit(CASH_TOTAL), F.col("caja")))
    projected = F.when(F.col("es_proyeccion"), _line(F.concat(F.lit(PROJECTED_CASH), "corte"), held + F.col("acumulado")))
    lines = F.filter(F.array(total, projected), lambda x: x.isNotNull())
    return by_month.select("dominio", "corte", F.inline(lines)).select(*SECTION)


def cash_detail(ledger: DataFrame, as_of=None) -> DataFrame:
    return cells(ledger, as_of).filter(F.col("seccion") == CASH)


def projection_detail(ledger: DataFrame, as_of=None) -> DataFrame:
    return cells(ledger, as_of).filter(F.col("seccion") == PROJECTION)


def cash_total(ledger: DataFrame, as_of=None) -> DataFrame:
    return _total_lines(cells(ledger, as_of)).filter(F.col("seccion") == CASH_TOTAL)


def running_projection(ledger: DataFrame, as_of=None) -> DataFrame:
    """Projection totals with their running sum by month."""
    return months(cells(ledger, as_of)).filter("es_proyeccion").select("dominio", "corte", "total_proyeccion", "acumulado")


def projection_total(ledger: DataFrame, as_of=None) -> DataFrame:
    return running_projection(ledger, as_of).drop("acumulado")


def projected_cash(ledger: DataFrame, as_of=None, missing_cash_zero: bool = False) -> DataFrame:
    """Cash total plus running projection; null without cash rows unless ``missing_cash_zero``."""
    return _total_lines(cells(ledger, as_of), missing_cash_zero).filter(F.col("seccion").startswith(PROJECTED_CASH))


def report(ledger: DataFrame, as_of=None, missing_cash_zero: bool = False) -> DataFrame:
    """The four sections in one unordered result. Details and totals share the aggregation of the ledger, which is read once."""
    found = cells(ledger, as_of)
    return found.select(*SECTION).unionByName(_total_lines(found, missing_cash_zero))


def section_rank() -> Column:
    """1 to 3 for the named sections, 4 for projected cash."""
    ranks = F.create_map(*[F.lit(x) for pair in _RANKS.items() for x in pair])
    return F.coalesce(ranks[F.col("seccion")], F.lit(len(_RANKS) + 1))


def ordered_report(rows: DataFrame) -> DataFrame:
    return rows.orderBy("dominio", "corte", section_rank(), "concepto")
