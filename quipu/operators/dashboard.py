"""Dashboard numbers over report rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.text import millions, millions_text
from quipu.operators.report import CASH_TOTAL, PROJECTED_CASH, PROJECTION

NOT_CHARTED = "INVERSIONES"
TOP_CONCEPTS = 9


def select_rows(report: DataFrame, domain: str = "ALL", corte: str = "ALL", section: str = "ALL") -> DataFrame:
    for column, value in (("dominio", domain), ("corte", corte), ("seccion", section)):
        if value != "ALL":
            report = report.filter(F.col(column) == value)
    return report


def choices(report: DataFrame, column: str) -> DataFrame:
    return report.select(column).distinct().orderBy(column)


def _projected_here() -> Column:
    return F.col("seccion") == F.concat(F.lit(PROJECTED_CASH), F.col("corte"))


def metrics(rows: DataFrame, corte: str = "ALL") -> DataFrame:
    """One row: active month, its projected cash, income, expense, investments, visible rows.

    The projected cash is summed per month on the way, so a single pass serves
    both the newest month and its amount.
    """
    counted = ~F.col("seccion").startswith("TOTAL") & ~F.col("seccion").startswith("CAJA_PROYECTADA")
    value = F.col("valor_ajustado")
    invested = (F.col("dominio") == "INVERSIONES") & (F.col("seccion") == CASH_TOTAL)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    monthly = rows.groupBy("corte").agg(
        total(_projected_here()).alias("proyectada"),
        total(counted & (value > 0)).alias("ingresos"),
        total(counted & (value < 0)).alias("egresos"),
        total(invested).alias("inversiones"),
        F.count(F.lit(1)).alias("n"),
    )
    active = F.max("corte") if corte == "ALL" else F.lit(corte)
    projected = (
        F.max_by("proyectada", "corte") if corte == "ALL" else F.sum(F.when(F.col("corte") == corte, F.col("proyectada")))
    )
    return monthly.agg(
        active.alias("corte_activo"),
        F.coalesce(projected, F.lit(0)).alias("caja_proyectada"),
        F.coalesce(F.sum("ingresos"), F.lit(0)).alias("total_ingresos"),
        F.coalesce(F.sum("egresos"), F.lit(0)).alias("total_egresos"),
        F.coalesce(F.sum("inversiones"), F.lit(0)).alias("portafolio"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros"),
    )


def _matrix(report: DataFrame, domains: list, scale: int) -> DataFrame:
    cells = [
        F.max(F.when(_projected_here() & (F.col("dominio") == d), millions(F.col("valor_ajustado"), 3, scale))).alias(d)
        for d in domains
    ]
    return report.groupBy("corte").agg(*cells)


def charted_domains(report: DataFrame) -> list:
    """The report's own domains that are charted, in order."""
    found = report.select("dominio").filter((F.col("dominio") != NOT_CHARTED) & (F.col("dominio") != "")).distinct()
    return sorted(r["dominio"] for r in found.collect())


def evolution(report: DataFrame, domains: list | None = None, scale: int = 1) -> DataFrame:
    """Projected cash in millions, month x domain; every month of the report, null where there is none. The domains are the report's
    unless they are given."""
    charted = charted_domains(report) if domains is None else [d for d in domains if d != NOT_CHARTED]
    return _matrix(report, charted, scale)


def comparison(rows: DataFrame, report: DataFrame, domains: list | None = None, scale: int = 1) -> DataFrame:
    """The months of the selected rows with projected cash from the whole report, 0 where there is none."""
    matrix = evolution(report, domains, scale)
    months = rows.select("corte").distinct()
    filled = [F.coalesce(F.col(d), F.lit(0)).alias(d) for d in matrix.columns if d != "corte"]
    return months.join(matrix, "corte", "left").select("corte", *filled)


def top_concepts(rows: DataFrame, n: int = TOP_CONCEPTS) -> DataFrame:
    """The n concepts with the largest projected sums by absolute value."""
    named = rows.filter((F.col("seccion") == PROJECTION) & (F.col("concepto") != ""))
    sums = named.groupBy("concepto").agg(F.sum("valor_ajustado").alias("total"))
    return sums.orderBy(F.abs("total").desc(), "concepto").limit(n)


def projected_amount(report: DataFrame, domain: str, corte: str) -> DataFrame:
    """One row with the projected cash of a domain and month, null when the report has none."""
    row = (F.col("dominio") == domain) & (F.col("corte") == corte) & _projected_here()
    return report.filter(row).agg(F.max("valor_ajustado").alias("caja_proyectada"))


def table_view(rows: DataFrame, scale: int = 1, digits: int = 3) -> DataFrame:
    concept = F.coalesce(F.nullif(F.col("concepto"), F.lit("")), F.lit("—"))
    return rows.select(
        "dominio", "corte", "seccion", concept.alias("concepto"),
        millions_text(F.col("valor_ajustado"), digits, scale).alias("valor"),
    )
