"""Report rows as searchable documents, field by field of the DOCUMENT schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.months import month_key
from quipu.schema import DOCUMENT

# Blocks that a section's name may show, first match first.
_BLOCKS = ["CAJA_ACTUAL", "PROYECCION"]


def _is_total() -> Column:
    return F.col("concepto") == ""


def record_class() -> Column:
    return F.when(_is_total(), "TOTAL").otherwise("DETALLE")


def block_class() -> Column:
    """The first block whose name the section shows; projected-cash sections show neither."""
    return F.coalesce(*[F.when(F.contains("seccion", F.lit(b)), b) for b in _BLOCKS], F.lit("OTRO"))


def is_future(as_of=None) -> Column:
    return F.coalesce(F.col("corte") >= month_key(as_of), F.lit(False))


def units(scale: int = 1) -> Column:
    """Amount in currency units; ``scale`` is the number of ledger units in one (100 for cents)."""
    return F.col("valor_ajustado").cast("decimal(28,2)") / F.lit(scale).cast("decimal(10,0)")


def sentence(scale: int = 1) -> Column:
    """One sentence per row, of those facts that have a text; a null amount gives a null sentence."""
    # The wording of a sentence.
    facts = {
        "Dominio financiero": F.col("dominio"),
        "Periodo": F.col("corte"),
        "Sección": F.col("seccion"),
        "Concepto": F.nullif(F.col("concepto"), F.lit("")),
        "Tipo registro": record_class(),
        "Valor calculado": F.format_number(units(scale), 0),
    }
    return F.when(F.col("valor_ajustado").isNotNull(), F.concat_ws(". ", *[F.concat(F.lit(f"{k}: "), v) for k, v in facts.items()]))


def documents(report: DataFrame, as_of=None, scale: int = 1) -> DataFrame:
    """valor and texto are both in currency units."""
    made = {
        "id": F.concat_ws("_", "dominio", "corte", "seccion", "concepto"),
        "categoria_bloque": block_class(),
        "tipo_registro": record_class(),
        "es_futuro": is_future(as_of),
        "valor": units(scale),
        "texto": sentence(scale),
    }
    return report.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields])
