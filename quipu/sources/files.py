"""Report, document and ledger files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.operators.report import ordered_report
from quipu.schema import DOCUMENT, SECTION

_CSV = T.StructType([T.StructField(c, T.StringType()) for c in SECTION])


def read_key_text_ledger(rows: DataFrame) -> DataFrame:
    """A ledger with key texts Dominio-Corte and Tipo-Concepto, with real dominio and corte columns."""
    renamed = rows.withColumnsRenamed({c: c.replace("-", "_") for c in rows.columns if "-" in c})
    key = F.split("Dominio_Corte", "#")
    return renamed.withColumn("dominio", F.get(key, 0)).withColumn("corte", F.get(key, 1))


def write_report_csv(report: DataFrame, path: str) -> None:
    """Sorted CSV with a header. Part files follow each other in report order; a small report is one file."""
    ordered_report(report).select(*SECTION).write.mode("overwrite").option("header", True).csv(path)


def leading_number(text: Column) -> Column:
    """Number at the start of a text, 0 when there is none."""
    digits = F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """Report rows from CSV: fields trimmed, unreadable amounts 0, rows without a domain dropped."""
    rows = spark.read.option("header", True).option("escape", '"').schema(_CSV).csv(path)
    texts = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in SECTION[:-1]}
    return rows.withColumns({**texts, "valor_ajustado": leading_number(F.col("valor_ajustado"))}).filter(
        F.col("dominio") != ""
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are left out."""
    documents.write.mode("overwrite").json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents from JSON lines; blank lines are skipped."""
    return spark.read.schema(DOCUMENT).json(path)
